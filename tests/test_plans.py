"""No registered batch query plans a product of two tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from conftest import SF001  # noqa: E402


@pytest.fixture(scope="module")
def plans(spark):
    from plan_check import audit
    return audit(spark, SF001)


def test_no_cross_products(plans):
    assert len(plans) >= 60
    assert {n: r["forbidden"] for n, r in plans.items() if r["forbidden"]} == {}


def test_flagship_uses_partial_top_k(plans):
    for name in ("c1_item_cosine", "c6_item_cf_recs", "t2_keywords", "t3_related"):
        assert plans[name]["group_limits"] >= 2, name
