"""Every pair operator gives the same answer when each group is split as far
as it goes (chunk=1, a hot-group worst case) as when no group is split."""

import pytest

from conftest import SF001
from pickwise.operators import collaborative as cf
from pickwise.operators import content as ct
from pickwise.sources import tables as src


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


CASES = {
    "user_cf_jaccard": lambda s, c: cf.user_cf(src.interactions(s, SF001), k=5, metric="jaccard", chunk=c),
    "adjusted_cosine": lambda s, c: cf.adjusted_cosine(src.ratings(s, SF001), k=5, chunk=c),
    "pair_rules": lambda s, c: cf.pair_rules(src.load(s, SF001, "lineitem"), 1, chunk=c),
    "tag_similar": lambda s, c: ct.tag_similar(src.catalog(s, SF001), 5, chunk=c),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_split_groups_change_nothing(spark, name):
    build = CASES[name]
    assert _rows(build(spark, 1)) == _rows(build(spark, 4096))


LARGE = {
    "user_cf": lambda s, m: cf.user_cf(src.interactions(s, SF001), k=5, most=m),
    "user_pearson": lambda s, m: cf.user_pearson(src.ratings(s, SF001), 3, most=m),
    "slope_one_devs": lambda s, m: cf.slope_one_devs(src.ratings(s, SF001), most=m),
}


@pytest.mark.parametrize("name", sorted(LARGE))
def test_large_rows_apart_change_nothing(spark, name):
    """Rows of over 35 terms meet the others in a join instead of a block."""
    build = LARGE[name]
    assert _rows(build(spark, 35)) == _rows(build(spark, 1 << 20))
