"""A third of all rows on one key: the joins to per-key aggregates are cut there."""

import datetime as dt

import pytest

from pickwise.operators import collaborative as cf
from pickwise.operators import content as ct
from pickwise.operators import prep
from pickwise.operators.pairs import co_pairs

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def small_pieces(spark):
    old = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_ratings(spark, n=6000):
    """User 0 and item 0 each hold a third of the rows."""
    day = dt.datetime(2024, 1, 1)
    rows = [(0 if i % 3 == 0 else 1 + i % 500, 0 if i % 3 == 1 else i, 1 + i % 5, day + dt.timedelta(minutes=i), i)
            for i in range(n)]
    return spark.createDataFrame(rows, "user_id long, item_id long, rating int, ts timestamp_ntz, event_id long").repartition(8)


def hot_articles(spark, n=3000):
    rows = [(i, "the same words in many texts" if i % 3 == 0 else f"the words of text {i}") for i in range(n)]
    return spark.createDataFrame(rows, "item_id long, text string").repartition(8)


CASES = {
    "leave_last_out": lambda s: prep.mark_last(hot_ratings(s)),
    "min_support": lambda s: prep.min_support(hot_ratings(s), 1, 1, 1),
    "bias": lambda s: cf.bias_baseline(hot_ratings(s))[2],
    "pair_sizes": lambda s: co_pairs(hot_ratings(s, 3000), "user_id", "item_id", chunk=64),
    "copy_groups": lambda s: ct.copy_groups(hot_articles(s)),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_hot_key_is_split(small_pieces, name):
    df = CASES[name](small_pieces)
    assert df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_partitions_grow_with_the_table(spark, monkeypatch):
    """Shuffles of a larger table have more partitions, so a task's share does not grow."""
    from conftest import SF001
    from pickwise.operators import skew
    from pickwise.sources import tables as src
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(name, None)
    try:
        monkeypatch.setattr(skew, "ROOM", 1000)
        src.interactions(spark, SF001)
        assert int(spark.conf.get(name)) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def test_joined_partitions_stay_small(spark):
    """Adaptive execution may not join shuffle partitions to more than SHARE; a lower setting stays."""
    from conftest import SF001
    from pickwise.operators import skew
    from pickwise.sources import tables as src
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name, None)
    try:
        spark.conf.set(name, "64m")
        src.interactions(spark, SF001)
        assert int(spark.conf.get(name)) == skew.SHARE
        spark.conf.set(name, "4k")
        src.catalog(spark, SF001)
        assert spark.conf.get(name) == "4k"
    finally:
        spark.conf.set(name, before)
