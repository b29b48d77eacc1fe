"""Hand-made fixtures of FIXTURES.md; expected values are worked out by hand
in the tests from the formulas, not from the code."""

import datetime as dt

INTER_SCHEMA = "user_id bigint, item_id bigint, n bigint, w double, last_ts timestamp_ntz"
RATINGS_SCHEMA = "user_id bigint, item_id bigint, rating int, ts timestamp_ntz, event_id bigint"
T0 = dt.datetime(2024, 1, 1)


def tiny_inter(spark):
    # u1: 1,2,3  u2: 1,2  u3: 2,3,4  u4: 5   (4 users, 5 items, 9 pairs)
    pairs = [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (3, 2), (3, 3), (3, 4), (4, 5)]
    rows = [(u, i, 1, float(u + i), T0 + dt.timedelta(days=u * 10 + i)) for u, i in pairs]
    return spark.createDataFrame(rows, INTER_SCHEMA)


def tiny_ratings(spark):
    # u1 5,3,4 / u2 4,2,3 (u1 shifted by one) / u3 all 3 / u4 a single rating / u5 one item
    r = [(1, 1, 5), (1, 2, 3), (1, 3, 4), (2, 1, 4), (2, 2, 2), (2, 3, 3),
         (3, 1, 3), (3, 2, 3), (3, 3, 3), (4, 4, 2), (5, 1, 4)]
    rows = [(u, i, y, T0 + dt.timedelta(hours=k), 100 + k) for k, (u, i, y) in enumerate(r)]
    return spark.createDataFrame(rows, RATINGS_SCHEMA)


def tiny_docs(spark):
    rows = [(1, "The cat sat on the mat", "en"), (2, "The cat sat on the mat", "en"),
            (3, None, "en"), (4, "", "en"), (5, "!!! ... ???", "en"),
            (6, "the cat sat on a mat", "en")]
    return spark.createDataFrame(rows, "item_id bigint, text string, lang string") \
        .selectExpr("item_id", "cast(null as array<string>) as tags", "text", "lang")


def planted_rank2(spark, seed=7):
    import numpy as np
    rng = np.random.default_rng(seed)
    u = rng.uniform(0.5, 1.5, size=(60, 2))
    v = rng.uniform(0.5, 1.5, size=(40, 2))
    y = u @ v.T
    rows = [(int(a), int(b), float(y[a, b]), T0, int(a * 40 + b))
            for a in range(60) for b in range(40) if (a * 7 + b * 3) % 4 != 0]
    return spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double, ts timestamp_ntz, event_id bigint")


def late_events():
    """Eight events in three files, one micro-batch each.  After the first
    file the watermark is 11:50 (max event time 12:00 minus 10 minutes); the
    second file's batch runs under it and evicts the closed 10:00-11:00
    window; the third file's 10:30 and 10:50 events are then late."""
    mk = lambda i, h, m, t="view": (i, dt.datetime(2024, 1, 1, h, m), 1, t, 1.0, '{"k": 1}')
    first = [mk(1, 10, 5), mk(2, 10, 40), mk(3, 11, 15, "click"), mk(4, 11, 55), mk(5, 12, 0)]
    second = [mk(6, 12, 5)]
    third = [mk(7, 10, 30), mk(8, 10, 50, "click")]
    return first, second, third
