"""Streaming queries (X-rows): each runs its stream over the events table to
the end of the input and returns the result as a batch DataFrame."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pickwise.plans.registry import register
from pickwise.streaming import live


@register("x1_stream_counts", """SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n
FROM events GROUP BY 1, 2""")
def x1_stream_counts(spark, sf_dir):
    return live.run_upserts(live.stream_counts(live.event_stream(spark, sf_dir)), "x1",
                            ["window_start", "event_type"])


@register("x2_stream_trending", """WITH w AS (
  SELECT date_trunc('hour', ts) - to_hours(CAST(unnest(range(0, 6)) AS BIGINT)) AS window_start,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id FROM events),
c AS (SELECT window_start, item_id, count(*) AS n FROM w WHERE item_id IS NOT NULL GROUP BY 1, 2)
SELECT window_start, item_id, n, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY n DESC, item_id) AS BIGINT) AS rank FROM c)
WHERE rank <= 3""")
def x2_stream_trending(spark, sf_dir):
    counts = live.run_upserts(live.stream_trending(live.event_stream(spark, sf_dir)), "x2",
                              ["window_start", "item_id"])
    w = Window.partitionBy("window_start").orderBy(F.col("n").desc(), F.col("item_id").asc())
    return (counts.withColumn("rank", F.row_number().over(w).cast("bigint"))
            .where(F.col("rank") <= 3))


@register("x3_stream_sessions", """WITH e AS (
  SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
                             OR ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE
                           THEN 1 ELSE 0 END AS st, event_id FROM events),
s AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sn FROM e)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events
FROM s GROUP BY user_id, sn HAVING max(ts) + INTERVAL 30 MINUTE <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def x3_stream_sessions(spark, sf_dir):
    """The sessions that have ended by the last watermark."""
    return live.run_append(live.stream_sessions(live.event_stream(spark, sf_dir)), "x3")


@register("x4_stream_dedup", """WITH e AS (
  SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id, ts FROM events),
l AS (SELECT *, lag(ts) OVER w AS was, lead(ts) OVER w AS next FROM e
      WINDOW w AS (PARTITION BY user_id, event_type, item_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(CASE WHEN was IS NULL OR ts >= was + INTERVAL 1 HOUR THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id, event_type, item_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM l),
c AS (SELECT *, max(ts) OVER (PARTITION BY user_id, event_type, item_id, run) + INTERVAL 1 HOUR AS run_end FROM r)
SELECT event_id, user_id, event_type, item_id, ts FROM c
WHERE (was IS NULL OR ts >= was + INTERVAL 1 HOUR)
  AND run_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def x4_stream_dedup(spark, sf_dir):
    return live.run_append(live.stream_dedup(live.event_stream(spark, sf_dir)), "x4")


@register("x5_view_to_purchase", """WITH v AS (SELECT user_id, event_id, ts FROM events WHERE event_type = 'view'),
p AS (SELECT user_id, event_id, ts FROM events WHERE event_type = 'purchase')
SELECT v.user_id, v.event_id AS view_id, p.event_id AS purchase_id FROM v JOIN p
ON v.user_id = p.user_id AND p.ts >= v.ts AND p.ts <= v.ts + INTERVAL 1 HOUR""")
def x5_view_to_purchase(spark, sf_dir):
    j = live.stream_view_to_purchase(live.event_stream(spark, sf_dir), live.event_stream(spark, sf_dir))
    return live.run_append(j, "x5")


@register("x6_stream_profile", """SELECT user_id, count(*) AS events,
  count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
  sum(coalesce(CAST(round(value * 100) AS BIGINT), 0))::BIGINT AS value_cents, max(ts) AS last_ts
FROM events GROUP BY user_id""")
def x6_stream_profile(spark, sf_dir):
    rows = live.run_upserts(live.stream_profile(live.event_stream(spark, sf_dir)), "x6", ["user_id"])
    return rows.withColumn("last_ts", live.ntz_of("last_ts"))
