"""Sequence queries (Q-rows)."""

from __future__ import annotations

from pickwise.operators import sequence as sq
from pickwise.plans import sqlparts as q
from pickwise.plans.registry import register
from pickwise.sources import tables as src

SESS = """e0 AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
  CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
         OR ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE
       THEN 1 ELSE 0 END AS st FROM events),
s AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sn FROM e0)"""


@register("q1_sessions", f"""WITH {SESS}
SELECT user_id, CAST(sn AS BIGINT) AS session_no, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS events
FROM s GROUP BY user_id, sn""")
def q1_sessions(spark, sf_dir):
    return sq.sessions(src.load(spark, sf_dir, "events"), 30)


@register("q2_next_item", f"""WITH e AS (
  SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         lead(CAST(json_extract_string(props, '$.k') AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_id
  FROM events),
cnt AS (SELECT item_id, next_id, count(*) AS n FROM e WHERE next_id IS NOT NULL AND item_id IS NOT NULL GROUP BY 1, 2),
tot AS (SELECT item_id, sum(n) AS total FROM cnt GROUP BY 1)
SELECT cnt.item_id, next_id, n, {q.r6('n / total')} AS p FROM cnt JOIN tot ON tot.item_id = cnt.item_id""")
def q2_next_item(spark, sf_dir):
    return sq.next_item(src.load(spark, sf_dir, "events"))


def _first(step, after=None):
    cond = f"event_type = '{step}'"
    join = ""
    if after:
        join = (f" JOIN {after} ON {after}.user_id = s.user_id AND {after}.sn = s.sn"
                f" AND (s.ts > {after}.fts OR (s.ts = {after}.fts AND s.event_id > {after}.fe))")
    return f"""{step} AS (SELECT user_id, sn, ts AS fts, event_id AS fe FROM (
  SELECT s.user_id, s.sn, s.ts, s.event_id,
         row_number() OVER (PARTITION BY s.user_id, s.sn ORDER BY s.ts, s.event_id) AS r
  FROM s{join} WHERE {cond}) WHERE r = 1)"""


@register("q3_funnel", f"""WITH {SESS}, {_first('view')}, {_first('click', 'view')}, {_first('purchase', 'click')}
SELECT (SELECT count(*) FROM (SELECT DISTINCT user_id, sn FROM s)) AS sessions,
       (SELECT count(*) FROM view) AS n_view, (SELECT count(*) FROM click) AS n_click,
       (SELECT count(*) FROM purchase) AS n_purchase""")
def q3_funnel(spark, sf_dir):
    return sq.funnel(src.load(spark, sf_dir, "events"), 30)


@register("q4_user_features", f"""WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id FROM events),
agg AS (SELECT user_id, count(*) AS events, min(ts) AS first_ts, max(ts) AS last_ts,
               count(DISTINCT CAST(ts AS DATE)) AS active_days FROM e GROUP BY 1),
l3 AS (SELECT user_id, list(item_id ORDER BY r) AS last_items FROM (
         SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM e)
       WHERE r <= 3 GROUP BY 1)
SELECT agg.user_id, events, date_diff('day', CAST(last_ts AS DATE), DATE '2024-01-31') AS recency_days,
       CASE WHEN events > 1 THEN {q.r6("date_diff('microsecond', first_ts, last_ts) / 1e6 / (events - 1)")} END AS mean_gap_s,
       active_days, last_items
FROM agg JOIN l3 ON l3.user_id = agg.user_id""")
def q4_user_features(spark, sf_dir):
    return sq.user_features(src.load(spark, sf_dir, "events"), "2024-01-31")


ROLL = "ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW"


@register("q4_rolling_value", f"""SELECT user_id, event_id, roll_cents, roll_n,
  {q.r6('roll_cents / 100.0 / roll_n')} AS roll_mean FROM (
  SELECT user_id, event_id,
         CAST(sum(CAST(floor(value * 100.0 + 0.5) AS BIGINT)) OVER (PARTITION BY user_id {ROLL}) AS BIGINT) AS roll_cents,
         count(*) OVER (PARTITION BY user_id {ROLL}) AS roll_n
  FROM events)""")
def q4_rolling_value(spark, sf_dir):
    return sq.rolling_value(src.load(spark, sf_dir, "events"), 5)
