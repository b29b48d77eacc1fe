"""Q1-Q4: sessions, next-item transitions, funnels and history features.

Per-user order is taken from one global sort by (user, ts, event_id) instead
of a window partitioned by user, so a user holding a third of all events is
spread over many range buckets: previous/next rows are joined on the global
rank and running values are bucket scans with carried totals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickwise.functions.scores import r6
from pickwise.operators.ordering import global_rank, neighbor_rows, running
from pickwise.operators.skew import loose


def item_events(events: DataFrame) -> DataFrame:
    """Events with the item id parsed from props."""
    return events.select("event_id", "ts", "user_id", "event_type", "value",
                         F.get_json_object("props", "$.k").cast("bigint").alias("item_id"))


def _ordered(events: DataFrame, cols: list[str]) -> DataFrame:
    ev = events.select("user_id", "ts", "event_id", *cols)
    return global_rank(ev, [F.col("user_id").asc(), F.col("ts").asc(), F.col("event_id").asc()],
                       "g", keep_bucket=True)


def session_events(events: DataFrame, gap_minutes: int = 30, cols: tuple[str, ...] = ()) -> DataFrame:
    """Every event with ``sg``, the global rank of its session's first event.

    A new session starts at a user's first event and after any gap longer
    than ``gap_minutes``.
    """
    r = _ordered(events, list(cols))
    p = neighbor_rows(r, "user_id", ["ts"], step=-1)
    gap = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(gap_minutes))
    start = F.col("prev_ts").isNull() | (F.col("ts") > F.col("prev_ts") + gap)
    flagged = p.withColumn("is_start", start.cast("int"))
    return running(flagged, F.when(F.col("is_start") == 1, F.col("g")), "sg", how="max")


def sessions(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """Q1: one row per session: user_id, session_no (1.. per user), start_ts,
    end_ts, events."""
    se = session_events(events, gap_minutes)
    per = se.groupBy("user_id", "sg").agg(F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"),
                                          F.count(F.lit(1)).alias("events"))
    # session number = rank of the session start among the user's session starts
    starts = se.where(F.col("is_start") == 1).select("user_id", "g", "_bucket")
    cnt = running(starts.select("user_id", "g", "_bucket"), F.lit(1), "k", how="sum")
    first = cnt.groupBy("user_id").agg(F.min("k").alias("k0"))
    no = cnt.join(loose(first), "user_id").select(F.col("g").alias("sg"),
                                           (F.col("k") - F.col("k0") + F.lit(1)).cast("bigint").alias("session_no"))
    return per.join(no, "sg").select("user_id", "session_no", "start_ts", "end_ts", "events")


def next_item(events: DataFrame) -> DataFrame:
    """Q2: P(next item | item) from consecutive events of each user by
    (ts, event_id): count of (item, next) over all transitions from item."""
    r = _ordered(item_events(events), ["item_id"])
    n = neighbor_rows(r, "user_id", ["item_id"], step=1, prefix="next_")
    tr = n.where(F.col("next_item_id").isNotNull() & F.col("item_id").isNotNull())
    cnt = tr.groupBy("item_id", F.col("next_item_id").alias("next_id")).agg(F.count(F.lit(1)).alias("n"))
    tot = cnt.groupBy("item_id").agg(F.sum("n").alias("total"))
    return cnt.join(loose(tot), "item_id").select("item_id", "next_id", "n",
                                           r6(F.col("n") / F.col("total")).alias("p"))


def funnel(events: DataFrame, gap_minutes: int = 30,
           steps: tuple[str, ...] = ("view", "click", "purchase")) -> DataFrame:
    """Q3: sessions reaching each step of ``steps`` in order (each step after
    the previous one within the session, by (ts, event_id))."""
    # every step reads the sessions: they are found once
    se = session_events(events, gap_minutes, cols=("event_type",)).checkpoint(eager=True)
    at = F.struct("ts", "event_id")
    reached = se.select("sg").distinct()
    out = [F.count(F.lit(1)).alias("sessions")]
    prev = None
    counts = reached.select("sg")
    for i, step in enumerate(steps):
        ev = se.where(F.col("event_type") == step).select("sg", at.alias("at"))
        if prev is not None:
            ev = ev.join(prev, "sg").where(F.col("at") > F.col("prev_at")).select("sg", "at")
        first = ev.groupBy("sg").agg(F.min("at").alias(f"s{i}"))
        counts = counts.join(first, "sg", "left")
        prev = first.select("sg", F.col(f"s{i}").alias("prev_at"))
        out.append(F.count(f"s{i}").alias(f"n_{step}"))
    return counts.agg(*out)


def user_features(events: DataFrame, ref) -> DataFrame:
    """Q4: per user recency in days, mean gap in seconds between consecutive
    events ((last - first) / (n - 1)), active days and the last three items.

    The last three items come from a top-3 per user (a partial group limit
    runs before the shuffle, so a heavy user sends three rows per task)."""
    ev = item_events(events)
    agg = ev.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("events"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        F.count_distinct(F.to_date("ts")).alias("active_days"))
    secs = F.expr("timestampdiff(MICROSECOND, first_ts, last_ts)") / F.lit(1e6)
    w = Window.partitionBy("user_id").orderBy(F.col("ts").desc(), F.col("event_id").desc())
    last3 = (ev.withColumn("r", F.row_number().over(w)).where(F.col("r") <= 3)
             .groupBy("user_id")
             .agg(F.array_sort(F.collect_list(F.struct("r", "item_id"))).alias("l"))
             .select("user_id", F.transform("l", lambda x: x["item_id"]).alias("last_items")))
    return agg.join(last3, "user_id").select(
        "user_id", "events",
        F.datediff(F.lit(ref).cast("date"), F.to_date("last_ts")).cast("bigint").alias("recency_days"),
        F.when(F.col("events") > 1, r6(secs / (F.col("events") - F.lit(1)))).alias("mean_gap_s"),
        F.col("active_days").cast("bigint").alias("active_days"), "last_items")


def rolling_value(events: DataFrame, k: int = 5) -> DataFrame:
    """Q4 rolling values: per event, the sum of ``value`` over the user's last
    k events (the current one included) in exact integer cents, the number of
    events in that window and their mean.

    The sum is a difference of global prefix sums: P(g) - P(g - k) when row
    g - k belongs to the same user, else P(g) - (the user's total before their
    first event).  P comes from the bucketed running sum and P(g - k) from an
    equi-join on the rank, so no user's history is sorted in one task.
    """
    r = _ordered(events, ["value"]).withColumn(
        "cents", F.floor(F.col("value") * F.lit(100.0) + F.lit(0.5)).cast("bigint"))
    p = running(r, F.col("cents"), "P", how="sum")
    back = neighbor_rows(p, "user_id", ["P"], step=-k, prefix="back_")
    first = p.groupBy("user_id").agg(F.min(F.struct("g", (F.col("P") - F.col("cents")).alias("base")))
                                     .alias("f"))
    j = back.join(loose(first), "user_id")
    roll = F.col("P") - F.coalesce(F.col("back_P"), F.col("f.base"))
    cnt = F.least(F.lit(k), F.col("g") - F.col("f.g") + F.lit(1)).cast("bigint")
    return j.select("user_id", "event_id", roll.alias("roll_cents"), cnt.alias("roll_n"),
                    r6(roll / F.lit(100.0) / cnt).alias("roll_mean"))
