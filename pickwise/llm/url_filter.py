"""URL filters by a temporal list join, in DataFrame functions alone.

Dated list entries (added, removed) become validity intervals.  Every capture is then
joined as of its fetch time to the entries that were active, by its host, each parent
domain of it, and its address without query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from pickwise.llm.common import written


def host_of(url):
    """Lower-case host without user and port; null without scheme and host."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def address_of(url):
    """Host and path without a slash at the end; no scheme, user, port, query or fragment."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.concat(host_of(url), F.regexp_replace(path, "/+$", ""))


def intervals(entries: DataFrame) -> DataFrame:
    """(kind, pattern, valid_from, valid_to) from dated entries (kind, pattern, action, at).

    ``action`` is add or remove.  An add holds until the pattern's next remove (valid_to
    null: still listed); adds while listed change nothing.  At one time a remove wins
    over an add.  Entries with a null field or another action are ignored.
    """
    moves = (entries.filter(F.col("kind").isNotNull() & F.col("pattern").isNotNull() & F.col("at").isNotNull()
                            & F.col("action").isin("add", "remove"))
             .groupBy("kind", "pattern", "at").agg(F.max("action").alias("action")))  # "remove" > "add"
    w = Window.partitionBy("kind", "pattern").orderBy("at")
    turns = (moves.withColumn("was", F.lag("action").over(w))
             .filter(F.col("was").isNull() | (F.col("was") != F.col("action"))))
    return (turns.withColumn("valid_to", F.lead("at").over(w)).filter("action = 'add'")
            .select("kind", "pattern", F.col("at").alias("valid_from"), "valid_to"))


def evaluate(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """For every capture (page_id, url, fetched_at): those, host, n_active, first_match, blocked.

    A capture matches a ``domain`` entry on its host or a parent domain, a ``host`` entry
    on its host, a ``url`` entry on its address, if valid_from <= fetched_at < valid_to.
    ``first_match`` is the longest matching pattern (ties: the greater text).  A null or
    hostless url and a null fetch time match nothing.  Repeated captures all return;
    other columns are ignored; an empty list blocks nothing.

    Captures are numbered and written once.  Only number, key and time meet the list: a
    sort-merge join of two plain shuffles, so that nothing is broadcast however long the list,
    and a host that a third of the captures share is cut by adaptive execution.
    """
    rows = written(captures.select("page_id", "url", "fetched_at", host_of(F.col("url")).alias("host"),
                                   F.monotonically_increasing_id().alias("seq")))
    parts = F.split("host", r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(parts)),
                          lambda i: F.struct(F.lit("domain").alias("kind"),
                                             F.array_join(F.slice(parts, i, F.size(parts)), ".").alias("pattern")))
    own = F.array(F.struct(F.lit("host").alias("kind"), F.col("host").alias("pattern")),
                  F.struct(F.lit("url").alias("kind"), address_of(F.col("url")).alias("pattern")))
    asked = (rows.filter(F.col("host").isNotNull() & F.col("fetched_at").isNotNull())
             .select("seq", "fetched_at", F.explode(F.concat(domains, own)).alias("k"))
             .select("seq", "fetched_at", "k.kind", "k.pattern"))
    valid = written(intervals(entries)).hint("merge")
    hit = (asked.join(valid, ["kind", "pattern"])
           .filter((F.col("valid_from") <= F.col("fetched_at"))
                   & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to")))))
    longest = F.max(F.struct(F.length("pattern"), F.col("pattern").alias("p")))["p"]
    found = hit.groupBy("seq").agg(F.count(F.lit(1)).alias("n_active"), longest.alias("first_match"))
    active = F.coalesce("n_active", F.lit(0))
    return (rows.join(found.hint("merge"), "seq", "left")
            .select("page_id", "url", "fetched_at", "host", active.alias("n_active"), "first_match",
                    (active > 0).alias("blocked")))
