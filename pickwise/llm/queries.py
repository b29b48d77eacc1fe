"""The subpackage's queries, one per operator with its production parameters, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.llm import (exact_dedup, hard_negatives, lattice_lm, maxscore, mixing, periodic, sentencepiece_codec,
                          simhash, substring_dedup, suffix_dedup, token_blocks, toxicity, url_filter)
from pickwise.sources import load

QUERIES, ORACLES = {}, {}

#: the public vocabulary that operators 8 and 9 read; never copied
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return keep


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned from the labelled rows of the learning folds."""
    return toxicity.toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"), threshold=0.7)


@query("op2_exact_dedup", r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(text) AS text_sha256
FROM t WINDOW w AS (PARTITION BY text)
""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of equal texts; the largest doc_id stays."""
    return exact_dedup.exact_dedup(load(spark, sf_dir, "documents"), keep="largest")


@query("op3_substring_dedup", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
i AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d),
x AS (SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS x FROM i WHERE p + 12 <= len(w)),
s AS (SELECT x, min(doc_id) AS first FROM x GROUP BY x),
r AS (SELECT DISTINCT x.doc_id, x.p FROM x JOIN s USING (x) WHERE s.first < x.doc_id),
g AS (SELECT DISTINCT doc_id, p + o AS p FROM r, range(13) t(o)),
k AS (SELECT i.doc_id, count(g.p) AS n_removed,
             string_agg(CASE WHEN g.p IS NULL THEN i.w[i.p] END, ' ' ORDER BY i.p) AS kept
      FROM i LEFT JOIN g ON g.doc_id = i.doc_id AND g.p = i.p GROUP BY i.doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 13-word windows that a smaller doc_id has too."""
    return substring_dedup.substring_dedup(load(spark, sf_dir, "documents"), window=13)


@query("op4_simhash_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the component of fingerprints linked at two bits or fewer."""
    return simhash.simhash_groups(load(spark, sf_dir, "documents"), shingle_words=3, max_bits=2)


@query("op5_maxscore_top_k", r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda c: floor(1024 * c::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest integer inner products of every hundredth vector over all others."""
    return maxscore.search(load(spark, sf_dir, "embeddings"), k=10, every=100)


@query("op6_mixing", r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
                  coalesce(md5(doc_id::VARCHAR), '') AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER] AS w,
             3 * source_size AS most FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / w, source NULLS LAST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
                / (sum(w) OVER (ORDER BY most / w, source NULLS LAST
                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM w),
a AS (SELECT *, (SELECT level FROM l WHERE level * w <= most ORDER BY most / w, source NULLS LAST LIMIT 1) AS lev FROM l),
t AS (SELECT source, source_size, CASE WHEN lev IS NULL OR w * lev > most THEN most::DOUBLE ELSE w * lev END AS target FROM a),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, round(t.target)::BIGINT AS budget,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS copies FROM p),
c AS (SELECT *, greatest(0, least(size, budget - copies * source_size - ahead)) AS part FROM e)
SELECT doc_id, size, source_size, target, (copies * size + part)::BIGINT AS taken,
       copies::BIGINT AS copies, part::BIGINT AS part FROM c
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix(load(spark, sf_dir, "documents"), weights=(5, 2, 1), limit=3)


@query("op7_suffix_dedup", r"""
WITH h AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
d AS (SELECT *, length(x) // 2 AS n FROM h),
s AS (SELECT r, p, md5(substr(x, 2 * p - 1, 400)) AS k
      FROM (SELECT r, x, unnest(range(1, n - 198)) AS p FROM d WHERE n >= 200)),
c AS (SELECT r, p, count(*) OVER (PARTITION BY k) AS c FROM s),
g AS (SELECT r, p, CASE WHEN p > lag(p) OVER (PARTITION BY r ORDER BY p) + 200 THEN 1 ELSE 0 END AS new FROM c WHERE c > 1),
b AS (SELECT r, p, sum(new) OVER (PARTITION BY r ORDER BY p ROWS UNBOUNDED PRECEDING) AS span FROM g),
spans AS (SELECT r, min(p) AS a, max(p) + 199 AS z FROM b GROUP BY r, span),
cuts AS (SELECT r, a, z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS was FROM spans),
kept AS (SELECT r, count(*) AS n_spans, sum(z - a + 1)::BIGINT AS n_removed, max(z) AS last,
                string_agg(substr(x, 2 * was + 1, 2 * (a - was - 1)), '' ORDER BY a) AS k
         FROM cuts JOIN d USING (r) GROUP BY r)
SELECT d.doc_id, d.n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN k IS NULL THEN d.x ELSE k || substr(d.x, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 200-byte strings that start anywhere else too."""
    return suffix_dedup.suffix_dedup(load(spark, sf_dir, "documents"), window=200)


@query("op8_sentencepiece")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids (their number and digest) and whether they decode to its text."""
    docs = load(spark, sf_dir, "documents").withColumn("sha", F.sha2(F.coalesce("text", F.lit("")), 256))
    return (sentencepiece_codec.encode_texts(docs, PIECES, keep=("doc_id", "sha"), decoded=True)
            .select("doc_id", F.size("ids").cast("long").alias("n_ids"),
                    F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
                    F.sha2("decoded", 256).alias("decoded_sha256"), "sha")
            .select("doc_id", "n_ids", "ids_sha256", "decoded_sha256", (F.col("decoded_sha256") == F.col("sha")).alias("exact")))


@query("op9_lattice_lm")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base and lattice log10 probability, learned from four folds of five."""
    return lattice_lm.lm_scores(load(spark, sf_dir, "documents"), PIECES)


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as captures: the tables hold no fetch time, so each gets a second of 2024 by its id."""
    at = F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.col("page_id") * 7919, F.lit(31536000)))
    return load(spark, sf_dir, "pages").select("page_id", "url", at.alias("fetched_at"))


def dated_entries(pages: DataFrame) -> DataFrame:
    """A dated block list drawn from the pages' own hosts and addresses.

    Every third host by hash is listed as a domain or a host, every second parent of a host of
    three labels or more as a domain, every seventh address as a url; each is added,
    removed 90 days later, and added again after 60 more.
    """
    host, address = url_filter.host_of(F.col("url")), url_filter.address_of(F.col("url"))
    number = lambda c: F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("long")
    hosts = (pages.select(host.alias("pattern")).filter("pattern IS NOT NULL").distinct()
             .withColumn("n", number(F.col("pattern"))).filter("n % 3 = 0")
             .select(F.when(F.col("n") % 2 == 0, "domain").otherwise("host").alias("kind"), "pattern", "n"))
    parents = (pages.select(F.regexp_extract(host, r"^[^.]+\.(.+\..+)$", 1).alias("pattern")).filter("pattern != ''").distinct()
               .withColumn("n", number(F.col("pattern"))).filter("n % 2 = 0").select(F.lit("domain").alias("kind"), "pattern", "n"))
    urls = (pages.select(address.alias("pattern")).filter("pattern IS NOT NULL").distinct()
            .withColumn("n", number(F.col("pattern"))).filter("n % 7 = 0").select(F.lit("url").alias("kind"), "pattern", "n"))
    steps = F.explode(F.array(*[F.struct(F.lit(a).alias("action"), F.lit(d).alias("day"))
                                for a, d in (("add", 0), ("remove", 90), ("add", 150))])).alias("s")
    return (hosts.union(parents).union(urls).select("kind", "pattern", "n", steps)
            .select("kind", "pattern", "s.action",
                    F.timestamp_seconds(F.lit(1704067200) + (F.col("n") % 200 + F.col("s.day")) * 86400).alias("at")))


@query("op10_url_filter", r"""
WITH p AS (SELECT row_number() OVER () AS seq, page_id, url,
                  1704067200 + ((page_id * 7919) % 31536000 + 31536000) % 31536000 AS fetched_at,
                  nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host,
                  regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '') AS path FROM pages),
h AS (SELECT DISTINCT host AS pattern, ('0x' || substr(md5(host), 1, 8))::BIGINT AS n FROM p WHERE host IS NOT NULL),
d AS (SELECT DISTINCT regexp_extract(host, '^[^.]+\.(.+\..+)$', 1) AS pattern FROM p WHERE host IS NOT NULL),
u AS (SELECT DISTINCT host || path AS pattern, ('0x' || substr(md5(host || path), 1, 8))::BIGINT AS n FROM p WHERE host IS NOT NULL),
e AS (SELECT CASE WHEN n % 2 = 0 THEN 'domain' ELSE 'host' END AS kind, pattern, n FROM h WHERE n % 3 = 0
      UNION SELECT 'domain', pattern, ('0x' || substr(md5(pattern), 1, 8))::BIGINT FROM d
            WHERE pattern <> '' AND ('0x' || substr(md5(pattern), 1, 8))::BIGINT % 2 = 0
      UNION SELECT 'url', pattern, n FROM u WHERE n % 7 = 0),
v AS (SELECT kind, pattern, 1704067200 + (n % 200 + x.d) * 86400 AS f,
             CASE WHEN x.d = 0 THEN 1704067200 + (n % 200 + 90) * 86400 END AS t
      FROM e, (VALUES (0), (150)) x(d)),
m AS (SELECT p.seq, v.pattern FROM p JOIN v ON p.fetched_at >= v.f AND (v.t IS NULL OR p.fetched_at < v.t)
      AND ((v.kind = 'domain' AND (p.host = v.pattern OR ends_with(p.host, '.' || v.pattern)))
           OR (v.kind = 'host' AND p.host = v.pattern) OR (v.kind = 'url' AND p.host || p.path = v.pattern))),
g AS (SELECT seq, count(*) AS n, max(struct_pack(l := length(pattern), p := pattern)).p AS first_match FROM m GROUP BY seq)
SELECT page_id, url, fetched_at, host, coalesce(n, 0)::BIGINT AS n_active, first_match, coalesce(n, 0) > 0 AS blocked
FROM p LEFT JOIN g USING (seq)
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page against the list entries that were active when it was fetched (seconds since 1970)."""
    pages = captures(spark, sf_dir)
    return (url_filter.evaluate(pages, dated_entries(pages))
            .withColumn("fetched_at", F.unix_timestamp("fetched_at")))


@query("op11_token_blocks")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids as they stand in the written files: their place, number and crc32."""
    import public_tokenizers
    return token_blocks.token_file_digests(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in a tenth of the documents, by crc32 of the id, the words from a place on repeat themselves."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n, h = F.size("w").cast("long"), F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    a = g % n
    period = F.floor((n - F.col("a")) / (3 + g % 8)) + 1
    at = lambda i: F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))
    changed = F.concat(F.slice("w", F.lit(1), F.col("a").cast("int")),
                       F.transform(F.sequence(F.col("a"), n - 1), at))
    planted = (h % 10 == 0) & (F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", "")) > 0)
    plain = docs.select("doc_id", "text").filter(~F.coalesce(planted, F.lit(False)))
    made = (docs.select("doc_id", "text").filter(planted).withColumn("w", words).withColumn("a", a).withColumn("p", period)
            .select("doc_id", F.array_join(changed, " ").alias("text")))
    return plain.union(made)


@query("op12_periodic_runs", r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                  doc_id::VARCHAR AS s FROM documents),
h AS (SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(8 * length(s)),
                    lambda k: ((ascii(s[k // 8 + 1]) >> (k % 8)::INTEGER) & 1)::BIGINT)),
                    lambda c, b: xor(c >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384 ELSE 0 END))) AS h FROM d),
a AS (SELECT *, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM h),
p AS (SELECT *, 1 + (len(w) - a) // (3 + (h // 10) % 8) AS p FROM a),
t AS (SELECT r, doc_id, CASE WHEN a IS NULL THEN w ELSE
        list_transform(range(len(w)), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) END AS w FROM p),
i AS (SELECT r, unnest(range(len(w) - 5)) AS i, w FROM t WHERE len(w) >= 6),
x AS (SELECT r, i, md5(array_to_string(w[i + 1:i + 6], ' ')) AS x FROM i),
j AS (SELECT x.r, x.i, y.i - x.i AS q FROM x JOIN x y ON x.r = y.r AND x.x = y.x AND x.i < y.i),
g AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS g FROM j),
m AS (SELECT r, q, min(i) AS start, count(*) + 5 + q AS length FROM g GROUP BY r, q, g),
n AS (SELECT r, start, length::BIGINT AS length, min(q) AS period FROM m WHERE length >= greatest(12, 2 * q) GROUP BY r, start, length),
b AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs,
             min(struct_pack(l := -length, s := start, q := period)) AS best FROM n GROUP BY r),
z AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM n),
k AS (SELECT e.r, string_agg(e.w[e.i + 1], ' ' ORDER BY e.i) AS kept
      FROM (SELECT r, w, unnest(range(len(w))) AS i FROM t) e ANTI JOIN z ON z.r = e.r AND z.i = e.i GROUP BY e.r)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, -best.l AS length, best.q AS period,
       (1000 * -best.l) // best.q AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM t LEFT JOIN b USING (r) LEFT JOIN k USING (r)
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's periodic runs: the longest, and digests of all and of what is left without their repeats."""
    found = periodic.periodic_runs(with_planted_runs(load(spark, sf_dir, "documents")), least=12)
    best = F.array_min(F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"])))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return (found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        (-F.col("best.col1")).alias("length"), F.col("best.period").alias("period"),
        F.floor(-1000 * F.col("best.col1") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))


@query("op13_hard_negatives", r"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
             coalesce(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
      FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 10
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every hundredth vector and each of its best positives."""
    return hard_negatives.hard_negatives(load(spark, sf_dir, "embeddings"))
