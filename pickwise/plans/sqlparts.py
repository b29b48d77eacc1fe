"""DuckDB SQL fragments (CTEs) mirroring the Spark shapes, for the oracles."""

INTER = """inter AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id, count(*) AS n,
         sum(l_quantity) AS w, max(o_orderdate) AS last_ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_custkey, l_partkey)"""

RATING_EVENTS = """rev AS (
  SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         CAST(least(5, 1 + floor(value / 40.0)) AS INTEGER) AS rating,
         ts, event_id, event_type
  FROM events)"""

RATINGS = RATING_EVENTS + """,
ratings AS (
  SELECT user_id, item_id, rating, ts, event_id FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY ts DESC, event_id DESC) AS rn
    FROM rev WHERE item_id IS NOT NULL) WHERE rn = 1)"""


def m6(expr: str) -> str:
    return f"CAST(floor(({expr}) * 1e6 + 0.5) AS BIGINT)"


def r6(expr: str) -> str:
    return f"CAST(floor(({expr}) * 1e6 + 0.5) / 1e6 AS DOUBLE)"


def item_cf(k: int, iuf: bool = False, src: str = "inter", name: str = "nb") -> str:
    """Item-item cosine top k (C1 / C2) over ``src`` (user_id, item_id)."""
    wt = "1.0 / ln(1.0 + ul.m)" if iuf else "1"
    return f"""{name}_cnt AS (SELECT item_id, count(*) AS n FROM {src} GROUP BY item_id),
{name}_ul AS (SELECT user_id, count(*) AS m FROM {src} GROUP BY user_id),
{name}_pr AS (
  SELECT x.item_id AS a, y.item_id AS b, count(*) AS support, sum({wt}) AS num
  FROM {src} x JOIN {src} y ON x.user_id = y.user_id AND x.item_id < y.item_id
  JOIN {name}_ul ul ON ul.user_id = x.user_id
  GROUP BY 1, 2),
{name}_sc AS (
  SELECT a, b, support, {m6('num / sqrt(ca.n * cb.n)')} AS score
  FROM {name}_pr JOIN {name}_cnt ca ON ca.item_id = a JOIN {name}_cnt cb ON cb.item_id = b),
{name}_dir AS (SELECT a AS id, b AS other, support, score FROM {name}_sc
               UNION ALL SELECT b, a, support, score FROM {name}_sc),
{name} AS (
  SELECT * FROM (SELECT id, other, support, score,
    CAST(row_number() OVER (PARTITION BY id ORDER BY score DESC, other) AS BIGINT) AS rank
    FROM {name}_dir) WHERE rank <= {k})"""


def top_n(src: str, n: int, source: str) -> str:
    """Final SELECT of R1 over ``src`` (user_id, item_id, score)."""
    return f"""SELECT user_id, item_id, CAST(score AS BIGINT) AS score, rank, '{source}' AS source
FROM (SELECT user_id, item_id, score,
      CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS BIGINT) AS rank
      FROM {src}) WHERE rank <= {n}"""


def unseen(src: str, seen: str = "inter") -> str:
    return (f"(SELECT * FROM {src} c WHERE NOT EXISTS (SELECT 1 FROM {seen} s "
            f"WHERE s.user_id = c.user_id AND s.item_id = c.item_id))")


SPLIT_LAST = """marked AS (
  SELECT *, CASE WHEN count(*) OVER (PARTITION BY user_id) > 1
              AND row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
             THEN 'test' ELSE 'train' END AS split FROM ratings),
train AS (SELECT user_id, item_id, rating, ts, event_id FROM marked WHERE split = 'train'),
test AS (SELECT user_id, item_id, rating, ts, event_id FROM marked WHERE split = 'test')"""


def cand_recs(seen: str, nb: str = "nb", n: int = 10, name: str = "recs") -> str:
    """Candidate sums over neighbor lists (C6) and the top-n list as CTEs."""
    return f"""{name}_cand AS (SELECT t.user_id, {nb}.other AS item_id, sum({nb}.score) AS score
    FROM {seen} t JOIN {nb} ON {nb}.id = t.item_id GROUP BY 1, 2),
{name}_un AS {unseen(name + '_cand', seen)},
{name} AS (SELECT * FROM (SELECT user_id, item_id, CAST(score AS BIGINT) AS score,
    CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS BIGINT) AS rank,
    'item_cf' AS source FROM {name}_un) WHERE rank <= {n})"""


# The flagship chain (interactions -> item cosine, 20 neighbors -> 10 recs) as CTEs.
FLAGSHIP = f"{INTER}, {item_cf(20)}, {cand_recs('inter')}"
# The movie chain: ratings -> leave-last-out -> item cosine on train -> 10 recs.
RATING_FLOW = f"{RATINGS}, {SPLIT_LAST}, {item_cf(20, src='train')}, {cand_recs('train')}"
