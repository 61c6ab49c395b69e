"""Crawl-frontier queries on ``pages``, ``documents``/``labels`` and the
supplier-part graph of ``lineitem``."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import crawl as C
from ..session import table
from . import sqlfrag as S
from .registry import query

BLOCKED = ("example.net",)
# least number of tasks that tell supplier-part pairs apart
PAIR_PARTS = 200


def engine_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two engines' hit lists over the page URLs (overlapping)."""
    p = table(spark, sf_dir, "pages", "page_id", "url")
    a = p.where(F.col("url").startswith("https")).select(
        "url", F.lit(1).alias("engine_rank"), F.col("page_id").alias("hit_rank"))
    b = p.where(F.col("url").contains("blog.") | F.col("url").contains("//m.")).select(
        "url", F.lit(2).alias("engine_rank"), F.col("page_id").alias("hit_rank"))
    return a.unionByName(b)


HITS_SQL = """
SELECT url, 1 AS engine_rank, page_id AS hit_rank FROM pages WHERE starts_with(url, 'https')
UNION ALL
SELECT url, 2 AS engine_rank, page_id AS hit_rank FROM pages WHERE contains(url, 'blog.') OR contains(url, '//m.')
"""
UNION_SQL = f"""
SELECT url, arg_min(engine_rank, (engine_rank, hit_rank)) AS engine_rank,
       arg_min(hit_rank, (engine_rank, hit_rank)) AS hit_rank
FROM ({HITS_SQL}) GROUP BY url
"""


@query("frontier_union", UNION_SQL)
def frontier_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.frontier_union(engine_hits(spark, sf_dir))


# public suffixes of one label and two, a wildcard and an exception from it
SUFFIX_RULES = ("com", "net", "org", "example.com", "*.example.org", "!thertion.example.org")
_RULES_SQL = "(SELECT unnest([" + ", ".join(S.q(r) for r in SUFFIX_RULES) + "]) AS rule)"


@query("domain_filter", f"""
WITH u AS ({UNION_SQL}),
d AS (
  SELECT url, string_split(nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^@/?#]*@)?([^:/?#]*)', 1)), ''), '.') AS labels
  FROM u
), r AS (
  SELECT string_split(ltrim(rule, '!'), '.') AS labels, starts_with(rule, '!') AS exception FROM {_RULES_SQL}
), m AS (
  SELECT d.url, max({{'exception': r.exception, 'n': len(r.labels) - r.exception::INT}}) AS best FROM d JOIN r
    ON len(d.labels) >= len(r.labels) AND len(list_filter(r.labels, lambda x, i: x <> '*' AND x <> d.labels[len(d.labels) - len(r.labels) + i])) = 0
  GROUP BY d.url
), g AS (
  SELECT d.url, CASE WHEN len(d.labels) > m.best.n THEN array_to_string(list_slice(d.labels, len(d.labels) - m.best.n, len(d.labels)), '.') END AS domain
  FROM d LEFT JOIN m ON m.url = d.url
)
SELECT url, domain FROM g WHERE domain IS NULL OR domain NOT IN ('example.net')
""")
def domain_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = C.frontier_union(engine_hits(spark, sf_dir))
    rules = spark.range(1).select(F.explode(F.array(*[F.lit(r) for r in SUFFIX_RULES])).alias("rule"))
    return C.domain_filter(u, list(BLOCKED), rules=rules).select("url", "domain")


@query("relevance_gate", """
WITH s AS (
  SELECT d.lang, l.quality = 1 AS keep, n_chars % 100 AS pct
  FROM documents d JOIN labels l USING (doc_id)
), g AS (
  SELECT lang, count(*) FILTER (WHERE keep AND pct >= 40) AS collected,
         coalesce(sum(pct) FILTER (WHERE keep AND pct >= 40), 0) AS total_pct
  FROM s GROUP BY lang
)
SELECT lang, collected,
  CASE WHEN collected = 0 THEN 0.0
       ELSE CAST((total_pct * 2 + collected) // (2 * collected) AS DOUBLE) / 100 END AS avg_relevance
FROM g
""")
def relevance_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents", "doc_id", "lang", "n_chars")
    lab = table(spark, sf_dir, "labels", "doc_id", "quality")
    s = d.join(lab, "doc_id").select(
        "lang", (F.col("quality") == 1).alias("keep"),
        (F.col("n_chars") % 100).alias("pct"), ((F.col("n_chars") % 100) / 100).alias("score"))
    kept = s.withColumn("_g", C.gate(F.col("keep"), F.col("score")))
    g = kept.groupBy("lang").agg(
        F.count_if("_g").alias("collected"),
        F.coalesce(F.sum(F.when(F.col("_g"), F.col("pct"))), F.lit(0)).alias("total_pct"))
    avg = F.when(F.col("collected") == 0, F.lit(0.0)).otherwise(
        F.floor((F.col("total_pct") * 2 + F.col("collected")) / (2 * F.col("collected")))
        .cast("double") / 100)
    return g.select("lang", "collected", avg.alias("avg_relevance"))


def supplier_part_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undirected supplier-part graph of all line items as directed edges over
    numeric node ids (supplier k -> 2k, part k -> 2k + 1): pairs are
    deduplicated on two longs before doubling.  Each task holds a part of PAIR_PARTS of the pairs at most;
    adaptive execution would join parts up to one for each core."""
    li = table(spark, sf_dir, "lineitem", "l_suppkey", "l_partkey")
    parts = max(PAIR_PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pairs = (li.select((F.col("l_suppkey") * 2).alias("s"), (F.col("l_partkey") * 2 + 1).alias("p"))
             .repartition(parts, "s", "p").distinct())
    return pairs.select(F.explode(F.array(F.struct(F.col("s").alias("src"), F.col("p").alias("dst")),
                                          F.struct(F.col("p").alias("src"), F.col("s").alias("dst")))).alias("e")).select("e.*")


def node_name(node) -> F.Column:
    return F.concat(F.when(node % 2 == 0, F.lit("s")).otherwise(F.lit("p")),
                    F.floor(node / 2).cast("bigint").cast("string"))


@query("frontier_rounds", """
WITH RECURSIVE e AS (
  SELECT DISTINCT 's' || CAST(l_suppkey AS VARCHAR) AS src, 'p' || CAST(l_partkey AS VARCHAR) AS dst FROM lineitem
  UNION
  SELECT DISTINCT 'p' || CAST(l_partkey AS VARCHAR), 's' || CAST(l_suppkey AS VARCHAR) FROM lineitem
), b(node, depth) AS (
  SELECT 's1', 0
  UNION
  SELECT e.dst, b.depth + 1 FROM b JOIN e ON e.src = b.node WHERE b.depth < 12
)
SELECT node, CAST(min(depth) AS INTEGER) AS depth FROM b GROUP BY node
""")
def frontier_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes that supplier 1 reaches (the oracle's depth bound is far beyond the graph's)."""
    seeds = spark.range(1).select(F.lit(2).cast("bigint").alias("node"))  # supplier 1
    r = C.frontier_rounds(spark, supplier_part_edges(spark, sf_dir), seeds)
    return r.select(node_name(F.col("node")).alias("node"), "depth")


SCORED_SQL = """
SELECT 's' || CAST(s_suppkey AS VARCHAR) AS node, s_acctbal > 0 AS keep, (s_suppkey % 100) / 100.0 AS score FROM supplier
UNION ALL
SELECT 'p' || CAST(p_partkey AS VARCHAR), p_size > 10, (p_partkey % 100) / 100.0 FROM part
"""


@query("gated_rounds", f"""
WITH RECURSIVE l AS (
  SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem
), d AS (
  SELECT 's' || CAST(s AS VARCHAR) AS src, 'p' || CAST(p AS VARCHAR) AS dst,
         row_number() OVER (PARTITION BY s ORDER BY p) - 1 AS pos FROM l
  UNION ALL
  SELECT 'p' || CAST(p AS VARCHAR), 's' || CAST(s AS VARCHAR),
         row_number() OVER (PARTITION BY p ORDER BY s) - 1 FROM l
), e AS (SELECT src, dst FROM d WHERE pos < 5),
g AS (SELECT node FROM ({SCORED_SQL}) WHERE keep AND score >= 0.4),
b(node, depth) AS (
  SELECT 's' || CAST(s_suppkey AS VARCHAR), 0 FROM supplier
  UNION
  SELECT e.dst, b.depth + 1 FROM b JOIN g ON g.node = b.node JOIN e ON e.src = b.node WHERE b.depth < 2
)
SELECT node, CAST(min(depth) AS INTEGER) AS depth FROM b GROUP BY node
""")
def gated_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rounds from all suppliers: only nodes past the relevance gate are
    expanded, along the first five links of each."""
    seeds = table(spark, sf_dir, "supplier", "s_suppkey").select((F.col("s_suppkey") * 2).alias("node"))
    r = C.frontier_rounds(spark, C.first_links(page_edges(spark, sf_dir)), seeds, max_depth=2, scored=scored_nodes(spark, sf_dir))
    return r.select(node_name(F.col("node")).alias("node"), "depth")


def page_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links (src, pos, dst) of the supplier-part graph, the other nodes of each in key order."""
    li = table(spark, sf_dir, "lineitem", "l_suppkey", "l_partkey").distinct()
    out = [(("l_suppkey", 0), ("l_partkey", 1)), (("l_partkey", 1), ("l_suppkey", 0))]
    links = None
    for (a, odd_a), (b, odd_b) in out:
        place = F.row_number().over(Window.partitionBy(a).orderBy(b)) - 1
        side = li.select(a, b, place.alias("pos")).where(F.col("pos") < C.FOLLOWED_LINKS).select(
            (F.col(a) * 2 + odd_a).alias("src"), (F.col(b) * 2 + odd_b).alias("dst"), "pos")
        links = side if links is None else links.unionByName(side)
    return links


def scored_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the pages: suppliers by balance and key, parts by size and key."""
    s = table(spark, sf_dir, "supplier", "s_suppkey", "s_acctbal")
    p = table(spark, sf_dir, "part", "p_partkey", "p_size")
    return s.select((F.col("s_suppkey") * 2).alias("node"), (F.col("s_acctbal") > 0).alias("keep"),
                    (F.col("s_suppkey") % 100 / 100).alias("score")).unionByName(
        p.select((F.col("p_partkey") * 2 + 1).alias("node"), (F.col("p_size") > 10).alias("keep"),
                 (F.col("p_partkey") % 100 / 100).alias("score")))


# one row a batch: what waits, what was seen, what was collected, as lists; links and scores by node number
@query("crawl_queue", f"""
WITH RECURSIVE l AS (
  SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem
), e AS (
  SELECT s * 2 AS src, p * 2 + 1 AS dst, row_number() OVER (PARTITION BY s ORDER BY p) AS pos FROM l
  UNION ALL SELECT p * 2 + 1, s * 2, row_number() OVER (PARTITION BY p ORDER BY s) FROM l
), a AS (
  SELECT src AS node, list(dst ORDER BY pos) AS links FROM e WHERE pos <= 5 GROUP BY src
), c AS (
  SELECT s_suppkey * 2 AS node, s_acctbal > 0 AS keep, s_suppkey % 100 AS pct FROM supplier
  UNION ALL SELECT p_partkey * 2 + 1, p_size > 10, p_partkey % 100 FROM part
), x AS (
  SELECT list(coalesce(links, []) ORDER BY i) AS links, list(CASE WHEN c.node IS NULL THEN 'failed' WHEN keep AND pct >= 40 THEN 'done' ELSE 'low_relevance' END ORDER BY i) AS status,
         list(coalesce(pct, 0) ORDER BY i) AS pcts
  FROM (SELECT unnest(range(greatest((SELECT max(node) FROM c), (SELECT max(greatest(src, dst)) FROM e)) + 1)) AS i) LEFT JOIN c ON c.node = i LEFT JOIN a ON a.node = i
), st AS (
  SELECT -1 AS b, 0 AS base, (SELECT list(s_suppkey * 2 ORDER BY s_suppkey) FROM supplier) AS waiting, CAST([] AS BIGINT[]) AS seen,
         CAST([] AS BIGINT[]) AS taken, CAST([] AS BIGINT[]) AS fresh, 0 AS n, 0 AS total, CAST(NULL AS VARCHAR) AS stop
  UNION ALL
  SELECT b, base, waiting, seen, taken, fresh, n, total,
    CASE WHEN n >= (SELECT count(*) FROM supplier) THEN 'target' WHEN n > 20 AND total / (100.0 * n) < 0.35 THEN 'low relevance' WHEN len(waiting) = 0 THEN 'empty' END AS stop
  FROM (SELECT b + 1 AS b, base, list_concat(rest, list_filter(new, lambda v, i: list_position(new, v) = i AND NOT list_contains(rest, v))) AS waiting,
      list_concat(seen, fresh) AS seen, taken, fresh, n + len(good) AS n, total + coalesce(list_sum(list_transform(good, lambda v: pcts[v + 1])), 0) AS total
    FROM (SELECT *, flatten(list_transform(good, lambda v: links[v + 1])) AS new
      FROM (SELECT *, list_filter(fresh, lambda v: status[v + 1] = 'done') AS good
        FROM (SELECT b, base + len(taken) AS base, seen, n, total, list_slice(waiting, 1, 20) AS taken, list_slice(waiting, 21, len(waiting)) AS rest,
            list_filter(list_slice(waiting, 1, 20), lambda v: NOT list_contains(seen, v)) AS fresh, links, status, pcts FROM st, x WHERE stop IS NULL) t1) t2) t3) t4
)
SELECT base + i - 1 AS slot, CASE WHEN taken[i] % 2 = 0 THEN 's' ELSE 'p' END || CAST(taken[i] // 2 AS VARCHAR) AS node, CAST(b AS BIGINT) AS batch,
       CASE WHEN list_contains(fresh, taken[i]) THEN (SELECT status FROM x)[taken[i] + 1] ELSE 'seen' END AS status, (SELECT max(stop) FROM st) AS stop_reason
FROM (SELECT *, unnest(range(1, len(taken) + 1)) AS i FROM st WHERE b >= 0)
""")
def crawl_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A crawl from all suppliers in batches of 20 places, until as many nodes as there are suppliers are collected."""
    suppliers = table(spark, sf_dir, "supplier", "s_suppkey")
    seeds = suppliers.select((F.col("s_suppkey") * 2).alias("node"), F.col("s_suppkey").alias("ord"))
    r = C.crawl_queue(seeds, page_edges(spark, sf_dir), scored_nodes(spark, sf_dir), target=suppliers.count())
    return r.select("slot", node_name(F.col("node")).alias("node"), "batch", "status", "stop_reason")
