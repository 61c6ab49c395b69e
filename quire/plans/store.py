"""Keyed-write queries: upsert, insert-if-absent and status update."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import store
from ..session import table, written
from ..streaming.incremental import scratch
from .registry import query

CUTOVER = "2024-01-15"


@query("upsert_last_wins", """
SELECT user_id, ts, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def upsert_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event per user: the table as of the cut-over, then the later
    events upserted on top (key user_id, write order (ts, event_id))."""
    e = table(spark, sf_dir, "events", "user_id", "ts", "event_id", "event_type", "value")
    before = e.where(F.col("ts") < F.lit(CUTOVER).cast("timestamp_ntz"))
    after = e.where(F.col("ts") >= F.lit(CUTOVER).cast("timestamp_ntz"))
    current = store.last_per_key(before, ["user_id"], ["ts", "event_id"])
    return store.upsert(current, after, ["user_id"], ["ts", "event_id"])


@query("insert_if_absent", """
WITH cur AS (
  SELECT c_custkey AS key, 'existing' AS status, 'customer' AS origin FROM customer WHERE c_acctbal > 0
), new AS (
  SELECT DISTINCT o_custkey AS key, 'pending' AS status, 'orders' AS origin FROM orders
)
SELECT * FROM cur
UNION ALL
SELECT * FROM new WHERE key NOT IN (SELECT key FROM cur)
""")
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A written table takes the rows whose key it lacks (A14), by an append."""
    c = table(spark, sf_dir, "customer", "c_custkey", "c_acctbal").where(F.col("c_acctbal") > 0)
    cur = c.select(F.col("c_custkey").alias("key"), F.lit("existing").alias("status"),
                   F.lit("customer").alias("origin"))
    o = table(spark, sf_dir, "orders", "o_custkey").distinct()
    new = o.select(F.col("o_custkey").alias("key"), F.lit("pending").alias("status"),
                   F.lit("orders").alias("origin"))
    path = scratch(spark, "urls")
    current = store.append_table(cur, path)
    # the absent keys are found before the append changes the table that they are looked up in
    return store.append_table(written(store.absent_rows(current, new, ["key"]), "absent"), path)


@query("status_update", """
WITH urls AS (SELECT url, 'pending' AS status, 0 AS depth, CAST(NULL AS VARCHAR) AS error FROM pages),
o AS (
  SELECT url,
    CASE WHEN length(html) < 2500 THEN 'too small' END AS err,
    contains(html, '<h1') AS extracted,
    contains(url, '/en/') AS keep,
    CAST(length(html) % 100 AS DOUBLE) / 100 AS score
  FROM pages WHERE NOT contains(url, 'spam-farm')
), u AS (
  SELECT url, err AS error,
    CASE WHEN err IS NOT NULL THEN 'failed' WHEN NOT extracted THEN 'extract_failed'
         WHEN keep AND score >= 0.4 THEN 'done' ELSE 'low_relevance' END AS status
  FROM o
)
SELECT urls.url, CASE WHEN u.url IS NOT NULL THEN u.status ELSE urls.status END AS status,
       urls.depth,
       CASE WHEN u.url IS NOT NULL THEN u.error ELSE urls.error END AS error
FROM urls LEFT JOIN u ON urls.url = u.url
""")
def status_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages", "url", "html")
    urls = p.select("url", F.lit("pending").alias("status"), F.lit(0).alias("depth"),
                    F.lit(None).cast("string").alias("error"))
    o = p.where(~F.col("url").contains("spam-farm"))
    err = F.when(F.length("html") < 2500, F.lit("too small"))
    score = (F.length("html") % 100).cast("double") / 100
    upd = o.select("url", err.alias("error"), store.status_machine(
        err, F.col("html").contains("<h1"), F.col("url").contains("/en/"), score).alias("status"))
    return store.keyed_update(urls, upd, ["url"], ["status", "error"])


STAMP = "2026-01-31 06:30:00"


@query("schema_evolution", f"""
WITH u AS (
  SELECT user_id, ts, event_id, event_type, CASE WHEN ts >= TIMESTAMP '{CUTOVER}' THEN value END AS value FROM events
)
SELECT user_id, ts, event_id, event_type, value, TIMESTAMP '{STAMP}' AS scraped_at FROM u
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that knew no ``value`` before the cut-over takes the rows that have it (A17); all rows get the
    stamp of the write (A18)."""
    e = table(spark, sf_dir, "events", "user_id", "ts", "event_id", "event_type", "value")
    at = F.lit(CUTOVER).cast("timestamp_ntz")
    old, new = e.where(F.col("ts") < at).drop("value"), e.where(F.col("ts") >= at)
    state = store.upsert(store.conform(old, new.schema), new, ["user_id"], ["ts", "event_id"])
    return store.stamp(state, "scraped_at", STAMP)
