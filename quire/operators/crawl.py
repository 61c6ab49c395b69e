"""Frontier operators of the generic crawl.

The crawl itself (search engines, fetching, model scoring) is outside Spark;
its results arrive as tables: hit lists ``(url, engine_rank, hit_rank)``,
scored pages ``(url, keep, score)`` and a link-edge table ``(src, dst)``.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import urls
from ..session import ensure_checkpoint_dir, materialize

# Domains the hit merge always drops.
SKIP_DOMAINS = ("facebook.com", "twitter.com", "x.com", "pinterest.com", "instagram.com")
KEEP_THRESHOLD = 0.4
MIN_PAGES_FOR_STOP = 20
STOP_AVG_RELEVANCE = 0.35
# pages that the queue hands out at a time, and links that a page appends
BATCH_PAGES = 20
FOLLOWED_LINKS = 5


def frontier_union(hits: DataFrame, url: str = "url",
                   order: tuple[str, ...] = ("engine_rank", "hit_rank")) -> DataFrame:
    """Ordered union with first occurrence kept: one row per URL carrying the
    smallest ``order`` tuple (partial + final aggregate, skew-safe)."""
    g = hits.groupBy(url).agg(F.min(F.struct(*order)).alias("_o"))
    return g.select(url, *[F.col(f"_o.{c}").alias(c) for c in order])


def registered_domains(urls_: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """``urls_`` with ``domain``: the public suffix of the host and one label more.

    ``rules`` (rule): public suffixes as ``com``, ``co.uk``, ``*.ck`` (any one label) and ``!www.ck`` (an exception from a
    wildcard).  An exception wins, else the rule with most labels.  ``domain`` is NULL for a host
    that no rule matches (an IP address, a bare name) or that is a public suffix itself.
    Distinct hosts are matched once, each on its few possible rules, by an equi join.
    """
    named = urls_.withColumn("host", urls.host(F.col(url)))
    hosts = named.select("host").where(F.col("host").isNotNull()).distinct()
    keys = hosts.select("host", F.explode(urls.suffix_keys("host")).alias("k")).select("host", "k.*")
    known = rules.select(F.col("rule").alias("key")).distinct()
    best = keys.join(known, "key").groupBy("host").agg(F.max(F.struct("exception", "labels")).alias("best"))
    n = F.size(F.split("host", r"\."))
    domains = best.where(n > F.col("best.labels")).select("host", urls.last_labels("host", F.col("best.labels") + 1).alias("domain"))
    return named.join(domains, "host", "left").drop("host")


def domain_filter(df: DataFrame, blocked, url: str = "url", rules: DataFrame | None = None) -> DataFrame:
    """Drop URLs whose registered domain is blocked (B9); adds ``domain``.

    ``blocked`` is a list of domains (compiled into an IN list) or a
    DataFrame ``(domain)`` joined with a left-anti join (planner picks
    broadcast by its size statistics).  ``rules``: public suffixes (see
    :func:`registered_domains`); without them a suffix has one label.
    """
    d = registered_domains(df, rules, url) if rules is not None else df.withColumn("domain", urls.registered_domain(F.col(url)))
    if isinstance(blocked, DataFrame):
        return d.join(blocked.select(F.col(blocked.columns[0]).alias("domain")), "domain", "left_anti")
    return d.where(F.col("domain").isNull() | ~F.col("domain").isin(*blocked))


def gate(keep, score, threshold: float = KEEP_THRESHOLD):
    """``keep and score >= threshold``."""
    return keep & (score >= threshold)


def relevance_gate(scored: DataFrame, keep: str = "keep", score: str = "score",
                   threshold: float = KEEP_THRESHOLD) -> DataFrame:
    """Pages the model kept with a score at or above the threshold."""
    return scored.where(gate(F.col(keep), F.col(score), threshold))


def should_continue(collected: int, target: int, avg_relevance: float) -> bool:
    """Stop test between rounds (B16): stop at the target, or once more than
    20 pages were collected with an average relevance under 0.35."""
    if collected >= target:
        return False
    if collected > MIN_PAGES_FOR_STOP and avg_relevance < STOP_AVG_RELEVANCE:
        return False
    return True


def frontier_rounds(spark: SparkSession, edges: DataFrame, seeds: DataFrame,
                    max_depth: int | None = None, scored: DataFrame | None = None,
                    target: int | None = None) -> DataFrame:
    """Level-by-level expansion of a frontier over a link-edge table.

    ``edges``: (src, dst) node ids; ``seeds``: (node).  Each round joins the
    newest level to the edges, removes nodes of all earlier levels (left-anti join)
    and writes the rest, the new level, to the session's checkpoint directory:
    what a round writes follows what it finds, and a lost executor recomputes at
    most one round.  It ends when a level is empty, or after ``max_depth`` levels.
    With ``scored`` (node, keep, score) only nodes that pass the relevance gate
    are expanded, and with ``target`` the stop test of B16 runs on one aggregate
    row per round.  Hub nodes are left to adaptive skew-join handling.  Edges may repeat: a node is expanded
    once, and what a round finds is made distinct, so the edge table is written as it comes.
    Output: node, depth (smallest depth at which the node was reached).
    """
    ensure_checkpoint_dir(spark)
    links = materialize(edges.select("src", "dst"))
    levels = [materialize(seeds.select("node", F.lit(0).alias("depth")).distinct())]
    passed = scored.where(gate(F.col("keep"), F.col("score"))) if scored is not None else None
    while max_depth is None or len(levels) <= max_depth:
        visited = reduce(DataFrame.unionByName, levels)
        if passed is not None and target is not None:
            st = (visited.join(passed, "node")
                  .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.avg("score"), F.lit(0.0)).alias("a")).first())
            if not should_continue(st["n"], target, st["a"]):
                break
        newest = levels[-1].select("node")
        if passed is not None:
            newest = newest.join(passed, "node", "left_semi")
        found = (newest.join(links, F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct()
                 .join(visited.select("node"), "node", "left_anti")
                 .select("node", F.lit(len(levels)).alias("depth")))
        level = materialize(found)
        if level.isEmpty():
            break
        levels.append(level)
    return reduce(DataFrame.unionByName, levels)


def first_links(links: DataFrame, n: int = 5) -> DataFrame:
    """Edges (src, dst) that a crawl follows: the first ``n`` links of each page by position."""
    return links.where(F.col("pos") < n).select("src", "dst")


def _numbered(df: DataFrame, order: list[str], start: int, name: str = "slot") -> DataFrame:
    """``df`` with its 0-based place in ``order`` counted from ``start``: a range sort, one offset per partition."""
    rows = materialize(df.orderBy(*order).select("*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid")))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    place = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return rows.join(F.broadcast(offsets), "_pid").withColumn(name, F.col("_off") + place + start).drop("_pid", "_mid", "_off")


def _running(batches: DataFrame, collected: int, total) -> DataFrame:
    """``batches`` (batch, n, total) with ``collected`` and ``sum`` up to each batch, by sorted ranges."""
    rows = materialize(batches.orderBy("batch").withColumn("_pid", F.spark_partition_id()))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("_pid").agg(F.sum("n").alias("_n"), F.sum("total").alias("_t")).select(
        "_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"), F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_t"))
    inside = Window.partitionBy("_pid").orderBy("batch").rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(F.broadcast(parts), "_pid").select(
        "batch", (F.sum("n").over(inside) + F.col("_n") + collected).alias("collected"),
        (F.sum("total").over(inside) + F.col("_t") + F.lit(total)).alias("sum"))


def _reason(collected: Column, total: Column, target: int) -> Column:
    """Why a crawl stops after a batch (B16); NULL if it goes on."""
    return (F.when(collected >= target, "target")
            .when((collected > MIN_PAGES_FOR_STOP) & (total / collected < STOP_AVG_RELEVANCE), "low relevance"))


def crawl_queue(seeds: DataFrame, links: DataFrame, scored: DataFrame, target: int,
                batch: int = BATCH_PAGES, follow: int = FOLLOWED_LINKS, threshold: float = KEEP_THRESHOLD,
                max_depth: int | None = None) -> DataFrame:
    """A crawl in queue order, batch by batch, until its stop test says so.

    ``seeds``: node, ord; ``links``: src, pos, dst; ``scored``: node, keep, score (nodes without a row could not be
    read).  The queue hands out ``batch`` places at a time.  A node seen in an earlier place does nothing; one that passes the
    gate counts as collected and appends its first ``follow`` links, in order, leaving out nodes that are waiting.  After every
    batch the crawl stops if ``target`` nodes are collected, or if more than 20 are and their average score is too
    low; else when nothing is waiting.

    Places have lasting numbers, and the links of one batch come behind all places that wait by then.  So whole
    batches that are waiting already are settled together, in one round over the cluster, and give the
    same as one after the other: a link is left out if its node waits in a later batch than the link's page, and
    of a node's remaining links the first counts.  Rounds are about as many as the crawl is deep.

    Output: slot, node, batch, depth, status (done, low_relevance, failed, seen) and stop_reason (target, low relevance, empty).
    """
    spark = seeds.sparkSession
    ensure_checkpoint_dir(spark)
    gated = scored.select("node", gate(F.col("keep"), F.col("score"), threshold).alias("passed"), F.col("score").cast("decimal(18,6)").alias("score"))
    followed = materialize(links.where(F.col("pos") < follow).select("src", "pos", F.col("dst").alias("node")))
    first = seeds.groupBy("node").agg(F.min("ord").alias("ord"))
    waiting = materialize(_numbered(first, ["ord", "node"], 0).select("slot", "node", F.lit(0).alias("depth")))
    begin, end, number = 0, waiting.count(), 0  # places [begin, end) wait; batches begin with this number
    done, collected, total, reason = [], 0, 0, None
    while reason is None:
        if begin == end:
            reason = "empty"
            break
        take = (end - begin) // batch * batch or end - begin
        taken = waiting.where(F.col("slot") < begin + take).withColumn("batch", F.floor((F.col("slot") - begin) / batch) + number)
        seen = reduce(DataFrame.unionAll, done).where("status <> 'seen'").select("node", F.lit(True).alias("again")) if done else None
        if seen is not None:
            taken = taken.join(seen, "node", "left")
        else:
            taken = taken.withColumn("again", F.lit(None).cast("boolean"))
        status = (F.when(F.col("again"), "seen").when(F.col("passed").isNull(), "failed")
                  .when(F.col("passed"), "done").otherwise("low_relevance"))
        settled = materialize(taken.join(gated, "node", "left").select("slot", "node", "batch", "depth", status.alias("status"), "score"))
        sums = settled.where("status = 'done'").groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("total"))
        running = _running(sums, collected, total).withColumn("reason", _reason(F.col("collected"), F.col("sum"), target))
        # the last batch of the round, or the first after which the crawl stops; batches that collect nothing change nothing
        hit, state = running.agg(F.min(F.when(F.col("reason").isNotNull(), F.struct("batch", "reason"))),
                                 F.max(F.struct("batch", "collected", "sum"))).first()
        if hit is not None:
            reason = hit["reason"]
            done.append(settled.where(F.col("batch") <= hit["batch"]).drop("score"))
            break
        done.append(settled.drop("score"))
        if state is not None:
            collected, total = state["collected"], state["sum"]
        pages = settled.where("status = 'done'")
        if max_depth is not None:
            pages = pages.where(F.col("depth") < max_depth)
        found = (pages.select(F.col("node").alias("src"), F.col("slot").alias("parent"), F.col("batch").alias("from_batch"), (F.col("depth") + 1).alias("depth"))
                 .join(followed, "src").select("node", "parent", "pos", "from_batch", "depth"))
        later = waiting.where(F.col("slot") >= begin + take)
        out = settled.select("node", F.col("batch").alias("own_batch"))
        new = (found.join(later.select("node"), "node", "left_anti").join(out, "node", "left")
               .where(F.col("own_batch").isNull() | (F.col("from_batch") >= F.col("own_batch")))
               .groupBy("node").agg(F.min(F.struct("parent", "pos", "depth")).alias("f")).select("node", "f.*"))
        added = _numbered(new, ["parent", "pos"], end).select("slot", "node", "depth")
        waiting = materialize(later.unionByName(added))
        number += -(-take // batch)
        begin, end = begin + take, begin + take + waiting.count()
    if not done:
        return waiting.select("slot", "node", F.lit(0).cast("bigint").alias("batch"), "depth", F.lit("").alias("status"), F.lit(reason).alias("stop_reason"))
    return reduce(DataFrame.unionAll, done).withColumn("stop_reason", F.lit(reason))
