"""URL filter: host and path rules, and a character language-model ratio where no rule fits.

Two variable-order Markov models over characters, one of accepted and one of rejected URLs, are
smoothed by Witten-Bell interpolation from the longest context down.  A URL's score is the
difference of its log-likelihoods divided by its length.  The threshold is calibrated on labelled
URLs that took no part in the counts.

Everything is joins and aggregates.  Distinct URLs are scored once.  The contexts of all positions
are counted after partial aggregation; probabilities are worked out once per distinct context; and
the join of positions with them is salted, as every URL has some contexts in common with all others.
"""
from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Longest context in characters; first hexadecimal digits of the hashes of the labelled URLs that
#: are kept for calibration.
ORDER, HELD = 4, "012"
#: Calibration: scores are compared at steps of this size up to this distance from 0.
STEP, REACH = 0.01, 10.0
BEGIN, END = "\x02", "\x03"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to / ? # or the end, A-Z lower-cased; path: then up to ? or #.

    A null url or one without ``://`` has neither: both are empty.
    """
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return ascii_lower(host), path


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct of the longest rule that fits and its verdict; null fields if none does.

    ``rules``: (verdict, host and path).  A rule fits its host and all subdomains of it if the
    path starts with the rule's.  Of rules of one length the first counts.
    """
    out = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    for verdict, rule in sorted(reversed(rules), key=lambda r: len(r[1])):
        own, slash, begin = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + begin)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _positions(texts: DataFrame, order: int) -> DataFrame:
    """A row for each character of each text, the end mark included, with up to ``order`` before it."""
    marked = F.concat(F.lit(BEGIN), "text", F.lit(END))
    grams = F.transform(F.sequence(F.lit(2), F.length(marked)),
                        lambda i: F.substring(marked, F.greatest(F.lit(1), i - order), F.least(F.lit(order + 1), i)))
    return texts.select(*[c for c in texts.columns if c != "text"], F.explode(grams).alias("gram"))


def gram_ratios(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, d) for every gram of the texts: log p(last character | the ones before), accepted less rejected.

    ``texts``: text and its weight among the accepted (``a``) and the rejected (``r``).
    """
    full = (_positions(texts, order).groupBy("gram").agg(F.sum("a").alias("a"), F.sum("r").alias("r")))
    full = materialize(full)
    subs = F.transform(F.sequence(F.lit(1), F.length("gram")), lambda k: F.right("gram", k))
    counts = (full.select(F.explode(subs).alias("sub"), "a", "r").groupBy("sub").agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
              .withColumn("ctx", F.col("sub").substr(F.lit(1), F.length("sub") - 1)))
    contexts = counts.groupBy("ctx").agg(F.sum("a").alias("na"), F.sum("r").alias("nr"),
                                         F.count_if(F.col("a") > 0).alias("ta"), F.count_if(F.col("r") > 0).alias("tr"))
    known = counts.join(contexts, "ctx").drop("ctx")
    levels = (full.select("gram", F.explode(subs).alias("sub")).join(known, "sub")
              .groupBy("gram").agg(F.sort_array(F.collect_list(F.struct(
                  F.length("sub").alias("k"), "a", "r", "na", "nr", "ta", "tr"))).alias("levels")))  # at most order + 1

    def finer(n: Column, t: Column, total: Column, coarse: Column) -> Column:
        return F.when(total > 0, (n + t * coarse) / (total + t)).otherwise(coarse)

    start = F.struct(F.lit(1 / 256).alias("pa"), F.lit(1 / 256).alias("pr"))
    p = F.aggregate("levels", start, lambda p, x: F.struct(finer(x["a"], x["ta"], x["na"], p["pa"]).alias("pa"),
                                                           finer(x["r"], x["tr"], x["nr"], p["pr"]).alias("pr")))
    return levels.select("gram", p.alias("p")).select("gram", (F.log("p.pa") - F.log("p.pr")).alias("d"))


def scores(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(key, score) of texts with a ``key`` each and their weights ``a`` and ``r``: the log-likelihood
    difference over the number of characters, the end mark included."""
    # a gram that every text has makes up one row in some forty; beyond so many partitions it is split
    salts = max(1, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 32)
    ratios = gram_ratios(texts, order).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = (_positions(texts.select("key", "text"), order)
            .withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int")))
    # sums in a fixed order, so that scores don't depend on how rows arrive
    return (rows.join(ratios, ["gram", "salt"]).groupBy("key")
            .agg(F.sum(F.col("d").cast("decimal(24,12)")).alias("d"), F.count("*").alias("n"))
            .select("key", (F.col("d").cast("double") / F.col("n")).alias("score")))


def calibrated(held: DataFrame) -> float:
    """The threshold on ``score`` with the least mean of the two error rates; 0 if a class is missing.

    ``held``: score, a and r (weights among accepted and rejected).  Of equally good thresholds the
    middle one; the driver gets one row for each step at most.
    """
    step = F.floor(F.least(F.greatest("score", F.lit(-REACH)), F.lit(REACH)) / STEP)
    bins = sorted(map(tuple, held.groupBy(step.cast("int").alias("bin")).agg(F.sum("a"), F.sum("r")).collect()))
    accepted, rejected = sum(b[1] for b in bins), sum(b[2] for b in bins)
    if not accepted or not rejected:
        return 0.0
    lost, kept, best = 0, rejected, []
    errors = [(kept / rejected, bins[0][0])]
    for b, a, r in bins:
        lost, kept = lost + a, kept - r
        errors.append((lost / accepted + kept / rejected, b + 1))
    least = min(e for e, _ in errors)
    best = [i for i, (e, _) in enumerate(errors) if e <= least + 1e-12]
    # between the lower edge of the threshold's bin and that of the next occupied one
    first, last = errors[best[0]][1], errors[min(best[-1] + 1, len(errors) - 1)][1] - 1
    return STEP * math.floor((first + max(first, last)) / 2)


def judge(pages: DataFrame, rules: list[tuple[str, str]], order: int = ORDER,
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, url, host, path, rule, verdict, score) for every row of ``pages``.

    ``verdict``: allow or block, the rule's or else the model's: allow from the threshold up.  The
    models learn from all URLs that rules judge, but three in sixteen by a hash, which
    calibrate the threshold.  ``score`` is the model's, also where a rule decides.  A null url is the empty
    text to the model.  Repeated rows stay; an empty table gives an empty result.
    """
    url = F.col("url")
    host, path = host_and_path(url)
    model_text = ascii_lower(F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + 3, F.length(url)))
                             .otherwise(F.coalesce(url, F.lit(""))))
    rows = (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
            .withColumns({"host": host, "path": path, "text": model_text})
            .withColumn("judged", rule_of(F.col("host"), F.col("path"), rules))
            .withColumn("key", F.unhex(F.md5("text"))))
    texts = (rows.groupBy("key", "text").agg(F.count_if(F.col("judged.verdict") == "allow").alias("allow"),
                                             F.count_if(F.col("judged.verdict") == "block").alias("block")))
    learns = ~F.substring(F.md5("text"), 1, 1).isin(*HELD)
    texts = materialize(texts.withColumns({"a": F.when(learns, F.col("allow")).otherwise(0),
                                           "r": F.when(learns, F.col("block")).otherwise(0)}))
    scored = materialize(scores(texts.select("key", "text", "a", "r"), order))
    held = texts.filter("allow + block > a + r").select("key", F.col("allow").alias("a"), F.col("block").alias("r"))
    threshold = calibrated(held.join(scored, "key"))
    own = F.when(F.col("score") >= threshold, F.lit("allow")).otherwise(F.lit("block"))
    return rows.join(scored, "key").select("page_id", "url", "host", "path", "judged.rule",
                                           F.coalesce("judged.verdict", own).alias("verdict"), "score")
