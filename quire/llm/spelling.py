"""Spelling variants of words: pairs one edit apart, through asymmetric chunks, and the common form of each.

Of two words at most one edit apart, the shorter contributes two disjoint chunks, its halves of ``length div 2``
code points, and the longer its positional grams of that length.  One edit preserves a chunk, and
moves it by at most the difference in length, so the pair meets in an equal gram within shift one.  Equal meetings are
candidates; an edit distance of exactly one decides.

A chunk that many words share is cut finer: without the chunk, the rests of two such words are one edit apart again, so
one of the rest's own two chunks is preserved.  This goes on until a group is small or only one code point is
left, so no group makes many useless pairs and no pair is lost.
"""
from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import slices, written

#: Least code points and occurrences of a word; how much more frequent a form is.
LENGTH, TIMES, RATIO = 7, 2, 10
#: One in so many (document, run) loses a code point.
TYPO = 31
#: Meetings of one chunk above which it is cut finer.
MEETINGS = 4096
#: Distinct words that a task counts before it passes the counts on.
COUNTED = 500_000
_UPPER = str.maketrans({c: chr(c + 32) for c in range(0x41, 0x5B)})


def _name(doc_id: object) -> str:
    return "" if doc_id is None else str(doc_id)


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(word, n): how often each word of at least ``length`` code points occurs in all texts, pre-aggregated in every task.

    A word is a maximal run of letters of ASCII or U+00C0 to U+00FF, A-Z lower-cased.  If TYPO divides the
    CRC-32 of ``<doc_id>:<run>``, the run's code point number crc % length is left out.
    """
    runs = re.compile("[A-Za-zÀ-ÿ]{%d,}" % length)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}

        def passed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for names, texts in zip(slices(batch.column(0)), slices(batch.column(1))):
                for name, text in zip(names, texts):
                    own: dict[str, int] = {}
                    for m in runs.finditer(text or ""):
                        own[m[0]] = own.get(m[0], 0) + 1
                    begun = zlib.crc32(f"{_name(name)}:".encode())
                    folded: dict[str, int] = {}
                    for run, n in own.items():
                        low = run.lower() if run.isascii() else run.translate(_UPPER)
                        folded[low] = folded.get(low, 0) + n
                    for run, n in folded.items():
                        crc = zlib.crc32(run.encode(), begun)
                        if crc % TYPO == 0:
                            at = crc % len(run)
                            run = run[:at] + run[at + 1:]
                            if len(run) < length:
                                continue
                        counts[run] = counts.get(run, 0) + n
                    if len(counts) > COUNTED:
                        yield passed_on()
                        counts.clear()
        if counts:
            yield passed_on()

    rows = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _piece(row: list, word: str, at: Column, size: Column) -> Column:
    """Struct of the key of a chunk or gram at ``at`` (from 0) and the rest without it."""
    rest = F.col(word)
    gram = F.substring(rest, at + 1, size)
    left = F.concat(F.substring(rest, F.lit(1), at), F.substring(rest, at + size + 1, F.length(rest)))
    return F.struct(F.xxhash64(*row, gram).alias("key"), left.alias("rest"))


def _chunks(rows: DataFrame) -> DataFrame:
    """The two chunks of ``rest``; ``rows``: key, word, n, rest and ``size``, the rest's length."""
    q = F.expr("size div 2").cast("int")
    both = [_piece(["key", F.lit(i)], "rest", i * q, q) for i in (0, 1)]
    return rows.select("word", "n", (F.col("size") - q).alias("size"), F.explode(F.array(*both)).alias("c")).select("word", "n", "size", "c.*")


def _grams(rows: DataFrame) -> DataFrame:
    """The grams of ``rest`` that can meet a chunk: at its place, or one further if the rest is one longer.

    ``rows``: key, word, n, rest, ``more`` (0 or 1: how much longer than the chunks' rest) and ``size`` of that one.
    """
    q = F.expr("size div 2").cast("int")
    places = [_piece(["key", F.lit(i)], "rest", i * q + s, q) for s in (0, 1) for i in (0, 1)]
    chosen = F.when(F.col("more") == 0, F.array(*places[:2])).otherwise(F.array(*places))
    return rows.select("word", "n", "more", (F.col("size") - q).alias("size"), F.explode(chosen).alias("c")).select("word", "n", "more", "size", "c.*")


def near_words(words: DataFrame, length: int = LENGTH, meetings: int = MEETINGS) -> DataFrame:
    """(a, n_a, b, n_b) of all words that differ by exactly one inserted, deleted or replaced code point, each pair once.

    ``words``: distinct ``word`` of at least ``length`` (2 or more) code points and ``n``; a written table.
    """
    size = F.length("word")
    base = words.select("word", "n", F.col("word").alias("rest"), size.alias("size"))
    shorter = base.withColumn("key", F.col("size").cast("long"))
    longer = (base.select("word", "n", "rest", F.explode(F.array(F.lit(0), F.lit(1))).alias("more"), "size")
              .withColumn("size", F.col("size") - F.col("more")).filter(F.col("size") >= length)
              .withColumn("key", F.col("size").cast("long")))
    found = []
    while True:
        chunks, grams = _chunks(shorter), _grams(longer)
        sizes = (chunks.select("key", F.lit(1).alias("c"), F.lit(0).alias("g")).unionAll(grams.select("key", F.lit(0), F.lit(1)))
                 .groupBy("key").agg(F.sum("c").alias("c"), F.sum("g").alias("g")))
        hot = materialize(sizes.filter(F.col("c") * F.col("g") > meetings).select("key"))
        more = not hot.isEmpty()
        if more:
            often = [x.join(hot, "key", "left_semi") for x in (chunks, grams)]
            # two words that agree but for one code point: few whatever the input
            last = [x.filter("size < 2") for x in often]
            calm = [x.join(hot, "key", "left_anti").unionAll(y) for x, y in zip((chunks, grams), last)]
        else:
            calm = [chunks, grams]
        left = calm[0].select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
        right = calm[1].select("key", F.col("word").alias("b"), F.col("n").alias("n_b"), "more")
        near = left.join(right, "key").filter((F.col("more") == 1) | (F.col("a") < F.col("b"))).filter(F.levenshtein("a", "b", 1) == 1)
        found.append(near.select("a", "n_a", "b", "n_b"))
        if not more:
            return reduce(DataFrame.unionAll, found).distinct()
        shorter, longer = (materialize(x.filter("size >= 2")) for x in often)


def roots(forms: DataFrame, steps: int) -> DataFrame:
    """(word, root) of ``forms`` (word, form), followed to the last form; ``steps``: the longest chain.

    Every round doubles the steps taken.
    """
    up = materialize(forms.select("word", F.col("form").alias("root")))
    for _ in range(math.ceil(math.log2(max(steps, 1)))):
        further = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        up = materialize(up.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
    return up


def variants(docs: DataFrame, length: int = LENGTH, times: int = TIMES, ratio: int = RATIO,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word of ``docs``: word, form, root, n, n_near, form_n.

    Words: see ``word_counts``; those that occur at least ``times`` times.  ``n_near``: words one edit apart.  ``form``: the most frequent of them
    (the smallest in code-point order, if several are), if it is at least ``ratio`` times as frequent; else null.  ``root``: where the
    forms of forms end; the word itself without one.  A null text has no words; a null id counts as the empty string.
    Repeated rows count again.  An empty table has no words.
    """
    words = written(word_counts(docs, id_col, text_col, length).filter(F.col("n") >= times), "words")
    pairs = written(near_words(words, length), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("m")).unionAll(
        pairs.select(F.col("b"), F.col("a"), F.col("n_a")))
    most = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best"))
    table = words.join(most, "word", "left")
    is_form = -F.col("best.m") >= ratio * F.col("n")
    table = written(table.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best.near")).alias("form"),
                                 F.when(is_form, -F.col("best.m")).alias("form_n")), "word-forms")
    # a form is ``ratio`` times as frequent, so chains are short
    top = words.agg(F.max("n")).first()[0] or 1
    last = roots(table.filter("form is not null").select("word", "form"), int(math.log(top, ratio)) + 1)
    return table.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
