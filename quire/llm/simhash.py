"""SimHash near-duplicates through covering locality-sensitive hashing.

Every document gets a 64-bit SimHash of its word shingles.  Fingerprints that differ in at
most ``max_bits`` bits are linked, and the connected components are the groups of copies.

Candidates come from structured bit masks instead of random ones.  For radius r each bit
position gets one of the 2^(r+1)-1 nonzero vectors of r+1 bits, and table v keeps the positions
whose vector has an odd overlap with v.  At most r differing positions span at most r of the
r+1 dimensions, so some v is orthogonal to all of them: in that table both fingerprints agree on
every kept bit.  No pair within the radius can be missed.

Only distinct fingerprints enter the tables, so exact copies cost one row.  A bucket with more
than ``BUCKET`` fingerprints is covered again by masks over the bits its own mask left open,
which keeps the guarantee; when few enough bits are open a bucket cannot exceed ``BUCKET``
whatever the data are.  A bucket yields links to one root per component of it, never all pairs.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..session import materialize
from .common import inputs, lookup, slices, unused

BITS = 64
#: Most distinct fingerprints that one task compares with each other.
BUCKET = 4096
_BIT_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def simhash(text: str, shingle: int, seed: int = 42) -> int:
    """The SimHash of one text, as a signed 64-bit integer.

    Words are runs of anything but ASCII white space, A-Z lower-cased.  A bit is set when more
    than half of the shingles' XXH64 values have it.  A text with fewer words than a shingle
    counts as one shingle; a text without words gives 0.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return int(np.uint64(xxhash.xxh64_intdigest(joined, seed)).astype(np.int64))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    ends = (starts + lengths)[shingle - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends)), np.uint64, len(ends))
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256, dtype=np.int16)
        counts += (np.bincount(part.ravel(), minlength=2048).reshape(8, 256) @ _BIT_OF_BYTE).ravel()
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprint(text: Column, shingle: int) -> Column:
    """Column of the SimHash of ``text``; null counts as the empty text."""

    @arrow_udf("long")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([simhash(x or "", shingle) for part in slices(batch) for x in part], pa.int64())

    return of.asNondeterministic()(text)  # not to be evaluated twice


def masks(positions: list[int], radius: int) -> list[int]:
    """The covering masks over ``positions``: one per nonzero vector of radius + 1 bits."""
    n = 2 ** (radius + 1) - 1
    return [sum(1 << p for i, p in enumerate(positions) if ((i % n + 1) & v).bit_count() % 2)
            for v in range(1, n + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def _in_buckets(members: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) inside buckets of at most BUCKET fingerprints, one root per component."""

    @arrow_udf("array<struct<a:long,b:long>>")
    def links(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([_spanning(x, radius) for x in batch.to_pylist()],
                           pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))

    return (members.groupBy("bucket", "key").agg(F.collect_list("fp").alias("fps"))
            .select(F.explode(links("fps")).alias("link")).select("link.a", "link.b"))


def _spanning(values: list[int], radius: int) -> list[dict]:
    """For each component of the values linked within the radius: its least member to the others."""
    rest, out = np.unique(np.array(values, np.int64)), []
    while len(rest) > 1:
        root, frontier, rest = rest[0], [rest[0]], rest[1:]
        while frontier and len(rest):
            near = np.bitwise_count((rest ^ frontier.pop()).view(np.uint64)) <= radius
            found, rest = rest[near], rest[~near]
            frontier.extend(found)
            out.extend({"a": int(root), "b": int(x)} for x in found)
    return out


def covering_links(fps: DataFrame, radius: int, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that connect all distinct ``fp`` within ``radius`` bits of each other.

    Buckets of more than ``bucket`` fingerprints are split by further masks over their open bits.
    """
    tables = [(mask, [p for p in range(BITS) if not mask >> p & 1]) for mask in masks(list(range(BITS)), radius)]
    rows, links = fps.select("fp"), []
    keyed = rows.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("bucket"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for i, (m, _) in enumerate(tables)])).alias("t")).select("fp", "t.bucket", "t.key")
    while True:
        bounded = all(2 ** len(free) <= bucket for _, free in tables)
        sizes = keyed.groupBy("bucket", "key").agg(F.count("*").alias("n")).filter("n > 1")
        members = keyed.join(sizes, ["bucket", "key"])
        links.append(_in_buckets(members if bounded else members.filter(F.col("n") <= bucket), radius))
        if bounded:
            return reduce(DataFrame.unionAll, links)
        # the masks of the next level, by the table whose open bits they cover
        finer = [[(m | s, [p for p in free if not s >> p & 1]) for s in masks(free, radius)] for m, free in tables]
        first = np.cumsum([0] + [len(x) for x in finer]).tolist()
        choices = F.array(*[F.array(*[F.struct(F.lit(first[i] + j).alias("bucket"), F.lit(_signed(m)).alias("mask"))
                                      for j, (m, _) in enumerate(x)]) for i, x in enumerate(finer)])
        tables = [x for y in finer for x in y]
        keyed = (members.filter(F.col("n") > bucket)
                 .select("fp", F.explode(F.element_at(choices, F.col("bucket") + 1)).alias("t"))
                 .select("fp", "t.bucket", F.col("fp").bitwiseAND(F.col("t.mask")).alias("key")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the least node it reaches.

    Alternating large-star and small-star rounds; each round is written to the checkpoint
    folder, so a lost executor costs at most that round.  The driver sees two numbers a round.
    """
    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .filter("u <> v").distinct())
    now = state(edges)
    while now[0]:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = materialize(small.select("e.u", "e.v").filter("u <> v").distinct())
        before, now = now, state(edges)
        if before == now:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    ``component_id`` is the smallest id among all documents that links reach, the row's own
    included.  A null or empty text has fingerprint 0 and is linked like any other.  Repeated
    rows all stay in the result.  A null id never names a component unless all its ids are null.
    An empty table gives an empty result.
    """
    rows = inputs(docs, id_col, text_col)
    rows = materialize(rows.select("doc_id", fingerprint(F.col("text"), shingle).alias("fp")))
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    roots = components(covering_links(nodes, max_bits))
    member = roots.unionAll(roots.select("root", "root").distinct().toDF("node", "root"))
    named = member.join(nodes, member.node == nodes.fp).select("node", "root", "least")
    best = named.groupBy("root").agg(F.min("least").alias("best"))
    linked = named.join(best, "root").select(F.col("node").alias("fp"), "best")
    label = nodes.join(linked, "fp", "left").select("fp", "n", F.coalesce("best", "least").alias("component_id"))
    return lookup(rows, materialize(label), "fp", "n").select("doc_id", "fp", "component_id")


def unique(docs: DataFrame, shingle: int = 3, max_bits: int = 2,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` of which one of each group of near-copies stays, with all their columns.

    The smallest (id, hash of the text) of a group stays, null ids first; of rows that repeat
    both, one stays.
    """
    row, again = unused(docs, "row"), unused(docs, "again")
    keyed = docs.withColumn(row, F.struct(F.col(id_col), F.xxhash64(text_col).alias("hash")))
    keep = (near_duplicates(keyed, shingle, max_bits, row, text_col)
            .filter("doc_id = component_id").select(F.col("doc_id").alias(row)).distinct())
    first = Window.partitionBy(row).orderBy(F.xxhash64(*docs.columns))
    return (keyed.join(keep, row).withColumn(again, F.row_number().over(first))
            .filter(F.col(again) == 1).select(docs.columns))
