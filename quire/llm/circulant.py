"""Near-duplicates by circulant MinHash, banding and exact Jaccard similarity.

Two permutations of the 64-bit numbers make the whole signature.  The first scatters the shingle hashes; the
second, shifted circularly by k, gives coordinate k: the least value of ``second(first(h) + k)`` over the set.
Both are bijections (odd multipliers and shifted exclusive-or), so no table of permutations is kept.

Bands of coordinates put sets into buckets.  Sets in a bucket are verified on all their shingles:

1. every set against one root of its bucket, which links copies of one text without making pairs of them;
2. in buckets whose other sets then still belong to several components, all sets of different components against each
   other, in blocks of bounded size, as rows of a bit matrix.  A block gives links that connect its components, never
   pairs, so its result is no larger than itself.

So a link that a bucket holds is found, or its ends are connected already, and every link is exact.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..session import materialize
from .common import bits_of, inputs, lookup, slices, written
from .simhash import components

#: Bands and coordinates of each: of links at a similarity of 0.8, 4 in 100,000 share no bucket.
BANDS, ROWS = 36, 5
#: Sets of a bucket, and shingles in them, that make one block; pairs of blocks cover the bucket.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20
#: Numbers of a set worked on at a time.
STRIP = 2048
#: Bits of the filter that tells tasks which documents are candidates: 8 MB, whatever the input.
FILTER_BITS = 1 << 26
_FIRST = tuple(map(np.uint64, (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)))
_SECOND = tuple(map(np.uint64, (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)))
_BAND = np.uint64(0x9FB21C651E98DF25)
_32, _29 = np.uint64(32), np.uint64(29)


def shingles(text: str, size: int) -> np.ndarray:
    """The distinct hashes of a text's word shingles, ascending.

    Words are runs of anything but ASCII white space, A-Z lower-cased.  With fewer words than a shingle
    the whole sequence is one; a text without words has none.
    """
    words = text.encode().lower().split()
    if len(words) <= size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))] if words else [], np.uint64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    ends = (starts + lengths)[size - 1:].tolist()
    digest = xxhash.xxh3_64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b]) for a, b in zip(starts.tolist(), ends)), np.uint64, len(ends)))


def signature(hashes: np.ndarray, n: int) -> np.ndarray:
    """``n`` coordinates of a set: the least value of the second permutation at each circular shift of the first.

    ``second(x + k)`` begins with a multiplication, so the shift is an addition of k times its multiplier.
    """
    x = hashes * _FIRST[0]
    x = (x ^ x >> _32) * _FIRST[1]
    x = (x ^ x >> _29) * _SECOND[0]
    shift = (np.arange(n, dtype=np.uint64) * _SECOND[0])[:, None]
    least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(x), STRIP):
        y = x[None, at:at + STRIP] + shift
        y ^= y >> _32
        y *= _SECOND[1]
        np.minimum(least, y.min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray, bands: int) -> np.ndarray:
    """One signed 64-bit key for each band of coordinates."""
    rows = least.reshape(bands, -1)
    key = np.arange(1, bands + 1, dtype=np.uint64) * _FIRST[0]
    for column in rows.T:
        key = (key ^ column ^ key >> _29) * _BAND
    return (key ^ key >> _32).view(np.int64)


def sketch(text: Column, size: int, bands: int, rows: int) -> Column:
    """Struct for each text: ``digest`` of its set and band ``keys`` (null for the empty set), and how many shingles it has, ``n``."""
    made_type = pa.struct([("digest", pa.binary()), ("n", pa.int64()), ("keys", pa.list_(pa.int64()))])

    def made(text: str) -> dict:
        hashes = shingles(text, size)
        if not len(hashes):
            return {"digest": None, "n": 0, "keys": None}
        with np.errstate(over="ignore"):
            keys = band_keys(signature(hashes, bands * rows), bands)
        return {"digest": digest(hashes), "n": len(hashes), "keys": keys}

    @arrow_udf("struct<digest:binary,n:long,keys:array<long>>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [pa.array([made(x or "") for x in part], made_type) for part in slices(batch)]
            yield pa.concat_arrays(parts) if parts else pa.array([], made_type)

    return of.asNondeterministic()(text)


def digest(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def full_sets(rows: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(digest, n, hashes) of at least the sets whose documents are ``wanted`` (name).

    ``rows``: name, text.  A second pass over the texts makes them, because few sets are candidates and a set
    is larger than its text: kept from the first pass they would fill the disk.
    """
    bits = bits_of(wanted, "name", FILTER_BITS)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, texts in zip(slices(batch.column(0)), slices(batch.column(1))):
                found = []
                for name, text in zip(names, texts):
                    at = zlib.crc32(name.encode()) % FILTER_BITS
                    if bits[at >> 3] >> (at & 7) & 1 and len(hashes := shingles(text, size)):
                        found.append(hashes)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(map(digest, found), pa.binary()), pa.array(map(len, found), pa.int64()),
                                                      pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64()))], ["digest", "n", "hashes"])

    return rows.select("name", "text").mapInArrow(make, "digest binary, n long, hashes array<long>")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets have at least ``percent`` of their union in common.

    A set travels once for each pair it is in; sizes that rule a pair out are looked at first.
    """
    own = sets.select("digest", "n", "hashes")
    sized = (pairs.join(own.select(F.col("digest").alias("a"), F.col("n").alias("n_a")), "a")
             .join(own.select(F.col("digest").alias("b"), F.col("n").alias("n_b")), "b")
             .filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")))
    both = (sized.join(own.select(F.col("digest").alias("a"), F.col("hashes").alias("h_a")), "a")
            .join(own.select(F.col("digest").alias("b"), F.col("hashes").alias("h_b")), "b"))
    common = F.size(F.array_intersect("h_a", "h_b"))
    return (both.withColumn("common", common).filter(100 * F.col("common") >= percent * (F.col("n_a") + F.col("n_b") - F.col("common")))
            .select("a", "b"))


def _spanning(sets: list[np.ndarray], side: np.ndarray, labels: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of places that connect the components of ``labels`` which links between the two sides connect.

    ``side``: block of each set; one block is compared with itself.  Every pair of different components is compared on all
    its shingles: sets are rows of a matrix with one bit for each shingle that two of them have.
    """
    rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    place = np.cumsum(shared) - 1
    rows, column = rows[shared[column]], place[column[shared[column]]]
    bits = np.zeros((len(sets), (int(shared.sum()) >> 6) + 1), np.uint64)
    np.bitwise_or.at(bits, (rows, column >> 6), np.uint64(1) << (column & 63).astype(np.uint64))
    sizes, labels, out = np.array([len(x) for x in sets]), labels.copy(), []
    first = np.flatnonzero(side == side.min())
    second = np.flatnonzero(side == side.max())
    for x in first:
        others = second[(second > x) | (side[second] != side[x])]
        while len(others := others[labels[others] != labels[x]]):
            part, others = others[:256], others[256:]
            common = np.bitwise_count(bits[part] & bits[x]).sum(axis=1, dtype=np.int64)
            for y in part[100 * common >= percent * (sizes[part] + sizes[x] - common)]:
                if labels[y] != labels[x]:
                    labels[labels == labels[y]] = labels[x]
                    out.append((int(x), int(y)))
    return out


def _cross(members: DataFrame, percent: int, block: int, shingles_: int) -> DataFrame:
    """Links (a, b) that connect the sets of one bucket and different components, as far as links do.

    ``members``: key, digest, label, hashes, and of the bucket ``sets`` and ``total``, its sets and shingles.  A bucket is
    dealt by digest over blocks of about ``block`` sets and ``shingles_`` shingles at most; each pair of blocks is one group.
    """
    blocks = F.greatest(F.ceil(F.col("sets") / block), F.ceil(F.col("total") / shingles_)).cast("int")
    dealt = members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("digest"), "blocks").cast("int"))
    paired = dealt.select("key", "digest", "label", "hashes", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    paired = paired.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "digest", "label", "hashes")

    def connect(table: pa.Table) -> pa.Table:
        digests, hashes = table.column("digest").to_pylist(), table.column("hashes").combine_chunks()
        ends, values = hashes.offsets.to_numpy(), hashes.values.to_numpy()
        sets = [values[a:b] for a, b in zip(ends[:-1], ends[1:])]
        labels = np.unique(np.array(table.column("label").to_pylist(), "S32"), return_inverse=True)[1]
        out = _spanning(sets, table.column("own").to_numpy(), labels, percent)
        return pa.table({"a": pa.array([digests[x] for x, _ in out], pa.binary()), "b": pa.array([digests[y] for _, y in out], pa.binary())})

    return paired.groupBy("key", "i", "j").applyInArrow(connect, "a binary, b binary")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Documents are linked if their sets of ``shingle`` words have at least ``percent`` of their union in common.  ``component_id`` is the
    smallest id that links reach, the row's own included; ``kept`` tells whether it is the row's own.  A null or empty text, or one
    without words, has no shingles and no link.  Rows that repeat an id and text all stay.  A null id never
    names a component unless all its ids are null; then it is kept.  An empty table gives an empty result.
    """
    source = inputs(docs, id_col, text_col).withColumn("name", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    made = source.select("doc_id", "name", sketch(F.col("text"), shingle, bands, rows).alias("s"))
    table = written(made.select("doc_id", "name", "s.*"), "circulant")
    # one row for each set, whatever its copies
    nodes = written(table.filter("digest is not null").groupBy("digest").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("least"), F.min("name").alias("name"), F.first("keys").alias("keys")), "circulant-sets")
    keyed = nodes.select("digest", F.explode("keys").alias("key"))
    buckets = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("digest").alias("root")).filter("n > 1")
    members = written(keyed.join(buckets, "key"), "circulant-buckets")
    wanted = written(nodes.join(members.select("digest").distinct(), "digest", "left_semi").select("digest", "name"), "circulant-candidates")
    sets = full_sets(source, wanted, shingle).join(wanted.select("digest"), "digest", "left_semi")
    # rows that repeat an id and text, and ids of several texts, give a set more than once
    sets = written(sets.groupBy("digest").agg(F.first("n").alias("n"), F.first("hashes").alias("hashes")), "circulant-hashes")
    star = members.filter("digest <> root").select(F.col("root").alias("a"), F.col("digest").alias("b")).distinct()
    links = materialize(verified(star, sets, percent))
    found = components(links)

    # buckets of three and more whose sets beside the root are in several components
    label = found.unionAll(found.select("root", "root").distinct()).toDF("digest", "label")
    others = (members.filter("n > 2 and digest <> root").select("key", "digest").join(label, "digest", "left")
              .withColumn("label", F.coalesce("label", "digest")))
    others = others.join(sets.select("digest", F.col("n").alias("size")), "digest")
    alike = [F.bit_xor(F.xxhash64("digest", F.lit(i))).alias(f"set{i}") for i in (1, 2)]
    mixed = (others.groupBy("key").agg(F.min("label").alias("first"), F.max("label").alias("last"), F.count("*").alias("sets"),
                                       F.sum("size").alias("total"), *alike).filter("first <> last")
             # of buckets with the same sets one is enough
             .groupBy("sets", "total", "set1", "set2").agg(F.min("key").alias("key")).select("key", "sets", "total"))
    crowd = others.select("key", "digest", "label").join(mixed, "key").join(sets.select("digest", "hashes"), "digest")
    more = materialize(_cross(crowd, percent, block, BLOCK_SHINGLES))
    if not more.isEmpty():
        found = components(links.unionAll(more))
    return _named(table, nodes, found)


def _named(table: DataFrame, nodes: DataFrame, found: DataFrame) -> DataFrame:
    """The component of every row; ``found``: node and root of the sets that have links."""
    member = found.unionAll(found.select("root", "root").distinct()).toDF("digest", "root")
    named = member.join(nodes.select("digest", "least"), "digest")
    best = named.groupBy("root").agg(F.min("least").alias("best"))
    linked = named.join(best, "root").select("digest", "best")
    # sets of one row without a link need no lookup: the row is its own component
    label = (nodes.select("digest", "copies", "least").join(linked, "digest", "left").filter("copies > 1 or best is not null")
             .select("digest", "copies", F.coalesce("best", "least").alias("component_id")))
    rows = table.select("doc_id", F.col("n").alias("n_shingles"), "digest")
    out = lookup(rows, written(label, "circulant-labels"), "digest", "copies", "left")
    own = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))
