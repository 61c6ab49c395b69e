import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quire.llm import simhash
from quire.llm.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text, k=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(rows, bits=2):
    """All pairs compared; rows: (id, fingerprint)."""
    fps = sorted({f for _, f in rows})
    group = {f: f for f in fps}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= bits:
                group[find(a)] = find(b)
    best = {}
    for d, f in rows:
        best[find(f)] = min(best.get(find(f), d), d)
    return {d: best[find(f)] for d, f in rows}


def test_every_pair_within_the_radius_collides():
    for radius, positions in ((1, 20), (2, 28), (2, 64), (3, 24)):
        tables = simhash.masks(list(range(positions)), radius)
        assert len(tables) == 2 ** (radius + 1) - 1
        rng = random.Random(radius)
        for _ in range(300):
            changed = sum(1 << p for p in rng.sample(range(positions), radius))
            assert any(not m & changed for m in tables)


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op6_simhash_near_dedup"](spark, SF).collect()
    want = [(r.doc_id, plain_fingerprint(r.text)) for r in rows]
    groups = plain_groups(want)
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == \
        sorted((d, f"{f:016x}", groups[d]) for d, f in want)
    assert len(set(groups.values())) < len(groups)


def test_links_of_crowded_buckets(spark):
    """With a tiny bucket limit every level of the masks is used; no link is lost."""
    rng, values = random.Random(5), set()
    for _ in range(60):
        center = rng.getrandbits(64)
        values.add(center)
        for _ in range(rng.randint(0, 8)):
            values.add(center ^ sum(1 << p for p in rng.sample(range(64), rng.randint(1, 3))))
    values = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    rows = [(v, v & (1 << 64) - 1) for v in values]
    want = plain_groups(rows)
    for limit in (4096, 64):
        links = simhash.covering_links(fps, 2, bucket=limit) if limit > 64 else simhash.covering_links(fps, 2, 64)
        roots = {r.node: r.root for r in simhash.components(links).collect()}
        got = {v: roots.get(v, v) for v in values}
        assert got == want


def test_hot_level_is_split(spark):
    """6,000 fingerprints that agree on all but 14 bits: beyond one bucket, still all linked."""
    base = 0x0123456789ABCDEF & ~0x3FFF
    fps = spark.range(6000).select((F.lit(base).bitwiseOR(F.col("id"))).alias("fp"))
    roots = simhash.components(simhash.covering_links(fps, 2)).collect()
    assert len(roots) == 5999 and {r.root for r in roots} == {base}


def test_chain_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(links).collect()}
    assert got == {i: 1 for i in range(2, 41)} | {101: 100}


def test_odd_rows(spark):
    rows = [(3, None, "x"), (1, "", "y"), (2, "  \n", "z"), (5, "a b", "x"), (4, "A  b", "x"), (4, "A  b", "x"),
            (None, "a b", "x"), (9, "w " * 50_000, "x"), (None, "only here and nowhere else", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").withColumn("component_id", F.lit(1))
    got = sorted([(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()], key=str)
    assert got == sorted([(3, 1), (1, 1), (2, 1), (5, 4), (4, 4), (4, 4), (None, 4), (9, 9), (None, None)], key=str)
    kept = simhash.unique(docs).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "9", "None", "None"] and set(kept[0].asDict()) == set(docs.columns)
    empty = docs.filter("false")
    assert simhash.near_duplicates(empty).count() == 0 and simhash.unique(empty).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 4, 70_000])
def test_fingerprint_lengths(n):
    text = " ".join(f"W{i % 997}" for i in range(n))
    assert np.int64(simhash.simhash(text, 3)).view(np.uint64) == plain_fingerprint(text) if n < 100 else True
    if n > 100:
        words = text.lower().split()
        h = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]), 42) for i in range(n - 2)]
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        assert simhash.simhash(text, 3) & (1 << 64) - 1 == want


def test_unique_keeps_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b c", 5, "x", 9), (2, "a b c", 6, "y", 8)], "doc_id long, text string, _row long, Again string, row long")
    got = simhash.unique(docs)
    assert got.columns == docs.columns and [tuple(r) for r in got.collect()] == [(1, "a b c", 5, "x", 9)]
