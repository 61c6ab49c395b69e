import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.llm import circulant

SF = "/root/testdata/sf0.001"


def plain_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def plain_components(rows, size, percent=80):
    """(id, n, component, kept) of (id, text) with distinct ids or repeated rows, all pairs compared."""
    sets = [plain_set(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            lo, hi = sorted((len(sets[i]), len(sets[j])))
            if lo and 100 * lo >= percent * hi and top(i) != top(j):
                common = len(sets[i] & sets[j])
                if 100 * common >= percent * len(sets[i] | sets[j]):
                    parent[top(i)] = top(j)
    groups = {}
    for i, (name, _) in enumerate(rows):
        groups.setdefault(top(i), []).append(name)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return sorted(((name, len(sets[i]), least[top(i)], name == least[top(i)]) for i, (name, _) in enumerate(rows)), key=str)


def found(frame):
    assert frame.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in frame.collect()), key=str)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"x{rng.random():.6f}"
    return " ".join(out)


def family(rng):
    """Chains of edits, families just below the threshold, copies, short and odd texts."""
    rows, vocabulary = [], [f"w{i}" for i in range(3000)]
    for _ in range(12):
        words = rng.choices(vocabulary, k=rng.choice([40, 120]))
        for _ in range(6):
            rows.append(" ".join(words))
            words = edited(rng, words, rng.choice([1, 2, 4])).split()
    base = rng.choices(vocabulary, k=100)
    rows += [edited(rng, base, 4) for _ in range(40)]  # about 0.7 alike
    rows += [rows[0], rows[0].upper(), rows[0].replace(" ", "\n \t"), rows[1], "one two three", "ONE two\x0bthree", "one two", "", " \t", None, "\xa0one"]
    return rows


def test_equals_brute_force(spark):
    rng = random.Random(8)
    rows = list(enumerate(family(rng)))
    rows += [rows[5], (None, rows[9][1]), (None, None), (None, "alone in the world with no id"), (None, "alone in the world with no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumn("digest", F.lit("x")).withColumn("n", F.lit(1)).withColumn("key", F.lit(2))
    want = plain_components(rows, 4)
    assert found(circulant.near_duplicates(docs, shingle=4)) == want
    assert sum(not k for *_, k in want) > 30


def test_blocks_of_a_bucket(spark):
    """A family below the threshold with a few links among its members, dealt over many blocks."""
    rng = random.Random(2)
    base = [f"w{i}" for i in range(60)]
    texts = [edited(rng, base, 3) for _ in range(150)]
    texts += [t + " tail" for t in texts[::7]]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = plain_components(rows, 4)
    assert found(circulant.near_duplicates(docs, shingle=4, block=8)) == want
    assert 20 <= sum(not k for *_, k in want) < 150


def test_query_equals_brute_force(spark):
    from quire.llm.catalog import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert found(QUERIES["op12_circulant_minhash"](spark, SF)) == plain_components(rows, 4)


def test_empty_table_and_long_text(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert circulant.near_duplicates(docs).count() == 0
    long = " ".join(f"w{i % 70_000}" for i in range(150_000))
    rows = [(3, long), (2, long + " end"), (1, "w " * 200_000), (0, " " * 1_000_000)]
    got = found(circulant.near_duplicates(spark.createDataFrame(rows, docs.schema)))
    assert got == [(0, 0, 0, True), (1, 1, 1, True), (2, 70_001, 2, True), (3, 70_000, 2, False)]


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aB \t\x0b\x1c\x85\xa0é"), max_size=40), st.integers(1, 5))
def test_shingles(text, size):
    got = circulant.shingles(text, size)
    assert len(got) == len(plain_set(text, size)) and list(got) == sorted(set(got.tolist()))


def test_coordinates_estimate_similarity():
    """Shares of equal coordinates are as many as similarity says, and vary no more than independent ones would."""
    rng, n = np.random.default_rng(4), circulant.BANDS * circulant.ROWS
    with np.errstate(over="ignore"):
        for size, common in ((50, 25), (400, 356), (400, 100)):
            true, shares = common / (2 * size - common), []
            for _ in range(150):
                pool = rng.integers(0, 2**64, 2 * size - common, np.uint64, endpoint=False)
                a, b = circulant.signature(pool[:size], n), circulant.signature(pool[size - common:], n)
                shares.append((a == b).mean())
            spread = (true * (1 - true) / n) ** 0.5
            assert abs(np.mean(shares) - true) < 4 * spread / 150 ** 0.5 and np.std(shares) < 1.25 * spread


def test_one_permutation_shifted():
    """Coordinate k of a set is coordinate 0 of the set whose first permutation is moved on by k."""
    with np.errstate(over="ignore"):
        x = np.arange(5, dtype=np.uint64) * np.uint64(0x123456789ABCDEF)
        first = x * circulant._FIRST[0]
        first = (first ^ first >> np.uint64(32)) * circulant._FIRST[1]
        first ^= first >> np.uint64(29)
        for k in (0, 1, 7, 179):
            y = (first + np.uint64(k)) * circulant._SECOND[0]
            y = (y ^ y >> np.uint64(32)) * circulant._SECOND[1]
            assert circulant.signature(x, 180)[k] == y.min()


@pytest.mark.parametrize("copies", [2500])
def test_many_near_copies(spark, copies):
    rng = random.Random(1)
    base = [f"w{i}" for i in range(80)]
    rows = [(i, edited(rng, base, 1)) for i in range(copies)] + [(copies + i, " ".join(base)) for i in range(copies)]
    got = found(circulant.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), shingle=4))
    assert {c for _, _, c, _ in got} == {0} and sum(k for *_, k in got) == 1


def test_filter_of_names(spark):
    import zlib

    from quire.llm.common import bits_of

    names = [f"{i}é" for i in range(3000)] + [""]
    bits = bits_of(spark.createDataFrame([(x,) for x in names], "name string"), "name", 1 << 20)
    assert {i * 8 + j for i, b in enumerate(bits) if b for j in range(8) if b >> j & 1} == {zlib.crc32(x.encode()) % (1 << 20) for x in names}
