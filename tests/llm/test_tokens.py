import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quire.llm import bpe, packing, token_counts, tokens
from quire.llm.catalog import QUERIES

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "  a", "a  b", "a\n\n b", "a \tb ", "é é ́x", "don't  DON'T's", "日本語 テキスト", "a b   c",
       "x <|endoftext|> y", "<|endoftext|>", "<|startoftext|> A", "𝒳😀 z" * 3, "\x1c a \x1c", "w" * 5000, "1234 5 ²½", "ΑΣ ΑΣΑ ς",
       "a\x00b", "؀ ‍", " \n", "ﬁ İ"]
TEXT = st.text(st.one_of(st.sampled_from(" \n\t.,'sABéσΣ1́ <|>!"), st.characters(codec="utf-8")), max_size=60)


@pytest.fixture(scope="module")
def ranks():
    with open(RANKS, "rb") as f:
        return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                 mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})


def whole(path, texts):
    return [np.array(x.ids, "<u4").tobytes() for x in
            Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def texts(spark):
    return ODD + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


@pytest.mark.parametrize("path", [JSON, WORDS])
def test_pieces_equal_whole_texts(path, texts):
    want = whole(path, texts)
    assert tokens.from_file(path).ids(texts) == want and tokens.from_file(path).counts(texts) == [len(x) // 4 for x in want]


@settings(max_examples=100, deadline=None)
@given(TEXT)
def test_pieces_equal_whole_texts_at_random(text):
    for path in (JSON, WORDS):
        assert tokens.from_file(path).ids([text]) == whole(path, [text])


def test_ranks_equal_the_other_library(ranks, texts):
    got = bpe.encoder(RANKS, public_tokenizers.PATTERN).ids(texts)
    assert got == [np.array(ranks.encode_ordinary(t), "<u4").tobytes() for t in texts]


def test_byte_level_equals_the_tokenizers_library(texts):
    assert tokens.byte_level(JSON).ids(texts) == whole(JSON, texts)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    points = [f"a{c}b {c}1{c} {c}" for c in points[::37]]
    assert tokens.byte_level(JSON).ids(points) == whole(JSON, points)


@settings(max_examples=100, deadline=None)
@given(TEXT)
def test_byte_level_at_random(text):
    assert tokens.byte_level(JSON).ids([text]) == whole(JSON, [text])


@settings(max_examples=100, deadline=None)
@given(TEXT)
def test_round_trip_at_random(text):
    ids = bpe.encoder(RANKS, public_tokenizers.PATTERN).ids([text])[0]
    table = bpe.byte_table(RANKS)
    assert bpe.decoded(ids, table).decode() == text
    starts, ends = bpe.offsets(ids, table)
    parts = [table[i] for i in np.frombuffer(ids, "<u4")]
    at = 0
    for part, a, b in zip(parts, starts, ends):
        inside = text.encode()[at:at + len(part)]
        assert inside in text[a:b].encode()
        at += len(part)


def test_encoding_query(spark, ranks):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = set()
    for r in rows:
        ids = ranks.encode_ordinary(r.text or "")
        want.add((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                  hashlib.sha256((r.text or "").encode()).hexdigest()))
    got = QUERIES["op10_byte_bpe"](spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert {tuple(r) for r in got.collect()} == want


def odd_rows(spark):
    rows = [(1, "two words", "x"), (1, "two words", "x"), (2, None, None), (None, "two  words", "y"), (3, "", "z"),
            (4, "w " * 30_000, "x"), (5, "two words", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string").withColumn("digest", F.lit(1))


def test_encoding_odd_rows(spark):
    out = bpe.encode(odd_rows(spark), RANKS, public_tokenizers.PATTERN, with_offsets=True)
    got = out.select("doc_id", bpe.decode(F.col("ids"), RANKS).cast("string").alias("text"), "ends").collect()
    assert sorted((str(r.doc_id), r.text, (r.ends or [0])[-1]) for r in got) == \
        sorted((str(r.doc_id), r.text or "", len(r.text or "")) for r in odd_rows(spark).collect())
    assert bpe.encode(odd_rows(spark).filter("false"), RANKS, public_tokenizers.PATTERN).count() == 0
    assert spark.range(1).select(bpe.decode(F.lit(None).cast("binary"), RANKS).alias("x")).first().x is None


def test_counts_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    n = [len(x) // 4 for x in whole(WORDS, [r.text or "" for r in rows])]
    got = {tuple(r) for r in QUERIES["op9_token_counts"](spark, SF).collect()}
    assert got == {(r.doc_id, len((r.text or "").encode()), k, k > 2048) for r, k in zip(rows, n)}


def test_counts_use_and_fill_the_cache(spark, scratch):
    cache, docs = f"{scratch}/cache", odd_rows(spark)
    first = sorted(map(str, token_counts.token_counts(docs, WORDS, cache, fold_space=True).collect()))
    entries = spark.read.parquet(cache).collect()
    assert len({bytes(r.digest) for r in entries}) == 3  # "two words" with one space or two, "", the long one
    assert sorted(map(str, token_counts.token_counts(docs, WORDS, cache, fold_space=True).collect())) == first
    assert len(spark.read.parquet(cache).collect()) == len(entries)  # only hits
    more = docs.unionByName(docs.limit(1).withColumn("text", F.lit("a new text")))
    assert token_counts.token_counts(more, WORDS, cache, fold_space=True).count() == len(first) + 1
    assert len(spark.read.parquet(cache).collect()) == len(entries) + 1
    # a stored count is what the result carries
    spark.createDataFrame([(bytearray(hashlib.sha256(b"zz").digest()), token_counts.version_of(WORDS), 77)],
                          token_counts.CACHE).write.mode("append").parquet(cache)
    zz = spark.createDataFrame([(1, "zz")], "doc_id long, text string")
    assert token_counts.token_counts(zz, WORDS, cache).first().n_tokens == 77
    assert token_counts.token_counts(docs.filter("false"), WORDS, cache).count() == 0
    by_id = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, WORDS, cache).collect()}
    assert by_id == {1: 2, 2: 0, None: 2, 3: 0, 4: 30_000, 5: 2}


def check_packing(pieces, docs, capacity=1024):
    """docs: (id, ids) of each document. Every id once, sequences gapless and within capacity."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for name, ids in docs:
        at = 0
        for p in sorted(by_doc.pop(name), key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) // 4 and p.length > 0
            at += p.length
            assert p.ids_crc32 == zlib.crc32(ids[4 * p.start:4 * at])
        assert at == len(ids) // 4
    assert not by_doc
    padding = 0
    for s in by_sequence.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding, len(by_sequence)


def test_packing_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    ids = [x + b"\0\0\0\0" for x in whole(JSON, [r.text or "" for r in rows])]
    padding, sequences = check_packing(QUERIES["op7_packing"](spark, "/root/testdata/sf0.01").collect(),
                                       [(r.doc_id, x) for r, x in zip(rows, ids)])
    print("padding", padding, "of", sequences * 1024)
    assert padding < 0.02 * sequences * 1024


def test_packing_odd_rows(spark):
    docs = odd_rows(spark).filter("doc_id is null or doc_id <> 1")
    out = packing.pack(docs, JSON, capacity=64, open_windows=2, with_ids=True).collect()
    rows = docs.select("doc_id", "text").collect()
    check_packing(out, [(r.doc_id, x + b"\0\0\0\0") for r, x in zip(rows, whole(JSON, [r.text or "" for r in rows]))], 64)
    assert all(zlib.crc32(p.ids) == p.ids_crc32 for p in out)
    assert packing.pack(docs.filter("false"), JSON).count() == 0
    again = packing.pack(odd_rows(spark), JSON).collect()
    assert sum(p.doc_id == 1 for p in again) == 2  # repeated rows are documents of their own


def test_windows_are_bounded_and_best_fit():
    w = packing.Windows(100, 2)
    assert w.place(60) == (0, 0, None) and w.place(70) == (1, 0, None)
    assert w.place(30) == (1, 70, None)  # fills it: closed
    assert w.place(50) == (2, 0, None) and w.place(90) == (3, 0, 0) and w.place(95)[2] == 3
    rng = random.Random(1)
    w = packing.Windows(1024, 64)
    for _ in range(5000):
        w.place(rng.randint(1, 1023))
        assert len(w.room) <= 64


def test_merged_leftovers_fill_sequences(spark):
    rows = [(i, 0, 100 + i % 300, 0, 1, i // 10, i, True, 0) for i in range(400)]
    left = spark.createDataFrame(rows, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                       "part int, win long, is_open boolean, offset long")
    used, spans = defaultdict(int), defaultdict(list)
    for r in packing.merge(left, 1024).collect():
        used[r.sequence_id] += r.length
        spans[r.sequence_id].append((r.offset, r.length))
    for s in spans.values():
        s.sort()
        assert [a for a, _ in s] == [sum(n for _, n in s[:i]) for i in range(len(s))]
    by_group = defaultdict(list)
    for k, n in used.items():
        by_group[k >> 32].append(n)
    assert len(by_group) == 5 and sum(used.values()) == sum(100 + i % 300 for i in range(400)) and max(used.values()) <= 1024
    for n in by_group.values():
        assert sum(sorted(n)[:2]) > 1024  # no two of a group would fit into one


def test_long_white_space(spark):
    """A run of white space longer than one library can look ahead over."""
    texts = ["a few words" + " " * 1_000_000, "\t" * 1_000_000 + "x", "a" + "\n" * 1_000_000 + "b", (" " * 99_999 + "x") * 3]
    want = whole(JSON, texts)
    assert tokens.byte_level(JSON).ids(texts) == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pieces = packing.pack(docs, JSON).collect()
    check_packing(pieces, [(i, x + b"\0\0\0\0") for i, x in enumerate(want)])
    encoded = {r.doc_id: bytes(r.ids) for r in bpe.encode(docs, RANKS, public_tokenizers.PATTERN).collect()}
    assert {i: len(x) for i, x in encoded.items()} == {i: len(x) for i, x in enumerate(want)}
    assert token_counts.token_counts(docs, WORDS, fold_space=True).count() == 4


def test_offsets_of_the_query(spark, ranks):
    """Every document's offsets, token by token: where its bytes begin and end among the text's characters."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r.offsets_sha256 for r in QUERIES["op10_byte_bpe"](spark, SF).collect()}
    table = bpe.byte_table(RANKS)
    for r in rows:
        text = r.text or ""
        place = [i for i, c in enumerate(text) for _ in c.encode()]  # character of each byte
        starts, ends, at = [], [], 0
        for i in ranks.encode_ordinary(text):
            starts.append(place[at])
            at += len(table[i])
            ends.append(place[at - 1] + 1)
        assert got[r.doc_id] == hashlib.sha256(np.array(starts, "<u4").tobytes() + np.array(ends, "<u4").tobytes()).hexdigest()


def test_folding_keeps_texts_with_special_strings(spark):
    specials = token_counts.special_strings(WORDS)
    assert "<|endoftext|>" in specials
    df = spark.createDataFrame([("a <|  b",), ("a  <|endoftext|>  b",), ("a \n\tb",)], "text string")
    assert [r[0] for r in df.select(token_counts.folded(F.col("text"), specials)).collect()] == ["a <| b", "a  <|endoftext|>  b", "a b"]
    assert df.select(token_counts.folded(F.col("text"), [])).first()[0] == "a <| b"
