import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.llm import spelling

SF = "/root/testdata/sf0.001"


def plain_words(rows):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            out[low[:h % len(low)] + low[h % len(low) + 1:] if h % 31 == 0 else low] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(words):
    """word: (form, root, n, n_near, form_n), by all words with one code point left out."""
    by_rest = defaultdict(set)
    for w in words:
        by_rest[w].add(w)
        for i in range(len(w)):
            by_rest[w[:i] + w[i + 1:]].add(w)
    near = {w: {x for r in [w, *(w[:i] + w[i + 1:] for i in range(len(w)))] for x in by_rest[r] if one_edit(w, x)} for w in words}
    best = {w: min(xs, key=lambda x: (-words[x], x), default=None) for w, xs in near.items()}
    form = {w: b if b is not None and words[b] >= 10 * words[w] else None for w, b in best.items()}
    out = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def result(frame):
    assert frame.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = frame.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: tuple(r)[1:] for r in rows}


def chains():
    """Words whose forms have forms, ties, words of other letters, odd rows."""
    texts = [("colourful " * 1200).strip(), "colorful " * 90, "colorfil " * 4, "kolorfil colorfil", "naïvement " * 30, "naivement " * 3, "NAÏVEMENT Naïvement",
             "aaaaaaaa " * 2, "aaaaaaab " * 30, "aaaaaaac " * 30, "aaaaaaa " * 2, "×÷×÷×÷× ×÷×÷×÷×÷", "sixsix", "word123456", None, "", "Ünïcödé ünïcödé"]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [(None, "colorful colorful"), (None, None), (3, texts[3]), (3, texts[3])] + [(1000 + i, "telephone telephoning straightforward") for i in range(300)]


def test_equals_brute_force(spark):
    docs = spark.createDataFrame(chains(), "doc_id long, text string").repartition(4).withColumn("word", F.lit(1)).withColumn("n", F.lit("x")).withColumn("key", F.lit(2))
    want = plain(plain_words(chains()))
    assert result(spelling.variants(docs)) == want
    assert max(sum(1 for _ in iter_chain(want, w)) for w in want) >= 2 and want["colorful"][1] == "colourful"


def iter_chain(forms, w):
    while forms[w][0]:
        w = forms[w][0]
        yield w


def test_query_equals_brute_force(spark):
    from quire.llm.catalog import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = plain(plain_words(rows))
    assert result(QUERIES["op11_spelling_variants"](spark, SF)) == want and sum(v[0] is not None for v in want.values()) >= 5


def test_empty_table_and_long_text(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(docs).count() == 0
    rows = [(1, "x" * 100_000 + " " + "spelling " * 100_000), (2, "spellin " * 9)]
    assert result(spelling.variants(spark.createDataFrame(rows, docs.schema))) == plain(plain_words(rows))


@pytest.mark.parametrize("meetings", [0, 5, 4096])
def test_near_words_in_crowded_groups(spark, meetings):
    """Words that share chunks: all are cut finer down to one code point, or none is."""
    rng = random.Random(6)
    words = {"".join(rng.choices("abé", k=rng.choice([7, 8, 9]))) for _ in range(700)} | {"a" * k for k in range(7, 24)} | {"ab" * k for k in range(4, 9)}
    words |= {"prefix" + "".join(rng.choices("xyz", k=3)) for _ in range(30)}
    frame = spark.createDataFrame([(w, len(w)) for w in words], "word string, n long")
    got = [tuple(r) for r in spelling.near_words(frame, meetings=meetings).collect()]
    pairs = {frozenset((a, b)) for a, _, b, _ in got}
    assert len(pairs) == len(got) and all(n == len(a) and m == len(b) for a, n, b, m in got)
    listed = sorted(words)
    assert pairs == {frozenset((a, b)) for i, a in enumerate(listed) for b in listed[:i] if abs(len(a) - len(b)) < 2 and one_edit(a, b)}


@settings(max_examples=300, deadline=None)
@given(st.text("abc", min_size=7, max_size=14), st.integers(0, 14), st.sampled_from("dir"), st.sampled_from("abcx"))
def test_one_edit_preserves_a_chunk(word, at, how, letter):
    at = min(at, len(word) - 1)
    other = word[:at] + ("" if how == "d" else letter) + word[at + (how != "i"):]
    a, b = sorted((word, other), key=len)
    q, more = len(a) // 2, len(b) - len(a)
    assert any(a[i * q:i * q + q] == b[i * q + s:i * q + s + q] for i in (0, 1) for s in {0, more})


def test_roots(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(11)] + [("x", "w3")], "word string, form string")
    assert {r.word: r.root for r in spelling.roots(forms, 11).collect()} == {f"w{i}": "w11" for i in range(11)} | {"x": "w11"}
