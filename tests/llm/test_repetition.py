import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.llm import repetition


def plain_longest(s):
    """Every pair of positions compared."""
    n = len(s)

    def common(i, j):
        k = 0
        while max(i, j) + k < n and s[i + k] == s[j + k]:
            k += 1
        return k

    return [max([0] + [common(i, j) for j in range(n) if j != i]) for i in range(n)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40))
def test_longest_repeats(symbols):
    got = repetition.longest_repeats(np.array(symbols + [9], np.int64))
    assert got.tolist() == plain_longest(symbols) + [0]


def test_ranks_sort_all_suffixes():
    rng = random.Random(3)
    s = [rng.randint(0, 3) for _ in range(500)] * 3 + [99]
    ranks = repetition.suffix_ranks(np.array(s, np.int64))[-1]
    assert np.argsort(ranks).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


def plain(text, min_words=5, max_covered=0.2, max_longest=50):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    longest = plain_longest(words)

    def inside(least):
        return {j for i in range(len(words)) if longest[i] >= least for j in range(i, i + longest[i])}

    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    n, five = len(words), len(inside(5))
    base = n < 10 or 100 * five > 20 * n
    covered, most = len(inside(min_words)), max(longest, default=0)
    return {"n_words": n, "word_chars": sum(map(len, words)), "n_symbols": len(re.findall("[#*$%&|<>]", text)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": five, "base_failed": base,
            "covered": covered, "longest": most,
            "kept": not base and covered <= max_covered * n and most <= max_longest}


TEXTS = [None, "", "  \n\t ", "one two", "a b c d e f g h i j", "a b c d e f g h i j\n" * 2, "x " * 300,
         "é\u00a0ñ | ## \n\n é\u00a0ñ | ##\n q " * 3, " ".join(map(str, range(200))),
         " ".join([*map(str, range(400)), *map(str, range(60)), "z"]), " ".join([*map(str, range(400)), *map(str, range(40))]),
         "日本語 " * 12, "\x1c\x1c a\x0bb\x0cc"]


@pytest.mark.parametrize("args", [{}, {"min_words": 3, "max_covered": 0.05, "max_longest": 4}])
def test_rules_equal_brute_force(spark, args):
    rng = random.Random(1)
    texts = TEXTS + [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(5, 90))) for _ in range(40)]
    docs = spark.createDataFrame([(i if i else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    got = docs.select("text", repetition.repetition(F.col("text"), **args).alias("r")).collect()
    for row in got:
        have = row.r.asDict()
        assert have.pop("spans") is None
        assert have == plain(row.text, **args), row.text
    assert docs.filter("false").select(repetition.repetition(F.col("text"))).count() == 0


def test_spans_are_maximal(spark):
    text = "q a b c d e f r a b c d e f s a b c d t"
    words = text.split()
    row = spark.createDataFrame([(text,)], "text string").select(
        repetition.repetition(F.col("text"), min_words=3, with_spans=True).alias("r")).first().r
    spans = [(s.start, s.end) for s in row.spans]
    assert spans == [(1, 7), (8, 14), (15, 19)] and row.covered == 16 and row.longest == 6
    assert [" ".join(words[a:b]) for a, b in spans] == ["a b c d e f", "a b c d e f", "a b c d"]


def test_very_long_text():
    n = 300_000
    once = list(next(repetition._judge([" ".join(map(str, range(n)))], 5, 0.2, 50, False)).values())
    assert once[:1] == [n] and once[-2] is True
    twice = next(repetition._judge([" ".join([*map(str, range(n // 2))] * 2)], 5, 0.2, 50, False))
    assert twice["longest"] == n // 2 and twice["n_repeat_words"] == n and not twice["kept"]
