import math
import random
import re
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import weak_labels
from quire.llm.catalog import QUERIES

SF = "/root/testdata/sf0.01"


def test_label_model_finds_the_accuracies():
    """Votes drawn from known rates, three kinds of junk: the estimates and the posteriors follow them."""
    rng, n, good = random.Random(2), 20_000, [0.01] * 10
    kinds = [[0.9, 0.8, 0.7] + [0.01] * 7, [0.01] * 4 + [0.9, 0.9] + [0.01] * 4, [0.01] * 6 + [0.7] * 4]
    counts, truth = {}, {}
    for _ in range(n):
        rates = rng.choice(kinds) if (bad := rng.random() < 0.2) else good
        p = "".join("0" if rng.random() < r else "-" for r in rates)
        counts[p] = counts.get(p, 0) + 1
        truth.setdefault(p, []).append(bad)
    posterior, rates = weak_labels.label_model(counts)
    assert np.allclose(rates[:, 0], np.mean(kinds, 0), atol=0.05)
    assert np.allclose(rates[:, 1], good, atol=0.02)
    right = sum(sum(b == (posterior[p] < 0.5) for b in bads) for p, bads in truth.items())
    assert right > 0.97 * n


def test_label_model_without_junk_or_documents():
    posterior, _ = weak_labels.label_model({"-" * 7 + "1--": 500, "-" * 10: 20})
    assert min(posterior.values()) > 0.9
    assert weak_labels.label_model({})[0] == {}


@pytest.mark.parametrize("text,name", [
    ("a | b | c | d | e | f | g | h | i | j | k | l", "bare_marks"), ("THE BIG SALE STARTS NOW", "capitals"),
    ("go!! now!! buy!!", "exclamations"), ("x x x x x x x y", "echo"), ("a%%% b$$$ c###", "marks")])
def test_labellers(text, name):
    assert weak_labels.votes(text)[weak_labels.LABELLERS.index(name)] == "0"


def test_labellers_abstain():
    assert weak_labels.votes("  \n") == "-" * len(weak_labels.LABELLERS)
    clean = weak_labels.votes("The cat sat on the mat, and the dog lay by the door of the house that was for sale in town.")
    assert set(clean) <= {"-", "1"}


def test_scorer_is_logistic_regression():
    rng = np.random.default_rng(0)
    x = rng.random((200, weak_labels.BUCKETS + 1))
    target = (x[:, 3] > 0.5).astype(float)
    w = weak_labels.train(x, target)
    assert ((x @ w[:-1] + w[-1] > 0) == (target > 0.5)).mean() > 0.97
    assert not weak_labels.train(x[:0], target[:0]).any()


def test_labels_that_were_never_seen(spark):
    """The labels table takes no part in training; the scorer agrees with it."""
    got = QUERIES["op8_weak_label_quality"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    r = {(x.quality, x.kept): x["count"] for x in got.join(labels, "doc_id").groupBy("quality", "kept").count().collect()}
    assert r.get((1, True), 0) >= 0.98 * (r.get((1, True), 0) + r.get((1, False), 0))
    assert r.get((0, False), 0) >= 0.95 * (r.get((0, True), 0) + r.get((0, False), 0))


def test_odd_rows(spark):
    clean = "The cat sat on the mat, and the dog lay by the door of the house that was for sale in town."
    rows = [(1, clean, "x"), (1, clean, "x"), (2, None, None), (3, "  ", ""), (None, "BUY!! NOW!! " * 20, "z"),
            (4, "so the man said that he had been on the road. " * 20_000, "x"), (5, "%%% ### &&& " * 30, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, votes string").withColumn("score", F.lit("clash"))
    scorer, labelled = weak_labels.quality(docs)
    assert labelled.count() == len(rows)
    out = docs.withColumn("q", scorer).collect()
    kept = {str(r.doc_id): r.q.kept for r in out}
    assert len(out) == len(rows) and kept["1"] and not kept["2"] and not kept["3"] and not kept["5"]
    assert all(0 <= r.q.score <= 1 for r in out)
    empty = docs.filter("false")
    scorer, labelled = weak_labels.quality(empty)
    assert labelled.count() == 0 and empty.withColumn("q", scorer).count() == 0


MARKS = "#*$%&|<>{}[]=\\^~_"


def plain_votes(text):
    """The labellers one by one, on characters instead of bytes."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(words)
    if not n:
        return "-" * 10
    chars = [c for w in words for c in w]
    letters = sum(c in string.ascii_letters for c in text)
    triples = [tuple(words[i:i + 3]) for i in range(n - 2)]
    function = sum(w.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)) in weak_labels.FUNCTION_WORDS for w in words) / n
    other = sum(c not in string.ascii_letters and ord(c) < 128 for c in chars)
    size = sum(len(c.encode()) for c in chars)
    reject = lambda bad: "0" if bad else "-"
    return "".join([
        reject(sum(text.count(c) for c in MARKS) / n >= 0.2),
        reject(sum(w[-1] in MARKS + "!" for w in words) / n >= 0.3),
        reject(sum(all(c in MARKS for c in w) for w in words) / n >= 0.2),
        reject(letters and sum(c in string.ascii_uppercase for c in text) / letters >= 0.5),
        reject(text.count("!") / n >= 0.3),
        reject(sum(a == b for a, b in zip(words, words[1:])) / n >= 0.3),
        reject(n > 20 and 1 - len(set(triples)) / (n - 2) >= 0.6),
        "-" if n <= 20 or 0.01 < function < 0.08 else "1" if function >= 0.08 else "0",
        reject(n > 20 and 1 - (size - other) / size >= 0.2),
        reject(n > 20 and sum(w[-1] in ".?!" for w in words) / n >= 0.6)])


def test_votes_of_all_documents_equal_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    _, labelled = weak_labels.quality(spark.read.parquet(f"{SF}/documents.parquet"))
    got = {r.doc_id: r.votes for r in labelled.collect()}
    assert got == {r.doc_id: plain_votes(r.text or "") for r in rows}
    assert len({v for v in got.values()}) > 5


def plain_label_model(counts, rounds):
    """Expectation-maximisation with loops over patterns, kinds and labellers."""
    size, n_kinds = len(weak_labels.LABELLERS), len(weak_labels.LABELLERS) + 1
    member = {}
    for p in counts:
        no = [i for i in range(size) if p[i] == "0"]
        good = (0.98, 0.5, 0.02)[min(len(no), 2)]
        inside = no or range(size)
        member[p] = [(1 - good) / len(inside) if k in inside else 0.0 for k in range(size)] + [good]
    for _ in range(rounds):
        chance, prior = [], []
        for k in range(n_kinds):
            prior.append(sum(counts[p] * member[p][k] for p in counts) + (1 if k == size else 0.01))
            own = []
            for i in range(size):
                c = {v: s for v, s in zip("01-", (0.02, 2, 1) if k == size else (0.2, 0.2, 0.2))}
                for p in counts:
                    c[p[i]] += counts[p] * member[p][k]
                own.append({v: c[v] / sum(c.values()) for v in c})
            chance.append(own)
        for p in counts:
            likely = [math.log(prior[k] / sum(prior)) + sum(math.log(chance[k][i][p[i]]) for i in range(size)) for k in range(n_kinds)]
            top = [math.exp(x - max(likely)) for x in likely]
            member[p] = [x / sum(top) for x in top]
    return {p: m[size] for p, m in member.items()}


def test_label_model_equals_loops():
    rng = random.Random(9)
    counts = {"".join(rng.choices("-01", [8, 2, 1], k=10)): rng.randint(1, 400) for _ in range(25)}
    for rounds in (1, 7):
        got, _ = weak_labels.label_model(counts, rounds)
        want = plain_label_model(counts, rounds)
        assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-9 for p in want)


def test_scores_of_all_documents_equal_brute_force(spark):
    """The query's scores again: posteriors by loops, the sample by its rule, features word by word, the weights on them."""
    import zlib

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    hashed = {r.doc_id: r.h for r in docs.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    votes = {i: plain_votes(t) for i, t in texts.items()}
    counts = {}
    for v in votes.values():
        counts[v] = counts.get(v, 0) + 1
    posterior, _ = weak_labels.label_model(counts)

    def features(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        out = np.zeros(weak_labels.BUCKETS + 1)
        for w in words:
            kinds = ["A" if c in string.ascii_uppercase else "a" if c in string.ascii_lowercase else "0" if c in string.digits else c for c in w] if w.isascii() else [
                "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in w]
            shape = "".join(c for i, c in enumerate(kinds) if i == 0 or kinds[i - 1] != c)[:12]
            low = w.encode()[:40].lower()
            for x in (b"shape " + shape.encode(), b"end " + w.encode()[-3:], b"word " + low):
                out[zlib.crc32(x) % weak_labels.BUCKETS] += 1
        out[-1] = sum(a == b for a, b in zip(words, words[1:]))
        return np.sqrt(out / len(words)) if words else out

    taught = []
    for side in (lambda p: p < 0.5, lambda p: p >= 0.5):
        ids = sorted((i for i in texts if votes[i] != "-" * 10 and side(posterior[votes[i]])), key=lambda i: (hashed[i], i))[:weak_labels.SAMPLE]
        taught += ids
    x = np.array([features(texts[i]).astype("<f4") for i in taught], float)
    target = np.array([posterior[votes[i]] for i in taught])
    order = sorted(range(len(taught)), key=lambda k: (target[k], x[k].astype("<f4").tobytes()))
    w = weak_labels.train(x[order], target[order])
    got = {r.doc_id: r.score for r in QUERIES["op8_weak_label_quality"](spark, SF).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        f = features(t)
        want = 1 / (1 + math.exp(-(f @ w[:-1] + w[-1]))) if f.any() else 0.0
        assert abs(got[i] - want) < 1e-6, i


def test_scorer_remembers_few_words():
    """What a task remembers of the words it has seen stays under 60,000, and a text gets the same row after words were forgotten."""
    known, text = weak_labels.Features(), "Some words, and SOME more more."
    before = known.of([text])
    for at in range(0, 120_000, 10_000):
        known.of([" ".join(f"w{i}" for i in range(at, at + 10_000))])
        assert len(known.known) < 61_000
    assert (known.of([text]) == before).all()
