import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import language
from quire.llm.catalog import QUERIES

SF = "/root/testdata/sf0.01"


def test_gradients_are_right():
    net = language.initial(["a", "b", "c"], units=5, kind=np.float64)
    words, target = [b"hello", b"x", b"\xc3\xa9t\xc3\xa9", b"abcdefgh"], np.array([0, 1, 2, 0])
    _, grads = language.loss_and_gradients(net, words, target)
    rng, step = np.random.default_rng(0), 1e-6
    for name, value in net.weights.items():
        for _ in range(8):
            at = tuple(int(rng.integers(0, n)) for n in value.shape)
            if name[0] == "w":
                at = (int(rng.choice(list(b"helox\xc3\xa9tabcd"))), at[1])
            value[at] += step
            up = language.loss_and_gradients(net, words, target)[0]
            value[at] -= 2 * step
            down = language.loss_and_gradients(net, words, target)[0]
            value[at] += step
            assert abs((up - down) / (2 * step) - grads[name][at]) < 1e-7


def plain_states(net, word, way):
    """One unit at a time, one word at a time."""
    w, u, b = (net.weights[k + way] for k in "wub")
    m, h, out = u.shape[0], np.zeros(u.shape[0]), []
    for c in word if way == "f" else word[::-1]:
        x, hu = w[c] + b, h @ u
        z, r = (1 / (1 + np.exp(-(x[k * m:(k + 1) * m] + hu[k * m:(k + 1) * m]))) for k in (0, 1))
        h = z * h + (1 - z) * np.tanh(x[2 * m:] + r * hu[2 * m:])
        out.append(h)
    return out if way == "f" else out[::-1]


def test_pooling_equals_one_position_at_a_time():
    net = language.initial(["x", "y", "z"], units=4, kind=np.float64)
    text = "Hello, wörld 123 -- 't été! " + "long" * 20
    logs = []
    for word in text.encode().split():
        core = word.strip(language.EDGE)
        for i in range(0, len(core), language.PIECE) if any(map(str.isalpha, core.decode())) else ():
            part = core[i:i + language.PIECE]
            for f, b in zip(plain_states(net, part, "f"), plain_states(net, part, "b")):
                logit = np.concatenate([f, b]) @ net.weights["out"] + net.weights["bias"]
                logs.append(logit - np.log(np.exp(logit).sum()))
    mean = np.exp(np.mean(logs, 0))
    names, scores = language.Labelled(net).pool([text, "", "12 34", text])
    assert names == [net.labels[mean.argmax()], "und", "und", net.labels[mean.argmax()]]
    assert np.allclose(scores, [(mean / mean.sum()).max(), 0, 0, (mean / mean.sum()).max()])


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES["op5_language_id"](spark, SF)
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    apart = [r.lang == r.lang_pred for r in rows if r.held_out]
    assert len(apart) > 200 and np.mean(apart) > 0.96


def test_prediction_uses_text_alone(spark):
    """Held-out rows with other languages, ids and sources teach nothing."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    changed = docs.withColumn("lang", F.when(language.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    a, b = language.train(docs), language.train(changed)
    assert a.labels == b.labels and all(np.array_equal(a.weights[k], b.weights[k]) for k in a.weights)


@pytest.mark.parametrize("rows", [[], [(1, "some text", None, "x")], [(2, None, "en", "x")]])
def test_nothing_to_learn(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    out = docs.select(language.predict(F.col("text"), language.train(docs)).alias("p")).collect()
    assert [(r.p.lang_pred, r.p.score) for r in out] == [("und", 0.0)] * len(rows)


def test_odd_rows(spark):
    rows = [(i, w, "en" if i % 2 else "de", "x") for i, w in enumerate(["the cat and the dog", "der hund und die katze"][::-1] * 30)]
    rows += [(100, None, "en", "x"), (None, "the the", "en", "x"), (101, "", None, "x"), (102, "1 2 3 !", "de", "x"),
             (103, "the " * 50_000, "en", "x"), (104, "w" * 100_000, None, "x"), (5, "the cat and the dog", "en", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string").withColumn("p", F.lit(0))
    out = docs.select("doc_id", "text", language.predict(F.col("text"), language.train(docs)).alias("r")).collect()
    assert len(out) == len(rows)
    for r in out:
        if r.text and any(map(str.isalpha, r.text)):
            assert r.r.lang_pred in ("en", "de") and 0 < r.r.score <= 1
        else:
            assert r.r.lang_pred == "und" and r.r.score == 0
    assert {r.r.lang_pred for r in out if r.doc_id in (1, 3, 103)} == {"en"}


def test_every_piece_of_a_long_word_can_teach(spark, monkeypatch):
    """Scripts without spaces: a word is a whole line."""
    line = "".join(chr(0x4E00 + i) for i in range(200))
    assert b"".join(language.pieces(line.encode())).decode() == line
    assert all(len(p.decode().encode()) <= language.PIECE for p in language.pieces(("a" + line).encode()))
    monkeypatch.setattr(language, "fit", lambda words, labels: words)
    held = [i for i in range(20) if zlib.crc32(str(i).encode()) % 4 != 2][0]
    words = language.train(spark.createDataFrame([(held, line, "zh")], "doc_id long, text string, lang string"))
    assert "".join(w.decode() for w in words) == line


def test_all_languages_with_text_are_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "fit", lambda words, labels: sorted(set(labels)))
    ids = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(ids[i], "some words", f"l{i:03}") for i in range(230)]
    rows += [(ids[300 + i], "more words" if i == 30 else None, "nulls") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language.train(docs, n_docs=1) == [f"l{i:03}" for i in range(230)] + ["nulls"]


def test_repeated_ids_teach_no_more_than_the_bound(spark, monkeypatch):
    monkeypatch.setattr(language, "fit", lambda words, labels: labels)
    free = next(i for i in range(20) if zlib.crc32(str(i).encode()) % 4 != 2)
    docs = spark.createDataFrame([(free, f"word{i}", "en") for i in range(40)] + [(free, "wort", "de")], "doc_id long, text string, lang string")
    assert language.train(docs, n_docs=5) == ["de"] + ["en"] * 5
