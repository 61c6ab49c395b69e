"""Quality classifier from weak labels: heuristic labellers, a label model and a hashed scorer.

Several overlapping heuristics vote accept, reject or abstain on every document.  Their accuracies
are not known; expectation-maximisation over the counts of vote patterns (at most 3 to the power of
the labellers, whatever the corpus) estimates them together with each pattern's posterior.  The
posteriors of a bounded sample then train a linear scorer on hashed word shapes, which judges every
document, also where the heuristics abstain.
"""
from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..session import materialize
from .common import inputs, slices

#: Frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = frozenset(
    "the of and to in a is that it for was on are as with his they be at this have from or had by "
    "der die und den von zu das mit sich des auf ist im dem nicht ein eine als auch es an er "
    "de la le et les des en un du une que est pour qui dans par au sur pas plus ne se ce il "
    "el los las del y se con por una su para como al lo".split())
_FUNCTION = frozenset(w.encode() for w in FUNCTION_WORDS)
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))
_HIGH = bytes(range(128, 256))
_MARKS = b"#*$%&|<>{}[]=\\^~_"

#: Hashed features; documents of each side of the posterior that train the scorer; steps of training.
BUCKETS, SAMPLE, STEPS = 1024, 1000, 200

#: All but function_words reject or abstain: that a text lacks one kind of junk says little for it.
LABELLERS = ("marks", "odd_ends", "bare_marks", "capitals", "exclamations", "echo", "variety",
             "function_words", "letters", "sentences")


def _over(value: float, limit: float) -> str:
    return "0" if value >= limit else "-"


def votes(text: str) -> str:
    """One character for each of LABELLERS: 1 accept, 0 reject, - abstain; all abstain without words."""
    data = text.encode()
    words = data.split()
    n = len(words)
    if not n:
        return "-" * len(LABELLERS)
    letters = len(data) - len(data.translate(None, _LETTERS))
    capitals = len(data) - len(data.translate(None, _UPPER))
    marks = len(data) - len(data.translate(None, _MARKS))
    high = len(data) - len(data.translate(None, _HIGH))  # parts of characters beyond ASCII count as letters
    dense = sum(map(len, words))
    triples = len(set(zip(words, words[1:], words[2:]))) / (n - 2) if n > 20 else None
    ends = b"".join([w[-1:] for w in words])
    closed = len(ends) - len(ends.translate(None, b".?!"))
    function = sum(map(_FUNCTION.__contains__, data.lower().split())) / n
    return "".join((
        _over(marks / n, 0.2),
        _over((n - len(ends.translate(None, _MARKS + b"!"))) / n, 0.3),
        _over(sum(not w.strip(_MARKS) for w in words) / n, 0.2),
        _over(capitals / letters, 0.5) if letters else "-",
        _over(data.count(b"!") / n, 0.3),
        _over(sum(map(eq, words, words[1:])) / n, 0.3),
        "-" if triples is None else _over(1 - triples, 0.6),
        "-" if n <= 20 or 0.01 < function < 0.08 else "1" if function >= 0.08 else "0",
        _over(1 - (letters + high) / dense, 0.2) if n > 20 else "-",
        _over(closed / n, 0.6) if n > 20 else "-"))


def vote(text: Column) -> Column:
    """Column of the votes on ``text``; null counts as empty."""

    @arrow_udf("string")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([votes(x or "") for part in slices(batch) for x in part], pa.string())

    return of.asNondeterministic()(text)


def label_model(counts: dict[str, int], rounds: int = 500) -> tuple[dict[str, float], np.ndarray]:
    """Posterior of acceptance of each vote pattern, and each labeller's rate of rejecting [bad, good].

    Votes (reject, accept, abstain) are independent given the class: good, or one kind of junk for
    each labeller, since junk that one labeller sees looks fine to most others.  A pattern starts
    in the kinds of the labellers that reject it, or half good if only one does, or good;
    smoothing keeps rejections rare in the good class.  Without any document there is no pattern.
    """
    patterns, kinds = sorted(counts), len(LABELLERS)
    if not patterns:
        return {}, np.full((kinds, 2), np.nan)
    n = np.array([counts[p] for p in patterns], float)
    made = np.array([[[c == v for c in p] for p in patterns] for v in "01-"], float)  # [vote, pattern, labeller]
    rejecting = made[0].sum(1)
    member = np.zeros((len(patterns), kinds + 1))
    member[:, kinds] = np.choose(np.minimum(rejecting, 2).astype(int), [0.98, 0.5, 0.02])
    member[:, :kinds] = np.where(rejecting[:, None] > 0, made[0], 1) * (
        (1 - member[:, kinds]) / np.where(rejecting > 0, rejecting, kinds))[:, None]
    smooth = np.full((kinds + 1, 1, 3), 0.2)
    smooth[kinds] = [0.02, 2, 1]
    for _ in range(rounds):
        votes_of = np.einsum("pk,vpl->klv", member * n[:, None], made) + smooth
        log = np.log(votes_of / votes_of.sum(2, keepdims=True))
        size = (member * n[:, None]).sum(0) + np.r_[np.full(kinds, 0.01), 1]
        likely = np.einsum("vpl,klv->pk", made, log) + np.log(size / size.sum())
        before, member = member, np.exp(likely - likely.max(1, keepdims=True))
        member /= member.sum(1, keepdims=True)
        if np.abs(member - before).max() < 1e-9:
            break
    good = member[:, kinds]
    rates = np.stack([(w @ made[0] + 0.01) / (w.sum() + 1) for w in (n * (1 - good), n * good)], 1)
    return dict(zip(patterns, good.tolist())), rates


_RUNS = re.compile(r"(.)\1+", re.S)
_SHAPE = str.maketrans({**{c: "A" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}, **{c: "a" for c in "abcdefghijklmnopqrstuvwxyz"},
                        **{c: "0" for c in "0123456789"}})


def word_features(word: bytes) -> tuple[int, int, int]:
    """Hashed features of a word: its shape, its last three bytes, itself without case."""
    text = word.decode()
    shape = text.translate(_SHAPE) if text.isascii() else "".join(
        "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in text)
    shape = _RUNS.sub(r"\1", shape)[:12]
    return tuple(zlib.crc32(x) % BUCKETS for x in (b"shape " + shape.encode(), b"end " + word[-3:], b"word " + word[:40].lower()))


class Features:
    """Features of texts; remembers those of up to ``most`` distinct words."""

    def __init__(self, most: int = 50_000):
        self.most, self.known, self.table = most, {}, np.empty((0, 3), np.int64)

    def of(self, texts: list[str]) -> np.ndarray:
        """A row for each text: square roots of the shares of words with each hashed feature.

        The last place is the share of words that equal the word before them.  Without words all
        places are 0.
        """
        if len(self.known) > self.most:
            self.known, self.table = {}, self.table[:0]
        split = [t.encode().split() for t in texts]
        if new := list(set().union(*split) - self.known.keys()):
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.table = np.concatenate([self.table, np.array([word_features(w) for w in new], np.int64)])
        out = np.zeros((len(texts), BUCKETS + 1))
        for row, words in zip(out, split):
            if words:
                found = self.table[list(map(self.known.__getitem__, words))].ravel()
                row[:BUCKETS] = np.bincount(found, minlength=BUCKETS)
                row[BUCKETS] = sum(map(eq, words, words[1:]))
                row /= len(words)
        return np.sqrt(out, out=out)


def train(x: np.ndarray, target: np.ndarray, steps: int = STEPS, ridge: float = 1e-3) -> np.ndarray:
    """Weights and, last, the bias of a logistic scorer; classes weigh the same.  Zeros without rows."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    if not len(x):
        return w
    weight = np.where(target >= 0.5, 0.5 / max(1, (target >= 0.5).sum()), 0.5 / max(1, (target < 0.5).sum()))
    scaled, at = x * np.sqrt(weight)[:, None], np.ones(x.shape[1])
    for _ in range(20):  # the largest curvature
        at = scaled.T @ (scaled @ (at / np.linalg.norm(at)))
    rate = 1 / (0.3 * np.linalg.norm(at) + ridge)
    last, speed = w, 1.0
    for _ in range(steps):  # accelerated gradient descent
        following = (1 + np.sqrt(1 + 4 * speed ** 2)) / 2
        at = w + (speed - 1) / following * (w - last)
        gradient = x.T @ (weight * (1 / (1 + np.exp(-x @ at)) - target)) + ridge * np.r_[at[:-1], 0]
        last, w, speed = w, at - rate * gradient, following
    return w


def quality(docs: DataFrame, threshold: float = 0.5, sample: int = SAMPLE,
            id_col: str = "doc_id", text_col: str = "text") -> tuple[Column, DataFrame]:
    """The scorer for ``docs``, and their votes.

    The column judges ``text_col`` of any row: a struct of ``score`` (0 to 1) and ``kept`` (score at
    least ``threshold``).  The frame has doc_id, votes and posterior of every row.  The scorer learns
    from at most ``sample`` documents of either side of the posterior, the first by a hash of the id;
    everything else covers all documents.  A text without words, as a null one, has score 0 and isn't
    kept.  An empty table gives an empty frame, and a scorer that keeps every text with words.
    """
    rows = inputs(docs, id_col, text_col)
    voted = materialize(rows.select("doc_id", vote(F.col("text")).alias("votes")))
    counts = {r.votes: r.n for r in voted.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    posterior, _ = label_model(counts)
    known = {p: float(x) for p, x in posterior.items()}
    table = voted.sparkSession.createDataFrame(list(known.items()), "votes string, posterior double")
    labelled = voted.join(F.broadcast(table), "votes")  # at most 3 ** 10 patterns, as a rule a few dozen

    with_votes = labelled.filter(F.col("doc_id").isNotNull() & (F.col("votes") != "-" * len(LABELLERS)))
    order = [F.xxhash64("doc_id"), "doc_id"]
    sides = [with_votes.filter(side).orderBy(*order).limit(sample).select("doc_id", "posterior")
             for side in ("posterior < 0.5", "posterior >= 0.5")]
    chosen = sides[0].unionAll(sides[1]).groupBy("doc_id").agg(F.avg("posterior").alias("posterior"))

    @arrow_udf("binary")
    def dense(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Features()
        for batch in batches:
            yield pa.array([x.astype("<f4").tobytes() for part in slices(batch) for x in known.of(part)], pa.binary())

    taught = (rows.join(F.broadcast(chosen), "doc_id").select("posterior", dense("text").alias("f"))
              .orderBy("posterior", "f").limit(2 * sample).collect())
    x = np.frombuffer(b"".join(bytes(r.f) for r in taught), "<f4").reshape(-1, BUCKETS + 1).astype(np.float64)
    weights = train(x, np.array([r.posterior for r in taught], float))

    @arrow_udf("struct<score:double,kept:boolean>")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Features()
        for batch in batches:
            score = [np.empty(0)]
            for part in slices(batch):
                x = known.of([t or "" for t in part])
                some = x.any(1)
                score.append(np.where(some, 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -500, 500))), 0.0))
            score = np.concatenate(score)
            kept = (score >= threshold) & (score > 0)
            yield pa.StructArray.from_arrays([pa.array(score, pa.float64()), pa.array(kept, pa.bool_())], ["score", "kept"])

    return scored.asNondeterministic()(F.col(text_col).cast("string")), labelled
