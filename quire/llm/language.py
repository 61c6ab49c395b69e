"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a word from both ends (a gated recurrent unit each way, its state fresh at every
word) and labels each of its bytes.  It is trained in numpy by backpropagation through time on a
bounded sample of labelled documents.  A document's probabilities pool the label probabilities of all
positions of all its words: the geometric mean, normalised.  Since a word's labels depend on nothing
but the word, a task labels each distinct word once and remembers a bounded number of them.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import slices

#: Units each way; documents of each language and words of each document that teach.
UNITS, DOCS, WORDS = 16, 150, 80
EPOCHS, BATCH, RATE, SEED = 8, 128, 0.02, 7
#: Longer words are learned and labelled in pieces of at most so many bytes; distinct words that a task remembers.
PIECE, REMEMBERED = 24, 300_000
EDGE = b"0123456789.,;:!?\"'()[]{}<>|#*$%&=+-_/\\`~@^"
UNDETERMINED = "und"


@dataclass
class Network:
    """Weights by name: per direction w (byte rows), u and b, gates update, reset, candidate; out, bias."""
    labels: list[str]
    weights: dict[str, np.ndarray]


def initial(labels: list[str], units: int = UNITS, seed: int = SEED, kind=np.float32) -> Network:
    rng = np.random.default_rng(seed)
    weights = {"out": rng.normal(0, 0.3, (2 * units, len(labels))), "bias": np.zeros(len(labels))}
    for way in "fb":
        weights |= {f"w{way}": rng.normal(0, 0.3, (256, 3 * units)), f"b{way}": np.zeros(3 * units),
                    f"u{way}": rng.normal(0, 1 / np.sqrt(units), (units, 3 * units))}
    return Network(labels, {k: v.astype(kind) for k, v in weights.items()})


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes forwards and backwards [word, position], 0 beyond the lengths, and the lengths."""
    lengths = np.array([len(w) for w in words])
    width = lengths.max()
    ahead = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
    back = np.frombuffer(b"".join(w[::-1].ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
    return ahead, back, lengths


def _run(symbols: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """States after each position [position, word, unit] and, to go back, what each step used."""
    n, steps = symbols.shape
    h, m = np.zeros((n, u.shape[0]), u.dtype), u.shape[0]
    states, kept = np.empty((steps, n, m), u.dtype), []
    table = w + b
    for t in range(steps):
        x, hu = table[symbols[:, t]], h @ u
        gates = _sigmoid(x[:, :2 * m] + hu[:, :2 * m])
        z, r = gates[:, :m], gates[:, m:]
        c = np.tanh(x[:, 2 * m:] + r * hu[:, 2 * m:])
        if keep:
            kept.append((h, z, r, c, hu[:, 2 * m:]))
        h = c + z * (h - c)
        states[t] = h
    return states, kept


def _reversed(states: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each word's positions in the opposite order, within its length (its own inverse)."""
    at = (lengths[None, :] - 1 - np.arange(len(states))[:, None]) % len(states)
    return states[at, np.arange(states.shape[1])[None, :]]


def log_probabilities(net: Network, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Log label probabilities [position, word, label] and the words' lengths."""
    ahead, back, lengths = _padded(words)
    p, m = net.weights, net.weights["uf"].shape[0]
    f, _ = _run(ahead, p["wf"], p["uf"], p["bf"], False)
    b, _ = _run(back, p["wb"], p["ub"], p["bb"], False)
    logits = f @ p["out"][:m] + _reversed(b @ p["out"][m:], lengths) + p["bias"]
    logits -= logits.max(-1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(-1, keepdims=True)), lengths


def loss_and_gradients(net: Network, words: list[bytes], labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy of all positions, and its gradients by backpropagation through time."""
    ahead, back, lengths = _padded(words)
    p, m = net.weights, net.weights["uf"].shape[0]
    f, kept_f = _run(ahead, p["wf"], p["uf"], p["bf"], True)
    b, kept_b = _run(back, p["wb"], p["ub"], p["bb"], True)
    b = _reversed(b, lengths)
    logits = f @ p["out"][:m] + b @ p["out"][m:] + p["bias"]
    logits -= logits.max(-1, keepdims=True)
    probs = np.exp(logits)
    probs /= probs.sum(-1, keepdims=True)
    inside = np.arange(len(f))[:, None] < lengths[None, :]
    total, every = inside.sum(), np.arange(len(words))
    loss = -(np.log(probs[:, every, labels] + 1e-30) * inside).sum() / total
    error = probs
    error[:, every, labels] -= 1
    error *= inside[..., None] / p["out"].dtype.type(total)
    flat = error.reshape(-1, error.shape[-1])
    grads = {"bias": flat.sum(0), "out": np.vstack([f.reshape(-1, m).T @ flat, b.reshape(-1, m).T @ flat])}
    for way, symbols, kept, above in (("f", ahead, kept_f, error @ p["out"][:m].T),
                                      ("b", back, kept_b, _reversed(error @ p["out"][m:].T, lengths))):
        u = p["u" + way]
        gw, gu, dh = np.zeros_like(p["w" + way]), np.zeros_like(u), np.zeros_like(above[0])
        for t in range(len(kept) - 1, -1, -1):
            h, z, r, c, hu = kept[t]
            dh = dh + above[t]
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (h - c) * z * (1 - z)
            dr = dc * hu * r * (1 - r)
            d_in, d_hu = np.hstack([dz, dr, dc]), np.hstack([dz, dr, dc * r])
            np.add.at(gw, symbols[:, t], d_in)
            gu += h.T @ d_hu
            dh = dh * z + d_hu @ u.T
        grads |= {"w" + way: gw, "b" + way: gw.sum(0), "u" + way: gu}
    return float(loss), grads


def fit(words: list[bytes], labels: list[str], epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """A network trained on words and the languages of their documents, by Adam.  No words: no label."""
    net = initial(sorted(set(labels)), seed=seed)
    number = {x: i for i, x in enumerate(net.labels)}
    target, rng = np.array([number[x] for x in labels], int), np.random.default_rng(seed)
    mean, square = ({k: np.zeros_like(v) for k, v in net.weights.items()} for _ in range(2))
    order = np.arange(len(words))
    steps, step = epochs * -(-len(words) // BATCH), 0
    for _ in range(epochs):
        rng.shuffle(order)
        by_length = order[np.argsort([len(words[i]) // 4 for i in order], kind="stable")]  # little padding
        for at in rng.permutation(range(0, len(order), BATCH)):
            chosen = by_length[at:at + BATCH]
            step += 1
            _, grads = loss_and_gradients(net, [words[i] for i in chosen], target[chosen])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            rate = RATE * (1 - step / (steps + 1))
            for k, g in grads.items():
                g = g * min(1.0, 1 / (norm + 1e-9))
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.001 * (g * g - square[k])
                net.weights[k] -= (rate * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net


def pieces(core: bytes) -> list[bytes]:
    """The word in pieces of at most PIECE bytes that begin and end between characters."""
    out, at = [], 0
    while at < len(core):
        end = min(at + PIECE, len(core))
        while end < len(core) and core[end] & 0xC0 == 0x80:
            end -= 1
        out.append(core[at:end])
        at = end
    return out


class Labelled:
    """Sums of log probabilities over the positions of distinct words, remembered in a task."""

    def __init__(self, net: Network, most: int = REMEMBERED):
        self.net, self.most = net, most
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.sums = np.zeros((1, len(self.net.labels) + 1))  # last column: positions; row 0: no letter
        self.used = 1

    def learn(self, raw: list[bytes]) -> None:
        cores, parts, owner = [], [], []
        for w in raw:
            core = w.strip(EDGE)
            self.known[w] = 0
            if core and any(map(str.isalpha, core.decode())):
                cores.append(w)
                for piece in pieces(core):
                    parts.append(piece)
                    owner.append(len(cores) - 1)
        sums = np.zeros((len(cores), len(self.net.labels) + 1))
        order = sorted(range(len(parts)), key=lambda i: len(parts[i]))
        for at in range(0, len(order), 2048):
            part = order[at:at + 2048]
            logs, lengths = log_probabilities(self.net, [parts[i] for i in part])
            inside = np.arange(len(logs))[:, None] < lengths[None, :]
            found = np.column_stack([np.einsum("twl,tw->wl", logs, inside.astype(logs.dtype)), lengths])
            np.add.at(sums, [owner[i] for i in part], found)
        if self.used + len(cores) > len(self.sums):
            self.sums = np.concatenate([self.sums[:self.used], np.zeros((max(len(cores), self.used), sums.shape[1]))])
        self.sums[self.used:self.used + len(cores)] = sums
        self.known.update(zip(cores, range(self.used, self.used + len(cores))))
        self.used += len(cores)

    def pool(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Label and probability of each text."""
        if len(self.known) > self.most:
            self.clear()
        split = [t.encode().split() for t in texts]
        if new := list(set().union(*split) - self.known.keys()):
            self.learn(new)
        totals = np.zeros((len(texts), self.sums.shape[1]))
        for total, words in zip(totals, split):
            if words:
                total += self.sums[list(map(self.known.__getitem__, words))].sum(0)
        some = totals[:, -1] > 0
        mean = totals[:, :-1] / np.maximum(totals[:, -1:], 1)
        best = mean.argmax(1)
        score = 1 / np.exp(mean - mean.max(1, keepdims=True)).sum(1)
        return ([self.net.labels[b] if s else UNDETERMINED for b, s in zip(best, some)],
                [float(x) if s else 0.0 for x, s in zip(score, some)])


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(4)) == 2


def train(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
          n_docs: int = DOCS, n_words: int = WORDS) -> Network:
    """The network learned from documents with text and language that aren't held out.

    At most ``n_docs`` documents of each language, the first by a hash of the id, and ``n_words`` words spread over each: the driver gets no more than these.  A word of
    more than PIECE bytes counts as several, its pieces, any of which may teach.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (rows.select("doc_id", "lang").withColumn("place", F.row_number().over(by_hash)).filter(F.col("place") <= n_docs)
              .select("doc_id", "lang").distinct())

    @arrow_udf("array<binary>")
    def spread(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for part in slices(batch):
                for text in part:
                    words = [p for w in (x.strip(EDGE) for x in text.encode().split()) if any(b > 64 for b in w) for p in pieces(w)]
                    out.append(words[::max(1, -(-len(words) // n_words))])
            yield pa.array(out, pa.list_(pa.binary()))

    # bounded: n_docs rows of each language, even if ids repeat
    again = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "words")
    taught = (rows.join(F.broadcast(chosen), ["doc_id", "lang"]).select("doc_id", "lang", spread("text").alias("words"))
              .withColumn("place", F.row_number().over(again)).filter(F.col("place") <= n_docs)
              .orderBy("lang", "doc_id", "words").collect())
    pairs = [(bytes(w), r.lang) for r in taught for w in r.words]
    return fit([w for w, _ in pairs], [x for _, x in pairs])


def predict(text: Column, net: Network) -> Column:
    """Struct of ``lang_pred`` and ``score`` (0 to 1) for a column of texts.

    ``und`` with score 0 for a null text, one without a letter, and when nothing was learned.
    """

    @arrow_udf("struct<lang_pred:string,score:double>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        labelled = Labelled(net)
        for batch in batches:
            names, score = [], []
            for part in slices(batch):
                if net.labels:
                    found = labelled.pool([x or "" for x in part])
                    names += found[0]
                    score += found[1]
                else:
                    names += [UNDETERMINED] * len(part)
                    score += [0.0] * len(part)
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score, pa.float64())], ["lang_pred", "score"])

    return of.asNondeterministic()(text)
