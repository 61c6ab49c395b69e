"""Information-theoretic sanitisation of personal data.

Patterns find the protected entities: e-mail and IP addresses, card and phone numbers.  The corpus
then tells which ordinary words give them away.  For a term t in the documents of an entity e,
document counts estimate the pointwise mutual information PMI(t, e) = log(p(t, e) / (p(t) p(e)))
and the entity's information IC(e) = -log p(e).  Their ratio is the share of the entity that the
term discloses: 1 if t occurs only beside e, about 0 for a common word.  Terms whose disclosure
reaches a threshold are generalised to a placeholder, and removed from a second threshold on, if the
co-occurrence is significant: t in k of the n different texts of e must be too rare by chance, given how many
documents hold t, even among as many pairs as were looked at.

All counts cover all documents.  Only the distinct terms of documents with entities, aggregated counts
and rows of spans travel between machines; an entity or term that a third of the documents share is
pre-aggregated.
"""
from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..session import materialize
from .common import bits_of, inputs, slices, unused

#: Kinds of protected entities, in the order in which spans of one start are listed, and of terms.
KINDS, TERMS = ("email", "ip", "card", "phone"), ("generalise", "remove")
#: Thresholds of disclosure; least different texts that must show a pair (one text shows nothing).
TEXTS, GENERALISE, REMOVE = 2, 0.8, 0.95
#: Pairs that chance may bring, all pairs taken together.
CHANCE = 0.01
#: Share of a term's documents that must hold the entity for the term to be marked where the entity is not.
POINTS = 0.8
#: Distinct terms that a task counts before it passes the counts on.
COUNTED = 50_000
#: Bits of the filter that tasks look words up in: 2 MB, however many terms are disclosing.
FILTER_BITS = 1 << 24

# patterns that must match exactly
_AFTER_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_WORD = re.compile(r"\S+")
_EDGE = ".,;:!?\"'()[]{}<>|#*$%&=+-_/\\`~"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain, in time linear in the text."""
    done = 0
    for m in _AFTER_AT.finditer(text):
        at = m.start()
        while at > done and text[at - 1] in _LOCAL:
            at -= 1
        if at < m.start():
            yield at, m.end()
            done = m.end()


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def entities(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, canonical value) of every protected entity, by start and kind."""
    out = []
    if "@" in text:
        out += [("email", a, b, text[a:b].lower()) for a, b in _emails(text)]
    if re.search("[0-9]", text):
        out += [("ip", *m.span(), m[0]) for m in _IP.finditer(text)
                if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span(), digits))
        for m in _PHONE.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if 9 <= len(digits) <= 15:
                out.append(("phone", *m.span(), digits))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def term(word: str) -> str:
    """A word as it is counted: without marks at its ends, lower case; empty if no letter is left."""
    bare = word.strip(_EDGE).lower()
    return bare if any(map(str.isalpha, bare)) else ""


def free_terms(text: str, found: list[tuple[str, int, int, str]]) -> Iterator[tuple[str, int, int]]:
    """(term, start, end) of every word outside all entities, in order; ``found``: entities by start."""
    covered = []  # entities, those that overlap as one
    for _, a, b, _ in found:
        if covered and a < covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], b)
        else:
            covered.append([a, b])
    at = 0
    for m in _WORD.finditer(text):
        while at < len(covered) and covered[at][1] <= m.start():
            at += 1
        if (at == len(covered) or covered[at][0] >= m.end()) and (t := term(m[0])):
            yield t, m.end() - len(m[0].lstrip(_EDGE)), m.start() + len(m[0].rstrip(_EDGE))


_FOUND = pa.struct([
    ("base", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))),
    ("terms", pa.list_(pa.string()))])


def detect(text: Column) -> Column:
    """Struct of the entities of a text (``base``) and, if it has any, the distinct terms outside them (``terms``)."""

    @arrow_udf("struct<base:array<struct<kind:string,start:long,end:long,value:string>>,terms:array<string>>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            done = [pa.array([], _FOUND)]
            for part in slices(batch):
                out = []
                for x in part:
                    found = entities(x or "")
                    out.append({"base": [dict(zip(("kind", "start", "end", "value"), f)) for f in found],
                                "terms": sorted({t for t, _, _ in free_terms(x, found)}) if found else []})
                done.append(pa.array(out, _FOUND))
            yield pa.concat_arrays(done)

    return of.asNondeterministic()(text)


def term_counts(rows: DataFrame) -> DataFrame:
    """(term, n_t): in how many rows each term occurs, pre-aggregated in every task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, known = Counter(), {}

        def passed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["term", "n"])

        for batch in batches:
            for part in slices(batch.column(0)):
                for text in part:
                    words = set(text.split())
                    for w in words:
                        if w not in known:
                            known[w] = term(w)
                    counts.update(set(map(known.__getitem__, words)))
                if len(known) > COUNTED:
                    known.clear()
                if len(counts) > COUNTED:
                    yield passed_on()
                    counts.clear()
        if counts:
            yield passed_on()

    return (rows.select("text").mapInArrow(count, "term string, n long").filter("term <> ''")
            .groupBy("term").agg(F.sum("n").alias("n_t")))


def _entities(base: str = "base") -> Column:
    """The distinct entities of a document, as kind:value."""
    return F.array_distinct(F.transform(base, lambda x: F.concat(x["kind"], F.lit(":"), x["value"])))


def _alike() -> list[Column]:
    """Aggregates that tell sets of different ``key`` apart: their size and 128 bits."""
    return [F.count("*").alias("n_texts"), *[F.bit_xor(F.xxhash64("key", F.lit(i))).alias(f"set{i}") for i in (1, 2)]]


def _classes(members: DataFrame, name: str, *also: Column) -> DataFrame:
    """``members`` (``name``, ``key``) of at least TEXTS texts, with ``cls``: equal for those in the same texts."""
    found = members.groupBy(name).agg(*_alike(), *also).filter(F.col("n_texts") >= TEXTS)
    return found.withColumn("cls", F.struct("n_texts", "set1", "set2"))


def disclosing(found: DataFrame, counts: DataFrame, n_docs: int, threshold: float = GENERALISE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs (e, t, disclosure, points), and which entities (entity, e) and terms (term, t) they stand for.

    ``found``: key of the text ``key``, ``base`` and ``terms`` of every document; ``counts``: term_counts.
    Copies of a text show a pair once.  Entities of the same texts are one ``e`` and terms of the same texts and
    count one ``t``, so a text with many addresses and many rare words, all its own, makes one pair of them.
    ``points``: the share of the term's documents that hold the entity.
    """
    holds = found.filter(F.size("base") > 0)
    texts = materialize(holds.groupBy("key").agg(F.count("*").alias("copies"), F.first(_entities()).alias("entities"),
                                                 F.first("terms").alias("terms")))
    seen = texts.select("key", "copies", F.explode("entities").alias("entity"))
    entities_ = materialize(_classes(seen, "entity", F.sum("copies").alias("n_e")).select("entity", "cls", "n_e"))
    most = entities_.agg(F.max("n_e")).first()[0] or 0
    # n_te is at most n_e, so a term of more documents than this cannot reach the threshold
    rare = counts.filter(F.col("n_t") <= 1.001 * n_docs ** (1 - threshold) * most ** threshold)
    told = texts.select("key", F.explode("terms").alias("term"))
    terms = materialize(_classes(told, "term").join(rare, "term").select("term", F.struct("cls", "n_t").alias("cls")))
    e_in = seen.join(entities_, "entity").groupBy(F.col("cls").alias("e"), "n_e", "key").agg(F.first("copies").alias("copies"))
    t_in = told.join(terms, "term").select(F.col("cls").alias("t"), "key").distinct()
    pairs = materialize(e_in.join(t_in, "key").groupBy("e", "n_e", "t").agg(F.sum("copies").alias("n_te"), F.count("*").alias("k"))
                        .filter(F.col("k") >= TEXTS))
    n, n_t, n_e = F.lit(float(n_docs)), F.col("t.n_t"), F.col("n_e")
    ratio = F.when(n_e < n, F.log(F.col("n_te") * n / (n_t * n_e)) / F.log(n / n_e))
    # k of the entity's texts hold the term: at most exp(-bits) likely, if each did with probability p
    m, p = F.col("e.n_texts"), n_t / n
    bits = F.col("k") * F.log(F.col("k") / (m * p)) + F.when(F.col("k") < m, (m - F.col("k")) * F.log((1 - F.col("k") / m) / (1 - p))).otherwise(0.0)
    kept = (pairs.select("e", "t", F.least(ratio, F.lit(1.0)).alias("disclosure"), bits.alias("bits"),
                         (F.col("k") > m * p).alias("more"), (F.col("n_te") / n_t).alias("points"))
            .filter((F.col("disclosure") >= threshold) & F.col("more") & (F.col("bits") >= math.log(max(pairs.count(), 1) / CHANCE)))
            .select("e", "t", "disclosure", "points"))
    return materialize(kept), entities_.select("entity", F.col("cls").alias("e")), terms.select("term", F.col("cls").alias("t"))


def term_filter(terms: DataFrame, column: str = "term") -> bytes:
    """A bit for the hash of each ``term`` of a table; FILTER_BITS in all, so its size is fixed."""
    return bits_of(terms, column, FILTER_BITS)


def _holds(bits: bytes, value: str) -> int:
    at = zlib.crc32(value.encode()) % FILTER_BITS
    return bits[at >> 3] >> (at & 7) & 1


def occurrences(rows: DataFrame, anywhere: bytes, own: bytes, keys: bytes) -> DataFrame:
    """(key, term, start, end) of words outside entities whose term a filter may hold; ``rows``: key and text.

    ``anywhere``: filter of terms to look for in all rows; ``own``: in those whose key the filter ``keys`` may hold.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {}  # by word: 1 to look for anywhere, 2 in rows of their own

        def of(word: str) -> int:
            return (_holds(anywhere, t) | _holds(own, t) << 1) if (t := term(word)) else 0

        for batch in batches:
            for names, texts in zip(slices(batch.column(0)), slices(batch.column(1))):
                out = [], [], [], []
                for key, text in zip(names, texts):
                    words, wanted = set(text.split()), 3 if _holds(keys, key) else 1
                    for w in words:
                        if w not in known:
                            known[w] = of(w)
                    if hit := {term(w) for w in words if known[w] & wanted}:
                        for t, start, end in free_terms(text, entities(text)):
                            if t in hit:
                                for column, value in zip(out, (key, t, start, end)):
                                    column.append(value)
                if len(known) > COUNTED:
                    known.clear()
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, (pa.string(), pa.string(), pa.int64(), pa.int64()))],
                                                     ["key", "term", "start", "end"])

    return rows.select("key", "text").mapInArrow(look, "key string, term string, start long, end long")


def find(docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE,
         everywhere: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key, spans) for every row of ``docs``.

    ``spans``: structs of start, order, kind and end in code points (end exclusive), by start and kind:
    all entities, and every occurrence of the disclosing terms, of kind ``generalise`` or ``remove``,
    in the documents that hold the entity; ``everywhere``: also in all other documents, if at least
    POINTS of the term's documents hold the entity.  ``key`` tells
    rows apart whose id or text differs; rows that repeat both have the same spans and all stay.
    A null text counts as empty and has no spans.  A null id is an id like any other.
    """
    rows = inputs(docs, id_col, text_col)
    found = materialize(rows.select("doc_id", row_key("doc_id", "text").alias("key"), F.xxhash64("text").alias("text_key"),
                                    detect(F.col("text")).alias("d"))
                        .select("doc_id", "key", "text_key", "d.base", "d.terms"))
    pairs, entity_of, term_of = disclosing(found.select(F.col("text_key").alias("key"), "base", "terms"), term_counts(rows),
                                           found.count(), generalise)
    held = found.select("key", F.explode(_entities()).alias("entity")).join(entity_of, "entity").select("key", "e").distinct()
    own = materialize(held.join(pairs, "e").groupBy("key", "t").agg(F.max("disclosure").alias("own")).join(term_of, "t")
                      .select("key", "term", "own"))
    told = pairs.filter(F.lit(everywhere) & (F.col("points") >= POINTS)).groupBy("t").agg(F.max("disclosure").alias("any"))
    told = materialize(told.join(term_of, "t").select("term", "any"))
    kind = F.when(F.col("disclosure") >= remove, TERMS[1]).otherwise(TERMS[0])
    terms = (occurrences(rows.select(row_key("doc_id", "text").alias("key"), "text"), term_filter(told), term_filter(own), term_filter(own, "key"))
             .join(told, "term", "left").join(own, ["key", "term"], "left")
             .select("key", "start", "end", F.greatest("own", "any").alias("disclosure")).filter("disclosure is not null")
             .groupBy("key", "start", "end").agg(F.max("disclosure").alias("disclosure"))
             .groupBy("key").agg(F.collect_list(_span(F.col("start"), kind, F.col("end"))).alias("terms")))
    base = F.transform("base", lambda x: _span(x["start"], x["kind"], x["end"]))
    none = F.array().cast("array<struct<start:long,order:int,kind:string,end:long>>")
    return (found.select("doc_id", "key", base.alias("base")).join(terms, "key", "left")
            .select("doc_id", "key", F.array_sort(F.concat("base", F.coalesce("terms", none))).alias("spans")))


def _span(start: Column, kind: Column, end: Column) -> Column:
    order = F.coalesce(*[F.when(kind == k, F.lit(i)) for i, k in enumerate(KINDS + TERMS)])
    return F.struct(start.alias("start"), order.alias("order"), kind.alias("kind"), end.alias("end"))


def row_key(id_col: str, text_col: str) -> Column:
    """What tells rows apart by id and text: the id (``-`` for null) and a hash of the text."""
    return F.concat_ws(" ", F.coalesce(F.col(id_col).cast("string"), F.lit("-")),
                       F.hex(F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))))


def joined(spans: Column) -> Column:
    """The spans as kind:start:end, separated by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def sanitised(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with its spans (start, end, kind) replaced: entities and generalised terms by a
    placeholder, removed terms by nothing.  Overlapping spans are replaced as one, by the first's rule."""
    out, at, last = [], 0, 0
    for start, end, kind in spans:
        if start < last:  # overlaps the one before: widen it
            at = last = max(last, end)
            continue
        out.append(text[at:start])
        out.append("" if kind == "remove" else "[TERM]" if kind == "generalise" else f"[{kind.upper()}]")
        at = last = end
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the text sanitised, all columns and rows kept; a null text stays null."""
    found = find(docs, id_col=id_col, text_col=text_col, **options)
    key, marked = unused(docs, "key"), unused(docs, "spans")
    # one row for each key; the rows of a key have equal spans
    spans = found.filter(F.size("spans") > 0).groupBy(F.col("key").alias(key)).agg(F.max("spans").alias(marked))

    @arrow_udf("string")
    def replace(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, found_ in texts:
            yield pa.concat_arrays([pa.array([], pa.string())] + [
                pa.array([t if t is None or not s else sanitised(t, [(x["start"], x["end"], x["kind"]) for x in s])
                          for t, s in zip(*part)], pa.string()) for part in zip(slices(text), slices(found_))])

    return (docs.withColumn(key, row_key(id_col, text_col)).join(spans, key, "left")
            .withColumn(text_col, replace(text_col, marked)).select(docs.columns))
