import hashlib
import math
import re

import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.llm import sanitise
from quire.llm.catalog import QUERIES

SF = "/root/testdata/sf0.001"
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    out = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            if kind == "ip" and max(map(int, m[0].split("."))) > 255:
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            if kind == "card":
                doubled = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
                if not 12 <= len(digits) <= 19 or sum(doubled) % 10:
                    continue
            out.append((m.start(), order, kind, m.end()))
    return [(k, a, b) for a, _, k, b in sorted(out)]


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from("a@.-+ 0149()_é\n٣"), max_size=40))
@example("a@b.c@d.e@f")
@example("x@y.z.@q.r a@b")
@example("1.2.3.4.5.6.7.8 01.2.3.4 256.1.1.1 1.1.1.256.3")
@example("4111 1111 1111 1111 4111-1111-1111-1112 +4111 1111 1111 1111")
@example("+1 (505) 555-1941, ++49 30 12345678 +12345678 +1234567890123456")
def test_entities_equal_the_patterns(text):
    assert [x[:3] for x in sanitise.entities(text)] == plain(text)


def test_entities_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+" * 300_000, "a@" * 100_000, "1 " * 150_000):
        sanitise.entities(text)


def test_query_has_all_base_spans(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op2_sanitise"](spark, SF).collect()}
    assert len(got) == len(rows)
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in got.values()) > 10
    for r in rows:
        base = plain(r.text)
        g = got[r.doc_id]
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert g.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [g[f"n_{k}"] for k in PATTERNS] == [sum(x[0] == k for x in base) for k in PATTERNS]
        own = [s for s in g.spans.split(",") if s.split(":")[0] in PATTERNS]
        assert ",".join(own) == listed


def corpus():
    """codename Zephyr stands beside one address in five texts, and hardly elsewhere; common words anywhere."""
    rows = [(i, f"Please write to boss@corp.example.com about Zephyr, today. Line {i} is the end of the report", "x") for i in range(5)]
    rows += [(10 + i, f"Nothing here but the end of line {i} and a word about today please write to the report is", None) for i in range(200)]
    rows += [(500, "Zephyr alone", "y"), (501, None, None), (502, "", "z"), (None, "write to me@home.example.org, friend", "q"),
             (503, "copy Quartz me2@home.example.org", "a")] + [(504, "copy Quartz me2@home.example.org", "a")] * 4
    rows += [(505, "w " * 50_000 + "+1 (505) 555-1941", "long")]
    return rows


def test_disclosing_terms(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, spans string").withColumn("key", F.lit(1)).repartition(4)
    out = sanitise.find(docs).collect()
    assert len(out) == len(corpus())
    terms = {(r.doc_id, s.kind) for r in out for s in r.spans if s.kind in sanitise.TERMS}
    # 5 of the 6 texts with zephyr have the address; copies of one text show nothing
    n, n_te, n_t, n_e = len(corpus()), 5, 6, 5
    disclosure = math.log(n_te * n / (n_t * n_e)) / math.log(n / n_e)
    assert sanitise.GENERALISE <= disclosure and terms == {(i, "remove" if disclosure >= 0.95 else "generalise") for i in range(5)}
    clean = {r.doc_id: r.text for r in sanitise.sanitise(docs).collect()}
    word = "" if disclosure >= 0.95 else "[TERM]"
    assert clean[3] == f"Please write to [EMAIL] about {word}, today. Line 3 is the end of the report"
    assert clean[501] is None and clean[500] == "Zephyr alone" and clean[None] == "write to [EMAIL], friend"
    assert clean[505].endswith(" [PHONE]")
    same = sanitise.sanitise(docs)
    assert same.columns == docs.columns and same.count() == len(corpus())


def test_counts_equal_brute_force(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, e string").repartition(3)
    rows = sanitise.inputs(docs)
    got = {r.term: r.n_t for r in sanitise.term_counts(rows).collect()}
    want = {}
    for _, text, _ in corpus():
        for t in {sanitise.term(w) for w in (text or "").split()} - {""}:
            want[t] = want.get(t, 0) + 1
    assert got == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sanitise.find(docs).count() == 0 and sanitise.sanitise(docs).count() == 0


@pytest.mark.parametrize("spans,want", [([(0, 3, "email"), (2, 5, "card")], "[EMAIL]fg"), ([(1, 2, "remove"), (3, 4, "generalise")], "ac[TERM]efg"), ([], "abcdefg")])
def test_replacing(spans, want):
    assert sanitise.sanitised("abcdefg", spans) == want


def test_terms_far_from_the_entity_and_without_it(spark):
    """The name stands in the greeting and the number in the footer; the name also stands alone."""
    gap = " ".join(f"the end of line {i} today" for i in range(20))
    rows = [(i, f"Dear (Quillan), {gap} note {i} Quillan +1 (505) 555-1941") for i in range(4)]
    rows += [(10 + i, f"{gap} dear note {i % 7} number {i}") for i in range(250)] + [(900, "QUILLAN! alone, twice: quillan"), (901, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    n, n_te, n_t, n_e = len(rows), 4, 5, 4
    disclosure = math.log(n_te * n / (n_t * n_e)) / math.log(n / n_e)
    assert sanitise.GENERALISE <= disclosure < sanitise.REMOVE
    texts = {i: t or "" for i, t in rows}
    held = {i: [m.span() for m in re.finditer("quillan", texts[i], re.I)] for i in (0, 1, 2, 3, 900)}
    for everywhere, ids in ((False, {0, 1, 2, 3}), (True, {0, 1, 2, 3, 900})):
        out = sanitise.find(docs, everywhere=everywhere).collect()
        assert len(out) == len(rows)
        got = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == "generalise"] for r in out}
        assert {i: x for i, x in got.items() if x} == {i: held[i] for i in ids}
        assert not any(s.kind == "remove" for r in out for s in r.spans)
    clean = {r.doc_id: r.text for r in sanitise.sanitise(docs, everywhere=True).collect()}
    assert clean[900] == "[TERM]! alone, twice: [TERM]" and clean[901] is None
    assert clean[2] == f"Dear ([TERM]), {gap} note 2 [TERM] [PHONE]"


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab@.-+ 019()\n"), max_size=40))
def test_free_terms_equal_brute_force(text):
    found = sanitise.entities(text)
    want = []
    for m in re.finditer(r"\S+", text):
        inside = any(a < m.end() and m.start() < b for _, a, b, _ in found)
        if not inside and (t := sanitise.term(m[0])):
            want.append((t, m.start() + m[0].lower().index(t)))
    got = list(sanitise.free_terms(text, found))
    assert [(t, a) for t, a, _ in got] == want and all(text[a:b].lower() == t for t, a, b in got)


def test_filter_holds_every_term(spark):
    import zlib
    terms = [f"term{i}é" for i in range(5000)]
    bits = sanitise.term_filter(spark.createDataFrame([(t,) for t in terms], "term string"))
    places = {zlib.crc32(t.encode()) % sanitise.FILTER_BITS for t in terms}
    assert len(bits) * 8 == sanitise.FILTER_BITS
    assert {i * 8 + j for i, b in enumerate(bits) if b for j in range(8) if b >> j & 1} == places


def brute_spans(rows, everywhere):
    """Every pair of entity and term, counted one by one."""
    n, texts = len(rows), {i: t or "" for i, t in rows}
    found = {i: sanitise.entities(t) for i, t in texts.items()}
    words = {i: {x for x, _, _ in sanitise.free_terms(t, found[i])} for i, t in texts.items()}
    n_t = {}
    for t in texts.values():
        for w in {sanitise.term(x) for x in t.split()} - {""}:
            n_t[w] = n_t.get(w, 0) + 1
    holders = {}
    for i, f in found.items():
        for kind, _, _, value in f:
            holders.setdefault((kind, value), set()).add(i)
    told, tested = [], set()
    for e, ids in holders.items():
        m = len({texts[i] for i in ids})
        for w in set().union(*(words[i] for i in ids)):
            inside = {i for i in ids if w in words[i]}
            k = len({texts[i] for i in inside})
            if k < 2 or n_t[w] > 1.001 * n ** 0.2 * max(map(len, holders.values())) ** 0.8:
                continue
            tested.add((frozenset(texts[i] for i in ids), frozenset(texts[j] for j in texts if found[j] and w in words[j]), n_t[w]))
            told.append((e, w, len(inside), k, m, len(ids)))
    kept = []
    for e, w, n_te, k, m, n_e in told:
        p = n_t[w] / n
        tail = sum(math.comb(m, j) * p ** j * (1 - p) ** (m - j) for j in range(k, m + 1))
        bound = (k / (m * p)) ** -k * (1 if k == m else ((1 - k / m) / (1 - p)) ** (k - m))
        assert tail <= bound * (1 + 1e-9) or k <= m * p
        if n_e < n and k > m * p and bound <= sanitise.CHANCE / len(tested):
            d = min(1, math.log(n_te * n / (n_t[w] * n_e)) / math.log(n / n_e))
            if d >= sanitise.GENERALISE:
                kept.append((e, w, d, n_te / n_t[w]))
    out = {}
    for i, t in texts.items():
        own = {(k, v) for k, _, _, v in found[i]}
        best = {}
        for e, w, d, points in kept:
            if e in own or everywhere and points >= sanitise.POINTS:
                best[w] = max(best.get(w, 0), d)
        out[i] = sorted([(a, k, b) for k, a, b, _ in found[i]] + [
            (a, "remove" if best[w] >= sanitise.REMOVE else "generalise", b) for w, a, b in sanitise.free_terms(t, found[i]) if w in best])
    return out


@pytest.mark.parametrize("everywhere", [False, True])
def test_whole_table_equals_brute_force(spark, everywhere):
    import random
    rng = random.Random(5)
    common = [f"word{chr(97 + i)}" for i in range(26)]
    rows = []
    for i in range(600):
        text = " ".join(rng.choices(common, k=12))
        if i % 10 == 0:  # ten people, each with an address, two pet words and a shared one
            who = i // 10 % 10
            text += f" p{who}@home.example pet{who}x " + (f"pal{who}x " if i % 3 else "") + f"shared{who % 3}x"
        elif i % 17 == 0:
            text += f" pet{i % 10}x shared{i % 3}x"
        rows.append((i, text))
    rows += [(700, rows[0][1]), (701, None), (702, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: sorted((s.start, s.kind, s.end) for s in r.spans) for r in sanitise.find(docs, everywhere=everywhere).collect()}
    want = brute_spans(rows, everywhere)
    assert got == want
    assert sum(k in sanitise.TERMS for x in want.values() for _, k, _ in x) > 50


def test_pair_of_two_texts_and_one(spark):
    """Two different texts can show a pair; two copies of one text cannot."""
    rows = [(i, f"note {i} of many common words about a thing {chr(97 + i % 26)}x") for i in range(3000)]
    rows += [(5000, "first Zorro letter z@home.example"), (5001, "second Zorro mail z@home.example")]
    rows += [(5002, "only Tango here y@home.example"), (5003, "only Tango here y@home.example")]
    out = sanitise.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    marked = {r.doc_id for r in out if any(s.kind in sanitise.TERMS for s in r.spans)}
    assert marked == {5000, 5001}


def test_clashing_names(spark):
    rows = [(1, "a b me@home.example", 7, "s", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key long, SPANS string, key string")
    got = sanitise.sanitise(docs)
    assert got.columns == docs.columns and tuple(got.first()) == (1, "a b [EMAIL]", 7, "s", "k")


def test_batches_longer_than_a_slice(spark):
    """Entities and texts keep their rows when a batch is worked off in slices, with null texts among them."""
    rows = [(i, None if i % 7 == 3 else f"write to u{i}@example.org now") for i in range(1300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = dict(map(tuple, sanitise.sanitise(docs).collect()))
    assert got == {i: t and "write to [EMAIL] now" for i, t in rows}
    found = docs.select("doc_id", sanitise.detect(docs["text"]).alias("d")).collect()
    assert {r.doc_id: [x.value for x in r.d.base] for r in found} == {i: [f"u{i}@example.org"] if t else [] for i, t in rows}


def test_few_terms_are_held(spark):
    """A task passes its counts on before it holds 60,000 terms; the counts are those of all rows."""
    assert sanitise.COUNTED <= 60_000
    rows = spark.createDataFrame([(" ".join(f"w{i}x" for i in range(at, at + 3000)) + " often",) for at in range(0, 90_000, 3000)], "text string").coalesce(1)
    got = {r.term: r.n_t for r in sanitise.term_counts(rows).collect()}
    assert len(got) == 90_001 and got["often"] == 30 and set(got.values()) == {1, 30}
