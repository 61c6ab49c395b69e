"""Nested answers: goldens of every kind of fault, and random answers against a plain checker."""
import json
import random

import pytest

from quire.operators import answers as A


def plain(x, schema, path="$"):
    """(path, reason) of the first fault, one value at a time."""
    if isinstance(schema, A.Record):
        if not isinstance(x, dict):
            return path, "not an object"
        for name, s in schema.fields:
            here = f"{path}.{name}"
            if name not in x:
                if not (getattr(s, "optional", False) or getattr(s, "default", False)):
                    return here, "missing"
            elif x[name] is None and getattr(s, "optional", False):
                continue
            elif f := plain(x[name], s, here):
                return f
        return None
    if isinstance(schema, A.ListOf):
        if not isinstance(x, list):
            return path, "not a list"
        return next((f for i, y in enumerate(x) if (f := plain(y, schema.item, f"{path}[{i}]"))), None)
    if isinstance(schema, A.Text):
        return None if isinstance(x, str) else (path, "not a string")
    if isinstance(schema, A.Number):
        try:
            return None if isinstance(x, (int, float, str)) and float(x) is not None else (path, "not a number")
        except ValueError:
            return path, "not a number"
    word = str(x).lower() if isinstance(x, str) else x
    ok = isinstance(x, bool) or (isinstance(x, (int, float)) and x in (0, 1)) or (isinstance(x, str) and word in A.TRUE_WORDS + A.FALSE_WORDS)
    return None if ok else (path, "not a flag")


def checked(spark, model, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, response string").repartition(3)
    return {r.id: r for r in A.check(df, "response", A.MODELS[model]).collect()}


def test_first_fault_of_every_kind(spark):
    good = {"number": "52.1-1", "title": "t", "kind": "Clause", "effective_date": None, "full_text": "x"}
    cases = [
        (None, ("$", "not json")), ("", ("$", "not json")), ("{", ("$", "not json")), ("3", ("$", "not an object")), ("null", ("$", "not an object")),
        ("{}", None), ('{"clauses": null}', ("$.clauses", "not a list")), ('{"clauses": {}}', ("$.clauses", "not a list")), ('{"clauses": []}', None),
        ('{"clauses": [null]}', ("$.clauses[0]", "not an object")), (json.dumps({"clauses": [good, {**good, "kind": None}]}), ("$.clauses[1].kind", "not a string")),
        (json.dumps({"clauses": [good, good, {k: v for k, v in good.items() if k != "title"}, 5]}), ("$.clauses[2].title", "missing")),
        (json.dumps({"clauses": [{**good, "effective_date": 7}]}), ("$.clauses[0].effective_date", "not a string")),
        (json.dumps({"clauses": [{**good, "more": [1, {"a": 2}]}], "other": 1}), None)]
    got = checked(spark, "clauses", [t for t, _ in cases])
    for i, (text, want) in enumerate(cases):
        assert ((got[i].fault_path, got[i].fault_reason) if want else got[i].fault_path) == want, text
    assert got[5].value.clauses == [] and got[13].value.clauses[0].asDict() == good


@pytest.mark.parametrize("score,want", [("0.5", 0.5), ('"0.25"', 0.25), ('" 2 "', 2.0), ("true", 1.0), ("3", 3.0), ("1e3", 1000.0), ("-0.0", 0.0), ('"high"', None), ("[1]", None), ("null", None)])
def test_lax_numbers(spark, score, want):
    row = checked(spark, "relevance", ['{"score": %s, "reasoning": "", "keep": true}' % score])[0]
    assert (row.value.score if want is not None else (row.fault_path, row.fault_reason)) == (want if want is not None else ("$.score", "not a number"))


@pytest.mark.parametrize("keep,want", [("true", True), ("false", False), ("1", True), ("0", False), ("1.0", True), ('"YES"', True), ('"off"', False), ('"n"', False), ("2", None), ('"maybe"', None), ("null", None), ("{}", None)])
def test_lax_flags(spark, keep, want):
    row = checked(spark, "relevance", ['{"score": 1, "reasoning": "", "keep": %s}' % keep])[0]
    assert (row.value.keep if want is not None else row.fault_path) == (want if want is not None else "$.keep")


VALUES = [None, 1, 0.5, "s", "", "1", True, [], ["a"], ["a", 3], [None], {}, {"a": 1}]


def random_answer(rng, schema):
    if rng.random() < 0.04:
        return rng.choice(VALUES)
    if isinstance(schema, A.Record):
        return {n: random_answer(rng, s) for n, s in schema.fields if rng.random() > 0.03}
    if isinstance(schema, A.ListOf):
        return [random_answer(rng, schema.item) for _ in range(rng.randint(0, 3))]
    return {A.Text: "text", A.Number: 0.5, A.Flag: True}[type(schema)]


@pytest.mark.parametrize("model", sorted(A.MODELS))
def test_random_answers_of_all_models(spark, model):
    rng = random.Random(model)
    answers = [random_answer(rng, A.MODELS[model]) for _ in range(300)]
    got = checked(spark, model, [json.dumps(a) for a in answers])
    want = [plain(a, A.MODELS[model]) for a in answers]
    assert [(got[i].fault_path, got[i].fault_reason) if got[i].fault_path else None for i in range(300)] == want
    assert 50 < sum(w is None for w in want) < 300
    for i, a in enumerate(answers):
        assert (got[i].value is None) == (want[i] is not None)
        if want[i] is None and model == "page":
            assert got[i].value.topics == a["topics"] and got[i].value.follow_links == a.get("follow_links", []) and got[i].value.author == a.get("author")


def test_lists_become_rows_in_order(spark):
    item = {"agency": "A", "deviation_number": "1", "title": "t"}
    texts = [json.dumps({"deviations": [{**item, "title": str(k)} for k in range(n)]}) for n in (3, 0, 2)] + ['{"deviations": [1]}', None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, response string")
    rows = A.rows_of(A.check(df, "response", A.DEVIATIONS), ["id"], "deviations").collect()
    assert sorted((r.id, r.pos, r.title, r.scope) for r in rows) == [(0, 0, "0", None), (0, 1, "1", None), (0, 2, "2", None), (2, 0, "0", None), (2, 1, "1", None)]
    assert A.rows_of(A.check(df.where("false"), "response", A.DEVIATIONS), ["id"], "deviations").count() == 0
