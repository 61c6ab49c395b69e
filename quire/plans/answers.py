"""Nested model answers: one JSON answer per document, of one of the five models, many of them faulty.

The answers are built by one expression that both engines read; the oracle compiles the same schema trees to
DuckDB's JSON functions.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import answers as A
from ..session import table
from . import sqlfrag as S
from .registry import query

_MODEL = "CASE doc_id % 5 WHEN 0 THEN 'page' WHEN 1 THEN 'clauses' WHEN 2 THEN 'deviations' WHEN 3 THEN 'plan' ELSE 'relevance' END"


def _items(one: str) -> str:
    """Up to three elements, as many as the document's id says; ``one`` holds the place K."""
    parts = [f"CASE WHEN doc_id % 7 > {k} THEN concat({S.q(',') if k else S.q('')}, {one.replace('K', str(k))}) ELSE '' END" for k in range(3)]
    return "concat('[', " + ", ".join(parts) + ", ']')"


def _pick(*choices: str, by: str = "n_chars % 17") -> str:
    """One of the fragments; the last for every other number."""
    whens = " ".join(f"WHEN {i} THEN {S.q(c)}" for i, c in enumerate(choices[:-1]))
    return f"CASE {by} {whens} ELSE {S.q(choices[-1])} END"


_CLAUSE = ("concat('{\"number\":\"52.', doc_id % 90, '-K\",\"title\":\"', source, '\",', " + _pick('"kind":null,', '"kind":"Clause",')
           + ", " + _pick('"effective_date":null,', '"effective_date":"JAN 2026",', "", by="doc_id % 3")
           + ", CASE WHEN n_chars % 13 = K THEN '\"full_text\":7}' ELSE concat('\"full_text\":\"', lang, ' text\"}') END)")
_DEVIATION = ("concat('{\"agency\":\"', lang, '\",', CASE WHEN n_chars % 11 = K THEN '' ELSE concat('\"deviation_number\":\"CD-', n_chars, '\",') END, "
              + _pick('"scope":{"a":1},', '"scope":null,', '"scope":"all",', '"more":[1,{"b":2}],') + ", '\"title\":\"', source, '\"}')")
_ANSWER = f"""
CASE WHEN n_chars % 29 = 3 THEN concat('{{"title": "', source, '"') WHEN n_chars % 29 = 4 THEN concat('[', doc_id, ']')
ELSE CASE doc_id % 5
  WHEN 0 THEN concat('{{"title":"', source, '",', {_pick('"author":5,', '"author":null,', '"author":"' + 'x",', '')}, '"body":"', lang, '",',
    {_pick('"topics":["a",2],', '"topics":"a",', '', '"topics":null,', '"topics":["a","b","c"],')}, {_pick('"follow_links":null,', '"follow_links":["/a"],', '', by='doc_id % 4')}, '"n":1}}')
  WHEN 1 THEN concat('{{', {_pick('"other":1', '"clauses":null', '"clauses":{}', '"clauses":[]', '"clauses":[3]', '"clauses":')},
    CASE WHEN n_chars % 17 < 5 THEN '' ELSE {_items(_CLAUSE)} END, '}}')
  WHEN 2 THEN concat('{{"deviations":', {_items(_DEVIATION)}, '}}')
  WHEN 3 THEN concat('{{', {_pick('"queries":["q",null]', '"queries":[]', '"queries":["q","r"]')}, {_pick('', ',"rationale":"r"', by='n_chars % 7')}, '}}')
  ELSE concat('{{"score":', {_pick('"high"', '"0.75"', 'true', '1', 'null', '[0.5]', '0.5')}, ',"reasoning":"', lang, '","keep":',
    {_pick('"Yes"', '0', '1.0', '"maybe"', '2', '"off"', 'null', 'true', by='doc_id % 11')}, '}}')
END END
"""


def model_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents", "doc_id", "lang", "source", "n_chars")
    return d.select("doc_id", F.expr(_MODEL).alias("model"), F.expr(_ANSWER).alias("response"))


ANSWERS_SQL = f"SELECT doc_id, {_MODEL} AS model, {_ANSWER} AS response FROM documents"


# ---- the oracle: schema trees to DuckDB's JSON functions ----
_NUMBERS = "('BIGINT', 'UBIGINT', 'DOUBLE', 'HUGEINT')"


def _number(x: str) -> str:
    return (f"(CASE WHEN json_type({x}) = 'VARCHAR' THEN TRY_CAST(trim({x} ->> '$') AS DOUBLE) WHEN json_type({x}) = 'BOOLEAN' THEN CAST(({x})::VARCHAR = 'true' AS INT)::DOUBLE "
            f"WHEN json_type({x}) IN {_NUMBERS} THEN TRY_CAST({x} ->> '$' AS DOUBLE) END)")


def _flag(x: str) -> str:
    words = lambda ws: "(" + ", ".join(S.q(w) for w in ws) + ")"
    return (f"(CASE WHEN json_type({x}) = 'BOOLEAN' THEN ({x})::VARCHAR = 'true' WHEN json_type({x}) = 'VARCHAR' AND lower({x} ->> '$') IN {words(A.TRUE_WORDS)} THEN true "
            f"WHEN json_type({x}) = 'VARCHAR' AND lower({x} ->> '$') IN {words(A.FALSE_WORDS)} THEN false "
            f"WHEN json_type({x}) IN {_NUMBERS} AND TRY_CAST({x} ->> '$' AS DOUBLE) = 1 THEN true WHEN json_type({x}) IN {_NUMBERS} AND TRY_CAST({x} ->> '$' AS DOUBLE) = 0 THEN false END)")


def _fault(x: str, schema, path: str, depth: int = 0) -> str:
    """SQL of ``path reason`` of the first fault of the JSON ``x``, or NULL; SQL NULL is a missing value."""
    bad = lambda reason: f"{path} || ' {reason}'"
    if isinstance(schema, A.Record):
        inside = ", ".join(_fault(f"json_extract({x}, '$.{n}')", s, f"{path} || '.{n}'", depth) for n, s in schema.fields)
        return f"CASE WHEN {x} IS NULL THEN {bad('missing')} WHEN json_type({x}) <> 'OBJECT' THEN {bad('not an object')} ELSE coalesce({inside}) END"
    if isinstance(schema, A.ListOf):
        item = f"x{depth}"
        each = _fault(f"coalesce({item}, CAST('null' AS JSON))", schema.item, f"{path} || '[' || (i{depth} - 1) || ']'", depth + 1)
        first = f"list_filter(list_transform(CAST({x} AS JSON[]), lambda {item}, i{depth}: {each}), lambda f: f IS NOT NULL)[1]"
        return (f"CASE WHEN {x} IS NULL THEN {'NULL' if schema.default else bad('missing')} WHEN json_type({x}) <> 'ARRAY' THEN {bad('not a list')} ELSE {first} END")
    wrong = {A.Text: (f"json_type({x}) <> 'VARCHAR'", "not a string"), A.Number: (f"{_number(x)} IS NULL", "not a number"), A.Flag: (f"{_flag(x)} IS NULL", "not a flag")}
    condition, reason = wrong[type(schema)]
    null = f"WHEN json_type({x}) = 'NULL' THEN NULL" if schema.optional else ""
    return f"CASE WHEN {x} IS NULL THEN {'NULL' if schema.optional else bad('missing')} {null} WHEN {condition} THEN {bad(reason)} END"


_FAULTS_SQL = f"""
SELECT doc_id, model, response, CASE WHEN NOT json_valid(response) THEN '$ not json' ELSE CASE model {' '.join(
    f"WHEN '{m}' THEN {_fault('TRY_CAST(response AS JSON)', s, S.q('$'))}" for m, s in A.MODELS.items())} END END AS fault FROM ({ANSWERS_SQL})
"""
_LISTED = {"page": "topics", "clauses": "clauses", "deviations": "deviations", "plan": "queries"}


def checked(spark: SparkSession, sf_dir: str, model: str) -> DataFrame:
    answers = model_answers(spark, sf_dir)
    return A.check(answers.where(F.col("model") == model), "response", A.MODELS[model])


@query("answer_check", f"""
SELECT doc_id, model, regexp_extract(fault, '^[^ ]+', 0) AS fault_path, substr(fault, length(regexp_extract(fault, '^[^ ]+', 0)) + 2) AS fault_reason,
  CASE WHEN fault IS NULL AND model <> 'relevance' THEN coalesce(json_array_length(TRY_CAST(response AS JSON), CASE model {' '.join(f"WHEN '{m}' THEN '$.{f}'" for m, f in _LISTED.items())} END), 0) END::INTEGER AS n_items,
  CASE WHEN fault IS NULL AND model = 'relevance' THEN {_number("json_extract(TRY_CAST(response AS JSON), '$.score')")} END AS score,
  CASE WHEN fault IS NULL AND model = 'relevance' THEN {_flag("json_extract(TRY_CAST(response AS JSON), '$.keep')")} END AS keep
FROM ({_FAULTS_SQL})
""")
def answer_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every answer: the path and reason of its first fault, or what its typed value holds."""
    def shown(model: str) -> DataFrame:
        v = checked(spark, sf_dir, model)
        n = F.size(F.col("value")[_LISTED[model]]) if model in _LISTED else F.lit(None).cast("int")
        score, keep = (F.col("value.score"), F.col("value.keep")) if model == "relevance" else (F.lit(None).cast("double"), F.lit(None).cast("boolean"))
        valid = F.col("fault_path").isNull()
        return v.select("doc_id", "model", "fault_path", "fault_reason", F.when(valid, n).alias("n_items"), F.when(valid, score).alias("score"),
                        F.when(valid, keep).alias("keep"))

    return reduce(DataFrame.unionAll, [shown(m) for m in A.MODELS])


def _rows_sql(model: str) -> str:
    fields = A.MODELS[model].fields[0][1].item.fields
    return f"""
SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, {', '.join(f"json_extract_string(items[i], '$.{n}') AS {n}" for n, _ in fields)}
FROM (SELECT doc_id, items, unnest(range(1, len(items) + 1)) AS i
      FROM (SELECT doc_id, CAST(json_extract(TRY_CAST(response AS JSON), '$.{model}') AS JSON[]) AS items FROM ({_FAULTS_SQL}) WHERE fault IS NULL AND model = '{model}'))
"""


@query("answer_clauses", _rows_sql("clauses"))
def answer_clauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clauses of valid answers as rows (I4)."""
    return A.rows_of(checked(spark, sf_dir, "clauses"), ["doc_id"], "clauses")


@query("answer_deviations", _rows_sql("deviations"))
def answer_deviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deviations of valid answers as rows (I4)."""
    return A.rows_of(checked(spark, sf_dir, "deviations"), ["doc_id"], "deviations")
