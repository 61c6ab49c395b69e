"""Validation of nested model answers against a schema tree.

A schema is a tree of the nodes below.  It compiles to two expressions over a parsed answer (a variant): the
path and reason of the first fault, in the order in which the fields are declared, and the typed value.  One
faulty field anywhere makes the whole answer invalid.  Strings must be strings; numbers and flags are lax: a
number may be written as text, a flag as 0, 1 or a word for it.  Unknown fields are ignored.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that count as a flag, lower case (fixed values).
TRUE_WORDS, FALSE_WORDS = ("true", "t", "yes", "y", "on", "1"), ("false", "f", "no", "n", "off", "0")
FAULT = "struct<path:string,reason:string>"


@dataclass(frozen=True)
class Text:
    """A string."""
    optional: bool = False  # may be missing or null
    type = "string"


@dataclass(frozen=True)
class Number:
    """A float: a number, a flag, or text that reads as a number."""
    optional: bool = False
    type = "double"


@dataclass(frozen=True)
class Flag:
    """A boolean: a flag, the numbers 0 and 1, or a word for one."""
    optional: bool = False
    type = "boolean"


@dataclass(frozen=True)
class ListOf:
    """A list whose elements all follow ``item``; ``default``: it may be missing (not null) and is empty then."""
    item: object
    default: bool = False

    @property
    def type(self) -> str:
        return f"array<{self.item.type}>"


@dataclass(frozen=True)
class Record:
    """An object with ``fields``: pairs of a name and a schema."""
    fields: tuple = field(default_factory=tuple)
    optional = False

    @property
    def type(self) -> str:
        return "struct<" + ",".join(f"{n}:{s.type}" for n, s in self.fields) + ">"


# The fields of the five answers of the corpus run, in the order in which faults are looked for.
PAGE = Record((("title", Text()), ("author", Text(True)), ("published", Text(True)), ("body", Text()),
               ("topics", ListOf(Text())), ("follow_links", ListOf(Text(), default=True))))
CLAUSE = Record((("number", Text()), ("title", Text()), ("kind", Text()), ("effective_date", Text(True)), ("full_text", Text())))
CLAUSES = Record((("clauses", ListOf(CLAUSE, default=True)),))
DEVIATION = Record((("agency", Text()), ("deviation_number", Text()), ("title", Text()), ("effective_date", Text(True)),
                    ("scope", Text(True)), ("link", Text(True))))
DEVIATIONS = Record((("deviations", ListOf(DEVIATION, default=True)),))
PLAN = Record((("queries", ListOf(Text())), ("rationale", Text())))
RELEVANCE = Record((("score", Number()), ("reasoning", Text()), ("keep", Flag())))
MODELS = {"page": PAGE, "clauses": CLAUSES, "deviations": DEVIATIONS, "plan": PLAN, "relevance": RELEVANCE}


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _part(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant")


def _items(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _is_number(kind: Column) -> Column:
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def _number(v: Column) -> Column:
    kind = F.schema_of_variant(v)
    return (F.when(kind == "STRING", F.trim(F.try_variant_get(v, "$", "string")).try_cast("double"))
            .when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("double"))
            .when(_is_number(kind), F.try_variant_get(v, "$", "double")))


def _flag(v: Column) -> Column:
    kind = F.schema_of_variant(v)
    word, number = F.lower(F.try_variant_get(v, "$", "string")), F.try_variant_get(v, "$", "double")
    return (F.when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
            .when((kind == "STRING") & word.isin(*TRUE_WORDS), F.lit(True)).when((kind == "STRING") & word.isin(*FALSE_WORDS), F.lit(False))
            .when(_is_number(kind) & (number == 1), F.lit(True)).when(_is_number(kind) & (number == 0), F.lit(False)))


def fault(v: Column, schema, path: Column) -> Column:
    """Path and reason of the first fault of the variant ``v``; NULL if it follows ``schema``.  SQL NULL is a missing value."""
    kind = F.schema_of_variant(v)

    def bad(reason: str) -> Column:
        return F.struct(path.alias("path"), F.lit(reason).alias("reason"))

    none = F.lit(None).cast(FAULT)
    if isinstance(schema, Record):
        def of(name: str, inner) -> Column:
            return _let(_part(v, name), lambda x: fault(x, inner, F.concat(path, F.lit(f".{name}"))))

        inside = F.coalesce(*[of(n, s) for n, s in schema.fields])
        return F.when(v.isNull(), bad("missing")).when(~kind.startswith("OBJECT"), bad("not an object")).otherwise(inside)
    if isinstance(schema, ListOf):
        faults = F.transform(_items(v), lambda x, i: fault(x, schema.item, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
        first = F.get(F.filter(faults, lambda f: f.isNotNull()), F.lit(0))
        return (F.when(v.isNull(), none if schema.default else bad("missing"))
                .when(~kind.startswith("ARRAY"), bad("not a list")).otherwise(first))
    missing = F.when(v.isNull(), none if schema.optional else bad("missing"))
    if schema.optional:
        missing = missing.when(kind == "VOID", none)
    if isinstance(schema, Text):
        return missing.when(kind != "STRING", bad("not a string"))
    if isinstance(schema, Number):
        return missing.when(_number(v).isNull(), bad("not a number"))
    return missing.when(_flag(v).isNull(), bad("not a flag"))


def value(v: Column, schema) -> Column:
    """The typed value of a variant without fault."""
    if isinstance(schema, Record):
        def of(name: str, inner) -> Column:
            return _let(_part(v, name), lambda x: value(x, inner)).alias(name)

        return F.struct(*[of(n, s) for n, s in schema.fields])
    if isinstance(schema, ListOf):
        return F.coalesce(F.transform(_items(v), lambda x: value(x, schema.item)), F.array().cast(schema.type))
    if isinstance(schema, Number):
        return _number(v)
    if isinstance(schema, Flag):
        return _flag(v)
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))


def check(answers: DataFrame, response: str, schema, out: str = "value") -> DataFrame:
    """``answers`` with ``out`` (typed by ``schema``, NULL for an invalid answer), and ``fault_path`` and ``fault_reason``.

    ``response``: JSON text.  Text that is not JSON, NULL included, has the path ``$`` and the reason ``not json``.
    """
    parsed = answers.withColumn("_answer", F.try_parse_json(F.col(response)))
    found = F.when(F.col("_answer").isNull(), F.struct(F.lit("$").alias("path"), F.lit("not json").alias("reason"))).otherwise(
        fault(F.col("_answer"), schema, F.lit("$")))
    faulty = parsed.withColumn("_fault", found)
    typed = faulty.withColumn(out, F.when(F.col("_fault").isNull(), value(F.col("_answer"), schema)))
    return typed.select(*answers.columns, out, F.col("_fault.path").alias("fault_path"), F.col("_fault.reason").alias("fault_reason"))


def rows_of(checked: DataFrame, keep: list[str], listed: str, col: str = "value") -> DataFrame:
    """One row per element of the list ``listed`` of valid answers: keep..., pos and the element's fields (I4)."""
    elements = checked.where(F.col("fault_path").isNull()).select(*keep, F.posexplode(F.col(col)[listed]).alias("pos", "x"))
    return elements.select(*keep, "pos", "x.*")
