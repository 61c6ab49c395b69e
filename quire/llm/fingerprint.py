"""Document fingerprints: Merkle trees over sections, paragraphs and sentences, in DataFrame functions.

A text is split into sections (at blank lines), paragraphs (lines) and leaves (sentences, or pieces of
at most ``LEAF`` characters of one).  A leaf's hash is that of its text, a node's that of its
children's hashes in order, so the tree tells the text.  Equal roots mean equal texts; where roots differ, the branches whose
hashes differ hold the edits, and the share of leaves in common is the likeness of two texts.

A fingerprint is the root, then the sections' paragraphs' leaf hashes (``;`` ``,`` ``.`` end them), each
shortened: it can be compared with another without either text.  Everything is native column functions.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import inputs

#: Characters of a leaf before its end at most; hexadecimal digits of a leaf's hash in a fingerprint.
LEAF, DIGITS = 120, 8
_LEAVES = f"[^.!?]{{1,{LEAF}}}[.!?]* ?|[.!?]+ ?"


def fingerprint(text: Column) -> Column:
    """Root hash, a colon, and the shortened leaf hashes; the empty text has a root and no leaves.

    Nodes: a paragraph is hashed over its leaves, a section over its paragraphs, the root over the
    sections.  A null text counts as empty.
    """
    sections = F.split(F.coalesce(text, F.lit("")), "\n\n", -1)
    return _shown(F.transform(sections, lambda s: F.transform(F.split(s, "\n", -1), lambda p: F.transform(
        F.regexp_extract_all(p, F.lit(_LEAVES), F.lit(0)), F.md5))))


def _shown(trees: Column) -> Column:
    root = F.md5(F.array_join(F.transform(trees, lambda s: F.md5(F.array_join(
        F.transform(s, lambda p: F.md5(F.array_join(p, ""))), ""))), ""))
    branches = F.array_join(F.transform(trees, lambda s: F.array_join(F.transform(s, lambda p: F.array_join(
        F.transform(p, lambda h: F.left(h, F.lit(DIGITS))), ".")), ",")), ";")
    return F.concat(root, F.lit(":"), branches)


def branches(of: Column) -> Column:
    """The distinct leaf hashes of a fingerprint."""
    return F.array_distinct(F.regexp_extract_all(F.substring_index(of, ":", -1), F.lit("[0-9a-f]+"), F.lit(0)))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal roots, else twice the distinct leaves in common over the leaves of both; 0 to 1."""
    x, y = branches(a), branches(b)
    both = F.size(x) + F.size(y)
    return (F.when(F.substring_index(a, ":", 1) == F.substring_index(b, ":", 1), F.lit(1.0))
            .when(both == 0, F.lit(0.0)).otherwise(2.0 * F.size(F.array_intersect(x, y)) / both))


def first_difference(a: Column, b: Column) -> Column:
    """How many leaves agree before the first that differs: where an edit begins."""
    x, y = (F.regexp_extract_all(F.substring_index(c, ":", -1), F.lit("[0-9a-f]+"), F.lit(0)) for c in (a, b))
    equal = F.transform(F.arrays_zip(x.alias("x"), y.alias("y")), lambda z: z["x"].eqNullSafe(z["y"]))
    at = F.array_position(equal, False)
    return F.when(at == 0, F.size(equal).cast("long")).otherwise(at - 1)


def next_rows(rows: DataFrame) -> DataFrame:
    """(key, next_key, n_next): for distinct (doc_id, key, n) the row after it, descending, round the end.

    Ids are range-partitioned and written; rows see their neighbours inside a partition, and one
    row for each partition links the partitions.  Null ids come last; ties go by key.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("key")]
    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = materialize(rows.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()))
    # a partition's first row follows the last row of the partition before
    firsts = dealt.groupBy("part").agg(F.min_by("key", F.struct(F.col("doc_id").isNull(), F.bitwise_not("doc_id"), "key")).alias("first"))
    around = Window.orderBy("part")  # one row for each partition
    after = firsts.select("part", F.coalesce(F.lead("first").over(around),
                                             F.first("first").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("follow"))
    inside = Window.partitionBy("part").orderBy(*order)
    return (dealt.withColumn("next_key", F.lead("key").over(inside)).join(F.broadcast(after), "part")
            .select("key", "n", F.coalesce("next_key", "follow").alias("next_key")))


def compare_edited(docs: DataFrame, share: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row: fingerprints of its text and of an edited one, and likenesses.

    Edited: the last floor(n_chars / share) code points give way to the first as many (or all) of the
    next document's, descending id; after the last comes the first.  Columns: doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_same_leaves (leaves
    before the edit).  A null text counts as empty.  Null ids come last in the order; rows of one id
    are ordered by a hash of the text; rows that repeat id and text are one document in the order and
    all stay.  Ids are integers.  A single document is its own next.
    """
    rows = inputs(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    n = F.length("text").cast("long")
    key = F.concat_ws(" ", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.md5("text"))
    keyed = rows.withColumn("key", key)
    order = next_rows(keyed.select("doc_id", "key", n.alias("n")).groupBy("key")
                      .agg(F.first("doc_id").alias("doc_id"), F.first("n").alias("n")))
    order = materialize(order)
    # what every document passes on to the one before it: as much of its beginning as that one replaces
    cut = F.floor(F.col("n") / share).cast("int")
    wanted = order.select(F.col("next_key").alias("key"), F.col("key").alias("to"), cut.alias("cut"))
    once = Window.partitionBy("key").orderBy("doc_id")  # it uses all columns of keyed, so the shuffle is one
    passed = (keyed.join(wanted, "key").withColumn("again", F.row_number().over(once)).filter("again = 1")
              .select(F.col("to").alias("key"), "cut", F.substring("text", F.lit(1), F.col("cut")).alias("begin"),
                      fingerprint(F.col("text")).alias("next_fingerprint")))
    edited = F.concat(F.substring("text", F.lit(1), n.cast("int") - F.col("cut")), F.col("begin"))
    both = (keyed.join(passed, "key").select("doc_id", n.alias("n_chars"), "next_fingerprint", "text", edited.alias("edited"))
            .select("doc_id", "n_chars", "next_fingerprint", F.sha2("edited", 256).alias("edited_sha256"),
                    fingerprint(F.col("text")).alias("fingerprint"), fingerprint(F.col("edited")).alias("edited_fingerprint")))
    return both.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
                       first_difference(F.col("fingerprint"), F.col("edited_fingerprint")).alias("n_same_leaves"))
