"""Pattern (theta) join of rows to files by a glob, with exact equi keys.

A row ``id = "<agency>|<dev_num>"`` matches a file whose name globs
``*_<agency>*<dev_num>*``.  A bare LIKE join plans as a nested loop over all
pairs.  Instead every row gets one equi key that any matching file must have,
and the full LIKE is the residual on the few candidates: the agency (its first
``AGENCY_KEY`` characters), which must follow some ``_`` of the name, and the
rarest ``k``-character piece (gram) of the number among the names of that
agency; an empty number has the empty gram.  Gram frequencies come from one
partial + final count.

The result equals brute-force glob matching (tested).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import split_once

GRAM = 4
#: Characters of an agency in the key; longer agencies are told apart by the LIKE.
AGENCY_KEY = 16


def _like_escape(c):
    return F.regexp_replace(c, r"([\\%_])", r"\\$1")


def substrings(col, lengths: int):
    """Distinct substrings of ``col`` of length 1..``lengths`` (all positions)."""
    n = F.length(col)
    per_len = F.transform(
        F.sequence(F.lit(1), F.lit(lengths)),
        lambda ln: F.transform(F.sequence(F.lit(1), F.greatest(n - ln + 1, F.lit(1))),
                               lambda i: F.substring(col, i, ln)))
    grams = F.filter(F.flatten(per_len), lambda g: F.length(g) > 0)
    return F.array_distinct(grams)


def grams_of(col, k: int):
    """Substrings of length ``min(k, len)`` at every position (the row side)."""
    n = F.length(col)
    ln = F.least(n, F.lit(k))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(n - ln + 1, F.lit(1))),
                                        lambda i: F.substring(col, i, ln)))


def candidate_agencies(name, max_len: int):
    """Distinct strings that follow some ``_`` in ``name``, of length 0..max_len."""
    parts = F.split(name, "_")
    n = F.size(parts)
    tails = F.transform(F.sequence(F.lit(2), F.greatest(n, F.lit(2))),
                        lambda i: F.array_join(F.slice(parts, i, 1 << 30), "_"))
    tails = F.when(n >= 2, tails).otherwise(F.array().cast("array<string>"))
    prefixes = F.transform(tails, lambda t: F.transform(
        F.sequence(F.lit(0), F.least(F.length(t), F.lit(max_len))), lambda k: F.substring(t, 1, k)))
    return F.array_distinct(F.flatten(prefixes))


def glob_match_join(rows: DataFrame, files: DataFrame, id_col: str = "id",
                    name_col: str = "filename", k: int = GRAM) -> DataFrame:
    """Pairs (row, file) where the file name globs ``*_{agency}*{dev_num}*``.

    An id without a pipe matches nothing.  Files travel to the grams as (name, gram)
    only; their other columns are joined to the matches.
    """
    has_dev = F.col(id_col).contains("|")
    r = rows.where(has_dev).select("*", split_once(F.col(id_col), "|", 0).alias("_agency"),
                                   split_once(F.col(id_col), "|", 1).alias("_dev"))
    r = r.withColumn("_pat", F.concat(F.lit("%\\_"), _like_escape(F.col("_agency")), F.lit("%"),
                                      _like_escape(F.col("_dev")), F.lit("%")))
    name = F.col(name_col)
    out_cols = rows.columns + [c for c in files.columns if c not in rows.columns]

    # names with the (begin of the) agency of some row after a "_"
    r = r.withColumn("_akey", F.substring("_agency", 1, AGENCY_KEY))
    fa = (files.select(name_col).distinct()
          .select(name_col, F.explode(candidate_agencies(name, AGENCY_KEY)).alias("_akey"))
          .join(r.select("_akey").distinct(), "_akey", "left_semi"))
    # key: (agency, rarest gram of the number among the files of that agency); '' without a number
    rg = r.select("_akey", "_dev").distinct().select("_akey", "_dev", F.explode(
        F.when(F.col("_dev") == "", F.array(F.lit(""))).otherwise(grams_of(F.col("_dev"), k))).alias("_gram"))
    # a name has about k grams a character: only those that some row asks for go on
    fg = (fa.select("_akey", name_col, F.explode(F.concat(F.array(F.lit("")), substrings(name, k))).alias("_gram"))
          .join(rg.select("_akey", "_gram").distinct(), ["_akey", "_gram"], "left_semi"))
    freq = fg.groupBy("_akey", "_gram").agg(F.count(F.lit(1)).alias("_freq"))
    # a gram that no file of the agency contains rules the row out (inner join drops it)
    best = (rg.join(freq, ["_akey", "_gram"]).groupBy("_akey", "_dev")
            .agg(F.min(F.struct("_freq", "_gram")).alias("_b"))
            .select("_akey", "_dev", F.col("_b._gram").alias("_gram")))
    # Spark's estimate of names does not grow by explode, so it would send all their grams to every machine
    found = (r.join(best, ["_akey", "_dev"]).join(fg.hint("merge"), ["_akey", "_gram"])
             .where(F.like(name, F.col("_pat"))).select(*rows.columns, name_col).distinct())
    return found.join(files.hint("merge"), name_col).select(*out_cols).distinct()
