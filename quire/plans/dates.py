"""Date normalisation queries on ``orders`` (stand-in for the deviations table).

The raw free-text date is built from each order's own columns by the same
formula in Spark and in the oracle SQL, covering every rule of the normaliser.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import with_normalized_date
from ..operators.report import kind_distribution, coverage
from ..session import table
from .registry import query


# The raw text per order as one Spark SQL expression (handed to the JVM in a
# single call); the same formula as RAW_DATES_SQL below.
_RAW_DATE_EXPR = """
CASE o_orderkey % 12
  WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd')
  WHEN 1 THEN date_format(o_orderdate, 'yyyy.MM.dd')
  WHEN 2 THEN date_format(o_orderdate, 'M/d/yyyy')
  WHEN 3 THEN CASE WHEN o_custkey % 3 = 0 THEN upper(date_format(o_orderdate, 'MMMM d, yyyy'))
                   ELSE date_format(o_orderdate, 'MMMM d, yyyy') END
  WHEN 4 THEN concat(date_format(o_orderdate, 'MMMM d, yyyy'), ' (Effective immediately)')
  WHEN 5 THEN CASE WHEN o_custkey % 2 = 0 THEN 'Immediately' ELSE 'Effective upon issuance' END
  WHEN 6 THEN concat('Date of issuance of the FY', date_format(o_orderdate, 'yy'), ' model language')
  WHEN 7 THEN concat(CAST(o_custkey % 60 AS STRING), ' days from signature')
  WHEN 8 THEN CASE WHEN o_custkey % 2 = 0 THEN NULL ELSE '   ' END
  WHEN 9 THEN CASE WHEN o_custkey % 2 = 0 THEN 'TBD' ELSE date_format(o_orderdate, 'MMMM d yyyy') END
  WHEN 10 THEN CASE WHEN o_custkey % 2 = 0 THEN concat(date_format(o_orderdate, 'yyyy'), '-13-40')
                    ELSE concat('February 30, ', date_format(o_orderdate, 'yyyy')) END
  ELSE concat('  ', date_format(o_orderdate, 'yyyy-MM-dd'), ' ')
END
"""


def raw_dates(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """``(o_orderkey, effective_date, *extra)`` free text derived from each order."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", *extra)
    return o.select("o_orderkey", F.expr(_RAW_DATE_EXPR).alias("effective_date"), *extra)


RAW_DATES_SQL = """
SELECT o_orderkey,
  CASE o_orderkey % 12
    WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN 1 THEN strftime(o_orderdate, '%Y.%m.%d')
    WHEN 2 THEN strftime(o_orderdate, '%-m/%-d/%Y')
    WHEN 3 THEN CASE WHEN o_custkey % 3 = 0 THEN upper(strftime(o_orderdate, '%B %-d, %Y'))
                     ELSE strftime(o_orderdate, '%B %-d, %Y') END
    WHEN 4 THEN strftime(o_orderdate, '%B %-d, %Y') || ' (Effective immediately)'
    WHEN 5 THEN CASE WHEN o_custkey % 2 = 0 THEN 'Immediately' ELSE 'Effective upon issuance' END
    WHEN 6 THEN 'Date of issuance of the FY' || strftime(o_orderdate, '%y') || ' model language'
    WHEN 7 THEN CAST(o_custkey % 60 AS VARCHAR) || ' days from signature'
    WHEN 8 THEN CASE WHEN o_custkey % 2 = 0 THEN NULL ELSE '   ' END
    WHEN 9 THEN CASE WHEN o_custkey % 2 = 0 THEN 'TBD' ELSE strftime(o_orderdate, '%B %-d %Y') END
    WHEN 10 THEN CASE WHEN o_custkey % 2 = 0 THEN strftime(o_orderdate, '%Y') || '-13-40'
                      ELSE 'February 30, ' || strftime(o_orderdate, '%Y') END
    ELSE '  ' || strftime(o_orderdate, '%Y-%m-%d') || ' '
  END AS effective_date
FROM orders
"""

# The normaliser spelt out in DuckDB SQL over ``raw`` (RE2 patterns).
NORMALIZED_SQL = r"""
WITH raw AS ({raw}),
s AS (
  SELECT *, regexp_replace(effective_date, '^\s+|\s+$', '', 'g') AS s FROM raw
),
p AS (
  SELECT *,
    CASE WHEN regexp_matches(s, '^(\d{{4}})-(\d{{2}})-(\d{{2}})$') THEN
      try(make_date(CAST(regexp_extract(s, '^(\d{{4}})', 1) AS INT),
                    CAST(regexp_extract(s, '^\d{{4}}-(\d{{2}})', 1) AS INT),
                    CAST(regexp_extract(s, '(\d{{2}})$', 1) AS INT))) END AS d_iso,
    CASE WHEN regexp_matches(s, '^(\d{{4}})\.(\d{{2}})\.(\d{{2}})$') THEN
      try(make_date(CAST(regexp_extract(s, '^(\d{{4}})', 1) AS INT),
                    CAST(regexp_extract(s, '^\d{{4}}\.(\d{{2}})', 1) AS INT),
                    CAST(regexp_extract(s, '(\d{{2}})$', 1) AS INT))) END AS d_dot,
    CASE WHEN regexp_matches(s, '^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}})$') THEN
      try(make_date(CAST(regexp_extract(s, '(\d{{4}})$', 1) AS INT),
                    CAST(regexp_extract(s, '^(\d{{1,2}})/', 1) AS INT),
                    CAST(regexp_extract(s, '^\d{{1,2}}/(\d{{1,2}})/', 1) AS INT))) END AS d_us,
    regexp_extract(s, '(?i)\b(January|February|March|April|May|June|July|August|September|October|November|December)\s+(\d{{1,2}}),\s*(\d{{4}})\b', ['m', 'd', 'y']) AS lg,
    lower(s) AS low
  FROM s
),
q AS (
  SELECT *,
    CASE WHEN lg.m <> '' AND TRY_CAST(lg.y AS INT) >= 1 THEN
      try(make_date(TRY_CAST(lg.y AS INT),
        list_position(['january','february','march','april','may','june','july','august',
                       'september','october','november','december'], lower(lg.m)),
        TRY_CAST(lg.d AS INT))) END AS d_long,
    coalesce(d_iso, d_dot, d_us) AS d_any
  FROM p
),
k AS (
  SELECT *,
    CASE
      WHEN effective_date IS NULL OR s = '' THEN 'empty'
      WHEN d_any IS NOT NULL THEN 'iso'
      WHEN d_long IS NOT NULL THEN 'long'
      WHEN starts_with(low, 'immediate') OR starts_with(low, 'effective upon') THEN 'immediate'
      WHEN contains(low, 'date of issuance') OR contains(low, 'document dated')
        OR contains(low, 'model language release') OR contains(low, 'model text release') THEN 'issuance'
      WHEN contains(low, 'days from') OR contains(low, 'days after') THEN 'delta'
      ELSE 'unparsed'
    END AS effective_date_kind
  FROM q
)
SELECT * EXCLUDE (s, d_iso, d_dot, d_us, lg, low, d_long, d_any),
  CASE effective_date_kind WHEN 'iso' THEN d_any WHEN 'long' THEN d_long END AS effective_date_iso
FROM k
"""

DATE_NORMALIZE_SQL = NORMALIZED_SQL.format(raw=RAW_DATES_SQL)


def normalized_orders(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    return with_normalized_date(raw_dates(spark, sf_dir, extra))


@query("date_normalize", DATE_NORMALIZE_SQL)
def date_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalized_orders(spark, sf_dir)


@query("date_kind_distribution", f"""
WITH n AS ({DATE_NORMALIZE_SQL}),
g AS (SELECT effective_date_kind AS kind, count(*) AS n FROM n GROUP BY 1),
t AS (SELECT *, sum(n) OVER () AS total FROM g)
SELECT kind, n, CAST((n * 2000 + total) // (2 * total) AS DOUBLE) / 10 AS pct,
       row_number() OVER (ORDER BY n DESC, kind) AS rank
FROM t
""")
def date_kind_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kind_distribution(normalized_orders(spark, sf_dir), "effective_date_kind")


@query("date_coverage", f"""
WITH n AS ({DATE_NORMALIZE_SQL}),
c AS (SELECT count(*) AS total, count(effective_date_iso) AS resolved FROM n)
SELECT total, resolved,
       CASE WHEN total = 0 THEN 0.0
            ELSE CAST((resolved * 2000 + total) // (2 * total) AS DOUBLE) / 10 END AS pct
FROM c
""")
def date_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage(normalized_orders(spark, sf_dir), "effective_date_iso")


@query("unparsed_sample", f"""
WITH n AS ({DATE_NORMALIZE_SQL})
SELECT o_orderkey, effective_date, row_number() OVER (ORDER BY o_orderkey) AS rank
FROM n WHERE effective_date_kind = 'unparsed'
ORDER BY o_orderkey LIMIT 15
""")
def unparsed_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 15 unparsed rows by key (the reference's manual-review sample)."""
    n = normalized_orders(spark, sf_dir).where(F.col("effective_date_kind") == "unparsed")
    top = n.orderBy("o_orderkey").limit(15).select("o_orderkey", "effective_date")
    # rank over the 15 collected rows only (the limit runs first)
    w = Window.orderBy("o_orderkey")
    return top.withColumn("rank", F.row_number().over(w).cast("bigint"))
