"""File sources and sinks: directory listings, CSV manifests, JSON run
manifests, landed HTML and page text (A1, A3, A4, A5, A6, A9, A10).

Everything is a DataFrame reader/writer with a declared schema; nothing is
inferred and no file content goes through the driver.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.manifest import CSV_HEADER

MANIFEST_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in CSV_HEADER])

RECORD_SCHEMA = T.StructType([
    T.StructField("pdf_url", T.StringType()), T.StructField("filename", T.StringType()),
    T.StructField("agency", T.StringType()), T.StructField("is_dod", T.BooleanType()),
    T.StructField("part_numbers", T.ArrayType(T.IntegerType())),
    T.StructField("saved_path", T.StringType()), T.StructField("error", T.StringType()),
])
RUN_MANIFEST_SCHEMA = T.StructType([
    T.StructField("started_utc", T.StringType()), T.StructField("finished_utc", T.StringType()),
    T.StructField("duration_sec", T.DoubleType()), T.StructField("guide_url", T.StringType()),
    T.StructField("total_pdfs_on_guide", T.IntegerType()),
    T.StructField("new_pdfs_count", T.IntegerType()),
    T.StructField("downloaded_count", T.IntegerType()),
    T.StructField("failed_count", T.IntegerType()),
    T.StructField("new_pdfs", T.ArrayType(RECORD_SCHEMA)),
])
LANDED_PAGE_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
    T.StructField("error", T.StringType()),
])
PAGE_TEXT_SCHEMA = T.StructType([
    T.StructField("doc", T.StringType()), T.StructField("page_no", T.IntegerType()),
    T.StructField("page_text", T.StringType()),
])


def list_files(spark: SparkSession, directory, glob: str = "*.pdf", by_folder: bool = False) -> DataFrame:
    """``(name, length, path)`` of the files under ``directory`` or a list of directories.

    Only metadata columns are selected, so file contents are never read.  ``by_folder``: objects that are folders of
    files, as a partitioned write leaves them (``name=<value>``): one row per object with its files' total size.
    """
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", str(by_folder).lower()).load(directory))
    if not by_folder:
        return df.select(F.substring_index("path", "/", -1).alias("name"), "length", "path")
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    files = df.select(F.url_decode(F.regexp_extract(folder, r"([^/=]*)$", 1)).alias("name"), "length", folder.alias("path"))
    return files.groupBy("name", "path").agg(F.sum("length").alias("length")).select("name", "length", "path")


# quotes inside a quoted field are doubled, and a field may hold line breaks
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False,
               "ignoreTrailingWhiteSpace": False}


def read_manifest_csv(spark: SparkSession, path: str) -> DataFrame:
    """Corpus manifest CSV, header row, every column a string (A5); an empty field
    is the empty string."""
    rows = spark.read.schema(MANIFEST_SCHEMA).options(**CSV_OPTIONS, multiLine=True).csv(path)
    return rows.select(*[F.coalesce(c, F.lit("")).alias(c) for c in CSV_HEADER])


def write_manifest_csv(df: DataFrame, path: str) -> None:
    """Manifest CSV with the fixed header order, sorted by file name."""
    (df.select(*CSV_HEADER).orderBy("on_disk_filename")
     .write.mode("overwrite").options(**CSV_OPTIONS).csv(path))


def read_run_manifests(spark: SparkSession, path: str) -> DataFrame:
    """Run-manifest JSON documents (one per file), nested records kept."""
    return spark.read.schema(RUN_MANIFEST_SCHEMA).option("multiLine", True).json(path)


def latest_run(manifests: DataFrame) -> DataFrame:
    """The newest run that has new PDFs (the stable "latest" pointer, A10)."""
    return (manifests.where(F.col("new_pdfs_count") > 0)
            .orderBy(F.col("started_utc").desc()).limit(1))


def run_records(manifests: DataFrame) -> DataFrame:
    """One row per new-PDF record of the run manifests (I4)."""
    return manifests.select("started_utc", F.inline("new_pdfs"))


#: Records that one nested run document may hold.
NESTED_RECORDS = 100_000


def write_run_manifest(summary: DataFrame, records: DataFrame, path: str) -> None:
    """Write run summaries with their records nested, one JSON document per
    run (A10).  ``summary`` has the run columns plus ``run_id``; ``records``
    has ``run_id`` plus the record columns.  A run's records meet in one row, so a run of more than
    NESTED_RECORDS is an error; :func:`write_runs` takes runs of any size."""
    most = records.groupBy("run_id").count().agg(F.max("count")).first()[0] or 0
    if most > NESTED_RECORDS:
        raise ValueError(f"a run has {most} records; write_runs keeps them beside its document")
    nested = records.groupBy("run_id").agg(
        F.collect_list(F.struct(*[f.name for f in RECORD_SCHEMA.fields])).alias("new_pdfs"))
    out = summary.join(nested, "run_id", "left")
    out.write.mode("overwrite").json(path)


RUN_SCHEMA = T.StructType([f for f in RUN_MANIFEST_SCHEMA.fields if f.name != "new_pdfs"])


def write_runs(summary: DataFrame, records: DataFrame, path: str) -> None:
    """Run manifests of any size (A10): a document per run below ``runs``, and its records as JSON rows below ``records``, both
    by ``run_id``.  No run's records meet in one task."""
    doc = F.to_json(F.struct(*[c for c in summary.columns if c != "run_id"]), {"pretty": "true"})
    summary.select("run_id", doc.alias("value")).write.mode("overwrite").partitionBy("run_id").text(f"{path}/runs")
    records.select("run_id", *[f.name for f in RECORD_SCHEMA.fields]).write.mode("overwrite").partitionBy("run_id").json(f"{path}/records")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The documents of :func:`write_runs`, each of several lines: run_id and the run columns."""
    schema = T.StructType([*RUN_SCHEMA.fields, T.StructField("run_id", T.StringType())])
    return spark.read.schema(schema).option("multiLine", True).json(f"{path}/runs")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of :func:`write_runs`: run_id and the record columns; a filter on run_id reads that run alone."""
    schema = T.StructType([*RECORD_SCHEMA.fields, T.StructField("run_id", T.StringType())])
    return spark.read.schema(schema).json(f"{path}/records")


def read_landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed fetch results ``(url, html, error)`` (A1)."""
    return spark.read.schema(LANDED_PAGE_SCHEMA).parquet(path)


def read_page_text(spark: SparkSession, path: str) -> DataFrame:
    """Per-page extracted text ``(doc, page_no, page_text)`` (A4)."""
    return spark.read.schema(PAGE_TEXT_SCHEMA).parquet(path)
