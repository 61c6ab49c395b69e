"""Imports every plan module so their queries register; names the flagship."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import answers, crawl, dates, extract, incremental, links, manifest, reports, sections, store  # noqa: F401


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates.date_normalize(spark, sf_dir)
