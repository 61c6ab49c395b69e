"""Session helpers: building a local session for tests/bench and reading tables.

Production jobs receive a session from the cluster; nothing here overrides
settings that the cluster already set.
"""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "quire") -> SparkSession:
    """A local[N] session for tests and the bench (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.files.maxPartitionBytes", "16m")
        .config("spark.sql.session.timeZone", os.environ.get("QUIRE_SESSION_TZ", "UTC"))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory the cluster names.

    On a cluster ``spark.checkpoint.dir`` must name a shared, fault-tolerant
    folder; it is used as is and its absence is an error, because a machine-local
    folder would be invisible to the other machines.  Only a ``local[...]``
    session (tests, the bench) gets a scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every machine shares")
        conf_dir = tempfile.mkdtemp(prefix="quire-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Scan one driver table; listing columns narrows the parquet ReadSchema."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*cols) if cols else df


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the session's checkpoint directory.

    Cuts lineage for results read more than once (or iterated on).  The rows are
    computed once, by the job that writes them.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table below the checkpoint directory: computed once, read again by column."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/quire-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
