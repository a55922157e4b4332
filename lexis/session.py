"""Session helpers: one place that builds a SparkSession and resolves the
shared checkpoint folder.

On a cluster the checkpoint folder is whatever the cluster names in
``spark.checkpoint.dir`` (a shared, fault-tolerant file system).  Only when
that setting is absent (tests, a laptop) do we fall back to a folder of our
own under the system temp dir.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "lexis") -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of this SparkContext: the one already set, else
    the one named in ``spark.checkpoint.dir``.  Only a purely local master
    (tests, a laptop) gets a temp folder of its own; anywhere else a missing
    setting is an error, because executors would not see each other's files."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="lexis-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared scratch folder and read it
    back: a compressed, columnar lineage cut whose later readers prune
    columns; like a checkpoint it survives the loss of executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder: survives
    executor loss (unlike localCheckpoint) and keeps the output
    partitioning.  (Not persisted first: a cached plan would keep the
    configured shuffle partition count instead of AQE's coalesced one.)"""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: set = set()


def ship_package(spark: SparkSession | None = None) -> None:
    """Make ``lexis`` importable in Python workers (UDFs pickle functions by
    reference): zip the package once per application and ``addPyFile`` it,
    which distributes it to every executor."""
    import shutil

    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import lexis

    pkg_dir = os.path.dirname(os.path.abspath(lexis.__file__))
    base = tempfile.mkdtemp(prefix="lexis-pkg-")
    archive = shutil.make_archive(os.path.join(base, "lexis"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir="lexis")
    sc.addPyFile(archive)
    _SHIPPED.add(key)
