"""Session construction and the shared checkpoint location."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
}


def local_session(cpus: int | str = "*", app: str = "segscore", **conf) -> SparkSession:
    """A local session for tests and the bench. Clusters build their own."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in {**_LOCAL_DEFAULTS, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only when it is unset
    (local tests) fall back to a fresh scratch folder."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="segscore-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(d)
    return d


def cut_lineage(df):
    """Reliable checkpoint (never local): survives executor loss and pins a
    non-deterministic plan (sort-based ids) to one materialisation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    """A size threshold from the session conf (``segscore.*``), else the default."""
    v = spark.conf.get(key, None)
    return int(v) if v not in (None, "") else default
