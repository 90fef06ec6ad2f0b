"""Session helpers: recommended configuration and the shared scratch folder.

The library never creates a session on its own inside an operator; callers pass
one in. ``local_session`` exists for tests, the bench and the examples.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Settings that matter at any scale: AQE re-plans joins and partition counts from
# measured shuffle sizes, splits skewed join partitions, and converts a join to a
# broadcast only when the measured build side is under the threshold.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def local_session(cpus: int | None = None, app: str = "tidyspark",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and benches (UI off, AQE on)."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "16g")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus)))
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``;
    it is read from the session and never replaced. Only a local session
    (``local[...]``, as in tests) without one gets a folder under the local temp
    dir; any other master without one is an error, since executors would write
    to their own disks.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext, the conf names the folder
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if sc is None:
        if configured is None:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        return configured
    if configured is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tidyspark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_RUN = f"tidyspark-{uuid.uuid4().hex[:12]}"      # this process's scratch tables share one folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the checkpoint folder for staged tables and round trips."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{_RUN}/{label}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete this process's staged tables. Frames that read them can't be used afterwards."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/{_RUN}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df, label: str = "stage"):
    """Cut lineage by writing ``df`` as parquet below the checkpoint folder.

    Later passes read the written files: a row count comes from parquet
    metadata and a pass over a few columns reads only those columns. Types that
    parquet cannot store (and only those) go to a reliable ``checkpoint()``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    try:
        df.write.parquet(path)
    except AnalysisException as e:
        if "UNSUPPORTED_DATA_TYPE_FOR_DATASOURCE" not in str(e):
            raise
        return df.checkpoint(eager=True)
    return spark.read.schema(df.schema).parquet(path)

