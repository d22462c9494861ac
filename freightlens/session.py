"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Pin the SQL settings that results and speed depend on.

    Timestamps are UTC without a zone, so the session zone must be UTC.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    # The JVM never compiles a method above 8000 bytes of bytecode.  Stages with very wide expressions are faster with one
    # compiled method per operator than with a single fused method that stays interpreted.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return tidy(spark)


def tidy(spark: SparkSession) -> SparkSession:
    """Have Spark remove a job's shuffle files when it ends: jobs that follow each other would keep the files of all of
    them until the driver collects garbage."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def build_session(app: str = "freightlens", cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the submitted one with :func:`configure`."""
    partitions = 8 if cores == "*" else int(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # A local file system lists folders faster than a job does.
        .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "1000")
        # Call-site capture per expression only serves error messages and slows down building large plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A temporary folder is made, and set as the checkpoint folder, only where the setting is absent and Spark runs
    in one local process.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named and spark.sparkContext.getCheckpointDir():
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="freightlens-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
