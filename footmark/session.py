"""Spark session helpers."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark import SparkConf
from pyspark.errors import AnalysisException, PySparkAttributeError, PySparkNotImplementedError
from pyspark.sql import SparkSession

# Settings the library relies on. ANSI mode stays on (Spark 4 default); the
# code uses try_* functions where bad input must become null.
REQUIRED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # size-driven coalescing (advisory 64 MB per partition) rather than keeping
    # the default parallelism for tiny stages
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # Keep fips/provider partition values as strings ("06083" stays "06083").
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows with large polygons: bound the bytes of a batch, not only its rows
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
}

# Set unless the session has a value of its own. Rows here are small and costly (WKB kernels, address
# grammar, exploded cells) and compress well: 64 MB of them are a million rows, in one task for minutes.
PREFERRED_CONF = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(4 << 20)}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "footmark") -> SparkSession:
    """Build (or reuse) a session with the settings the library expects.

    A master or driver memory that spark-submit or the environment has set is left alone; without
    any, the session is local.
    """
    given = SparkConf()
    master = master or os.environ.get("FOOTMARK_MASTER") or given.get("spark.master", None)
    builder = SparkSession.builder.master(master or "local[*]").appName(app_name)
    builder = builder.config("spark.ui.enabled", "false")
    builder = builder.config("spark.sql.session.timeZone", "UTC")
    if (master or "local").startswith("local[") and not given.contains("spark.driver.memory"):
        builder = builder.config("spark.driver.memory", os.environ.get("FOOTMARK_DRIVER_MEMORY", "16g"))
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prefer_small_tasks(configure(spark))


def prefer_small_tasks(spark: SparkSession) -> SparkSession:
    """Apply ``PREFERRED_CONF`` where neither the cluster nor the session has set a value."""
    for k, v in PREFERRED_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


#: A stage after a shuffle starts with this many partitions; adaptive execution joins small ones.
PARTITIONS_CONF = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_GIVEN: dict = {}


def prefer_partitions(spark: SparkSession, n: int) -> SparkSession:
    """Shuffle into at least ``n`` partitions, unless the session has set how many it starts with.

    A fixed number of partitions makes each of them, and the memory that a task sorts or groups in,
    grow with the input."""
    now = spark.conf.get(PARTITIONS_CONF, None)
    if now is None or now == _GIVEN.get(spark.sparkContext.applicationId):
        now = str(max(n, int(spark.conf.get("spark.sql.shuffle.partitions"))))
        spark.conf.set(PARTITIONS_CONF, now)
        _GIVEN[spark.sparkContext.applicationId] = now
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library needs to an existing session."""
    for k, v in REQUIRED_CONF.items():
        try:
            spark.conf.set(k, v)
        except AnalysisException:  # static conf on a running session; leave it
            pass
    try:
        spark.sparkContext
    except (PySparkAttributeError, PySparkNotImplementedError):  # Spark Connect
        return spark
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in Python workers (``addPyFile`` of a zip).

    UDFs pickle references to this package's modules, so executors need it on
    their path; on a cluster this is what ``--py-files`` would do.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="footmark-pkg-"), "footmark.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(key)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is. Only a local session (tests) that has none gets a scratch folder;
    on a cluster executors could not share it, so there it is an error.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="footmark-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d
