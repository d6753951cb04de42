"""Session helpers: the SQL settings the library relies on, and the shared
checkpoint folder.

The library never creates its own cluster settings for memory or cores; it
only sets SQL behaviour flags that change results (duplicate JSON keys) or
that it needs for skew handling (AQE).
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings the operators assume.
SQL_DEFAULTS = {
    # Python's json module keeps the last of duplicate keys; VARIANT parsing
    # only does so with this flag (otherwise the whole value is NULL).
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Runtime re-planning: size-checked broadcast conversion, partition
    # coalescing and splitting of skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows and bytes that a Python worker holds at once, whatever the size of its task:
    # by default 10,000 captions, which are whole texts here.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session."""
    for key, value in SQL_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "promolens", extra: dict | None = None) -> SparkSession:
    """Session for tests and the benchmark (no UI, small shuffle width)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        # many distinct query shapes per session: keep their compiled code
        .config("spark.sql.codegen.cache.maxEntries", "4000")
        # delete checkpoint files once their DataFrames are garbage collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in {**SQL_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be a shared file system folder set by the
    operator. Only when nothing is set (local tests) a fresh scratch folder
    is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="promolens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
