"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that keep results deterministic and plans adaptive.  The JVM never compiles a method of over 8,000 bytes of byte code:
# a stage whose generated method is longer (records of many columns) would be interpreted row by row, so it runs operator by
# operator in small methods instead.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "feedloom", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("FEEDLOOM_DRIVER_MEMORY", "16g"))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is used as is.
    Only when it is unset on a local master (tests) a private folder is created; elsewhere that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="feedloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (never machine-local on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its (possibly remote) filesystem, via Hadoop's FileSystem API."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def arrow_uri(uri: str) -> str:
    """A path as Spark writes it, in the schemes that pyarrow knows (Hadoop's names for stores are mapped)."""
    if "://" not in uri:
        return "file://" + re.sub("^file:", "", uri)
    return re.sub(r"^(s3a|s3n)://", "s3://", re.sub(r"^wasbs?://|^abfss://", "abfs://", uri))


def open_output(uri: str):
    """Writable binary stream for ``uri`` on any filesystem pyarrow knows (local, s3, gs, hdfs, abfs).

    Used by per-partition helpers on executors that must write whole files (Stata, ZIP).
    """
    import pyarrow.fs as pafs
    fs, path = pafs.FileSystem.from_uri(arrow_uri(uri))
    parent = path.rsplit("/", 1)[0]
    if parent:
        fs.create_dir(parent, recursive=True)
    return fs.open_output_stream(path)


def cluster_conf(total_cores: int, input_tb: float = 100.0) -> dict[str, str]:
    """Settings for a large cluster run (pass as ``extra`` to ``build_session`` or spark-submit).

    Shuffle partitions start high (about 3 per core, at least one per ~2 GB of input) and AQE
    coalesces them to ~256 MB at runtime; skewed partitions are split; broadcast joins stay
    size-checked by the planner (64 MB measured size), never forced.
    """
    parts = max(total_cores * 3, int(input_tb * 1024 / 2))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.session.timeZone": "UTC",
        # Streaming dedup / state keys scale with the data: keep them in RocksDB, not the JVM heap.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
