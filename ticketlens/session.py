"""Session helpers: one place for the settings every plan relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job sets for itself; everything else is left to the cluster.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "ticketlens") -> SparkSession:
    """A local session for tests and benches (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.ansi.enabled", "true")
    )
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Turn on AQE / skew handling on a session someone else built."""
    for key, value in _DEFAULTS.items():
        try:
            spark.conf.set(key, value)
        except Exception:  # static or locked settings stay as the cluster set them
            pass


#: Bytes of text that one task takes, and of shuffled rows that one task reads.
TEXT_BYTES = 4 << 20
READ_BYTES = 8 << 20
#: Bytes of rows that a task hands to Python at once.
BATCH_BYTES = 8 << 20


def size_shuffles(spark: SparkSession, text_bytes: int) -> None:
    """Let AQE cut exchanges into pieces of a size that does not grow with the text.

    A text makes thirty times its size in counted terms: with a fixed number of
    partitions, or pieces of the default 64 MB, a task's hash maps and sorts outgrow it.
    """
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-text_bytes // TEXT_BYTES))
    settings = {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(most),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{READ_BYTES}b",
        # 10,000 rows of counts may be 100 MB and more, held by the JVM and by Python at once
        "spark.sql.execution.arrow.maxBytesPerBatch": f"{BATCH_BYTES}b",
    }
    for key, value in settings.items():
        try:
            spark.conf.set(key, value)
        except Exception:  # a locked setting stays as the cluster set it
            pass


def text_partitions(spark: SparkSession, text_bytes: int) -> int:
    """Partitions of an exchange of texts whose terms are counted right after it."""
    return max(spark.sparkContext.defaultParallelism, -(-text_bytes // TEXT_BYTES))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is. Only a local session may leave it unset and gets a folder under the
    system temporary directory; a cluster's machines do not share that one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        if not current:
            current = tempfile.mkdtemp(prefix="ticketlens-ckpt-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
