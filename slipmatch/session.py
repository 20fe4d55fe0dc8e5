"""Sessions for local runs, and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


# Of the input, for a partition of its shuffles; what adaptive execution merges partitions up to.
PARTITION_BYTES, SHUFFLED_BYTES, MOST_PARTITIONS = 2 << 20, 8 << 20, 8192
# Of files, for a task that scans them. With many partitions a task holds all rows it writes to a
# shuffle, many times the compressed bytes it reads.
SCANNED_BYTES = 16 << 20
# Of files, for a table that may be broadcast unread, in jobs with an input beyond the second figure.
# Rows take many times the bytes of compressed files, and the driver holds all that it broadcasts.
BROADCAST_FILE_BYTES, BROADCAST_FREELY = 256 << 10, 64 << 20

# Folders made for local applications that name none.
_made: dict[str, str] = {}


def local_session(
    name: str = "slipmatch", cores: int | str = "*", partitions: int = 8, folder: str | None = None
) -> SparkSession:
    """A session for tests and benches; on a cluster the caller brings its own.

    ``folder`` is where tables that cut lineage are written.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if folder is not None:
        builder = builder.config("spark.checkpoint.dir", folder)
    return builder.getOrCreate()


def sized(spark: SparkSession, input_bytes: int) -> None:
    """Lets shuffles of a large input start from more partitions, and scans from smaller splits, so
    that what one task holds does not grow with the input; adaptive execution merges partitions
    that turn out small.

    What the driver holds is not to grow either: unless its files are very small, a table is broadcast
    only once adaptive execution knows the bytes of its rows. These meet the limit that held for files.
    """
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if input_bytes > BROADCAST_FREELY and limit > BROADCAST_FILE_BYTES:
        if spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) is None:
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(limit))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(BROADCAST_FILE_BYTES))
    wanted = min(input_bytes // PARTITION_BYTES, MOST_PARTITIONS)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(SHUFFLED_BYTES))
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(SCANNED_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder the session names for checkpoints; a temporary one in local mode only,
    where there is one machine, and the same for the whole application."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _made:
        _made[context.applicationId] = tempfile.mkdtemp(prefix="slipmatch-")
    return _made[context.applicationId]
