"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import math
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

from saleslake.sources.files import qualified, temporary_folder

SHUFFLE_PARTITION_BYTES = 200 * 1024 * 1024
_PARTITIONS = "spark.sql.shuffle.partitions"
_RAISING = threading.Lock()


def build_session(
    app_name: str = "saleslake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the settings the jobs rely on; anything can be overridden by ``conf``."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions_for(input_bytes: int) -> int:
    """Shuffle partitions that keep one near 200 MB for this much file input.

    Shuffled rows are fewer columns than the files and compressed as well, so their
    size is taken to be that of the files.
    """
    return max(1, math.ceil(input_bytes / SHUFFLE_PARTITION_BYTES))


def fit_to_input(spark: SparkSession, input_bytes: int) -> None:
    """Raise the session's shuffle partitions to this much file input; never lower them.

    Adaptive execution merges partitions that turn out small but cannot split those of
    an ordinary aggregate, so the number has to start high enough. Jobs that run side
    by side share the session, so that comparing and setting is one step.
    """
    partitions = shuffle_partitions_for(input_bytes)
    with _RAISING:
        if partitions > int(spark.conf.get(_PARTITIONS)):
            spark.conf.set(_PARTITIONS, str(partitions))


def frame_bytes(frame: DataFrame) -> int:
    """The optimizer's size of a frame: file sizes after partition pruning."""
    return int(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcasts(frame: DataFrame) -> bool:
    """Whether the optimizer takes a frame to be small enough to be sent to every executor."""
    return frame_bytes(frame) <= frame.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def shared_by_executors(master: str, address: str) -> bool:
    """Whether a folder is certain to be one for all executors."""
    return not address.startswith("file:") or master == "local" or master.startswith("local[")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables, in the folder the cluster shares.

    It is removed when the application ends. The place is ``spark.checkpoint.dir``, or,
    where that is not set, a folder of the warehouse. On a cluster a warehouse in the local
    file system is refused, as executors may not share it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
        if not shared_by_executors(spark.sparkContext.master, qualified(spark, base)):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return temporary_folder(spark, f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}")


def write_out(frame: DataFrame, path: str) -> DataFrame:
    """Write a frame as Parquet and read it back.

    Cuts the lineage with files that outlive an executor, and gives the optimizer the
    true size of the result instead of an estimate, so that its own broadcast
    threshold is applied to a measured size.
    """
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
