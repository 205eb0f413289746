"""New files of a dated landing folder, each loaded once.

The stream carries the names of files alone. What a piece names is compared with the files that
bronze holds and then read once, as a batch. The stream's checkpoint spares the comparison of old
names; what counts as loaded is told by bronze, so a lost checkpoint loses and repeats nothing,
and files whose batch was taken back are loaded again.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from saleslake.plans.lake import Lake, load_files
from saleslake.sinks import bronze
from saleslake.sources.landing import FILE_COLUMNS, described, manifest

MAX_FILES = 100_000


def landing_stream(lake: Lake, root: str, max_files: int) -> DataFrame:
    """Names, arrival times and sizes of new landing files; no contents."""
    files = (
        lake.spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        # No file is too old, seen from the newest one: a century stands for no limit.
        .option("maxFileAge", "36500d")
        .load(root)
    )
    return described(files).select(*FILE_COLUMNS)


def pick_up(
    lake: Lake, feed: str, root: str, run_ts: datetime, max_files: int = 10_000
) -> None:
    """Append all files that arrived since the last call, then stop.

    Also loaded are files that were taken back (undone, purged, or of a run that died) and are
    still there as they were. Pieces have at most ``max_files`` files, whose names pass the
    driver. A file that is gone before it was read is an error.
    """
    if not 0 < max_files <= MAX_FILES:
        raise ValueError(f"max_files must be 1 to {MAX_FILES}")
    back = bronze.files_taken_back(lake.spark, lake.table("bronze", feed))
    if back is not None:
        listed = manifest(lake.spark, root, suffix=None)
        again = listed.join(back, ["source_file", "received_at"], "left_semi")
        load_files(lake, again, feed, run_ts, max_files=max_files)

    def append(piece: DataFrame, number: int) -> None:
        load_files(lake, piece, feed, run_ts)

    (
        landing_stream(lake, root, max_files)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", lake.path("checkpoints", feed))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
