"""Few large files for the closed days of a landing folder.

A day is closed when all files of it are of finished writers: batch jobs and compactions that succeeded, and micro-batches
that have a report. A micro-batch without one may come again and would replace its folder, so days that hold rows of it
stay as they are, as do those of streams whose checkpoints are not given.

The small files of each hour are gathered up to a target size and rewritten by Spark into a hidden folder. When that is
complete, the old files are removed and the folder becomes a writer's folder. Whoever reads these days in this moment may
miss rows. Broken off at any point, the next call first finishes or clears what is there. One compaction at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telemill.plans.logtype import PARTITIONS, LogType, resolve
from telemill.session import reliable
from telemill.sinks.files import WRITER, stream_writer
from telemill.sinks.landing import LAYOUT, _read

DAY = PARTITIONS[:-1]
TARGET_BYTES = 128 << 20
STAGED, SOURCES = "_compact-", ".sources"


class _Folder:
    """The file system's side: names of folders, marks of success, removing and renaming."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path.rstrip("/")
        self.fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, place: str):
        return self.jvm.org.apache.hadoop.fs.Path(place)

    def names(self, pattern: str) -> list[str]:
        """The last parts of the folders or files that match, at any depth of the pattern its first one."""
        found = self.fs.globStatus(self._path(f"{self.path}/{pattern}")) or []
        return [f.getPath().getParent().getName() if "/" in pattern else f.getPath().getName() for f in found]

    def remove(self, name: str) -> None:
        self.fs.delete(self._path(f"{self.path}/{name}"), True)

    def remove_file(self, uri: str) -> None:
        self.fs.delete(self.jvm.org.apache.hadoop.fs.Path(self.jvm.java.net.URI(uri)), False)

    def rename(self, old: str, new: str) -> None:
        if not self.fs.rename(self._path(f"{self.path}/{old}"), self._path(f"{self.path}/{new}")):
            raise OSError(f"cannot rename {old} in {self.path}")


def finish_compaction(spark: SparkSession, path: str) -> None:
    """Complete a compaction that broke off after its files were written, or clear one that broke off before."""
    folder = _Folder(spark, path)
    complete = set(folder.names(f"{STAGED}*/_SUCCESS"))
    for name in folder.names(f"{STAGED}*"):
        if name.endswith(SOURCES):
            continue
        if name in complete:
            for row in spark.read.schema("value string").text(f"{path}/{name}{SOURCES}").toLocalIterator():
                folder.remove_file(row.value)
            folder.rename(name, f"{WRITER}=compact-{name.removeprefix(STAGED)}")
        else:
            folder.remove(name)
    for name in folder.names(f"{STAGED}*{SOURCES}"):
        folder.remove(name)


def _finished(spark: SparkSession, path: str, checkpoints: Iterable[str]) -> DataFrame:
    """The writers that will not write again."""
    from telemill.streaming.jobs import read_reports

    marked = spark.createDataFrame([(n.partition("=")[2],) for n in _Folder(spark, path).names(f"{WRITER}=*/_SUCCESS")], "writer string")
    finished = marked.where("writer not like 'stream-%'")
    for checkpoint in checkpoints:
        name = F.concat(F.lit(f"{stream_writer(spark, checkpoint)}-"), F.lpad(F.col("batch_id").cast("string"), 9, "0"))
        reported = read_reports(spark, checkpoint).select(name.alias("writer"))
        finished = finished.union(marked.join(reported, "writer", "left_semi"))
    return finished.distinct()


def compact_days(
    spark: SparkSession, path: str, log_type: str | LogType, checkpoints: Iterable[str] = (), target_bytes: int = TARGET_BYTES
) -> DataFrame:
    """Rewrite the closed days of a landing folder; returns a row for each day: its keys, `open`, `files` and `files_after`.

    checkpoints   of the streams that write to the folder
    target_bytes  files of an hour are gathered until they have so many bytes; hours that would not have fewer files stay
    """
    spec = resolve(log_type)
    finish_compaction(spark, path)
    rows = _read(spark, path, spec)
    place = F.col("_metadata.file_path").alias("_file")
    files = rows.select(place, F.col("_metadata.file_size").alias("_size"), WRITER, *LAYOUT)
    files = reliable(files.groupBy("_file", "_size", WRITER, *LAYOUT).agg(F.count(F.lit(1)).alias("_rows")))
    finished = _finished(spark, path, checkpoints).withColumn("_done", F.lit(True))
    day = Window.partitionBy(*DAY)  # files, not rows
    hour = Window.partitionBy(*LAYOUT)
    judged = files.join(finished, WRITER, "left").withColumn("open", F.max(F.col("_done").isNull()).over(day))
    before = hour.orderBy(F.desc("_size"), "_file").rowsBetween(Window.unboundedPreceding, -1)
    gathered = F.call_function("div", F.coalesce(F.sum("_size").over(before), F.lit(0)), F.lit(target_bytes))
    binned = judged.withColumn("_bin", gathered).withColumn("_bins", F.size(F.collect_set("_bin").over(hour)))
    binned = binned.withColumn("_moves", ~F.col("open") & (F.col("_bins") < F.count(F.lit(1)).over(hour)))
    binned = reliable(binned)
    moving = binned.where("_moves")
    slots = moving.select(*LAYOUT, "_bin").distinct().count()
    if slots:
        name = f"{STAGED}{uuid.uuid4().hex}"
        moving.select(F.col("_file").alias("value")).coalesce(1).write.text(f"{path}/{name}{SOURCES}")
        slot = F.dense_rank().over(Window.orderBy(*LAYOUT, "_bin")) - 1  # a row for each file
        chosen = moving.select("_file", slot.alias("_slot"))
        data = rows.withColumn("_file", F.col("_metadata.file_path")).join(chosen, "_file")
        data = data.repartitionById(slots, "_slot").drop("_file", "_slot", WRITER)
        data.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*LAYOUT).parquet(f"{path}/{name}")
        written = _read(spark, f"{path}/{name}", spec).count()
        expected = moving.agg(F.sum("_rows")).first()[0]
        if written != expected:
            _Folder(spark, path).remove(name)
            raise RuntimeError(f"{expected} rows were to be rewritten, {written} were; the files were changed meanwhile")
        finish_compaction(spark, path)
    per_hour = binned.groupBy(*DAY, "open", *[c for c in LAYOUT if c not in DAY]).agg(
        F.count(F.lit(1)).alias("files"), F.max(F.when(F.col("_moves"), F.col("_bins"))).alias("bins")
    )
    return per_hour.groupBy(*DAY, "open").agg(F.sum("files").alias("files"), F.sum(F.coalesce("bins", "files")).alias("files_after"))
