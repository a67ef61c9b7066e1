"""Files taken once: those of a source that no earlier run has read."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.names import literal_path
from tagloom.scratch import discard, staged

_LEDGER = "path string, modified timestamp, run_date date"


@dataclass(frozen=True)
class Taken:
    """Files a run reads, until they are remembered or released."""

    spark: SparkSession
    files: DataFrame
    folder: str
    ledger: str
    run_date: date

    @property
    def paths(self) -> list[str]:
        """Patterns for a reader that match exactly these files, in order."""
        return [literal_path(row.path) for row in self.files.select("path").orderBy("path").toLocalIterator()]

    def remember(self) -> None:
        """Enter the files into the ledger, once what was made of them is written.

        A run that breaks off before reads them again.
        """
        self.files.withColumn("run_date", F.lit(self.run_date)).coalesce(1).write.mode("append").parquet(self.ledger)
        self.release()

    def release(self) -> None:
        """Forget the listing."""
        discard(self.spark, self.folder)


def take_new_files(spark: SparkSession, paths: Sequence[str], ledger: str, run_date: date) -> Taken:
    """The files below ``paths`` (patterns) that are not in the table at ``ledger``.

    A file is known by its path and change time, so one that was written anew is taken again.
    Patterns that match nothing are passed over. The listing is made by Spark, reads no
    contents, and is kept as it is: files that come later are left to the next run.
    """
    there = [path for path in paths if _matches(spark, path)]
    listed = spark.createDataFrame([], "path string, modified timestamp")
    if there:
        # only the columns of the listing: contents are not opened
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(there)
        listed = found.select("path", F.col("modificationTime").alias("modified")).distinct()
    if _matches(spark, literal_path(ledger)):
        listed = listed.join(spark.read.schema(_LEDGER).parquet(ledger), ["path", "modified"], "left_anti")
    files, folder = staged(listed, "taken", with_path=True)
    return Taken(spark, files, folder, ledger, run_date)


def _matches(spark: SparkSession, pattern: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(path)
    return found is not None and len(found) > 0
