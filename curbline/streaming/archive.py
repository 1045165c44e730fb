"""Landing files that were taken move to an archive, so that a stream remembers recent ones only.

A file stream keeps the files that it has taken in memory, for as long as it would take a file of that
age: for ever, by default here. Where taken files leave the landing folder it can forget them
sooner. It then passes over files with old times, which late copies can have. They are found by
comparison with the log of what was taken, and given the present time, so that the next drain takes them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline import storage

REMEMBERED = "30d"


def archiving(archive: str, remembered: str = REMEMBERED) -> dict[str, str]:
    """Options of a file stream whose taken files move to ``archive``, below their own paths, when the
    batch after theirs begins. What is older than ``remembered``, against the newest, is forgotten."""
    return {"cleanSource": "archive", "sourceArchiveDir": archive, "maxFileAge": remembered}


def one_spelling(path: Column) -> Column:
    """Local paths are written with one slash after the scheme, or with three."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def taken_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """path and batch of every file that the first source of a stream has taken, from its log."""
    # A line for each file, and again in each file of the log that sums up earlier ones.
    entry = F.from_json("value", "path string, batchId long").alias("entry")
    log = spark.read.text(f"{checkpoint}/sources/0").where("value LIKE '{%'").select(entry)
    return log.groupBy(one_spelling(F.col("entry.path")).alias("path")).agg(
        F.max("entry.batchId").alias("batch")
    )


def passed_over(spark: SparkSession, landing: str, checkpoint: str) -> DataFrame:
    """path of the files in ``landing`` that the stream has not taken."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing)
    files = files.select(one_spelling(F.col("path")).alias("path"))
    files = files.where(~F.regexp_extract("path", "([^/]*)$", 1).rlike("^[_.]"))
    return files.join(taken_files(spark, checkpoint), "path", "left_anti")


def offer_again(spark: SparkSession, landing: str, checkpoint: str) -> int:
    """Give files that were passed over the present time; how many there were. They are few: the
    driver takes them one by one."""
    found = 0
    for row in passed_over(spark, landing, checkpoint).toLocalIterator():
        storage.touch(spark, row["path"])
        found += 1
    return found
