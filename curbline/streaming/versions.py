"""Tables that are replaced as a whole while others read them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from curbline import storage
from curbline.streaming.tables import table_folder

# Versions that stay for readers that began before a replacement, the current one among them.
KEPT_VERSIONS = 3
VERSION = re.compile(r"version=(\d+)")


def versions_folder(spark: SparkSession, name: str) -> str:
    return f"{table_folder(spark, name)}.versions"


def publish(rows: DataFrame, name: str, kept: int = KEPT_VERSIONS) -> None:
    """Write ``rows`` to a new folder and point the view ``name`` at it.

    The view changes in one step: a query made before it reads the old files to its end, one made
    after it the new ones, and a job that fails leaves the view as it was. Older versions go when
    ``kept`` newer ones are there. A table of that name, from before there were versions, is dropped.
    """
    spark = rows.sparkSession
    folder = versions_folder(spark, name)
    found = versions(spark, name)
    number = max(found, default=0) + 1
    path = f"{folder}/version={number}"
    rows.write.mode("overwrite").parquet(path)
    if kind_of(spark, name) == "table":
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")
    for old in sorted([*found, number])[:-kept]:
        storage.remove(spark, f"{folder}/version={old}")


def versions(spark: SparkSession, name: str) -> list[int]:
    names = storage.names_in(spark, versions_folder(spark, name))
    return sorted(int(m[1]) for m in map(VERSION.fullmatch, names) if m)


def kind_of(spark: SparkSession, name: str) -> str | None:
    """``view``, ``table``, or None where there is neither."""
    if not spark.catalog.tableExists(name):
        return None
    return "view" if spark.catalog.getTable(name).tableType == "VIEW" else "table"


def drop(spark: SparkSession, name: str) -> None:
    """Drop a table, or a view with all its versions."""
    kind = kind_of(spark, name)
    if kind:
        spark.sql(f"DROP {kind.upper()} {name}")
    storage.remove(spark, versions_folder(spark, name))
