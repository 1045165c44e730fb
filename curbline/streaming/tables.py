"""Tables as stream sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_folder(spark: SparkSession, table: str) -> str:
    """Where Spark puts the managed table ``table``."""
    database, _, name = table.rpartition(".")
    database = database or spark.catalog.currentDatabase()
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name.lower()}"


def checkpoint_of(spark: SparkSession, table: str) -> str:
    """The checkpoint of the stream that fills ``table``, where none is given."""
    return f"{table_folder(spark, table)}/_checkpoint"


def drain_to_table(
    stream: DataFrame,
    table: str,
    table_format: str = "parquet",
    checkpoint: str | None = None,
    timeout_seconds: int | None = None,
) -> None:
    """Append everything available to ``table``, then stop.

    The checkpoint lives inside the managed table's folder unless given, so dropping the
    table drops the checkpoint: neither can outlive the other and lose or repeat rows.
    A failed query raises here.
    """
    spark = stream.sparkSession
    query = (
        stream.writeStream.format(table_format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint or checkpoint_of(spark, table))
        .trigger(availableNow=True)
        .toTable(table)
    )
    if timeout_seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_seconds):
        query.stop()
        raise TimeoutError(f"{table}: stream still running after {timeout_seconds} s")
