"""Columns that say where and when a streamed row came in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.functions.labels import hour_in_path


INGEST_COLUMNS = {
    "_ingest_timestamp": "timestamp",
    "_source_file": "string",
    "_kafka_offset_sim": "long",
    "_batch_hour": "int",
}


def with_ingest_columns(files: DataFrame) -> DataFrame:
    """Add INGEST_COLUMNS to a file scan.

    ``_kafka_offset_sim`` is the row's position in its file. Together with
    ``_source_file`` it identifies a row, and a replayed micro-batch gives it the same
    value again. Generated ids would repeat between micro-batches.
    """
    path = F.col("_metadata.file_path")
    return files.withColumns(
        {
            "_ingest_timestamp": F.current_timestamp(),
            "_source_file": path,
            "_kafka_offset_sim": F.col("_metadata.row_index"),
            "_batch_hour": hour_in_path(path),
        }
    )
