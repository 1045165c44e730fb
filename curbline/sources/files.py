"""Batch and stream scans of files."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.schema import TRIP_COLUMNS, conform, struct_of
from curbline.session import keep
from curbline.storage import in_task

# A file stream skips files that are older than this, against the newest it has seen. Its own
# limit of a week would lose late backfills without an error.
NEVER_TOO_OLD = "36500d"


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """Trip files in whatever types they were written with, cast to the trip schema.

    Months differ: counts are integers or doubles, times have a zone or not, columns are
    missing. Spark merges the schemas of a folder in tasks. Where two types of a column can't
    be merged, folders are scanned in groups of one layout.
    """
    try:
        return conform(spark.read.option("mergeSchema", True).parquet(path))
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE_SCHEMAS" not in _conditions(error):
            raise
    return reduce(DataFrame.unionByName, map(conform, scans_by_layout(spark, path)))


def _conditions(error: PySparkException | Py4JJavaError) -> list[str]:
    """The names of an error's condition and of its causes'."""
    if isinstance(error, PySparkException):
        own = error.getCondition() or ""
        return [own, own.partition(".")[2], *_conditions_of(getattr(error, "_origin", None))]
    return _conditions_of(error.java_exception)


def _conditions_of(thrown) -> list[str]:
    found = []
    while thrown is not None:
        if hasattr(thrown, "getCondition"):
            try:
                found.append(str(thrown.getCondition()).partition(".")[0])
            except Py4JJavaError:  # not one of Spark's
                pass
        thrown = thrown.getCause()
    return found


def layouts(spark: SparkSession, path: str) -> DataFrame:
    """layout and path of every Parquet file below ``path``. Tasks read the footers; files are alike
    in layout when their columns have the same names and stored types. A file in a store that tasks
    can't reach on their own is a layout by itself."""

    def read(batches):
        for rows in batches:
            names = rows.column("path").to_pylist()
            yield pa.RecordBatch.from_pydict(
                {"layout": pa.array([_layout(name) for name in names]), "path": rows.column("path")}
            )

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    # Spark's rule: names that begin with a dot or an underscore are not data.
    data = files.select("path").where(~F.regexp_extract("path", "([^/]*)$", 1).rlike("^[_.]"))
    return data.mapInArrow(read, "layout string, path string")


def _layout(path: str) -> str:
    try:
        system, at = in_task(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return path
    with system.open_input_file(at) as opened:
        shown = str(pq.read_metadata(opened).schema)
    return shown.partition("\n")[2]  # without the line that names the object


def scans_by_layout(spark: SparkSession, path: str) -> list[DataFrame]:
    """A scan for each layout. The driver sees the folders, not the files, but where a folder mixes
    layouts or has more folders below it; and one footer for each layout."""
    files = layouts(spark, path).withColumn("folder", F.regexp_replace("path", "/[^/]*$", ""))
    files = keep(files, "layouts")
    folders = files.groupBy("folder").agg(F.count_distinct("layout").alias("n"))
    steps = F.split("folder", "/")
    above = F.transform(
        F.sequence(F.lit(1), F.size(steps) - 1), lambda n: F.array_join(F.slice(steps, 1, n), "/")
    )
    nested = folders.select(F.explode(above).alias("folder")).distinct()
    plain = folders.where("n = 1").join(nested, "folder", "left_anti").select("folder", F.lit(True).alias("plain"))
    scan = F.when(F.col("plain"), F.col("folder")).otherwise(F.col("path"))
    found = files.join(plain, "folder", "left").groupBy("layout", scan.alias("scan"))
    rows = found.agg(F.min("path").alias("one")).collect()
    schemas: dict[str, tuple] = {}
    scans: dict[str, list[str]] = {}
    for row in rows:
        if row["layout"] not in schemas:
            schema = spark.read.parquet(row["one"]).schema
            schemas[row["layout"]] = (schema.json(), schema)
        scans.setdefault(schemas[row["layout"]][0], []).append(row["scan"])
    by_text = dict(schemas.values())
    return [spark.read.schema(by_text[text]).parquet(*own) for text, own in sorted(scans.items())]


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """The zone CSV at ``path``, or the folder of the same name without ``.csv``.

    Only a missing path falls through to the folder. Columns are strings and are cast
    by name later, so the file is not scanned for types.
    """
    reader = spark.read.option("header", True)
    try:
        return reader.csv(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND" or not path.endswith(".csv"):
            raise
    return reader.csv(path.removesuffix(".csv"))


def file_stream(
    spark: SparkSession,
    path: str,
    columns: Mapping[str, str] = TRIP_COLUMNS,
    **options: str,
) -> DataFrame:
    """New Parquet files anywhere below ``path``, as a stream with a declared schema.

    Batches arrive in sub-folders, which a file stream reads only with recursive lookup.
    Files count as new however old they are. ``options`` are those of the file source, such
    as ``maxFilesPerTrigger``, or a lower ``maxFileAge`` where nothing is filled in late.
    """
    reader = spark.readStream.schema(struct_of(columns)).option("recursiveFileLookup", True)
    reader = reader.option("maxFileAge", NEVER_TOO_OLD)
    return reader.options(**options).parquet(path)


def table_stream(spark: SparkSession, table: str, **options: str) -> DataFrame:
    """New rows of a table as a stream, whatever the clocks say that wrote its files."""
    return spark.readStream.options(**{"maxFileAge": NEVER_TOO_OLD, **options}).table(table)
