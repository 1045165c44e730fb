"""Session settings the jobs rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Hours and dates are taken in the session zone, so it is pinned. AQE sizes shuffle
# partitions at run time: `shuffle.partitions` is only where it starts. The JVM never
# compiles a method of more than 8000 bytecodes; a stage that would need one is split
# into smaller methods instead (2 s against 14 s for the widest test projection). Times
# stored as INT96, the default, carry no statistics, and a day filter could skip nothing.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

_local_folders: dict[str, str] = {}


def build_session(app_name: str = "curbline", **extra: str) -> SparkSession:
    """A session with SETTINGS; ``extra`` keys use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """SETTINGS on a session that somebody else built.

    They stay: results are lazy, so there is no point at which they could be put back.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; it gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="curbline-")
    return _local_folders[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_folder(spark)}/curbline/{name}-{uuid.uuid4().hex}"


def keep(rows: DataFrame, name: str) -> DataFrame:
    """Write ``rows`` to the shared folder once and read them back.

    For results that several later steps read: the steps then share one computation
    and see the same values, and lost executors cost no rescan of the source.
    """
    spark = rows.sparkSession
    path = fresh_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
