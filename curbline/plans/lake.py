"""A database with the four tables, and the stages that fill them in order."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.operators.zones import zone_dimension
from curbline.plans import bronze, gold, replay, reports, silver
from curbline.schema import PICKUP, TRIP_COLUMNS
from curbline.sources.files import read_trips, read_zone_lookup, table_stream
from curbline.streaming import versions, windows
from curbline.streaming.archive import archiving, offer_again
from curbline.streaming.segments import Segments
from curbline.streaming.tables import checkpoint_of, drain_to_table, table_folder


@dataclass(frozen=True)
class Lake:
    """Names and paths of one installation. ``landing`` and the database lie on storage
    that every executor reaches. ``source_options`` limit what one micro-batch of the
    bronze and silver streams takes, as in ``{"maxFilesPerTrigger": "10000"}``.
    ``file_columns`` are the types of landing files that others wrote. Landing files that were taken
    move to ``archive``, if it is given, and the bronze stream forgets them after a while."""

    spark: SparkSession
    database: str
    landing: str
    table_format: str = "parquet"
    source_options: Mapping[str, str] = field(default_factory=dict)
    file_columns: Mapping[str, str] = field(default_factory=lambda: dict(TRIP_COLUMNS))
    archive: str | None = None

    @property
    def bronze(self) -> str:
        return f"{self.database}.bronze_trips"

    @property
    def silver(self) -> str:
        return f"{self.database}.silver_trips"

    @property
    def closed_windows(self) -> str:
        return f"{self.database}.trip_windows"

    @property
    def gold_totals(self) -> Segments:
        return gold.silver_totals(self.spark, table_folder(self.spark, f"{self.database}.gold_totals"))

    @property
    def gold_zones(self) -> str:
        return f"{self.database}.gold_zone_kpis"

    @property
    def gold_hours(self) -> str:
        return f"{self.database}.gold_hourly_kpis"

    def create(self, location: str | None = None) -> None:
        """Create the database if it is missing."""
        where = f" LOCATION '{location}'" if location else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}{where}")

    def use(self) -> None:
        self.spark.catalog.setCurrentDatabase(self.database)

    def reset(self, first: str | None = None) -> None:
        """Drop ``first`` and every table after it, with their checkpoints.

        A checkpoint counts the files of the table before it, so a table is never
        dropped without those that stream from it. All of them go by default. The totals
        of silver go with any of them.
        """
        tables = [self.bronze, self.silver, self.closed_windows, self.gold_zones, self.gold_hours]
        for table in tables[tables.index(first) if first else 0 :]:
            versions.drop(self.spark, table)
        self.gold_totals.drop()

    def land(self, trips_path: str, day: date, replace: bool = False) -> DataFrame:
        """Publish a day's hourly batches and return their counts. A day that has landed is refused;
        ``replace`` it only after a reset, or its trips are taken twice. A landing that broke off is
        simply repeated."""
        trips = read_trips(self.spark, trips_path)
        replay.write_hour_batches(trips, day, self.landing, replace)
        return replay.hour_batch_counts(self.spark, replay.day_folder(self.landing, day))

    def fill_bronze(self) -> None:
        """Take new landing files. With an archive, files whose times made the stream pass them over are
        offered again and taken as well."""
        archived = archiving(self.archive) if self.archive else {}
        drain = partial(
            bronze.ingest,
            self.spark,
            self.landing,
            self.bronze,
            file_columns=self.file_columns,
            source_options={**archived, **self.source_options},
            table_format=self.table_format,
        )
        drain()
        if self.archive and offer_again(self.spark, self.landing, checkpoint_of(self.spark, self.bronze)):
            drain()

    def fill_silver(self) -> None:
        silver.refine_table(
            self.spark,
            self.bronze,
            self.silver,
            source_options=self.source_options,
            table_format=self.table_format,
        )

    def fill_windows(self) -> None:
        """Take new silver rows into hourly event-time windows; those that close are emitted."""
        stream = table_stream(self.spark, self.silver, **self.source_options)
        drain_to_table(windows.trip_windows(stream), self.closed_windows)

    def windows(self) -> DataFrame:
        """The KPIs of every window, ``is_open`` where rows in time can still change them."""
        spark, closed = self.spark, self.spark.table(self.closed_windows)
        opened = windows.open_trip_windows(spark, checkpoint_of(spark, self.closed_windows))
        return closed.withColumn("is_open", F.lit(False)).unionByName(
            opened.withColumn("is_open", F.lit(True))
        )

    def late_trips(self) -> DataFrame:
        """Silver rows that came too late for their window, which are in all other tables."""
        checkpoint = checkpoint_of(self.spark, self.closed_windows)
        return windows.late_rows(self.spark.table(self.silver), checkpoint, PICKUP)

    def fill_gold(self, zones: DataFrame) -> None:
        """Add the totals of new silver rows, and replace both gold tables from all totals."""
        self.gold_totals.drain(table_stream(self.spark, self.silver, **self.source_options))
        totals = self.gold_totals.read()
        gold.replace_table(gold.zone_kpis(totals, zones), self.gold_zones, self.table_format)
        gold.replace_table(gold.hourly_kpis(totals), self.gold_hours, self.table_format)

    def fill_gold_from_csv(self, zones_path: str) -> None:
        self.fill_gold(zone_dimension(read_zone_lookup(self.spark, zones_path)))

    def report(self) -> DataFrame:
        names = (self.bronze, self.silver, self.gold_zones, self.gold_hours)
        return reports.run_report(*map(self.spark.table, names))
