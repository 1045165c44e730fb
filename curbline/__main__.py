"""Run the stages from the command line, for example with ``spark-submit``."""

from __future__ import annotations

import argparse
from datetime import date

from curbline.plans.lake import Lake
from curbline.schema import TRIP_COLUMNS
from curbline.session import build_session

STAGES = ["land", "bronze", "silver", "gold", "report"]
# Not among those that run by default.
MORE_STAGES = ["windows"]


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="curbline", description=__doc__)
    parser.add_argument(
        "stages", nargs="*", metavar="stage", help=f"any of {', '.join(STAGES + MORE_STAGES)}; by default all but windows"
    )
    parser.add_argument("--database", default="trips")
    parser.add_argument("--database-location")
    parser.add_argument("--landing", required=True, help="folder of the hourly batches")
    parser.add_argument("--trips", help="trip files, for the land stage")
    parser.add_argument("--day", type=date.fromisoformat, default=date(2024, 1, 1))
    parser.add_argument("--zones", help="zone lookup CSV, for the gold stage")
    parser.add_argument("--format", default="parquet", dest="table_format")
    parser.add_argument("--max-files-per-trigger", type=int)
    parser.add_argument("--archive", help="folder that landing files move to once they are taken")
    parser.add_argument(
        "--file-type",
        action="append",
        default=[],
        metavar="COLUMN=TYPE",
        help="the type that landing files of others have for a column",
    )
    parser.add_argument(
        "--reset",
        action="store_true",
        help="first drop the tables that the stages fill, and those after them; "
        "the land stage then replaces a day that has landed",
    )
    options = parser.parse_args(argv)
    options.stages = options.stages or STAGES
    unknown = set(options.stages) - set(STAGES + MORE_STAGES)
    if unknown:
        parser.error(f"unknown stages: {', '.join(sorted(unknown))}")
    if "land" in options.stages and not options.trips:
        parser.error("the land stage needs --trips")
    if "gold" in options.stages and not options.zones:
        parser.error("the gold stage needs --zones")
    return options


def main(argv: list[str] | None = None) -> None:
    options = parse(argv)
    limit = options.max_files_per_trigger
    lake = Lake(
        build_session(),
        options.database,
        options.landing,
        table_format=options.table_format,
        source_options={"maxFilesPerTrigger": str(limit)} if limit else {},
        file_columns=TRIP_COLUMNS | dict(pair.split("=", 1) for pair in options.file_type),
        archive=options.archive,
    )
    lake.create(options.database_location)
    lake.use()
    if options.reset:
        # New files for a day that the tables hold would double it.
        first = {
            "land": lake.bronze,
            "bronze": lake.bronze,
            "silver": lake.silver,
            "gold": lake.gold_zones,
        }
        refilled = [first[stage] for stage in STAGES if stage in options.stages and stage in first]
        if refilled:
            lake.reset(refilled[0])
    for stage in (stage for stage in STAGES + MORE_STAGES if stage in options.stages):
        if stage == "land":
            lake.land(options.trips, options.day, replace=options.reset).show(30)
        elif stage == "bronze":
            lake.fill_bronze()
        elif stage == "silver":
            lake.fill_silver()
        elif stage == "gold":
            lake.fill_gold_from_csv(options.zones)
        elif stage == "windows":
            lake.fill_windows()
            lake.windows().orderBy("window_start").show(100)
        else:
            lake.report().show(truncate=False, vertical=True)


if __name__ == "__main__":
    main()
