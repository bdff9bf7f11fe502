"""Command line: ``python -m playmart reset|load|arrivals|report``."""

from __future__ import annotations

import argparse

from playmart.plans import reports
from playmart.plans.job import run_etl
from playmart.session import submitted_session
from playmart.sinks import Warehouse
from playmart.sources.json_trees import read_path_list
from playmart.streaming.arrivals import ArrivalStore, load_arrivals


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="playmart", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name, text in [
        ("reset", "drop and create all tables"),
        ("load", "load staging and target tables"),
        ("arrivals", "load only newly arrived files"),
        ("report", "print the three usage reports"),
    ]:
        command = commands.add_parser(name, help=text)
        command.add_argument("--root", required=True, help="folder of the stored tables")
        command.add_argument("--database", default="playmart")
        command.add_argument("--numeric-mode", choices=["exact", "ddl"], default="exact")
        if name in ("load", "arrivals"):
            command.add_argument("--logs", required=True, help="folder of the activity logs")
            command.add_argument("--songs", required=True, help="folder of the song metadata")
            command.add_argument("--event-paths", help="mapping file of the event fields")
        if name == "load":
            command.add_argument("--mode", choices=["overwrite", "append"], default="overwrite")
            command.add_argument("--staging-mode", choices=["overwrite", "append"], default="overwrite")
        if name in ("load", "arrivals"):
            command.add_argument("--ignore-trailing-blanks", action="store_true", help="in artist names and titles")
            command.add_argument("--quarantine", help="folder for malformed records; without it they abort the load")
        if name == "arrivals":
            command.add_argument("--max-files", type=int, help="most files of one micro-batch")
        if name == "report":
            command.add_argument("--incremental", action="store_true", help="report on tables loaded by arrivals")
            command.add_argument("--out", help="folder to write the reports to as JSON, too")
    return parser.parse_args()


def _report(tables: Warehouse | ArrivalStore, out: str | None) -> None:
    """Print all rows of each report in full; their number is that of the groups."""
    plays = tables.table("songplays")
    results = {
        "plays_by_hour": reports.plays_by_hour(plays, tables.table("time")),
        "plays_by_level": reports.plays_by_level(plays),
        "users_by_gender": reports.users_by_gender(tables.table("users")),
    }
    for name, result in results.items():
        stored = result.persist()
        if out:
            stored.write.mode("overwrite").json(f"{out}/{name}")
        stored.show(max(1, stored.count()), truncate=False)
        stored.unpersist()


def main() -> None:
    args = _arguments()
    spark = submitted_session()
    warehouse = Warehouse(spark, args.root, args.database, args.numeric_mode)
    if args.command == "reset":
        warehouse.reset()
    elif args.command == "report":
        if args.incremental:
            _report(ArrivalStore(spark, args.root, args.numeric_mode), args.out)
        else:
            warehouse.create()
            _report(warehouse, args.out)
    else:
        paths = read_path_list(spark, args.event_paths) if args.event_paths else None
        if args.command == "load":
            run_etl(
                spark,
                args.logs,
                args.songs,
                args.root,
                args.database,
                paths,
                args.numeric_mode,
                args.mode,
                args.staging_mode,
                args.ignore_trailing_blanks,
                args.quarantine,
            )
        else:
            load_arrivals(
                spark,
                args.logs,
                args.songs,
                args.root,
                paths,
                args.numeric_mode,
                args.max_files,
                args.ignore_trailing_blanks,
                args.quarantine,
            )
    spark.stop()


if __name__ == "__main__":
    main()
