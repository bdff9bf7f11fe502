"""Music-listening analytics on Spark: JSON logs to a star schema and reports."""

from playmart.plans.job import load_staging, load_targets, run_etl
from playmart.plans.reports import plays_by_hour, plays_by_level, users_by_gender
from playmart.sinks import Warehouse
from playmart.sources.json_trees import read_events, read_json_quarantine, read_path_list, read_songs
from playmart.streaming.arrivals import ArrivalStore, load_arrivals

__version__ = "0.1.0"

__all__ = [
    "ArrivalStore",
    "Warehouse",
    "load_arrivals",
    "load_staging",
    "load_targets",
    "plays_by_hour",
    "plays_by_level",
    "read_events",
    "read_json_quarantine",
    "read_path_list",
    "read_songs",
    "run_etl",
    "users_by_gender",
]
