"""A PySpark-native engine for catalogue snapshots and colour analytics."""

from tintloom.config import Collection, Settings, load_collection
from tintloom.functions.urls import HostPolicy
from tintloom.operators.runs import catalogue_tables, color_run, discover
from tintloom.plans.catalogue_run import run_catalogue
from tintloom.plans.colour_map import map_page, map_points
from tintloom.session import build_session, local_session

__all__ = ["Collection", "HostPolicy", "Settings", "build_session", "catalogue_tables", "color_run", "discover", "load_collection", "local_session", "map_page", "map_points", "run_catalogue"]
__version__ = "0.2.0"
