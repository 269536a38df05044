"""weektide: weekly surveillance analytics on Spark DataFrames."""

from weektide.api import (
    get_data,
    get_latest_week,
    list_diseases,
    list_prefectures,
    load,
    prefecture_map,
    read,
)
from weektide.model import COLS, Cols, observation_schema
from weektide.operators.combine import attach_prefecture_id, merge
from weektide.operators.reshape import pivot
from weektide.sources.catalog import Catalog

__all__ = [
    "COLS",
    "Catalog",
    "Cols",
    "attach_prefecture_id",
    "get_data",
    "get_latest_week",
    "list_diseases",
    "list_prefectures",
    "load",
    "merge",
    "observation_schema",
    "pivot",
    "prefecture_map",
    "read",
]
