import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from weektide.model import observation_schema  # noqa: E402
from weektide.session import build_session  # noqa: E402
from weektide.sources.catalog import Catalog  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def _observation(area, year, week, count, category, condition, source, rate=None):
    """A row of the observation schema, dated on the Monday of its week."""
    return (area, year, week, dt.date.fromisocalendar(year, week, 1), float(count), category, condition, source, rate)


@pytest.fixture(scope="session")
def mini(spark, tmp_path_factory):
    """Small tables of every kind, as a catalog: weeks around the turn of the years 2016 and 2017."""
    root = tmp_path_factory.mktemp("mini")
    confirmed, all_case, sites = "Confirmed cases", "All-case reporting", "Sentinel surveillance"
    areas = ["Aichi", "Gifu", "Kagawa", "Nara"]
    split = {"total": 1.0, "male": 0.25, "female": 0.75}
    tables = {
        "sex_prefecture": [
            _observation(area, 2016, week, 8 * week * share, category, "Pertussis", confirmed)
            for area in areas[:2] for week in (50, 51) for category, share in split.items()
        ],
        "place_prefecture": [
            _observation("Nara", 2016, week, n, "japan", "Rubella", confirmed) for week, n in ((49, 3), (50, 0), (52, 11))
        ],
        "bullet": [
            _observation(area, 2017, week, week + 2 * k, "total", condition, all_case)
            for k, area in enumerate(areas) for week in (1, 2, 3) for condition in ("Pertussis", "Rubella")
        ],
        "sentinel": [
            _observation("Kagawa", 2017, week, 6 * week, None, "Herpangina", sites, 0.75 * week) for week in (1, 2, 4)
        ],
        "unified": [
            _observation("Aichi", 2016, 51, 408, "total", "Pertussis", confirmed),
            _observation("Gifu", 2016, 51, 17, "total", "Pertussis", confirmed),
            _observation("Nara", 2016, 52, 11, "total", "Rubella", confirmed),
            _observation("Aichi", 2017, 1, 1, "total", "Rubella", all_case),
            _observation("Aichi", 2017, 2, 2, "total", "Pertussis", all_case),
            _observation("Kagawa", 2017, 2, 6, "total", "Pertussis", all_case),
            _observation("Kagawa", 2017, 4, 24, "total", "Herpangina", sites, 3.0),
        ],
    }
    for name, rows in tables.items():
        spark.createDataFrame(rows, observation_schema()).coalesce(1).write.parquet(str(root / f"{name}.parquet"))
    spark.createDataFrame([(a,) for a in areas], "prefecture string").coalesce(1).write.parquet(str(root / "prefecture_en.parquet"))
    return Catalog(spark, str(root))
