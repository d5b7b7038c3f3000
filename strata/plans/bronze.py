"""Bronze: landing rows as they arrived, plus the load timestamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import clean_column_names
from ..sources.landing import Landing

BRONZE_NAMES = {
    "class": "brz_pr_class", "duration": "brz_pr_duration", "measure": "brz_pr_measure",
    "sector": "brz_pr_sector", "footnote": "brz_pr_footnote", "period": "brz_pr_period",
    "seasonal": "brz_pr_seasonal", "series": "brz_pr_series",
    "data_0_current": "brz_pr_data_0_current", "data_1_alldata": "brz_pr_data_1_alldata",
}


def audit(df: DataFrame, load_ts: Column | None = None) -> DataFrame:
    ts = load_ts if load_ts is not None else F.current_timestamp()
    return clean_column_names(df.withColumn("load_timestamp", ts))


_LANDING_ATTR = {"class": "class_", "data_0_current": "data_current", "data_1_alldata": "data_alldata"}


class BronzeTables(dict):
    """Bronze tables by name, each built on first access."""

    def __init__(self, landing: Landing, load_ts: Column | None = None):
        super().__init__()
        self._landing, self._load_ts = landing, load_ts
        self._by_name = {v: k for k, v in BRONZE_NAMES.items()}

    def __missing__(self, name: str) -> DataFrame:
        key = self._by_name[name]
        df = audit(getattr(self._landing, _LANDING_ATTR.get(key, key)), self._load_ts)
        self[name] = df
        return df

    def names(self) -> list[str]:
        return list(BRONZE_NAMES.values())


def bronze_tables(landing: Landing, load_ts: Column | None = None) -> BronzeTables:
    return BronzeTables(landing, load_ts)
