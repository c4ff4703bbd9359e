"""Lazy readers for the parquet tables of a scale-factor folder.

One ``Tables`` object per (session, folder): parquet relations and the
fixture views built on them are planned once and reused by every query,
the way a catalog view is registered once.  Only plans are shared, never
data: each query still reads its columns from the files.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

_LOCK = threading.Lock()


class Tables(dict):
    """``name -> DataFrame``; each parquet file is opened on first use only."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.views: dict[str, DataFrame] = {}

    def __missing__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise KeyError(name)
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        self[name] = df
        return df

    def view(self, name: str, build) -> DataFrame:
        """Memoised fixture view ``build(self)`` (a lazy plan, not data)."""
        if name not in self.views:
            self.views[name] = build(self)
        return self.views[name]


def load_tables(spark: SparkSession, sf_dir: str) -> Tables:
    key = sf_dir.rstrip("/")
    with _LOCK:
        # Kept on the session itself, so it goes with the session.
        per_session = spark.__dict__.setdefault("_groundstop_tables", {})
        if key not in per_session:
            per_session[key] = Tables(spark, key)
        return per_session[key]
