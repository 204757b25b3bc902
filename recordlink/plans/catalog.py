"""Named tables: the driver's parquet tables under one directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


_SCANS: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str, refresh: bool = False) -> DataFrame:
    """Lazy scan of one table. The scan (file listing + footer schema) is built
    once per session and path; ``refresh`` re-lists the files."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), spark.sparkContext.applicationId, path)
    if refresh or key not in _SCANS:
        _SCANS[key] = spark.read.parquet(path)
    return _SCANS[key]


class Catalog:
    """``cat.orders`` etc.; every access is a lazy parquet scan (pruned by Catalyst)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return table(self.spark, self.sf_dir, name)
        raise AttributeError(name)

    def register_views(self) -> None:
        for t in TABLES:
            table(self.spark, self.sf_dir, t).createOrReplaceTempView(t)
