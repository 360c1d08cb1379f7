"""Access to the source tables of a scale-factor folder.

Each table is one parquet file ``<sf_dir>/<name>.parquet``.  Reads are lazy, so
Catalyst prunes columns and pushes filters into every scan built from here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ORDER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy handle over the tables of one folder: ``t.orders``, ``t.lineitem``..."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in ORDER_TABLES:
            raise AttributeError(name)
        return table(self.spark, self.sf_dir, name)

    def register_views(self) -> None:
        """Temp views with the source names, for the SQL dashboard texts."""
        for name in ORDER_TABLES:
            table(self.spark, self.sf_dir, name).createOrReplaceTempView(name)
