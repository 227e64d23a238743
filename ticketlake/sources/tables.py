"""Lazy access to a folder of parquet tables and to the bronze shapes derived from them."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticketlake.sources.adapters import BRONZE

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
#: Bytes of a text table's files that make one partition.
PART_BYTES = 16 << 20
TEXTS = ("documents", "pages", "conversations")


class Tables:
    """``Tables(spark, folder).orders`` is a lazy parquet scan; ``.bronze("glpi_tickets")`` a bronze shape."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in NAMES:
            raise AttributeError(name)
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name in TEXTS and len(df.inputFiles()) < self.spark.sparkContext.defaultParallelism:
            # fewer files than cores: text work is CPU-bound, so spread the rows first, in partitions that do not grow with the table
            size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
            return df.repartition(max(self.spark.sparkContext.defaultParallelism, -(-size // PART_BYTES)))
        return df

    def bronze(self, name: str) -> DataFrame:
        sql, needs = BRONZE[name]
        return self.spark.sql(sql, **{n: getattr(self, n) for n in needs})
