"""Table access for the TPC-H-like inputs.

Reads are lazy parquet scans, so Catalyst prunes columns and pushes filters
into the scan of whatever the caller finally selects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


class Tables:
    """Lazy accessor: ``t = Tables(spark, sf_dir); t.lineitem`` is a parquet scan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._scans: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        """One scan DataFrame per table and query: the file listing and
        footer schema read happen once on the driver, however many branches
        of the plan use the table (each branch still prunes its own
        columns)."""
        if name not in self._scans:
            self._scans[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._scans[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.read(name)
        raise AttributeError(name)


def ts_col(name: str):
    """Parquet timestamps here are zone-less (read as TIMESTAMP_NTZ); event-time
    operators and watermarks need TIMESTAMP, interpreted in the session zone."""
    return F.col(name).cast("timestamp")

