"""Table readers.

Plain ``spark.read.parquet``: Catalyst prunes columns and pushes filters into
the scan, so readers never select or filter eagerly themselves.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, base: str, name: str, schema: StructType | None = None) -> DataFrame:
    """Read ``<base>/<name>.parquet`` (a file or a directory of parts)."""
    path = os.path.join(base, f"{name}.parquet")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)
