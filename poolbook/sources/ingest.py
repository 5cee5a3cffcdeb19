"""Ingest of on-chain amounts.

Token amounts are 256-bit integers (up to 78 digits); Spark's widest exact
type is DECIMAL(38,0).  Amounts are cast with ``try_cast`` and every row whose
non-NULL amount does not fit is tagged -- never silently turned into NULL.
One pass produces one frame with a ``quarantine_reason`` column (NULL for
clean rows), so a caller can write both outcomes in a single job, e.g.
``write.partitionBy("quarantined")``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tag_amounts(df: DataFrame, columns: list[str], precision: int = 38, scale: int = 0) -> DataFrame:
    """Cast ``columns`` to DECIMAL(precision, scale); add ``quarantine_reason``
    naming the columns that did not fit, and ``quarantined`` (boolean)."""
    target = f"decimal({precision},{scale})"
    casted = {c: F.col(c).try_cast(target) for c in columns}
    reasons = [F.when(F.col(c).isNotNull() & casted[c].isNull(), F.lit(f"{c} exceeds {target}")) for c in columns]
    reason = F.concat_ws("; ", *reasons)
    out = df.withColumn("quarantine_reason", F.when(reason != "", reason))
    # Keep the original text of quarantined amounts; cast the clean ones.
    for c in columns:
        out = out.withColumn(f"{c}_raw_text", F.when(F.col("quarantine_reason").isNotNull(), F.col(c).cast("string")))
        out = out.withColumn(c, casted[c])
    return out.withColumn("quarantined", F.col("quarantine_reason").isNotNull())


def split_amounts(df: DataFrame, columns: list[str], precision: int = 38, scale: int = 0) -> tuple[DataFrame, DataFrame]:
    """(clean rows, quarantined rows) -- two filters over ``tag_amounts``.
    Each is a separate scan when executed; prefer one partitioned write of
    ``tag_amounts`` for large inputs."""
    tagged = tag_amounts(df, columns, precision, scale)
    text_cols = [f"{c}_raw_text" for c in columns]
    clean = tagged.where(~F.col("quarantined")).drop("quarantine_reason", "quarantined", *text_cols)
    bad = tagged.where(F.col("quarantined")).drop("quarantined")
    return clean, bad
