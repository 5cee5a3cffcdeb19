"""Readers: Parquet tables with column pruning left to Catalyst, and the
stand-in mapping from the driver's test tables to chain-shaped inputs."""

from poolbook.sources.tables import read_table

__all__ = ["read_table"]
