"""poolbook: daily pool-liquidity analytics as Spark DataFrame operators.

Sub-packages:
  functions  -- column expressions (day truncation, decimal scaling, labels, ordering keys)
  sources    -- table readers and the stand-in mapping from the driver's test tables
  operators  -- the composite operators (forward-fill, running balance, valuation, sinks)
  plans      -- configured jobs built from the operators, and the query catalog
  streaming  -- incremental refresh: windowed backfill and high-water-mark refresh
"""

from poolbook.session import build_session, checkpoint, checkpoint_dir

__all__ = ["build_session", "checkpoint", "checkpoint_dir"]
