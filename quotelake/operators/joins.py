"""Join helpers that keep broadcasts behind a size check.

A side is broadcast only when its size is known: either it is a literal
constant table, or it has been materialised with a reliable
``checkpoint()`` (in ``spark.checkpoint.dir``) and counted.  Beyond the
limit the join stays a shuffle join, where AQE can still split skewed
partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Rows a dimension side may hold and still be broadcast.
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, lineage cut (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fits(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (counts no further than that)."""
    return df.limit(max_rows + 1).count() <= max_rows


def materialize_small(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS):
    """Checkpoint ``df`` and return ``(df, fits)`` where ``fits`` means ≤ max_rows."""
    cp = checkpointed(df)
    return cp, fits(cp, max_rows)


def join_dimension(big: DataFrame, dim: DataFrame, on, how: str = "inner",
                   max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Join a large fact side to a dimension, broadcasting it only if it is small."""
    dim, fits = materialize_small(dim, max_rows)
    return big.join(F.broadcast(dim) if fits else dim, on, how)
