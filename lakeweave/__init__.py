"""lakeweave: versioned Parquet tables and medallion pipelines on stock PySpark.

Every operator takes and returns DataFrames; the heavy lifting is left to
Catalyst (pushdown, pruning, partial aggregation, AQE).
"""

from lakeweave.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
