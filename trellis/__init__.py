"""trellis: link graphs, matrices and file catalogs as Spark DataFrame jobs.

Every operator is a function from DataFrames (or Columns) to DataFrames (or
Columns).  The heavy lifting is left to Catalyst: joins, aggregations, windows
and Structured Streaming.  Python only drives iteration counts and picks a
join strategy from size checks.
"""

from trellis.session import build_session, shared_dir, ensure_checkpoint_dir

__all__ = ["build_session", "shared_dir", "ensure_checkpoint_dir"]
