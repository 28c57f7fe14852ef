"""tallyframe: Spark-native survey and free-text analytics.

Every operator is a ``DataFrame -> DataFrame`` function over long tables
(``(id, token)``, ``(id, feature, value)``, ``(token, label, theta)`` ...).
The driver only ever sees parameters of bounded size (class lists, class
counts, candidate grids); all row-sized work runs as Spark jobs.

Sub-packages
------------
sources    table loaders, fixture views, CSV/parquet readers and sinks
functions  column expressions (number parsing, tokens, hashing, ordinal maps)
operators  cleaning, profiling, text features, splits, models, searches
plans      the registered queries and their DuckDB oracle SQL
"""

from tallyframe.session import get_session, ensure_checkpoint_dir

__all__ = ["get_session", "ensure_checkpoint_dir"]
