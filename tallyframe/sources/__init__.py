"""Sources and sinks: driver tables, fixture views, CSV and parameter tables."""

from tallyframe.sources.tables import TABLES, table
from tallyframe.sources import views

__all__ = ["TABLES", "table", "views"]
