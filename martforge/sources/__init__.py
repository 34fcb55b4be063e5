"""Sources: the transactional relations the mart is built from."""

from martforge.sources.tables import SourceTables
from martforge.sources.fixture import fixture_sources, read_driver_table
from martforge.sources.calendar import calendar_days
from martforge.sources.jdbc import jdbc_sources, read_jdbc

__all__ = ["SourceTables", "fixture_sources", "read_driver_table", "calendar_days",
           "jdbc_sources", "read_jdbc"]
