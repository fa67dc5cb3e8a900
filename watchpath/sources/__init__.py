"""Table access: the two source tables and the attributed store."""

from watchpath.sources.standin import StandInTables
from watchpath.sources.store import load_attributed, save_attributed, vacuum
from watchpath.sources.tables import LakeTables, Tables

__all__ = ["LakeTables", "StandInTables", "Tables", "load_attributed", "save_attributed", "vacuum"]
