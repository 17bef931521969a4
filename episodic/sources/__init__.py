from episodic.sources.tables import TABLES, TableSpec, load, register_views, table
from episodic.sources.files import read_csv_worklist, write_csv_snapshot, read_or_empty

__all__ = ["TABLES", "TableSpec", "load", "register_views", "table",
           "read_csv_worklist", "write_csv_snapshot", "read_or_empty"]
