"""Where the input tables come from."""

from pairloom.sources.database import read_database, read_tables_database, write_database
from pairloom.sources.rejects import read_tables_dealt
from pairloom.sources.tables import Tables, read_tables, read_tables_jdbc

__all__ = ["Tables", "read_database", "read_tables", "read_tables_database", "read_tables_dealt", "read_tables_jdbc", "write_database"]
