"""Sources: JDBC tables, delimited files, and the driver-table adapter."""

from regstar.sources import schemas
from regstar.sources.delimited import read_csv_with_header, read_delimited, read_tsv, write_delimited
from regstar.sources.driver_tables import Sources, driver_sources, load_tables
from regstar.sources.jdbc import jdbc_options, read_jdbc
from regstar.sources.layout import jdbc_and_file_sources
from regstar.sources.quarantine import Records, read_records

__all__ = [
    "Records",
    "Sources",
    "driver_sources",
    "jdbc_and_file_sources",
    "jdbc_options",
    "load_tables",
    "read_csv_with_header",
    "read_delimited",
    "read_jdbc",
    "read_records",
    "read_tsv",
    "schemas",
    "write_delimited",
]
