from ledgerlake.sources.binding import bank_tables, register_bank_views  # noqa: F401
from ledgerlake.sources.csv_landing import csv_headers, scan_csv_by_name  # noqa: F401
from ledgerlake.sources.tables import scan_partitioned_parquet, scan_table  # noqa: F401
