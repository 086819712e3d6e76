from .csv import MARKET_SCHEMA, input_files, read_market_csv, rows_per_file, stream_market_csv, write_market_csv
from .market import market, table

__all__ = [
    "MARKET_SCHEMA",
    "input_files",
    "rows_per_file",
    "market",
    "read_market_csv",
    "stream_market_csv",
    "table",
    "write_market_csv",
]
