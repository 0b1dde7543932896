"""Sources and sinks."""

from tidewheel.sources.files import csv_table, json_table, latest_file, parquet_table, warehouse_catalog, warehouse_table, write_csv, write_parquet, write_warehouse
from tidewheel.sources.generated import choices, date_range, literal, number_range, refresh_time
from tidewheel.sources.shared import shared_folder, stored
from tidewheel.sources.workbook import workbook_table, write_workbooks

__all__ = [
    "choices", "csv_table", "date_range", "json_table", "latest_file", "literal", "number_range", "parquet_table", "refresh_time", "shared_folder", "stored", "warehouse_catalog", "warehouse_table", "workbook_table", "write_csv",
    "write_parquet", "write_warehouse", "write_workbooks",
]
