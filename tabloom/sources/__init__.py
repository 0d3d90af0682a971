"""Reading and writing tables and reports."""

from tabloom.sources.readers import file_format, infer_text_types, read_csv, read_json, read_table
from tabloom.sources.writers import write_report, write_table

__all__ = ["file_format", "infer_text_types", "read_csv", "read_json", "read_table", "write_report", "write_table"]
