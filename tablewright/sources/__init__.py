from tablewright.sources.reader import load_table, read_csv, read_json
from tablewright.sources.writer import write_table

__all__ = ["load_table", "read_csv", "read_json", "write_table"]
