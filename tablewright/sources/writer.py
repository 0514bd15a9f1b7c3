"""Distributed table sink."""

from __future__ import annotations

from pyspark.sql import DataFrame


ROWS_PER_FILE = 500_000


def write_table(df: DataFrame, path: str, format: str = "parquet", mode: str = "errorifexists",
                rows_per_file: int = ROWS_PER_FILE, **options) -> str:
    """Write a table as a folder of csv, json (one record per line) or parquet files; no index column.

    CSV keeps blanks, line breaks and quotes of texts and the microseconds of times. Its files end after ``rows_per_file`` rows.
    An empty text is a quoted empty cell, NULL an empty one.
    """
    if format not in ("csv", "json", "parquet"):
        raise ValueError(f"unsupported table format {format!r}")
    writer = df.write.mode(mode).options(**options)
    if format == "csv":
        writer = writer.options(**{
            "header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
            "maxRecordsPerFile": rows_per_file, "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
            "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX", **options})
    writer.format(format).save(path)
    return path
