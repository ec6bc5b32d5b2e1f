"""Holds a query's rows against those of its SQL in DuckDB."""

import math
import os

import duckdb


def rows_of(frame):
    """Sorted rows of a pandas frame, columns by name; numbers as floats, nulls alike."""
    cols = sorted(frame.columns)

    def plain(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return None
        if isinstance(v, bool) or type(v).__name__ == "bool_":
            return bool(v)
        if isinstance(v, (int, float)) or hasattr(v, "dtype"):
            return None if v != v else float(v)
        return str(v) if str(v) != "<NA>" and str(v) != "NaT" else None

    return cols, sorted((tuple(plain(v) for v in r) for r in frame[cols].astype(object).itertuples(index=False, name=None)), key=repr)


def sql_rows(sql, sf_dir):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        path = f"{sf_dir}/{f}"
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return rows_of(con.sql(sql).df())
