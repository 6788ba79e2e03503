"""Compare a Spark result with DuckDB's on the same Parquet tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values as text, rows in order."""
    frame = frame[sorted(frame.columns)]
    text = pd.DataFrame(
        {c: [None if pd.isna(v) else str(v) for v in frame[c]] for c in frame.columns},
        columns=frame.columns,
        dtype="object",
    )
    return text.sort_values(list(text.columns), na_position="first").reset_index(drop=True)


# Spark and DuckDB names of the types the results use.
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def assert_matches(frame, sql: str, sf_dir: str) -> int:
    relation = connect(sf_dir).sql(sql)
    spark_types = {f.name: TYPES[f.dataType.simpleString()] for f in frame.schema.fields}
    duck_types = dict(zip(relation.columns, map(str, relation.types)))
    assert spark_types == duck_types
    ours, theirs = arrow_rows(frame.toArrow()), arrow_rows(relation.to_arrow_table())
    pd.testing.assert_frame_equal(ours, theirs)
    return len(ours)


def arrow_rows(table) -> pd.DataFrame:
    return canonical(table.to_pandas(types_mapper=pd.ArrowDtype))
