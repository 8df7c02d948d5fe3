"""Compare a Spark query with its SQL on the same Parquet tables, ignoring row order."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(frame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(str(v) for v in row) for row in frame.itertuples(index=False)))


def differences(df, con, sql: str) -> str | None:
    """None if columns, types and all values agree, else a short description."""
    got = df.toPandas()
    want = con.execute(sql).df()
    for field in df.schema.fields:
        # Pandas has no nulls in its integers.
        if field.dataType.typeName() in ("long", "integer") and got[field.name].dtype.kind in "fO":
            got[field.name] = got[field.name].astype("Int64")
            want[field.name] = want[field.name].astype("Int64")
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    kinds = {c: (got[c].dtype, want[c].dtype) for c in got.columns}
    odd = {c: k for c, k in kinds.items() if k[0] != k[1] and "O" not in (k[0].kind, k[1].kind)}
    if odd and len(got):
        return f"types {odd}"
    bad = [(a, b) for a, b in zip(_rows(got), _rows(want)) if a != b]
    return f"{len(bad)} of {len(got)} rows differ, e.g. {bad[0]}" if bad else None
