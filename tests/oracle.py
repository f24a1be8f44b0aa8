"""Compare a registered query with its SQL twin: names, types, row count, values."""

from __future__ import annotations

import glob
import os

import duckdb

import __spark_entry__ as entry


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(frame):
    frame = frame[sorted(frame.columns)]
    def cell(v):
        if v is None or v != v:
            return "null"
        return repr(v.item() if hasattr(v, "item") else v)
    return sorted(tuple(cell(v) for v in row) for row in frame.astype(object).itertuples(index=False, name=None))


def _kinds(table):
    import pyarrow as pa
    out = {}
    for f in table.schema:
        t = f.type
        if pa.types.is_large_string(t) or pa.types.is_string_view(t):
            t = pa.string()
        out[f.name] = str(t)
    return out


def differences(spark, name: str, sf_dir: str) -> list[str]:
    """What differs between both engines, empty when nothing does."""
    ours = entry.queries()[name](spark, sf_dir).toArrow()
    con = connect(sf_dir)
    theirs = con.sql(entry.oracle_sql()[name]).to_arrow_table()
    found = []
    if _kinds(ours) != _kinds(theirs):
        a, b = _kinds(ours), _kinds(theirs)
        found.append(f"types differ: { {k: (a.get(k), b.get(k)) for k in sorted({*a, *b}) if a.get(k) != b.get(k)} }")
    if ours.num_rows != theirs.num_rows:
        found.append(f"rows differ: {ours.num_rows} and {theirs.num_rows}")
    if set(ours.column_names) == set(theirs.column_names):
        a, b = _rows(ours.to_pandas()), _rows(theirs.to_pandas())
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        if bad:
            found.append(f"{len(bad)} of {len(a)} rows differ, first {bad[0]}")
    return found
