"""Compare registered queries with their SQL in another engine."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def _cell(value):
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, float):
        return ("f", None if math.isnan(value) else round(value, 6) + 0.0)
    if isinstance(value, int):
        return ("i", value)
    if value is None:
        return ("n", None)
    return ("s", str(value))


def rows_of(table) -> tuple[list[str], Counter]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, Counter(tuple(_cell(v) for v in row) for row in zip(*columns))


def compare(df, sql: str, con) -> str | None:
    """None when equal, else what differs."""
    got_names, got = rows_of(df.toArrow())
    want_names, want = rows_of(con.sql(sql).to_arrow_table())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if got == want:
        return None if got else "no rows on either side"
    extra, lacking = got - want, want - got
    return (
        f"rows {sum(got.values())} vs {sum(want.values())}; "
        f"only here: {str(list(extra)[:2])[:600]}; only there: {str(list(lacking)[:2])[:600]}"
    )
