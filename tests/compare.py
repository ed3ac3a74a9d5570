"""Compare a registered query with its SQL oracle: rows, columns, types and values."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def differences(df, sql: str, con) -> list[str]:
    """Empty when the query and the oracle agree."""
    relation = con.sql(sql)
    want_types = dict(zip(relation.columns, map(str, relation.types)))
    have_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    if sorted(want_types) != sorted(have_types):
        return [f"columns: {sorted(set(want_types) ^ set(have_types))}"]
    out = [f"{c}: {have_types[c]} against {want_types[c]}" for c in have_types if have_types[c] != want_types[c]]
    names = sorted(have_types)
    have = Counter(tuple(plain(r[c]) for c in names) for r in df.collect())
    order = [relation.columns.index(c) for c in names]
    want = Counter(tuple(plain(r[i]) for i in order) for r in relation.fetchall())
    if have != want:
        extra, missing = have - want, want - have
        out.append(f"rows {sum(have.values())} against {sum(want.values())}, {sum(extra.values())} extra")
        for mine, theirs in zip(sorted(extra), sorted(missing)):
            out.append(str([(n, a, b) for n, a, b in zip(names, mine, theirs) if a != b][:6]))
            break
    return out
