"""Each registered query of the engine against its SQL in DuckDB."""

import math
from pathlib import Path

import duckdb
import pytest

from weftline.plans import catalog

DATA = Path("/root/testdata/sf0.001")


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def text(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "~"
        return f"{v:.6f}" if isinstance(v, float) else str(v)

    return sorted(tuple(text(r[i]) for i in order) for r in rows)


@pytest.mark.skipif(not DATA.exists(), reason="the given tables are not here")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, name):
    got = catalog.QUERIES[name](spark, str(DATA))
    if name not in catalog.SQL:
        assert got.count() >= 0
        return
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    cursor = con.execute(catalog.SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(got.columns)
    assert rows_of(got.columns, got.collect()) == rows_of(names, cursor.fetchall())
