"""Queries with a DuckDB twin: same rows, column names and types."""

import duckdb
import pytest

from cardrisk.llm.queries import ORACLE, QUERIES
from conftest import SF_SMALL

ARROW = {"string": "string", "bigint": "int64", "int": "int32", "double": "double", "boolean": "bool"}


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_rows_and_types_match(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    df = QUERIES[key](spark, SF_SMALL)
    table = con.sql(ORACLE[key]).to_arrow_table()
    assert {f.name: ARROW[f.dataType.simpleString()] for f in df.schema} == {f.name: str(f.type) for f in table.schema}
    cols = sorted(df.columns)
    want = [tuple(r[c] for c in cols) for r in table.to_pylist()]
    assert sorted(map(repr, map(tuple, df.select(cols).collect()))) == sorted(map(repr, want))
