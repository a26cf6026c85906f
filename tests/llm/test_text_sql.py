"""Operators 6 and 7 against their DuckDB SQL, on a table and on small texts with distinct ids."""

import duckdb
import pytest

from flightlake.llm import text_sql
from flightlake.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.data import awkward_rows, frame


@pytest.mark.parametrize("name", ["op6_token_group_join", "op7_run_length_repeats"])
def test_sql_of_the_table(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    want = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    got = QUERIES[name](spark, SF_SMALL)
    assert got.columns == columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_sql_of_awkward_texts(spark, tmp_path):
    rows = list({r[0]: r for r in awkward_rows() if r[0] is not None}.values())
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    for name, sql in (("op6_token_group_join", text_sql.SHINGLE_COMPONENTS), ("op7_run_length_repeats", text_sql.REPEATED_BYTES)):
        got = QUERIES[name](spark, str(tmp_path))
        assert sorted(map(tuple, got.collect())) == sorted(con.execute(sql).fetchall())
