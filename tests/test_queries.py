"""Every registered query beside its SQL on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
from compare import cell  # noqa: E402

from citeforge.plans import bibliographic, problems  # noqa: E402

QUERIES = {**bibliographic.QUERIES, **problems.QUERIES}
SQL = {**bibliographic.SQL, **problems.SQL}


@pytest.fixture(scope="module")
def db(small):
    con = duckdb.connect()
    for p in Path(small).iterdir():
        con.execute(f"CREATE VIEW {p.name.split('.')[0]} AS SELECT * FROM '{p}'")
    return con


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, db, name):
    df = QUERIES[name](spark, small)
    order = sorted(df.columns)
    ours = sorted(str([cell(r[c]) for c in order]) for r in df.collect())
    if name in SQL:
        rel = db.sql(SQL[name])
        columns = rel.columns
        assert sorted(columns) == order
        theirs = sorted(str([cell(v) for _, v in sorted(zip(columns, r, strict=True))]) for r in rel.fetchall())
        assert ours == theirs
