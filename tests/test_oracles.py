"""Every registered query with SQL gives what DuckDB gives; the others run and return rows."""

import pytest

from tests.conftest import rows_of
from tidemark.catalog import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, small, request):
    out = QUERIES[name](spark, small)
    got = out.collect()
    names = sorted(out.columns)
    if name not in ORACLES:
        assert got
        return
    cur = request.getfixturevalue("duck").execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == names
    assert rows_of(got, out.columns, names) == rows_of(cur.fetchall(), columns, names)
