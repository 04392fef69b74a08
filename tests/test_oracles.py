"""Every catalogue query with SQL gives the SQL's rows on the smallest tables:
values, column order and types."""

import datetime
import decimal
import math

import duckdb
import pytest

from basketry.plans.catalog import QUERIES
from basketry.plans.oracles import oracle_sql
from basketry.sources.tables import TABLES, table_path
from tests.conftest import SF001

ORACLES = oracle_sql()
KINDS = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
         "decimal(38,0)": "DECIMAL(38,0)"}


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (decimal.Decimal, datetime.date)):
        return str(value)
    return value


def ordered(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{table_path(SF001, t)}'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_rows_equal_the_sql(spark, con, name):
    found = QUERIES[name](spark, SF001)
    want = con.execute(ORACLES[name])
    assert found.columns == [d[0] for d in want.description]
    for (column, kind), d in zip(found.dtypes, want.description):
        assert KINDS.get(kind, kind) == str(d[1]), column
    assert ordered(found.collect()) == ordered(want.fetchall())
