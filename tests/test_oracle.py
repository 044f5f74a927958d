"""Every query with an oracle must equal DuckDB on the same parquet tables
(row count, column names/types, exact multiset of rounded rows)."""

from collections import Counter

import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from scripts.oracle_check import canon, duck, kind

SQL = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert len(SQL) >= 60


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    srows = sdf.collect()
    cur = con.execute(SQL[name])
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)
    st = {f.name: kind(f.dataType.simpleString()) for f in sdf.schema.fields}
    dt = {c: kind(str(d[1])) for c, d in zip(dcols, cur.description)}
    assert st == dt
    assert len(srows) == len(drows)
    order = sorted(sdf.columns)
    si = [sdf.columns.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    a = Counter(tuple(canon(r[i]) for i in si) for r in srows)
    b = Counter(tuple(canon(r[i]) for i in di) for r in drows)
    assert a == b, (list((a - b).elements())[:3], list((b - a).elements())[:3])
