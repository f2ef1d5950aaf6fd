"""Every named query against its DuckDB twin: same columns, same multiset of rows."""

import datetime
import math
from collections import Counter

import pytest

from __spark_entry__ import entry
from conftest import DATA
from linegauge.plans.oracle import ORACLES
from linegauge.plans.registry import ALL as QUERIES


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    return value


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_twin(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    found = duck.execute(ORACLES[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    expected = multiset(columns, found.fetchall())
    got = multiset(df.columns, [tuple(r) for r in df.collect()])
    assert sum(expected.values()) > 0
    missing, extra = expected - got, got - expected
    assert not missing and not extra, f"missing {list(missing)[:3]} extra {list(extra)[:3]}"


def test_entry(spark):
    rows = entry(spark).collect()
    assert rows and all(r.n >= 10 for r in rows if r.enough)
