"""Every registered query against its SQL on the driver tables."""

import math

import pytest

from regloom.plans.oracles import ORACLES
from regloom.plans.queries import QUERIES


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return "" if value is None else f"{type(value).__name__}:{value}"


def rows_by_name(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, parity, name):
    folder, db = parity
    result = QUERIES[name](spark, folder)
    relation = db.execute(ORACLES[name])
    names = [d[0] for d in relation.description]
    expected = rows_by_name(names, relation.fetchall())
    actual = rows_by_name(result.columns, [tuple(r) for r in result.collect()])
    assert actual[0] == expected[0]
    assert len(actual[1]) == len(expected[1])
    assert len(actual[1]) > 0
    assert actual[1] == expected[1]
