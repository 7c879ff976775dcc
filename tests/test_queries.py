"""Registered queries against their SQL twins on the smallest tables."""

import os
from concurrent.futures import ThreadPoolExecutor

import duckdb
import pytest

from kgloom.plans import registry

NAMES = sorted(registry.ORACLES)


def plain(rows):
    value = lambda v: None if v is None else float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    return sorted((tuple(map(value, r)) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for name in os.listdir(small):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{small}/{name}'")
    return con


@pytest.fixture(scope="module")
def answers(request, spark, small):
    """Rows and columns of the selected queries, several at a time: most of a small query is planning."""
    chosen = [i.callspec.params["name"] for i in request.session.items if getattr(i, "originalname", "") == "test_matches_its_twin"]

    def answer(name):
        frame = registry.QUERIES[name](spark, small)
        return frame.columns, frame.collect()

    with ThreadPoolExecutor(6) as pool:
        yield {name: pool.submit(answer, name) for name in chosen}


@pytest.mark.parametrize("name", NAMES)
def test_matches_its_twin(duck, answers, name):
    columns, rows = answers[name].result()
    result = duck.execute(registry.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(columns)
    order = [columns.index(n) for n in names]
    assert plain([[r[i] for i in order] for r in rows]) == plain(result.fetchall())


def test_every_twin_has_a_query():
    assert set(registry.ORACLES) <= set(registry.QUERIES)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
