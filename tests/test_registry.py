"""Registered queries against their SQL in DuckDB, on the smallest data."""

import datetime
import decimal
from itertools import islice
from pathlib import Path

import duckdb
import pytest
from helpers import plan

import __spark_entry__ as entry
from marquee.registry import load

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
NATIVE = set(load()[0])   # queries of optional parts may run Python in tasks


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return round(v, 9) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def canon(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=str)


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for p in Path(small).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, small, name):
    df = QUERIES[name](spark, small)
    got = df.collect()
    text = plan(df)
    # no pairwise joins in any plan, no row-at-a-time or Arrow Python in the library's own
    banned = ["CartesianProduct", "NestedLoop"] + (["Python", "Pandas", "Arrow"] if name in NATIVE else [])
    assert not [op for op in banned if op in text]
    if name not in ORACLES:
        return
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert canon(got, df.columns) == canon(result.fetchall(), columns)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def tables_of(folder, orders):
    """The sources of the catalogue with these orders (key, customer, status), and a connection that has them."""
    con = duckdb.connect()
    con.execute("create table orders (o_orderkey bigint, o_custkey bigint, o_orderstatus varchar, o_totalprice double, o_orderdate timestamp, o_orderpriority varchar)")
    con.executemany("insert into orders values (?, ?, ?, 50000, timestamp '2020-01-01', '1-URGENT')", orders)
    con.execute(f"copy orders to '{folder}/orders.parquet'")
    return con


def keys_rated(lowest, highest, more=lambda k: True):
    """Order keys whose rated titles have a rating within the bounds."""
    rating = lambda k: int(100.5 - (k * 7919 % 91) ** 2 / 90) / 10
    return (k for k in range(1, 10 ** 6) if k % 5 and k % 17 and k % 31 and k % 41 and lowest <= rating(k) <= highest and more(k))


def same_as_sql(spark, con, folder, name):
    df, result = QUERIES[name](spark, str(folder)), con.execute(ORACLES[name])
    got, want = canon(df.collect(), df.columns), canon(result.fetchall(), [d[0] for d in result.description])
    assert got == want
    return df


def test_genres_of_every_priority(spark, tmp_path):
    # single genres by key: Action and Comedy good enough, Drama and Crime not
    year = lambda k: 1900 + k % 135
    wanted = {0: (9.0, 10.0, lambda y: 2020 <= y <= 2029), 1: (6.6, 6.9, lambda y: 1950 <= y < 2020),
              2: (6.1, 6.4, lambda y: 1950 <= y < 2020), 3: (2.0, 5.0, lambda y: 1950 <= y < 2020)}
    orders = []
    for genre, (low, high, years) in wanted.items():
        keys = keys_rated(low, high, lambda k: k % 3 == 0 and k % 8 == genre and years(year(k)))
        orders += [(next(keys), 1, "F") for _ in range(12)]
    con = tables_of(tmp_path, orders)
    marts = {r["genre"]: r["investment_priority"] for r in same_as_sql(spark, con, tmp_path, "mart_genres").collect()}
    assert marts == {"Action": "High Priority", "Comedy": "Medium Priority", "Drama": "Low Priority", "Crime": "Not Recommended"}
    kept = same_as_sql(spark, con, tmp_path, "consumer_genres").collect()
    assert sorted(r["genre"] for r in kept) == ["Action", "Comedy"]


def test_series_of_every_use(spark, tmp_path):
    # by customer: the ratings of a series' episodes, how many have each, and if the published query wants it
    wanted = {1: ([(9.5, 10.0, 60)], True), 2: ([(7.4, 7.6, 13), (8.6, 9.2, 17)], True), 3: ([(9.8, 10.0, 48), (5.0, 6.0, 12)], False),
              4: ([(7.1, 7.3, 60)], False), 5: ([(9.5, 10.0, 12)], False), 6: ([(9.5, 10.0, 5)], False)}
    orders, taken = [], set()
    for customer, (bands, _) in wanted.items():
        orders.append((17 * 10 ** 6 + customer, customer, "O"))
        for low, high, n in bands:
            for k in islice(keys_rated(low, high, lambda k: k not in taken), n):
                taken.add(k)
                orders.append((k, customer, "P"))
    con = tables_of(tmp_path, orders)
    series = {int(r["series_tconst"][-1]): (r["series_performance_tier"], r["consistency_rating"])
              for r in same_as_sql(spark, con, tmp_path, "mart_series").collect()}
    assert series == {1: ("Premium Franchise", "Very Consistent"), 2: ("Quality Series", "Consistent"), 3: ("Premium Franchise", "Highly Variable"),
                      4: ("Solid Series", "Very Consistent"), 5: ("Strong Series", "Very Consistent")}
    kept = same_as_sql(spark, con, tmp_path, "consumer_series").collect()
    assert sorted(int(r["series_title"][-1]) for r in kept) == [c for c, (_, wants) in wanted.items() if wants]
