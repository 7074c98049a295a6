"""Running a query and its SQL on the same tables and comparing the rows."""

import glob
import math
import os

import duckdb

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def connection(sf_dir=SF_DIR):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        source = path if os.path.isfile(path) else f"{path}/*.parquet"
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{source}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in values), key=repr)


def assert_same(df, sql, con):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows(names, result.fetchall())
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    assert sorted(df.columns) == sorted(names)
    assert len(got) == len(expected), f"{len(got)} rows, {len(expected)} expected; only here {[r for r in got if r not in expected][:3]}, only there {[r for r in expected if r not in got][:3]}"
    differing = [(a, b) for a, b in zip(got, expected) if a != b]
    assert not differing, differing[:3]
