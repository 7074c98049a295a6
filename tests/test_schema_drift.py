import datetime
import itertools
import json

from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.operators import schema_drift
from millrace.operators.schema_drift import best_matching, schema_changes, unified_table

SCHEMA = "line_id bigint, feed_id bigint, file_id bigint, as_of timestamp_ntz, arrived_at timestamp_ntz, row bigint, line string"


def table(spark, files):
    out = []
    for (feed, file, day), records in files.items():
        at = datetime.datetime(2020, 1, day)
        for row, record in enumerate(records, 1):
            out.append((len(out), feed, file, at, at, row, record if record is None or isinstance(record, str) else json.dumps(record)))
    return spark.createDataFrame(out, SCHEMA)


def found(df):
    return sorted((r.file_id, r.change_kind, r.field_name, r.new_name) for r in schema_changes(df).collect())


def people(key="urn", name="name", flag="live", **more):
    out = []
    for n in range(8):
        record = {key: f"ROW-{1000 + n}", name: f"Person {chr(65 + n)}x", flag: n % 3 == 0, "visits": n * 7}
        out.append(record | {k: f(n) for k, f in more.items()})
    return out


def test_changes(spark):
    df = table(
        spark,
        {
            (1, 10, 1): people(gone=lambda n: n),
            (1, 11, 3): [{k.upper(): v for k, v in r.items()} for r in people(key="ref", name="full_name", flag="active", visits=lambda n: str(n * 7), extra=lambda n: "q" * (n + 3))],
            (1, 12, 2): people(),
            (2, 20, 1): people(),
        },
    )
    assert found(df) == [
        (11, "added", "extra", ""), (11, "renamed", "live", "active"), (11, "renamed", "name", "full_name"), (11, "renamed", "urn", "ref"), (11, "retyped", "visits", ""),
        (12, "removed", "gone", ""),
    ]
    wide = unified_table(df)
    assert set(wide.columns) == {"feed_id", "file_id", "row", "urn", "name", "live", "visits", "gone", "extra"}
    assert {(r.urn, r.name) for r in wide.filter("file_id = 11").collect()} == {(f"ROW-{1000 + n}", f"Person {chr(65 + n)}x") for n in range(8)}


def test_renamed_and_back(spark):
    df = table(spark, {(1, 1, 1): people(), (1, 2, 2): people(name="nm"), (1, 3, 3): people(name="full")})
    assert found(df) == [(2, "renamed", "name", "nm"), (3, "renamed", "nm", "full")]
    assert "name" in unified_table(df).columns and "nm" not in unified_table(df).columns


def test_edge_cases(spark):
    df = table(spark, {(1, 1, 1): [None, "not json", "[1]", {"a": None, "b": 1}], (1, 2, 2): [{"a": 1, "b": 1}, {"B": 2}], (None, 3, 1): [{"a": 1}]})
    assert found(df) == [(2, "added", "a", "")]
    again = df.unionByName(df.withColumnRenamed("line_id", "line_id"))
    assert found(again) == [(2, "added", "a", "")]
    assert found(df.limit(0)) == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abcd"), st.sampled_from("wxyz"), st.floats(0.1, 1)), max_size=10, unique_by=lambda e: e[:2]))
def test_matching_is_best(edges):
    weight = {e[:2]: e[2] for e in edges}
    got = sum(weight[p] for p in best_matching(edges)) if edges else 0
    best = max(sum(weight.get(p, 0) for p in zip("abcd", perm)) for perm in itertools.permutations("wxyz"))
    assert abs(got - best) < 1e-9


def test_one_table_of_typed_values(spark):
    def line(n, file, day, text):
        return (n, 1, file, datetime.datetime(2020, 1, day), datetime.datetime(2020, 2, 1), n, text)

    rows = [
        line(1, 1, 1, '{"name":"say \\"hi\\"\\nthere","n":1,"ok":true,"x":1.5,"mixed":1}'), line(2, 1, 1, '{"a":"y","A":"z","n":2,"x":2}'), line(3, 1, 1, '{"a":"same","A":"same"}'),
        line(4, 2, 2, '{"name":"b","mixed":"one","ok":false,"deep":{"k":[1,2]}}'),
    ]
    df = unified_table(spark.createDataFrame(rows, SCHEMA))
    assert {c: t for c, t in df.dtypes if c in ("name", "n", "ok", "x", "mixed", "a")} == {"name": "string", "n": "bigint", "ok": "boolean", "x": "double", "mixed": "string", "a": "string"}
    got = {r.row: r for r in df.collect()}
    assert got[1].name == 'say "hi"\nthere' and (got[1].n, got[1].ok, got[1].x, got[1].mixed) == (1, True, 1.5, "1") and got[4].mixed == "one"
    assert got[2].a == '["y","z"]' and got[3].a == "same" and got[4].deep == '{"k":[1,2]}'


def test_lines_are_parsed_once(spark, monkeypatch):
    """Every plan after that reads a table; a plan that carries the parsing along again is large for the driver."""
    plans, cut = [], schema_drift.cut_lineage
    monkeypatch.setattr(schema_drift, "cut_lineage", lambda df, name="stage": (plans.append(df._jdf.queryExecution().analyzed().toString()), cut(df, name))[1])
    lines = table(spark, {(1, 1, 1): people(), (1, 2, 2): people(name="who")})
    assert found(lines) == [(2, "renamed", "name", "who")]
    assert sum(p.count("from_json") for p in plans) == 1
