"""P1-P5, F1-F3, F12, S1."""

import random

import pytest
from pyspark.sql import functions as F

from tabwright.functions.paths import key_lists
from tabwright.operators.discovery import discover, parse_shape
from tabwright.operators.observe import Layout, observations, with_target
from tabwright.sources.documents import as_documents, parse_documents, readable, unreadable


def seen(df, **options):
    return {(r.path, r.vtype, r.text) for r in observations(df, "pos", **options).collect()}


def test_nested_paths_skip_ids_arrays_and_nulls(documents):
    doc = {"y": "a", "b": {"c": 1, "d": {"e": "x", "_id": 5}}, "_id": 9, "arr": [1], "n": None, "empty": {}}
    assert seen(documents([doc])) == {("y", "string", "a"), ("b.c", "int", "1"), ("b.d.e", "string", "x")}


def test_unknown_values_can_be_counted(documents):
    rows = observations(documents([{"y": "a", "arr": [1]}]), "pos", keep_unknown=True)
    assert {r.path: r.vtype for r in rows.collect()} == {"y": "string", "arr": "unknown"}


def test_wrappers_are_opened_and_broken_ones_hold_the_missing_value(documents):
    doc = {
        "v": {"$numberDouble": "5.1"}, "w": {"$numberLong": "7"}, "i": {"$numberInt": 3}, "bad": {"$numberInt": "x"},
        "d": {"$date": "2020-01-01T00:00:00"}, "z": {"$date": "2020-01-01T05:00:00+05:00"},
        "m": {"$date": {"$numberLong": "1577836800000"}}, "two": {"$numberInt": "1", "k": 2},
    }
    assert seen(documents([doc])) == {
        ("v", "float", "5.1"), ("w", "int", "7"), ("i", "int", "3"), ("bad", "int", "0"),
        ("d", "date", "2020-01-01 00:00:00"), ("z", "date", "2020-01-01 00:00:00"),
        ("m", "date", "2020-01-01 00:00:00"), ("two.$numberInt", "string", "1"), ("two.k", "int", "2"),
    }


def test_dates_do_not_depend_on_the_session_zone(spark, documents):
    docs = documents([{"d": {"$date": "2020-06-01T00:00:00Z"}, "n": {"$date": "2020-06-01T00:00:00"}}])
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert {t for _, _, t in seen(docs)} == {"2020-06-01 00:00:00"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_number_and_boolean_text_keys(documents):
    docs = documents(['{"a": 2.0, "b": 1e3, "c": true, "d": false, "e": 12}'])
    assert seen(docs) == {
        ("a", "float", "2.0"), ("b", "float", "1000.0"), ("c", "int", "1"), ("d", "int", "0"), ("e", "int", "12"),
    }


def test_target_gate(documents):
    docs = documents([{"x": 1}, {"y": None}, {"y": ""}, {"y": 0}, {"y": False}, {"y": "a"}, {"y": {"k": 1}}])
    assert [r.pos for r in with_target(docs, "y").orderBy("pos").collect()] == [3, 4, 5, 6]


def test_dotted_target_may_be_nested_or_flat(documents):
    docs = documents([{"a": {"b": "x"}}, {"a.b": "y"}, {"a": {"c": 1}}])
    assert with_target(docs, "a.b").count() == 2


def test_typed_tables_and_documents_observe_the_same(spark):
    df = spark.createDataFrame(
        [(1, "x", 2.5, True, ("n", 3), [1])],
        "pos long, s string, f double, t boolean, o struct<k:string,`_id`:int>, arr array<int>",
    )
    typed = seen(df)
    assert typed == seen(as_documents(df, "pos").select("pos", "doc")) - {("pos", "int", "1")}
    assert typed == {("s", "string", "x"), ("f", "float", "2.5"), ("t", "int", "1"), ("o.k", "string", "n")}


def test_variant_and_map_columns_join_typed_ones(spark):
    df = spark.sql("select 1L pos, 'a' s, parse_json('{\"k\": {\"j\": 1}}') v, map('q', 2.5D) m")
    assert seen(df) == {("s", "string", "a"), ("v.k.j", "int", "1"), ("m.q", "float", "2.5")}


def nested(depth, leaf):
    for i in reversed(range(depth)):
        leaf = {f"k{i}": leaf}
    return leaf


def test_documents_of_any_depth(documents):
    docs = documents([nested(12, 1), nested(40, "x"), nested(3, {}), {"k0": 5}])
    want = {(".".join(f"k{i}" for i in range(n)), t, v) for n, t, v in ((12, "int", "1"), (40, "string", "x"), (1, "int", "5"))}
    assert seen(docs) == want == seen(docs, written_paths=0)


def plain_leaves(value, keys=()):
    """(path, text of the value) of the scalars of a document without wrappers, from the definition."""
    if isinstance(value, dict):
        return [x for k, v in value.items() if k != "_id" for x in plain_leaves(v, (*keys, k))]
    return [] if value is None or isinstance(value, list) else [(".".join(keys), value)]


def random_value(rng, depth):
    kind = rng.randrange(10 if depth else 7)
    if kind < 7:
        return [1, 2.5, "x", True, None, [1, {"a": 2}], -3][kind]
    keys = rng.sample(["a", "b c", "d.e", "_id", "q`r", "h>,: i", "é", 'q"u'], rng.randrange(4))
    return {k: random_value(rng, depth - 1) for k in keys}


def test_found_paths_equal_the_definition_and_the_opened_levels(documents):
    rng = random.Random(7)
    items = [{k: random_value(rng, 4) for k in ("a", "b c", "z")} for _ in range(300)] + [{}, [1], 7]
    docs = documents(items)
    rows = observations(docs, "pos").collect()
    opened = observations(docs, "pos", written_paths=0).collect()
    assert sorted(map(str, rows)) == sorted(map(str, opened))
    want = [(i, p, float(v) if not isinstance(v, str) else v) for i, d in enumerate(items) for p, v in plain_leaves(d)]
    got = [(r.pos, r.path, r.text if r.vtype == "string" else float(r.text)) for r in rows]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert all((r.vtype == "int") == (not r.text.startswith("2")) for r in rows if r.vtype in ("int", "float"))
    merged = observations(docs, "pos", found=discover(docs, [((), F.col("doc"))], few=1)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, merged))
    with_unknown = [sorted(map(str, observations(docs, "pos", keep_unknown=True, written_paths=n).collect())) for n in (0, 1000)]
    assert with_unknown[0] == with_unknown[1] and len(with_unknown[0]) > len(rows)


def test_wrappers_beside_objects_at_one_place(documents):
    docs = documents([
        {"a": {"$numberInt": "3"}}, {"a": {"$numberInt": "4", "b": 5}}, {"a": {"$numberInt": {"c": 1}, "$date": "x"}}, {"a": {}},
        {"a": 7}, {"d": {"$date": {"$numberLong": "0"}}}, {"d": {"$date": "2020-01-01"}}, {"w": {"$numberLong": {"$numberInt": "1"}}},
    ])
    rows = sorted(map(str, observations(docs, "pos").collect()))
    assert rows == sorted(map(str, observations(docs, "pos", written_paths=0).collect()))
    assert rows == sorted(map(str, observations(docs, "pos", found=discover(docs, [((), F.col("doc"))], few=1)).collect()))
    assert {("a", "int", "3"), ("a.$numberInt", "string", "4"), ("a.b", "int", "5"), ("a.$numberInt.c", "int", "1"), ("a", "int", "7")} <= seen(docs)


def test_discovery_counts_and_parses_shapes(spark, documents):
    docs = documents([{"a": {"b": 1}}, {"a": 2}, {"a": {"b": {"c": "x"}}}])
    found, merged = (discover(docs, [((), F.col("doc"))], few=n) for n in (1000, 1))
    assert found.n_rows == merged.n_rows == 3 and found.depth == merged.depth == 3
    assert {(leaf.keys, leaf.kind) for leaf in found.leaves} == {(("a",), "any"), (("a", "b"), "any"), (("a", "b", "c"), "string")}
    assert {leaf.keys for leaf in merged.leaves} == {leaf.keys for leaf in found.leaves}
    assert discover(docs.where("false"), [((), F.col("doc"))]).leaves == []
    shape = parse_shape("OBJECT<a: DECIMAL(3,1), `b``c: d`: ARRAY<OBJECT<x: VOID>>, e: OBJECT<>>")
    assert [(k, m.tag, m.members) for k, m in shape.members.items()] == [("a", "DECIMAL", {}), ("b`c: d", "ARRAY", {}), ("e", "OBJECT", {})]


def test_bad_json_is_set_aside(spark):
    texts = ['{"a": 1}', '{"a":', '{"a": NaN}', '{"a": 1, "a": 2}', "[1]", "", "7"]
    parsed = parse_documents(spark.createDataFrame(list(enumerate(texts)), "pos long, text string"))
    assert [r.pos for r in readable(parsed).collect()] == [0]
    assert {r.pos for r in unreadable(parsed).collect()} == {1, 2, 3, 4, 6}


def test_key_lists_cover_every_cut():
    assert key_lists("a.b.c") == [("a", "b", "c")]
    assert set(key_lists("a.b.c", 1, 3)) == {("a", "b", "c"), ("a.b", "c"), ("a", "b.c"), ("a.b.c",)}


def test_odd_keys_can_be_read_back(documents):
    key = "q'r\"s"
    docs = documents([{key: 5, "a b": 3}])
    layout = Layout(docs.schema, ("pos",))
    row = docs.select(
        F.try_variant_get(layout.source(key), "$", "int").alias("q"),
        F.try_variant_get(layout.source("a b"), "$", "int").alias("b"),
    ).first()
    assert (row.q, row.b) == (5, 3)
