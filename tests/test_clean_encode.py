"""F4-F10, P6-P9, E2-E5, S2-S19."""

import json

import pytest
from pyspark.sql import functions as F

from tabwright.functions.paths import col
from tabwright.operators.clean import Attribute, accepted, clean_columns, quarantined
from tabwright.operators.encode import DEFAULT, KEEP, decode, encode_rows, senses, target_labels
from tabwright.plans.report import default_row, sample_request
from tabwright.sources.delimited import ADULT, EARLY_DIABETES, IRIS, WINE, bad_rows, read_delimited
from tabwright.sources.documents import read_json_lines, readable, write_json_lines


def number(path, kind="float", default=0.0):
    return Attribute(path, kind, "Numerical", False, default, None)


def text(path, default="d", labels=None, target=False):
    return Attribute(path, "string", "Categorical", target, None, default, labels=labels)


TARGET = text("y", target=True)


def cleaned(docs, attributes, **options):
    return [r.asDict() for r in accepted(clean_columns(docs, attributes, "pos", **options)).orderBy("pos").collect()]


def test_int_conversion(documents):
    docs = documents([{"y": "a", "v": v} for v in [3, 3.7, -3.7, "3", "3.7", "x", True, " 4 "]])
    values = [r["v"] for r in cleaned(docs, [TARGET, number("v", "int", 99.0)])]
    assert values == [3.0, 3.0, -3.0, 3.0, 99.0, 99.0, 1.0, 4.0]


def test_float_and_text_conversion(documents):
    docs = documents([{"y": 1, "v": v, "s": v} for v in [3, 2.5, "1e2", "q", {"$numberDouble": "5.5"}]])
    rows = cleaned(docs, [TARGET, number("v", "float", -1.0), text("s")])
    assert [r["v"] for r in rows] == [3.0, 2.5, 100.0, -1.0, 5.5]
    assert [r["s"] for r in rows] == ["3", "2.5", "1e2", "q", "5.5"]
    assert {r["y"] for r in rows} == {"1"}


def test_date_conversion(documents):
    docs = documents([{"y": "a", "d": d} for d in ["2020-01-02", {"$date": "2020-01-02T00:00:00Z"}, "x", 5]])
    plan = [TARGET, Attribute("d", "date", "Categorical", False, None, "1970-01-01 00:00:00")]
    assert [r["d"] for r in cleaned(docs, plan)] == ["2020-01-02 00:00:00"] * 2 + ["1970-01-01 00:00:00"] * 2


@pytest.mark.parametrize("paths,allowed", [(9, 1), (10, 2), (20, 3)])
def test_default_budget(documents, paths, allowed):
    names = [f"v{i}" for i in range(paths - 1)]
    docs = documents([{"y": "a", **{n: 1 for n in names[missing:]}} for missing in range(5)])
    plan = [TARGET, *[number(n) for n in names]]
    checked = clean_columns(docs, plan, "pos")
    assert accepted(checked).count() == allowed + 1
    assert {r._reason for r in quarantined(checked).collect()} == {"too_many_defaults"}


def test_target_gates(documents):
    docs = documents([{"v": 1}, {"y": "x", "v": 1}, {"y": "5", "v": 1}])
    plan = [Attribute("y", "float", "Numerical", True, 7.0, None), number("v")]
    assert [r["y"] for r in cleaned(docs, plan)] == [7.0, 5.0]
    strict = clean_columns(docs, plan, "pos", strict_target=True)
    assert {(r.pos, r._reason) for r in quarantined(strict).collect()} == {(0, "missing_target"), (1, "bad_target")}


def test_unsupported_values_are_absent_or_reject_the_row(documents):
    docs = documents([{"y": "a", "v": [1]}, {"y": "a", "v": 2}])
    plan = [TARGET, number("v", default=9.0)]
    assert [r["v"] for r in cleaned(docs, plan)] == [9.0, 2.0]
    checked = clean_columns(docs, plan, "pos", unsupported="reject")
    assert [(r.pos, r._reason) for r in quarantined(checked).collect()] == [(0, "unsupported_type")]


def test_rows_are_conserved_and_flat_keys_found(documents):
    docs = documents([{"y": "a", "b": {"c": 1}}, {"y": "a", "b.c": 2}, {"b.c": 3}])
    plan = [TARGET, Attribute("b.c", "int", "Numerical", False, 0.0, None, 1, 2)]
    checked = clean_columns(docs, plan, "pos")
    assert accepted(checked).count() + quarantined(checked).count() == 3
    assert [r["b.c"] for r in cleaned(docs, plan)] == [1.0, 2.0]


def test_typed_columns_take_the_same_decisions(spark, documents):
    rows = [(0, "a", 1, 2.5), (1, None, 1, 2.5), (2, "b", None, None)]
    typed = spark.createDataFrame(rows, "pos long, y string, i int, f double")
    docs = documents([{k: v for k, v in zip(("y", "i", "f"), r[1:]) if v is not None} for r in rows])
    plan = [TARGET, number("i", "int", 8.0), number("f", "float", 9.0)]
    assert cleaned(typed, plan) == cleaned(docs, plan)
    nan = spark.createDataFrame([(0, "a", 1, float("nan"))], typed.schema)
    assert cleaned(nan, plan)[0]["f"] == 9.0


def test_encode_policies_and_round_trip(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "`x.1` string")
    attr = Attribute("x.1", "string", "Categorical", False, None, "b", labels=("a", "b"))
    assert [r[0] for r in encode_rows(df, [attr], KEEP).collect()] == [0, 1, 2]
    assert [r[0] for r in encode_rows(df, [attr], DEFAULT).collect()] == [0, 1, 1]
    with pytest.raises(Exception, match="unseen category"):
        encode_rows(df, [attr]).collect()
    known = encode_rows(df.where(col("x.1") != "c"), [attr])
    assert [r[0] for r in known.select(decode(col("x.1"), attr)).collect()] == ["a", "b"]


def test_long_label_lists_are_joined(spark):
    labels = tuple(f"v{i:03d}" for i in range(200))
    attr = Attribute("y", "string", "Categorical", True, None, "v000", labels=labels)
    df = spark.createDataFrame([(label,) for label in labels] + [("zz",)], "y string")
    assert sorted(r[0] for r in encode_rows(df, [attr], KEEP).collect()) == list(range(201))


def test_target_labels_and_senses(spark):
    encoders = spark.createDataFrame([("y", "b", 1), ("y", "a", 0), ("x", "q", 0)], "path string, label string, idx int")
    assert [r.label for r in target_labels(encoders, "y").collect()] == ["a", "b"]
    assert senses([TARGET, number("v"), text("s")]) == ["Numerical", "Categorical"]


def test_sample_request_quotes_by_type(spark):
    plan = [TARGET, number("a", "int", 3.0), number("b c", "float", 2.5), number("m", "int", 673.5), text("s", "x")]
    assert json.loads(sample_request(default_row(spark, plan)).first().request) == {"a": 3, "b c": 2.5, "m": 673.5, "s": "x"}


def test_delimited_formats(spark, tmp_path):
    def read(name, layout, lines):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        return [tuple(r) for r in read_delimited(spark, str(tmp_path / name), layout).collect()]

    assert read("iris", IRIS, ["5.1,3.5,1.4,0.2,Iris-setosa", ""]) == [(5.1, 3.5, 1.4, 0.2, "Iris-setosa")]
    wine = read("wine", WINE, ["1,14.23,1.71,2.43,15.6,127,2.8,3.06,.28,2.29,5.64,1.04,3.92,1065"])
    assert wine[0][0] == 1 and wine[0][8] == 0.28 and wine[0][13] == 1065
    adult = read("adult", ADULT, ["39, State-gov, 77516, Bachelors, 13, ?, Adm, Not, White, Male, 2174, 0, 40, US, <=50K", ""])
    assert len(adult) == 1 and adult[0][0] == 39 and adult[0][5] == "?" and adult[0][14] == "<=50K"
    header = ",".join(name for name, _ in EARLY_DIABETES.columns)
    row = ",".join(["40"] + ["No"] * 15 + ["Positive"])
    diabetes = read("esd", EARLY_DIABETES, [header, row])
    assert diabetes == [(40, *["No"] * 15, "Positive")]


def test_bad_delimited_rows_are_set_aside(spark, tmp_path):
    lines = ["1.5,2.5,3.5,4.5,Own-kind", "1.5,x,3.5,4.5,Own-kind", "1.5,2.5,3.5,4.5,Own-kind,more", "1.5;2.5;3.5;4.5;Own-kind"]
    (tmp_path / "rows").write_text("\n".join(lines) + "\n")
    good = read_delimited(spark, str(tmp_path / "rows"), IRIS).collect()
    bad = {r.line for r in bad_rows(spark, str(tmp_path / "rows"), IRIS).collect()}
    assert [r["class"] for r in good] == ["Own-kind"] and bad == set(lines[1:])


def test_extended_json_lines_round_trip(spark, tmp_path):
    df = spark.sql("select 5 i, 7L l, 2.5D d, 's' s, timestamp_ntz'2020-01-02 03:04:05' t, cast(null as int) n")
    write_json_lines(df, str(tmp_path / "out"))
    line = json.loads(spark.read.text(str(tmp_path / "out")).first().value)
    assert line["i"] == {"$numberInt": "5"} and line["l"] == {"$numberLong": "7"} and "n" not in line
    from tabwright.operators.observe import observations

    back = {r.path: (r.vtype, r.text) for r in observations(readable(read_json_lines(spark, str(tmp_path / "out"))), "pos").collect()}
    assert back == {
        "i": ("int", "5"), "l": ("int", "7"), "d": ("float", "2.5"), "s": ("string", "s"),
        "t": ("date", "2020-01-02 03:04:05"),
    }
