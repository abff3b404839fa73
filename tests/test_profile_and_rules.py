"""A2-A11, R1-R13, E1, E12, E13."""

import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabwright.config import EstimatorSpec, SchemaOptions
from tabwright.operators.observe import observations, with_target
from tabwright.plans.planning import planned
from tabwright.operators.profile import freq_of, median_by_narrowing, medians, profile, profile_of, value_freq
from tabwright.operators.rules import (
    attribute_plan, constant_default, label_encoders, preferred_type, rejected, selected,
)

SPEC = EstimatorSpec("t", "y")


def plan_of(docs, spec=SPEC):
    kept = with_target(docs, spec.target)
    n = kept.count()
    freq = freq_of(kept, "pos")
    return freq, attribute_plan(profile(freq), medians(freq), n, spec)


def decisions(docs, spec=SPEC):
    return {r.path: r for r in plan_of(docs, spec)[1].collect()}


def spread(n, **attributes):
    """n documents with target a/b and attributes given as functions of the row number."""
    out = []
    for i in range(n):
        doc = {"y": "ab"[i % 2]}
        for name, make in attributes.items():
            value = make(i)
            if value is not None:
                doc[name] = value
        out.append(doc)
    return out


def test_counts_mode_and_text_numbers(documents):
    docs = documents([{"v": v} for v in ["12", " 7 ", "1.5", "x", 3, 3, True, 2.0, "1_0", "1__0", "nan"]])
    row = profile(freq_of(docs, "pos")).first()
    assert (row.present, row.unique_count, row.n_int, row.n_float, row.n_string) == (11, 10, 3, 1, 7)
    assert (row.int_strings, row.float_strings, row.mode) == (3, 2, "3")


def test_mode_tie_goes_to_the_value_that_got_there_first(documents):
    docs = documents([{"v": v} for v in ["a", "b", "b", "a"]])
    assert profile(freq_of(docs, "pos")).first().mode == "b"


def test_values_of_different_types_share_their_text(documents):
    row = value_freq(observations(documents([{"v": 1}, {"v": "1"}, {"v": True}]), "pos")).first()
    assert (row.n, row.n_int, row.n_string) == (3, 2, 1)


def test_fixed_type_frequencies_equal_the_general_ones(spark):
    df = spark.createDataFrame([(i, i % 3, float(i % 2), f"s{i % 4}") for i in range(20)], "pos long, a int, b double, c string")
    lean = profile(freq_of(df, "pos")).orderBy("path").collect()
    full = profile(value_freq(observations(df, "pos"))).orderBy("path").collect()
    assert lean == full


def test_median_and_mean_by_form(documents):
    docs = documents([{"v": v} for v in ["1", 2, 2.5, "x", "4"]])
    freq = freq_of(docs, "pos")
    row = medians(freq).join(profile(freq), "path").first()
    assert (row.median_int, row.median_float) == (2.0, 2.25)
    assert row.mean_int == pytest.approx(7 / 3) and row.mean_float == pytest.approx(9.5 / 4)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("pq"), st.integers(-50, 50), st.integers(1, 9)), min_size=1, max_size=60))
def test_narrowed_median_is_exact(spark, rows):
    df = spark.createDataFrame([(p, float(v), n) for p, v, n in rows], "path string, number double, n long")
    expected = {}
    for p, v, n in rows:
        expected.setdefault(p, []).extend([v] * n)
    got = {r.path: r.m for r in median_by_narrowing(df, {"m": "n"}).collect()}
    assert got == {p: statistics.median(values) for p, values in expected.items()}


def test_both_medians_of_many_values_come_from_one_plan(spark):
    rng = random.Random(3)
    values = [rng.choice([rng.randint(-9, 9), rng.randint(-(10**6), 10**6), rng.random()]) for _ in range(3000)]
    rows = [(i, str(v), float("inf") if i < 3 else v + 0.5) for i, v in enumerate(values)]
    got = {r.path: r for r in medians(freq_of(spark.createDataFrame(rows, "pos long, a string, b double"), "pos")).collect()}
    assert got["a"].median_int == statistics.median(v for v in values if isinstance(v, int))
    assert got["a"].median_float == pytest.approx(statistics.median(values)) and got["b"].median_int is None
    assert got["b"].median_float == pytest.approx(statistics.median([r[2] for r in rows]))


def test_numeric_strings_stay_strings_unless_promoted(documents):
    docs = documents(spread(20, s=lambda i: str(i)))
    assert decisions(docs)["s"].reason == "too_many_values"
    promoted = decisions(docs, EstimatorSpec("t", "y", schema=SchemaOptions(string_numbers="promote")))["s"]
    assert (promoted.type, promoted.sense) == ("int", "Numerical")


def test_mixed_numbers_and_numeric_strings(documents):
    docs = documents(
        spread(
            20, mostly_int=lambda i: str(i) if i < 2 else i, mostly_text=lambda i: i + 0.5 if i < 2 else f"{i}.5"
        )
    )
    got = decisions(docs)
    assert (got["mostly_int"].type, got["mostly_int"].ext_int) == ("int", 20)
    assert (got["mostly_text"].type, got["mostly_text"].ext_float) == ("float", 20)


def test_native_ints_count_as_float_only_on_request(documents):
    docs = documents(spread(20, v=lambda i: i if i % 2 else i + 0.5))
    assert decisions(docs)["v"].reason == "too_many_values"
    assert decisions(docs, EstimatorSpec("t", "y", schema=SchemaOptions(int_is_float=True)))["v"].type == "float"


def test_thresholds_are_strict_and_over_all_documents(documents):
    got = decisions(documents(spread(100, at80=lambda i: i if i < 80 else None, at81=lambda i: i if i < 81 else None)))
    assert got["at80"].reason == "too_sparse" and got["at81"].selected


def test_single_value_comes_before_sparse(documents):
    got = decisions(documents(spread(10, one=lambda i: 5, rare=lambda i: 5 if i == 0 else None)))
    assert got["one"].reason == got["rare"].reason == "single_value"


def test_ties_between_types_go_to_the_first_seen(documents):
    spec = EstimatorSpec("t", "y", schema=SchemaOptions(min_typealign=0.4))
    first_text = decisions(documents(spread(10, v=lambda i: "q%d" % i if i % 2 == 0 else i)), spec)["v"]
    first_int = decisions(documents(spread(10, v=lambda i: i if i % 2 == 0 else "q%d" % i)), spec)["v"]
    assert first_int.type == "int" and first_text.sense == "Categorical"


def test_categorical_limit_and_encoder_order(documents):
    docs = documents(spread(40, few=lambda i: "zyx"[i % 3], many=lambda i: f"v{i}"))
    freq, plan = plan_of(docs)
    got = {r.path: r for r in plan.collect()}
    assert got["few"].sense == "Categorical" and got["many"].reason == "too_many_values"
    codes = {(r.path, r.label): r.idx for r in label_encoders(freq, plan).collect()}
    assert codes == {("few", "x"): 0, ("few", "y"): 1, ("few", "z"): 2, ("y", "a"): 0, ("y", "b"): 1}
    assert [(r.path, r.type, r.sense) for r in selected(plan).collect()] == [("few", "string", "Categorical")]


def test_target_is_always_kept(documents):
    docs = documents([{"y": i, "x": i % 2} for i in range(30)])
    assert (decisions(docs)["y"].type, decisions(docs)["y"].sense) == ("string", "Categorical")
    regression = EstimatorSpec("t", "y", is_classification=False, is_regression=True)
    assert (decisions(docs, regression)["y"].type, decisions(docs, regression)["y"].sense) == ("float", "Numerical")


def test_defaults(documents):
    got = decisions(documents(spread(4, i=lambda i: [1, 2, 3, 10][i], f=lambda i: [0.5, 1.5, 1.5, 9.0][i], c=lambda i: "aab b"[i])))
    assert got["i"].default_number == 2.5 and got["f"].default_number == 1.5 and got["c"].default_text == "a"


def test_constant_defaults(spark):
    rows = spark.createDataFrame([("int",), ("float",), ("string",), ("date",)], "type string")
    assert [r[0] for r in rows.select(constant_default(F.col("type"))).collect()] == ["0", "0.0", "", "1970-01-01 00:00:00"]


def test_rejects_report_raw_and_extended_counts(documents):
    _, plan = plan_of(documents(spread(20, s=lambda i: str(i))))
    row = rejected(plan).first()
    assert row.type_counts == {"string": 20} and row.extended_counts == {"int": 20, "float": 20, "string": 20}


def test_preferred_type_needs_enough_documents(documents):
    docs = documents(spread(10, v=lambda i: i if i < 8 else None))
    rows = profile(freq_of(docs, "pos")).where("path = 'v'")
    assert rows.select(preferred_type(SPEC, 10).alias("t")).first().t is None


def test_long_texts_are_counted_by_key_and_fetched_back(spark):
    head = "h" * 64
    texts = [head, head + "b", head + "a" * 900, head + "a" * 900, "9" * 70, "short", "é" * 64, "é" * 65, "é" * 65]
    df = spark.createDataFrame([(i, t, ["x" * 80, "y" * 80][i % 2]) for i, t in enumerate(texts)], "pos long, t string, y string")
    freq = freq_of(df, "pos").where("path = 't'").collect()
    assert sorted(r.n for r in freq) == [1, 1, 1, 1, 1, 2, 2] and max(len(r.text) for r in freq) == 129
    assert [(r.int_text, r.number) for r in freq if r.text.startswith("9")] == [(True, float("9" * 70))]
    found = {r.path: r for r in profile_of(df, "pos").collect()}
    assert found["t"].mode == head + "a" * 900 and found["t"].unique_count == 7 and found["y"].mode == "x" * 80
    done = planned(df, EstimatorSpec("t", "y"))
    assert [(r.label, r.idx) for r in done.encoders.where("path = 'y'").orderBy("idx").collect()] == [("x" * 80, 0), ("y" * 80, 1)]
    defaults = {r.path: r.default_text for r in done.plan.collect()}
    assert defaults["y"] == "x" * 80
