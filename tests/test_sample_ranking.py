"""B1-B9, A12, A13 and running totals over cut groups."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.config import BalanceOptions
from tabwright.functions.hashing import hash_number, unit_hash
from tabwright.operators.ranking import hash_bucket, range_buckets, ranked_by_hash, running_totals
from tabwright.operators.sample import balance_copies, balance_quota, balance_rows, class_counts, exact_split, hash_split


def classes(spark, **sizes):
    rows, i = [], 0
    for label, size in sizes.items():
        for _ in range(size):
            rows.append((i, label))
            i += 1
    return spark.createDataFrame(rows, "id long, label string")


def quotas(spark, mode, over):
    counts = class_counts(classes(spark, a=10, b=30, c=60), "label")
    return {r.label: r.quota for r in balance_quota(counts, BalanceOptions(mode, over)).collect()}


def test_known_hash(spark):
    row = spark.range(1).select(hash_number(10001, F.lit(5)).alias("h"), unit_hash(10001, F.lit(5)).alias("u")).first()
    assert row.h == 990001544143966564 and 0 <= row.u < 1


@pytest.mark.parametrize(
    "mode,over,expected",
    [
        ("equalize", 1.0, (10, 10, 10)), ("equalize", 2.0, (20, 20, 20)),
        ("average", 1.0, (10, 14, 21)), ("average", 2.0, (20, 29, 43)), ("none", 2.0, (10, 30, 60)),
    ],
)
def test_quotas(spark, mode, over, expected):
    assert tuple(quotas(spark, mode, over)[k] for k in "abc") == expected


def test_both_spellings_of_equal_and_no_others():
    assert BalanceOptions("equal").mode == BalanceOptions("equalize").mode == "equalize"
    with pytest.raises(ValueError, match="unknown balancing"):
        BalanceOptions("uniform")


@pytest.mark.parametrize("mode,over", [("equalize", 2.0), ("average", 2.0), ("equalize", 9.0)])
def test_balanced_rows_meet_their_quotas(spark, mode, over):
    df = classes(spark, a=10, b=30, c=60)
    rows = balance_rows(df, "label", "id", BalanceOptions(mode, over), 7)
    got = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    assert got == quotas(spark, mode, over)
    assert rows.join(df, ["id", "label"], "left_anti").count() == 0
    whole = {k: v // n for (k, v), n in zip(sorted(got.items()), (10, 30, 60))}
    copies = balance_copies(df, "label", "id", BalanceOptions(mode, over), 7).collect()
    assert len(copies) == 100 and all(r.copies >= whole[r.label] for r in copies)


def test_balance_is_repeatable_and_seeded(spark):
    df = classes(spark, a=10, b=30, c=60)

    def run(seed, parts):
        rows = balance_rows(df.repartition(parts), "label", "id", BalanceOptions("average"), seed, shuffle=True)
        return [r.id for r in rows.collect()]

    assert run(1, 2) == run(1, 5) != run(2, 2)


def test_split_sizes(spark):
    df = spark.range(1000)
    assert exact_split(df, "id", 3, 1000).where("in_test").count() == 200
    assert exact_split(spark.range(11), "id", 3, 11).where("in_test").count() == 3
    assert 150 < hash_split(df, "id", 3).where("in_test").count() < 250


@pytest.mark.parametrize("keys", [[], ["label"]])
def test_rank_by_hash_equals_the_plain_window(spark, keys):
    df = classes(spark, a=3, b=50, c=400).withColumn("h", hash_number(5, "id"))
    window = W.partitionBy(*keys).orderBy("h", "id")
    both = ranked_by_hash(df, keys, "h", "id").withColumn("plain", F.row_number().over(window) - 1)
    assert both.count() == 453 and both.where("rank <> plain").count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.tuples(st.sampled_from("pq"), st.integers(0, 300)), st.integers(0, 9), min_size=1, max_size=80))
def test_running_totals_equal_the_plain_window(spark, values):
    df = spark.createDataFrame([(k, float(v), n) for (k, v), n in values.items()], "k string, v double, n long")
    cut = range_buckets(df, ["k"], ["v"])
    got = running_totals(cut, ["k"], ["v"], {"upto": "n"}, {"next_n": "n"})
    w = W.partitionBy("k").orderBy("v")
    plain = got.withColumns({"w_upto": F.sum("n").over(w), "w_next": F.lead("n").over(w)})
    assert got.count() == len(values)
    assert plain.where("upto <> w_upto OR NOT (next_n <=> w_next)").count() == 0


def test_hash_buckets_spread_one_hot_class(spark):
    df = classes(spark, hot=2000).withColumn("bucket", hash_bucket(hash_number(1, "id"), 8))
    sizes = [r["count"] for r in df.groupBy("label", "bucket").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 2000 / 8
