"""Steps whose cost must not grow faster than the rows."""

from collections import Counter
from contextlib import redirect_stdout
from io import StringIO

from pyspark.sql import functions as F

from tabwright.config import BalanceOptions, EstimatorSpec, SearchOptions
from tabwright.operators import search
from tabwright.operators.clean import Attribute
from tabwright.operators.importance import borrowed_rows
from tabwright.operators.learners import Candidate, Problem
from tabwright.operators.one_pass import GAUSSIAN_BAYES, OnePassModel
from tabwright.operators.sample import balance_copies, class_draws
from tabwright.plans.catalog.common import mixed_orders
from tabwright.sources import scratch

_BODY = '{"prior": [-0.5, -0.9], "features": [{"mean": [0.0, 1.0], "variance": [1.0, 2.0]}]}'


def _plan(df):
    text = StringIO()
    with redirect_stdout(text):
        df.explain(True)
    return text.getvalue()


def test_shares_are_plain_arithmetic_and_sum_to_one(spark):
    rows = spark.createDataFrame([(i, [i / 3.0]) for i in range(6)] + [(6, [-0.0])], "`a.b` int, feature_row array<double>")
    out = OnePassModel(body=_BODY, slot="m").transform(rows)
    assert out.columns == ["a.b", "feature_row", "proba_m"]
    assert "transform(" not in _plan(out) and "lambda" not in _plan(out)
    assert all(abs(sum(r["proba_m"]) - 1) < 1e-12 for r in out.collect())


def test_rounds_are_scored_together_and_pick_as_one_by_one(spark, monkeypatch):
    rows = [(i, float(i % 2), [[0.6, 0.4], [0.3, 0.7]][(i // 3) % 2], [[0.9, 0.1], [0.2, 0.8]][(i // 5) % 2], [[0.55, 0.45], [0.4, 0.6]][i % 2 if i % 7 else 0]) for i in range(90)]
    oof = spark.createDataFrame(rows, "id long, y double, p0 array<double>, p1 array<double>, p2 array<double>")
    problem = Problem(2, 1, 1, 0, 1, (0,))
    spec = EstimatorSpec("e", "y", search=SearchOptions(ensemble_size=9, ensemble_nbest=3))
    runs = [search.Run(Candidate(GAUSSIAN_BAYES, params={"smoothing": float(i)}), search.OK, score=0.5 + i / 10) for i in range(3)]
    calls, real = [], search.score_candidates
    monkeypatch.setattr(search, "score_candidates", lambda *a: calls.append(1) or real(*a))
    weights, trail = search.select_ensemble(runs, oof, spec, problem)
    assert len(trail) == 9 and len(calls) <= 4

    def right(members):
        total = 0
        for _, y, *p in rows:
            n = Counter(members)
            blend = [sum(p[i][k] * (n[i] / len(members)) for i in sorted(n)) for k in range(2)]
            total += blend.index(max(blend)) == y
        return total / len(rows)

    picked = []
    for step in trail:
        pool = search.pool_of(runs, 3)
        best = max(pool, key=lambda c: (right([*picked, c]), -c))
        picked.append(best)
        assert (step["candidate"], round(step["score"], 9)) == (runs[best].candidate.name, round(right(picked), 9))
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "65535"


def test_bucket_heads_sort_no_rows(spark):
    rows = spark.createDataFrame([(i, [float(i)]) for i in range(50)], "id long, v array<double>")
    out = borrowed_rows(rows, "id", "v", 5, 2)
    assert {r["repeat"]: r["n"] for r in out.groupBy("repeat").agg(F.count_distinct("borrowed").alias("n")).collect()} == {0: 50, 1: 50}
    # One sort for the order itself; the heads come from one number per bucket.
    assert "min(_hash" in _plan(out)


def test_borrowing_rows_are_not_broadcast_whatever_the_size_of_their_file(spark, tmp_path):
    spark.range(4000).selectExpr("id", "array(CAST(id AS double)) AS v").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    pairs = borrowed_rows(rows, "id", "v", 5, 2).groupBy("repeat").agg(F.count_distinct("borrowed").alias("n"), F.count("*").alias("rows"))
    plan = pairs._jdf.queryExecution().executedPlan()
    pairs._jdf.collectAsList()
    final = plan.toString().split("Initial Plan")[0]
    assert "isFinalPlan=true" in final
    # One number per bucket may be broadcast, rows may not.
    assert all("_hash" in line for line in final.splitlines() if "BroadcastHashJoin" in line)
    assert {(r["n"], r["rows"]) for r in pairs.collect()} == {(4000, 4000)}


def test_draws_of_a_large_class_are_spread_over_tasks(spark):
    quota = spark.createDataFrame([("a", 900_000, 1, 800_000), ("b", 10, 0, 0)], "_class string, cnt long, whole long, rest long")
    draws = class_draws(quota, 7)
    assert draws.rdd.getNumPartitions() == 4
    assert draws.count() == 800_000


def test_draws_are_not_broadcast_whatever_adaptive_execution_takes_them_for(spark):
    rows = spark.range(4000).select("id", F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("label"))
    copies = balance_copies(rows, "label", "id", BalanceOptions("average", 2.0), 7).agg(F.sum("copies").alias("n"), F.count("*").alias("rows"))
    plan = copies._jdf.queryExecution().executedPlan()
    copies._jdf.collectAsList()
    final = plan.toString().split("Initial Plan")[0]
    assert "isFinalPlan=true" in final
    assert not [line for line in final.splitlines() if "BroadcastHashJoin" in line and "_rank" in line]


def test_fits_read_files_of_few_rows_and_keep_no_wide_rows(spark, monkeypatch):
    monkeypatch.setattr(scratch, "_ROWS_PER_FILE", 100)
    monkeypatch.setattr(scratch, "_SCAN_BYTES", 1 << 20)
    rows = spark.range(900, numPartitions=1).selectExpr("id", "CAST(id % 2 AS double) AS y", "array(CAST(id % 7 AS double)) AS feature_row")
    attributes = [
        Attribute("a", "float", "Numerical", False, 0.0, None), Attribute("y", "string", "Categorical", True, None, "0", labels=("0", "1")),
    ]
    spec = EstimatorSpec("e", "y", search=SearchOptions(num_folds=3, include=frozenset({"decision_tree"}), max_models=1))
    before, seen, real = spark.conf.get("spark.sql.files.maxPartitionBytes"), [], search.fit

    def fit(candidate, problem, given, *rest):
        most = given.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        seen.append((most, given.storageLevel.useMemory, spark._jsparkSession.sharedState().cacheManager().isEmpty()))
        return real(candidate, problem, given, *rest)

    monkeypatch.setattr(search, "fit", fit)
    runs, oof = search.cross_validate(rows, attributes, spec)
    assert [r.status for r in runs] == ["ok"] and oof.count() == 900
    assert len(seen) == 3 and all(most <= 100 and not kept and empty for most, kept, empty in seen)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_documents_are_dealt_evenly_whatever_the_table_file(spark, tmp_path):
    orders = spark.range(2000, numPartitions=1).selectExpr(
        "id AS o_orderkey", "id % 50 AS o_custkey", "CASE id % 3 WHEN 0 THEN 'O' WHEN 1 THEN 'F' ELSE 'P' END AS o_orderstatus",
        "CAST(id AS double) AS o_totalprice", "CAST('1996-01-02' AS timestamp_ntz) AS o_orderdate", "'1-URGENT' AS o_orderpriority",
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = mixed_orders(spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    per_file = [r["count"] for r in docs.groupBy(F.input_file_name()).count().collect()]
    assert len(per_file) == 4 and sum(per_file) == 2000 and max(per_file) < 700
