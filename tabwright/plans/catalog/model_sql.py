"""SQL twins of the queries that search, fit, ensemble and score the one-pass learners.

The twins fit every candidate of every fold from plain aggregates over the line items and share no
code with the learners.
"""

from __future__ import annotations

from tabwright.plans.catalog.common import sql_round
from tabwright.plans.catalog.evaluate_queries import sql_panel
from tabwright.plans.catalog.sample_queries import sql_hash

_SEED, _FOLDS, _REPEATS = 10001, 5, 10
#: Candidates in the order that the seed gives: name, smoothing, whether classes share variances.
_BAYES = [
    ("gaussian_bayes/no_preprocessing(smoothing=0.0)", 1e-9, False), ("pooled_bayes/no_preprocessing(smoothing=0.0)", 1e-9, True),
    ("gaussian_bayes/no_preprocessing(smoothing=0.01)", 0.01, False), ("pooled_bayes/no_preprocessing(smoothing=0.1)", 0.1, True),
    ("gaussian_bayes/no_preprocessing(smoothing=0.1)", 0.1, False), ("gaussian_bayes/no_preprocessing(smoothing=1.0)", 1.0, False),
]
_RIDGE = [0.0, 0.01, 0.1]
_NUMBERS, _TEXTS = ["d", "q", "t"], ["ls", "rf"]
_ID = sql_hash("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
_HELD = f"{sql_hash(str(_SEED), 'id')} / {16**15}.0::DOUBLE < 0.2::DOUBLE"
_FOLD = f"{sql_hash(repr(f'fold{_SEED}'), 'id')} % {_FOLDS}"


def _candidates() -> str:
    rows = ", ".join(f"({i}, '{name}', {smoothing}::DOUBLE, {pooled})" for i, (name, smoothing, pooled) in enumerate(_BAYES))
    return f"cands(cand, name, smoothing, pooled) AS (VALUES {rows})"


def _bayes_models() -> str:
    """CTEs up to ``model``: one row per candidate, left-out fold (-1: none) and class; rows of ``lines`` hold coded features."""
    stats = ", ".join(f"avg({x}) AS m_{x}, var_pop({x}) AS v_{x}" for x in _NUMBERS)
    own = ", ".join(f"var_pop({x}) AS o_{x}" for x in _NUMBERS)
    pooled = ", ".join(f"sum(v_{x} * n) OVER w / sum(n) OVER w AS i_{x}" for x in _NUMBERS)
    variance = ", ".join(
        f"CASE WHEN pooled THEN i_{x} ELSE v_{x} END + smoothing * CASE WHEN o_{x} > 0 THEN o_{x} ELSE 1 END AS s_{x}" for x in _NUMBERS
    )
    shares = ",\n".join(
        f"""share_{c} AS (SELECT k.f, k.y AS label, code, ln((count(train.id) + 1) / (any_value(k.n) + (SELECT count(DISTINCT {c}) FROM lines))) AS part
  FROM classes k, (SELECT DISTINCT {c} AS code FROM lines) LEFT JOIN train ON train.y = k.y AND train.fold <> k.f AND train.{c} = code
  GROUP BY k.f, k.y, code)"""
        for c in _TEXTS
    )
    return f"""
src AS (SELECT {_ID} AS id, l_discount AS d, l_linestatus AS ls_text, l_quantity AS q, l_returnflag AS rf_text, nullif(l_tax, 0) AS t0,
    l_quantity * (1 - l_discount) * (1 + l_tax) AS net FROM lineitem),
named AS (SELECT *, CASE WHEN net < 6 THEN 'low' WHEN net < 30 THEN 'mid' ELSE 'high' END AS band,
    coalesce(t0, (SELECT median(t0) FROM src)) AS t FROM src),
lines AS MATERIALIZED (SELECT *, CAST(row_number() OVER () AS VARCHAR) AS rid, dense_rank() OVER (ORDER BY band) - 1 AS y, dense_rank() OVER (ORDER BY ls_text) - 1 AS ls,
    dense_rank() OVER (ORDER BY rf_text) - 1 AS rf, {_HELD} AS held, {_FOLD} AS fold FROM named),
train AS MATERIALIZED (SELECT * FROM lines WHERE NOT held),
parts AS (SELECT unnest(range(-1, {_FOLDS})) AS f),
classes AS MATERIALIZED (SELECT f, y, count(*) AS n, {stats} FROM train JOIN parts ON fold <> f GROUP BY f, y),
whole AS (SELECT f, count(*) AS n_all, {own} FROM train JOIN parts ON fold <> f GROUP BY f),
{_candidates()},
model AS MATERIALIZED (SELECT cand, f, y AS label, ln(n / n_all) AS prior, {', '.join(f'm_{x}' for x in _NUMBERS)}, {variance}
  FROM (SELECT *, {pooled} FROM classes WINDOW w AS (PARTITION BY f)) JOIN whole USING (f), cands),
{shares}"""


def _number_term(x: str, value: str | None = None) -> str:
    value = value or x
    return f"(-0.5 / s_{x}) * ({value} - m_{x}) * ({value} - m_{x}) - 0.5 * ln(2 * pi() * s_{x})"


def _scored(name: str, rows: str, on: str) -> str:
    """CTE of (cand, rid, y, label, p): probabilities of ``rows`` by the models that ``on`` picks."""
    joint = " + ".join(["prior", *map(_number_term, _NUMBERS), *[f"share_{c}.part" for c in _TEXTS]])
    shares = " ".join(f"JOIN share_{c} ON share_{c}.f = model.f AND share_{c}.label = model.label AND share_{c}.code = r.{c}" for c in _TEXTS)
    return f"""{name} AS MATERIALIZED (
  SELECT cand, rid, y, label, exp(j - max(j) OVER w) / sum(exp(j - top)) OVER w AS p FROM (
    SELECT *, max(j) OVER (PARTITION BY cand, rid) AS top FROM (
      SELECT model.cand, r.rid, r.y, model.label, {joint} AS j FROM {rows} r JOIN model ON {on} {shares}))
  WINDOW w AS (PARTITION BY cand, rid))"""


_GUESS = "(SELECT cand, rid, any_value(y) AS y, arg_min(label, struct_pack(a := -p, b := label)) AS yhat FROM {0} GROUP BY cand, rid)"
_CV = f"""{_bayes_models()},
{_scored('oof', 'train', 'model.f = r.fold')},
scores AS MATERIALIZED (SELECT cand, avg(CAST(yhat = y AS INTEGER)) AS score FROM {_GUESS.format('oof')} GROUP BY cand)"""
_BEST = "best AS (SELECT cand FROM scores ORDER BY score DESC, cand LIMIT 1)"
_CHOSEN = "model.f = -1 AND model.cand = (SELECT cand FROM best)"


def cv_search() -> str:
    return f"""WITH {_CV}
SELECT CAST(cand AS INTEGER) AS run, split_part(name, '/', 1) AS candidate, name AS params, {sql_round('score')} AS score,
  'ok' AS status, CAST(NULL AS VARCHAR) AS message, true AS timed FROM scores JOIN cands USING (cand)"""


def search_summary() -> str:
    return f"WITH {_CV} SELECT 'ok' AS status, count(*) AS runs, {sql_round('max(score)')} AS best_score FROM scores"


def ensemble_rounds(pool: int, rounds: int) -> str:
    """Greedy rounds as a recursion that carries every row's running sums; ties go to the earlier candidate."""
    labels, members = range(3), range(pool)
    wide = ", ".join(f"max(p) FILTER (place = {c} AND label = {k}) AS p{c}{k}" for c in members for k in labels)

    def hit(c: int) -> str:
        s = [f"(s{k} + p{c}{k})" for k in labels]
        guess = f"CASE WHEN {s[0]} >= {s[1]} AND {s[0]} >= {s[2]} THEN 0 WHEN {s[1]} >= {s[2]} THEN 1 ELSE 2 END"
        return f"avg(CAST({guess} = y AS INTEGER)) OVER () AS a{c}"

    moved = ", ".join(f"s{k} + CASE pick {' '.join(f'WHEN {c} THEN p{c}{k}' for c in members)} END AS s{k}" for k in labels)
    top = f"greatest({', '.join(f'a{c}' for c in members)})"
    pick = "CASE " + " ".join(f"WHEN a{c} = {top} THEN {c}" for c in members) + " END"
    kept = ", ".join(f"p{c}{k}" for c in members for k in labels)
    return f"""WITH RECURSIVE {_CV},
pool AS (SELECT cand, row_number() OVER (ORDER BY score DESC, cand) - 1 AS place, rank_of FROM
  (SELECT *, row_number() OVER (ORDER BY score DESC, cand) AS rank_of FROM scores) WHERE rank_of <= {pool}),
ordered AS MATERIALIZED (SELECT cand, row_number() OVER (ORDER BY cand) - 1 AS place FROM pool),
wide AS MATERIALIZED (SELECT rid, any_value(y) AS y, {wide} FROM oof JOIN ordered USING (cand) GROUP BY rid),
walk AS (
  SELECT -1 AS round, y, 0.0::DOUBLE AS s0, 0.0::DOUBLE AS s1, 0.0::DOUBLE AS s2, {kept}, 0 AS pick, 0.0::DOUBLE AS score FROM wide
  UNION ALL
  SELECT round + 1, y, {moved}, {kept}, pick, score FROM (
    SELECT round, y, s0, s1, s2, {kept}, {pick} AS pick, {top} AS score FROM (
      SELECT *, {', '.join(hit(c) for c in members)} FROM walk WHERE round < {rounds - 1})))
SELECT CAST(round AS INTEGER) AS round, any_value(name) AS candidate, {sql_round('max(score)')} AS score
FROM (SELECT DISTINCT round, pick, score FROM walk WHERE round >= 0) JOIN ordered ON pick = place JOIN cands USING (cand) GROUP BY round"""


def refit_holdout() -> str:
    test = "(SELECT * FROM lines WHERE held)"
    pred = f"""pred AS MATERIALIZED (SELECT rid, any_value(y) AS y, list(p ORDER BY label) AS proba,
  arg_min(label, struct_pack(a := -p, b := label)) AS yhat FROM tested GROUP BY rid)"""
    return sql_panel(f"{_CV}, {_BEST}, {_scored('tested', test, _CHOSEN)}, {pred}", False)


def perm_importance() -> str:
    """Each swapped variant is scored from scratch, unlike in the query."""
    features = {"l_discount": "d", "l_linestatus": "ls", "l_quantity": "q", "l_returnflag": "rf", "l_tax": "t"}
    packed = "struct_pack(d := d, ls := ls, q := q, rf := rf, t := t)"
    variants = " UNION ALL ".join(
        f"SELECT '{name}#' || repeat || '#' || rid AS rid, y, " + ", ".join(f"nxt.{c} AS {c}" if c == x else c for c in features.values()) + " FROM borrowed"
        for name, x in features.items()
    )
    mean = sql_round("avg(base - share)")
    return f"""WITH {_CV}, {_BEST},
test AS MATERIALIZED (SELECT * FROM lines WHERE held),
{_scored('tested', 'test', _CHOSEN)},
base AS (SELECT avg(CAST(yhat = y AS INTEGER)) AS base FROM {_GUESS.format('tested')}),
hashed AS (SELECT *, {sql_hash(str(_SEED), 'repeat', 'id')} AS h FROM test, (SELECT unnest(range({_REPEATS})) AS repeat)),
borrowed AS MATERIALIZED (SELECT *, coalesce(lead({packed}) OVER w, first_value({packed}) OVER w) AS nxt
  FROM hashed WINDOW w AS (PARTITION BY repeat ORDER BY h, id)),
variants AS ({variants}),
{_scored('moved', 'variants', _CHOSEN)},
drops AS (SELECT split_part(rid, '#', 1) AS feature, split_part(rid, '#', 2) AS repeat, avg(CAST(yhat = y AS INTEGER)) AS share
  FROM {_GUESS.format('moved')} GROUP BY 1, 2)
SELECT feature, {mean} AS mean, {sql_round('stddev_pop(base - share)')} AS std,
  CAST(row_number() OVER (ORDER BY {mean} DESC, feature) AS INTEGER) AS rank,
  CAST((row_number() OVER (ORDER BY {mean} DESC, feature) - 1) // 20 AS INTEGER) AS page
FROM drops, base GROUP BY feature"""


def score_lines() -> str:
    return f"""WITH {_CV}, {_BEST}, {_scored('everything', 'lines', _CHOSEN)},
guess AS (SELECT rid, arg_min(label, struct_pack(a := -p, b := label)) AS yhat FROM everything GROUP BY rid)
SELECT id AS pos, d AS l_discount, ls_text AS l_linestatus, q AS l_quantity, rf_text AS l_returnflag, t AS l_tax, names.band
FROM lines JOIN guess USING (rid) JOIN (SELECT DISTINCT y, band FROM lines) names ON names.y = yhat"""


def regression_search() -> str:
    """Normal equations of every fold and ridge by Gauss-Jordan elimination, column by column."""
    terms = ["one", "d", "q", "rf1", "rf2", "t"]
    k = range(len(terms))
    sums = ", ".join(f"sum({terms[i]} * {terms[j]}) AS s{min(i, j)}_{max(i, j)}" for i in k for j in k if i <= j)
    right = ", ".join(f"sum({terms[i]} * y) AS r{i}" for i in k)
    start = ", ".join(
        f"s{min(i, j)}_{max(i, j)}" + (" + ridge * s0_0" if i == j and i else "") + f" AS a{i}_{j}" for i in k for j in k
    ) + ", " + ", ".join(f"r{i} AS a{i}_{len(terms)}" for i in k)
    steps = []
    for p in k:
        cols = [
            (f"a{p}_{j} / a{p}_{p}" if i == p else f"a{i}_{j} - a{i}_{p} * a{p}_{j} / a{p}_{p}") + f" AS a{i}_{j}"
            for i in k for j in range(len(terms) + 1)
        ]
        steps.append(f"g{p + 1} AS MATERIALIZED (SELECT cand, f, {', '.join(cols)} FROM g{p})")
    guess = " + ".join(f"a{i}_{len(terms)} * {t}" for i, t in enumerate(terms))
    miss = "(y - yhat)"
    return f"""WITH src AS (SELECT {_ID} AS id, 1.0::DOUBLE AS one, l_discount AS d, l_quantity AS q, l_tax AS t, l_returnflag,
  l_quantity * (1 - l_discount) AS y FROM lineitem),
lines AS MATERIALIZED (SELECT *, CAST(code = 1 AS DOUBLE) AS rf1, CAST(code = 2 AS DOUBLE) AS rf2, {_HELD} AS held, {_FOLD} AS fold
  FROM (SELECT *, dense_rank() OVER (ORDER BY l_returnflag) - 1 AS code FROM src)),
parts AS (SELECT unnest(range(-1, {_FOLDS})) AS f),
cands(cand, ridge) AS (VALUES {', '.join(f'({i}, {r}::DOUBLE)' for i, r in enumerate(_RIDGE))}),
sums AS MATERIALIZED (SELECT f, {sums}, {right} FROM lines JOIN parts ON fold <> f WHERE NOT held GROUP BY f),
g0 AS (SELECT cand, f, {start} FROM sums, cands),
{', '.join(steps)},
oof AS (SELECT cand, y, {guess} AS yhat FROM lines JOIN g{len(terms)} ON f = fold WHERE NOT held),
best AS (SELECT cand FROM oof GROUP BY cand ORDER BY sqrt(avg({miss} * {miss})), cand LIMIT 1),
tested AS (SELECT y, {guess} AS yhat FROM lines, g{len(terms)} WHERE held AND f = -1 AND cand = (SELECT cand FROM best))
SELECT {sql_round(f'sqrt(avg({miss} * {miss}))')} AS rmse, {sql_round(f'avg(abs{miss})')} AS mae,
  {sql_round(f'1 - sum({miss} * {miss}) / (var_pop(y) * count(*))')} AS r2 FROM tested"""
