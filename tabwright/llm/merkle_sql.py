"""SQL twin of the dataset manifest; levels are written out, for up to a million leaves a source."""

from __future__ import annotations

LEVELS = 5

_CRC32 = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, len({s}) + 1), lambda i: CAST(ord({s}[i]) AS BIGINT))),
  lambda a, b: list_reduce(list_prepend(xor(a, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""


def _leaf(text: str) -> str:
    def part(value: str) -> str:
        return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || {value}, '-')"

    return f"sha256({' || '.join(part(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


def _levels(name: str) -> str:
    """Tables name1.. above ``name0`` (grp, idx, n, h): parents of runs of 16; a lone node passes as it is."""
    return ",\n".join(
        f"""{name}{k}_steps AS (SELECT *, coalesce(string_agg(h, '') OVER (PARTITION BY grp, idx // 16 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS pre,
  coalesce(string_agg(h, '') OVER (PARTITION BY grp, idx // 16 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS post FROM {name}{k}),
{name}{k + 1} AS (SELECT grp, idx // 16 AS idx, (n + 15) // 16 AS n, CASE WHEN n = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY idx)) END AS h
  FROM {name}{k} GROUP BY grp, idx // 16, n)"""
        for k in range(LEVELS)
    )


def _climb(rows: str, name: str, grp: str, idx: str, out: str) -> str:
    """Fold ``x`` and collect ``p`` (all siblings) of ``rows`` over the levels of ``name``."""
    parts, last = [], rows
    for k in range(LEVELS):
        now = out if k == LEVELS - 1 else f"{out}{k}"
        parts.append(
            f"""{now} AS (SELECT r.* EXCLUDE (x, p), CASE WHEN s.n = 1 THEN x ELSE sha256(pre || x || post) END AS x,
  CASE WHEN s.n = 1 THEN p ELSE p || pre || post END AS p
  FROM {last} r JOIN {name}{k}_steps s ON s.grp = r.{grp} AND s.idx = r.{idx} // {16**k})"""
        )
        last = now
    return ",\n".join(parts)


SQL = f"""
WITH d AS (SELECT doc_id, {_leaf('text')} AS leaf, coalesce('=' || source, '-') AS grp,
  CASE WHEN {_CRC32.format(s='CAST(doc_id AS VARCHAR)')} % 5 = 0
    THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {_leaf('text')} END AS x FROM documents),
leaves AS (SELECT *, '' AS p, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY grp) AS n FROM d),
low0 AS (SELECT grp, idx, n, leaf AS h FROM leaves),
{_levels('low')},
top0 AS (SELECT '' AS grp, row_number() OVER (ORDER BY grp) - 1 AS idx, count(*) OVER () AS n, h, grp AS source FROM low{LEVELS}),
{_levels('top').replace("top0_steps AS (SELECT *", "top0_steps AS (SELECT grp, idx, n, h", 1)},
{_climb('leaves', 'low', 'grp', 'idx', 'folded')},
placed AS (SELECT f.* EXCLUDE (grp, idx, n), '' AS grp, t.idx, t.h AS subroot, top{LEVELS}.h AS root FROM folded f JOIN top0 t ON t.source = f.grp CROSS JOIN top{LEVELS}),
{_climb('placed', 'top', 'grp', 'idx', 'done')}
SELECT doc_id, leaf, subroot, root, sha256(p) AS proof_sha256, x AS folded_root, x = root AS verified FROM done"""
