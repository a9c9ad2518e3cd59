"""The isolation forest as SQL text: draws, splits, scores and cut, step by step as common table expressions."""

from collections.abc import Sequence
from math import ceil, log2

from ...operators.forest import PATH_UNITS, PRIME, mean_unsuccessful_path, tree_numbers

P = f"{PRIME}.0E0"


def _scrambled(name: str, value: str) -> str:
    """`scrambled` as a chain of named columns."""
    return (
        f"{value} AS {name}_x, ({name}_x * 48271 + 11) % {PRIME} AS {name}_y, ({name}_y * {name}_y + {name}_x) % {PRIME} AS {name}_z, "
        f"({name}_z * 69621 + {name}_y) % {PRIME} AS {name}_w, ({name}_w * {name}_w + {name}_z) % {PRIME} AS {name}"
    )


def _part(hi: str) -> str:
    return f"(({hi} + (lo + 5E-1) / {P}) / {P})"


def draw_ctes(source: str, seed: int, trees: int, sample: int) -> str:
    """chosen(tree, place, _id) from the numbers `_id` (not negative) of a source."""
    listed = ", ".join(str((t, *tree_numbers(seed, t))) for t in range(trees))
    step = f"((hi + r + 1) % {PRIME})"
    return f"""
sizes AS (SELECT count(*) AS rows, least(count(*), {sample}) AS wanted, least(1E0, (least(count(*), {sample}) + 8 * sqrt(least(count(*), {sample}))) / count(*)) AS reach FROM {source}),
counted AS (SELECT _id, count(*) AS c FROM {source} GROUP BY _id),
lanes AS (SELECT _id, c, {_scrambled("s", f"((_id % {PRIME} + {seed % PRIME}) % {PRIME})")}, {_scrambled("a", f"((s + (_id // {PRIME}) % {PRIME}) % {PRIME})")}, {_scrambled("b", f"((a + 1) % {PRIME})")} FROM counted),
trees(tree, f1, o1, f2, o2, start) AS (VALUES {listed}),
tickets AS (SELECT tree, _id, c, (a * f1 + o1) % {PRIME} AS hi, (b * f2 + o2) % {PRIME} AS lo FROM lanes, trees),
near AS (SELECT tree, _id, c, hi, lo, CAST(1 AS BIGINT) AS r, CASE WHEN c = 1 THEN {_part("hi")} ELSE 1 - pow(1 - {_part("hi")}, 1 / c) END AS v FROM tickets),
copies AS (
  SELECT n.* FROM near n, sizes WHERE v <= reach UNION ALL
  SELECT tree, _id, c, next AS hi, lo, r + 1 AS r, 1 - (1 - v) * pow(1 - {_part("next")}, 1 / (c - r)) AS v
  FROM (SELECT k.*, {_scrambled("next", step)} FROM copies k, sizes WHERE k.r < k.c AND k.r < wanted AND k.v <= reach)
),
chosen AS (
  SELECT tree, place, _id FROM (SELECT tree, _id, row_number() OVER (PARTITION BY tree ORDER BY v, _id, r) AS place FROM copies, sizes WHERE v <= reach), sizes WHERE place <= wanted)"""


def forest_ctes(source: str, features: Sequence[str], seed: int, trees: int = 100, sample: int = 256) -> str:
    """scores(_id, score) besides the draw; the source holds `_id` and numeric features without gaps, and more rows than a sample."""
    limit, names = ceil(log2(sample)), ", ".join(features)
    pick = lambda prefix, at: "CASE " + at + "".join(f" WHEN {i} THEN {prefix}{f}" for i, f in enumerate(features)) + " END"
    range_of = ", ".join(f"min({f}) AS lo_{f}, max({f}) AS hi_{f}" for f in features)
    able = ", ".join(f"CASE WHEN hi_{f} > lo_{f} THEN {i} END" for i, f in enumerate(features))
    parts = [
        draw_ctes(source, seed, trees, sample),
        f"points AS MATERIALIZED (SELECT _id, {', '.join(f'min({f}) AS {f}' for f in features)} FROM {source} GROUP BY _id)",
        f"rows0 AS MATERIALIZED (SELECT tree, start, CAST(0 AS BIGINT) AS node, {names} FROM chosen JOIN points USING (_id) JOIN trees USING (tree))",
    ]
    for d in range(limit):
        parts += [
            f"nodes{d} AS (SELECT tree, start, node, count(*) AS n, {range_of} FROM rows{d} GROUP BY tree, start, node)",
            f"""splits{d} AS MATERIALIZED (
  SELECT tree, node, n, picked, CASE WHEN t >= high THEN low ELSE t END AS threshold FROM (
    SELECT *, {_scrambled("p", f"((start + 2 * node) % {PRIME})")}, {_scrambled("q", f"((start + 2 * node + 1) % {PRIME})")},
      CASE WHEN len(able) > 0 THEN able[1 + p % len(able)] END AS picked, {pick("lo_", "picked")} AS low, {pick("hi_", "picked")} AS high, low + q / {P} * (high - low) AS t
    FROM (SELECT *, [x FOR x IN [{able}] IF x IS NOT NULL] AS able FROM nodes{d})))""",
            f"rows{d + 1} AS MATERIALIZED (SELECT r.tree, r.start, r.node * 2 + CASE WHEN {pick('r.', 'picked')} <= threshold THEN 1 ELSE 2 END AS node, {names} FROM rows{d} r JOIN splits{d} s ON r.tree = s.tree AND r.node = s.node WHERE picked IS NOT NULL)",
        ]
    ends = " UNION ALL ".join(
        [f"SELECT tree, node, n, {d} AS depth FROM splits{d} WHERE picked IS NULL" for d in range(limit)]
        + [f"SELECT tree, node, count(*) AS n, {limit} AS depth FROM rows{limit} GROUP BY tree, node"]
    )
    path = f"CASE WHEN n = 1 THEN 0E0 WHEN n = 2 THEN 1E0 ELSE 2E0 * (ln(n - 1E0) + 0.57721566490153286E0) - 2E0 * (n - 1E0) / n END"
    parts += [
        f"ends AS MATERIALIZED (SELECT tree, node, CAST(round((depth + {path}) * {PATH_UNITS}) AS BIGINT) AS units FROM ({ends}))",
        "inner_nodes AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT tree, node, picked, threshold FROM splits{d} WHERE picked IS NOT NULL" for d in range(limit)) + ")",
        f"walk0 AS (SELECT _id, tree, CAST(0 AS BIGINT) AS node, {names} FROM points, trees)",
    ]
    for d in range(limit):
        parts.append(
            f"walk{d + 1} AS (SELECT _id, w.tree, CASE WHEN picked IS NULL THEN w.node ELSE w.node * 2 + CASE WHEN {pick('w.', 'picked')} <= threshold THEN 1 ELSE 2 END END AS node, {names} "
            f"FROM walk{d} w LEFT JOIN inner_nodes i ON w.tree = i.tree AND w.node = i.node)"
        )
    scale = float(max(mean_unsuccessful_path(sample), 1.0))
    parts.append(
        f"scores AS MATERIALIZED (SELECT _id, pow(2E0, -(CAST(sum(units) AS BIGINT) / {float(PATH_UNITS):.1E} / {trees} / {scale:.17E})) AS score "
        f"FROM walk{limit} w JOIN ends e ON w.tree = e.tree AND w.node = e.node GROUP BY _id)"
    )
    return ",\n".join(parts)


def labelled_ctes(source: str, features: Sequence[str], seed: int, contamination: float, trees: int = 100, sample: int = 256) -> str:
    """labelled: the source's columns with score and outlier."""
    return forest_ctes(source, features, seed, trees, sample) + f""",
cut AS (SELECT quantile_cont(score, {1 - contamination!r}) AS cut FROM {source} JOIN scores USING (_id)),
labelled AS (SELECT s.*, score, CASE WHEN score > cut THEN -1 ELSE 1 END AS outlier FROM {source} s JOIN scores USING (_id), cut)"""
