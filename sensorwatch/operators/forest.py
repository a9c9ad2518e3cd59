"""Isolation forest (Liu, Ting and Zhou, 2008) on Spark.

Fitting reads its input twice. The first pass counts the copies of each row by a number that stands for its content (combined before the
shuffle, two numbers a row) and draws: every copy has a ticket in every tree, a function of number, copy, tree and seed, and the `sample_size`
smallest tickets of a tree are its sample. The tickets of copies come in ascending order from the order statistics of as many uniform
draws, so a row with any number of copies costs what it has drawn and stands for its share of all rows. The second pass
fetches the drawn rows. One task builds one tree from at most `sample_size` rows. Scoring is map-only.

Draws and splits are whole-number arithmetic, and path lengths are added as whole numbers: scores do not depend on partitioning, on
the order of rows, on task retries or on the number of rows, and another engine can redo them.
"""

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace
from math import ceil, log2

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import staged
from .skew import MAX_GROUP_ROWS, exact_quantiles

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MISSING = -999.0
#: Arithmetic of draws: numbers below this prime, so that a product of two fits 64 bits.
PRIME = 2_147_483_647
#: Path lengths are kept in whole parts of this size.
PATH_UNITS = 1_000_000_000
#: A model with at most so many nodes is scored by one SQL expression, a larger one by numpy over Arrow batches.
NATIVE_NODES = 1_500
NODE_SCHEMA = "tree int, node int, feature int, threshold double, size int, path double"


def mean_unsuccessful_path(n: float) -> float:
    """Expected path length of an unsuccessful search in a binary search tree of n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def scrambled(x):
    """A number below PRIME that looks unrelated to x; for numbers and for columns."""
    a = (x * 48_271 + 11) % PRIME
    b = (a * a + x) % PRIME
    c = (b * 69_621 + a) % PRIME
    return (c * c + b) % PRIME


def tree_numbers(seed: int, tree: int) -> tuple[int, int, int, int, int]:
    """What a tree draws by: two factors and two offsets of its tickets, and the number that its splits start from."""
    start = scrambled((seed * 31 + tree) % PRIME)
    made = [start := scrambled((start + k) % PRIME) for k in range(1, 6)]
    return 1 + made[0] % (PRIME - 1), made[1], 1 + made[2] % (PRIME - 1), made[3], made[4]


def _scramble(df: DataFrame, name: str, value: Column) -> DataFrame:
    """`scrambled` of a column, step by step, so that no step is computed more than once."""
    df = df.withColumn("_x", value).withColumn("_y", (F.col("_x") * 48_271 + 11) % PRIME)
    df = df.withColumn("_z", (F.col("_y") * F.col("_y") + F.col("_x")) % PRIME)
    df = df.withColumn("_y", (F.col("_z") * 69_621 + F.col("_y")) % PRIME)
    return df.withColumn(name, (F.col("_y") * F.col("_y") + F.col("_z")) % PRIME).drop("_x", "_y", "_z")


def _grow(points: np.ndarray, start: int, depth_limit: int) -> list[tuple]:
    """Nodes (heap position, feature, threshold, size, path length) of one tree; feature -1 is a leaf."""
    nodes, pending = [], [(0, 0, points)]
    while pending:
        position, depth, here = pending.pop()
        low, high = (here.min(axis=0), here.max(axis=0)) if len(here) else (np.zeros(0), np.zeros(0))
        splittable = np.flatnonzero(high > low)
        if depth >= depth_limit or len(splittable) == 0:
            nodes.append((position, -1, 0.0, len(here), depth + mean_unsuccessful_path(len(here))))
            continue
        chosen = int(splittable[scrambled((start + 2 * position) % PRIME) % len(splittable)])
        part = scrambled((start + 2 * position + 1) % PRIME) / PRIME
        threshold = float(low[chosen] + part * (high[chosen] - low[chosen]))
        if threshold >= high[chosen]:
            threshold = float(low[chosen])
        goes_left = here[:, chosen] <= threshold
        nodes.append((position, chosen, threshold, len(here), float(depth)))
        pending += [(2 * position + 1, depth + 1, here[goes_left]), (2 * position + 2, depth + 1, here[~goes_left])]
    return nodes


def _numeric(features: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(MISSING)), F.lit(MISSING)).alias(f) for f in features]


@dataclass
class IsolationForest:
    features: Sequence[str]
    seed: int
    contamination: float = 0.05
    trees: int = 100
    sample_size: int = 256

    def fit(self, df: DataFrame, row_id: Sequence[str] = (), number: Column | None = None) -> "ForestModel":
        """Build the trees. Rows that are equal in `row_id` and the features are copies.

        `number` may name the whole number that draws go by, one for each content, in place of a hash of these columns.
        """
        return self._fit(self._slim(df, row_id, number))

    def _slim(self, df: DataFrame, row_id: Sequence[str], number: Column | None) -> DataFrame:
        values = _numeric(self.features)
        ident = F.xxhash64(*row_id, *values) if number is None else number.cast("long")
        return df.select(ident.alias("_id"), *values)

    def _fit(self, rows: DataFrame) -> "ForestModel":
        features = list(self.features)
        available = rows.count()
        if available == 0:
            raise ValueError("no rows to fit")
        wanted = min(self.sample_size, available)
        drawn = self.draw(rows, wanted, available)
        # At most trees x sample_size numbers, whatever the size of the input.
        ids = F.broadcast(drawn.select("_id").distinct())
        points = rows.join(ids, "_id").groupBy("_id").agg(F.min(F.struct(*features)).alias("_p"))
        samples = drawn.join(points, "_id").select("tree", "place", *[F.col("_p")[f].alias(f) for f in features])
        depth_limit = max(1, ceil(log2(max(wanted, 2))))
        seed = self.seed

        def build(key: tuple, sample: pd.DataFrame) -> pd.DataFrame:
            tree = int(key[0])
            points = sample.sort_values("place")[features].to_numpy(dtype=float)
            nodes = _grow(points, tree_numbers(seed, tree)[4], depth_limit)
            grown = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "size", "path"])
            grown.insert(0, "tree", tree)
            return grown

        nodes = samples.groupBy("tree").applyInPandas(build, NODE_SCHEMA).collect()
        return ForestModel.from_nodes(features, nodes, wanted, depth_limit)

    def draw(self, rows: DataFrame, wanted: int, available: int) -> DataFrame:
        """tree, place, _id: the `wanted` smallest tickets of each tree, one place for each drawn copy.

        Only tickets below a level are listed; it is raised until every tree has enough, so it decides the cost alone.
        """
        counted = rows.groupBy("_id").agg(F.count(F.lit(1)).alias("_copies"))
        low = F.pmod(F.col("_id"), F.lit(PRIME))
        lanes = _scramble(counted, "_a", (low + self.seed % PRIME) % PRIME)
        lanes = _scramble(lanes, "_a", (F.col("_a") + F.pmod(F.expr(f"_id div {PRIME}"), F.lit(PRIME))) % PRIME)
        lanes = _scramble(lanes, "_b", (F.col("_a") + 1) % PRIME)
        numbers = [tree_numbers(self.seed, t) for t in range(self.trees)]
        factor = [F.array(*[F.lit(n[i]).cast("long") for n in numbers])[F.col("tree")] for i in range(4)]
        each = lanes.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(self.trees - 1))))
        each = each.withColumn("_hi", (F.col("_a") * factor[0] + factor[1]) % PRIME).withColumn("_lo", (F.col("_b") * factor[2] + factor[3]) % PRIME)
        level = (wanted + 8 * wanted**0.5) / available
        order = Window.partitionBy("tree").orderBy("ticket", "_id", "copy")
        while True:
            reach = min(level, 1.0)
            listed = staged(self._tickets(each, wanted, reach), "tickets")
            enough = listed.groupBy("tree").count().filter(F.col("count") >= wanted).count() == self.trees
            if enough or reach == 1.0:
                ranked = listed.withColumn("place", F.row_number().over(order))
                return ranked.filter(F.col("place") <= wanted).select("tree", "place", "_id")
            level *= 4

    @staticmethod
    def _tickets(each: DataFrame, wanted: int, reach: float) -> DataFrame:
        """tree, _id, copy, ticket of the copies with a ticket up to `reach`, at most `wanted` of a row."""
        part = lambda hi: (hi + (F.col("_lo") + 0.5) / float(PRIME)) / float(PRIME)
        first = F.when(F.col("_copies") == 1, part(F.col("_hi"))).otherwise(1 - F.pow(1 - part(F.col("_hi")), 1 / F.col("_copies")))
        near = each.withColumn("_first", first).filter(F.col("_first") <= reach)
        start = F.struct(F.col("_hi").alias("hi"), F.array("_first").alias("t"))

        def following(state: Column, r: Column) -> Column:
            hi = scrambled((state["hi"] + r) % PRIME)
            last = F.element_at(state["t"], -1)
            ticket = 1 - (1 - last) * F.pow(1 - part(hi), 1 / (F.col("_copies") - r + 1))
            return F.when(last > reach, state).otherwise(F.struct(hi.alias("hi"), F.array_append(state["t"], ticket).alias("t")))

        more = F.aggregate(F.sequence(F.lit(2).cast("long"), F.least("_copies", F.lit(wanted).cast("long"))), start, following)["t"]
        tickets = F.when(F.col("_copies") > 1, more).otherwise(F.array("_first"))
        found = near.select("tree", "_id", F.posexplode(tickets).alias("copy", "ticket"))
        return found.filter(F.col("ticket") <= reach)

    def fit_score(self, df: DataFrame, row_id: Sequence[str] = (), max_group_rows: int = MAX_GROUP_ROWS,
                  number: Column | None = None) -> tuple["ForestModel", DataFrame]:
        """Fit, score each row once into a written table, and set the cut from its exact quantile.

        Numbers and features are written first, because counting and fetching would each run the input's plan.
        """
        model = self._fit(staged(self._slim(df, row_id, number), "features"))
        scored = staged(model.score(df), "scored")
        model = model.with_cut(scored, self.contamination, max_group_rows)
        return model, model.label(scored)


def _units(path: float) -> int:
    return round(path * PATH_UNITS)


@dataclass
class ForestModel:
    """Trees as heap-ordered arrays. The size is bounded by the number of trees, not by the data."""

    features: list[str]
    sample_size: int
    depth_limit: int
    nodes: list[tuple] = field(repr=False)
    cut: float | None = None

    @classmethod
    def from_nodes(cls, features, nodes, sample_size, depth_limit, cut=None) -> "ForestModel":
        plain = sorted(tuple(n) for n in nodes)
        return cls(list(features), sample_size, depth_limit, plain, cut)

    def _arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Split features, thresholds and path lengths as (tree, heap position). A leaf above the
        last level sends every row left, down to a copy of its path length."""
        width, depth = 2 ** (self.depth_limit + 1) - 1, self.depth_limit
        order = {t: i for i, t in enumerate(sorted({n[0] for n in self.nodes}))}
        feature = np.zeros((len(order), width), dtype=np.int32)
        threshold = np.full((len(order), width), np.inf)
        path = np.zeros((len(order), width), dtype=np.int64)
        for tree, node, chosen, at, _, length in self.nodes:
            row = order[tree]
            if chosen >= 0:
                feature[row, node], threshold[row, node] = chosen, at
                continue
            last = node
            while last < 2**depth - 1:
                last = 2 * last + 1
            path[row, last] = _units(length)
        return feature, threshold, path

    def path_sql(self) -> str:
        """The summed path of a row in whole units as one SQL expression over the feature columns; plain enough for any engine."""
        trees: dict[int, dict[int, tuple]] = {}
        for tree, node, *rest in self.nodes:
            trees.setdefault(tree, {})[node] = rest
        value = [f"CASE WHEN {f} IS NULL OR isnan(CAST({f} AS DOUBLE)) THEN {MISSING:.1E} ELSE CAST({f} AS DOUBLE) END" for f in self.features]

        def branch(nodes: dict[int, tuple], at: int) -> str:
            feature, threshold, _, length = nodes[at]
            if feature < 0:
                return str(_units(length))
            return f"CASE WHEN {value[feature]} <= {threshold:.17E} THEN {branch(nodes, 2 * at + 1)} ELSE {branch(nodes, 2 * at + 2)} END"

        return " + ".join(f"CAST({branch(nodes, 0)} AS BIGINT)" for _, nodes in sorted(trees.items()))

    def score_sql(self) -> str:
        """`score_column` as SQL text."""
        trees = len({n[0] for n in self.nodes})
        return f"pow(2.0E0, -(({self.path_sql()}) / {float(PATH_UNITS):.1E} / {trees} / {self._scale():.17E}))"

    def _scale(self) -> float:
        return float(max(mean_unsuccessful_path(self.sample_size), 1.0))

    def score_column(self, spark: SparkSession, native: bool | None = None) -> Column:
        """Outlier score in (0, 1]; higher is more isolated. A small model stays in the JVM."""
        if native or native is None and len(self.nodes) <= NATIVE_NODES:
            return F.expr(self.score_sql())
        shared = spark.sparkContext.broadcast(self._arrays())
        depth, scale = self.depth_limit, self._scale()

        @F.pandas_udf("double")
        def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            feature, threshold, path = shared.value
            for batch in batches:
                columns = batch if isinstance(batch, tuple) else (batch,)
                points = np.column_stack([c.to_numpy(dtype=float) for c in columns])
                flat, offsets = points.ravel(), np.arange(len(points)) * points.shape[1]
                total = np.zeros(len(points), dtype=np.int64)
                for split, at, length in zip(feature, threshold, path):
                    node = np.zeros(len(points), dtype=np.intp)
                    for _ in range(depth):
                        node = 2 * node + 1 + (flat[offsets + split[node]] > at[node])
                    total += length[node]
                yield pd.Series(np.exp2(-(total / float(PATH_UNITS) / len(feature) / scale)))

        return score(*_numeric(self.features))

    def score(self, df: DataFrame) -> DataFrame:
        return df.withColumn("score", self.score_column(df.sparkSession))

    def with_cut(self, scored: DataFrame, contamination: float, max_group_rows: int = MAX_GROUP_ROWS) -> "ForestModel":
        level = exact_quantiles(scored, "score", {"cut": 1 - contamination}, (), max_group_rows)
        return replace(self, cut=level.first()["cut"])

    def label(self, scored: DataFrame) -> DataFrame:
        """-1 for scores strictly beyond the cut, 1 otherwise."""
        return scored.withColumn("outlier", F.when(F.col("score") > self.cut, -1).otherwise(1))

    def predict(self, df: DataFrame) -> DataFrame:
        return self.label(self.score(df))

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.nodes, NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        facts = [(self.features, self.sample_size, self.depth_limit, self.cut)]
        schema = "features array<string>, sample_size int, depth_limit int, cut double"
        spark.createDataFrame(facts, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/facts")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "ForestModel":
        facts = spark.read.parquet(f"{path}/facts").first()
        nodes = spark.read.parquet(f"{path}/nodes").collect()
        return cls.from_nodes(facts["features"], nodes, facts["sample_size"], facts["depth_limit"], facts["cut"])


def contamination_sweep(scored: DataFrame, levels: Sequence[float], score: str = "score",
                        max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Threshold and number of flagged rows for each contamination level, from one scored table."""
    names = {f"_c{i}": 1 - level for i, level in enumerate(levels)}
    cuts = exact_quantiles(scored, score, names, (), max_group_rows)
    packed = cuts.select(F.struct(*names).alias("c")).scalar()
    counted = scored.select(score).withColumn("c", packed).agg(
        F.count(score).alias("rows"), F.first("c").alias("c"),
        *[F.count_if(F.col(score) > F.col(f"c.{n}")).alias(f"n{n}") for n in names],
    )
    rows = [
        F.struct(F.lit(level).alias("contamination"), F.col(f"c.{n}").alias("cut"), F.col(f"n{n}").alias("flagged"))
        for n, level in zip(names, levels)
    ]
    return counted.select("rows", F.inline(F.array(*rows)))
