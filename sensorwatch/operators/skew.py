"""Grouped work that stays balanced when one group holds a large share of the rows.

A group is hot when it has more than `max_group_rows` rows. Hot groups are found by one counting
job (map-side combined) and kept as a table of key hashes, which plans join: a plan does not grow with
their number. The splits only decide where rows are processed; every result is exact for any choice of splits.
"""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import staged

MAX_GROUP_ROWS = 5_000_000
#: So many hot groups come to the driver and back as a local table; more are written to the shared folder.
LISTED_GROUPS = 1_000
#: Up to so many hot groups (two numbers each, 32 MB) are broadcast; more are joined by shuffle.
BROADCAST_GROUPS = 2_000_000


@dataclass(frozen=True)
class HotGroups:
    """The groups above a limit: a table (_h, _rows) of key hashes and row counts, the number of groups, and their rows together."""

    table: DataFrame | None = None
    groups: int = 0
    rows: int = 0

    def __bool__(self) -> bool:
        return self.groups > 0

    def joined(self) -> DataFrame:
        """The table as it should be joined."""
        return F.broadcast(self.table) if self.groups <= BROADCAST_GROUPS else self.table


NO_GROUPS = HotGroups()


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys]) if keys else F.lit(0).cast("long")


def hot_groups(df: DataFrame, keys: Sequence[str], max_group_rows: int = MAX_GROUP_ROWS) -> HotGroups:
    """The groups of a frame above the limit."""
    return hot_groups_of(df, [keys], max_group_rows)[0]


def hot_groups_of(df: DataFrame, key_sets: Sequence[Sequence[str]], max_group_rows: int = MAX_GROUP_ROWS) -> list[HotGroups]:
    """The same for several keys of one frame, in one job over the key columns alone."""
    spark = df.sparkSession
    if len(key_sets) == 1:
        hashes = df.select(F.lit(0).alias("k"), key_hash(key_sets[0]).alias("_h"))
    else:
        hashes = df.select(F.posexplode(F.array(*[key_hash(k) for k in key_sets])).alias("k", "_h"))
    large = hashes.groupBy("k", "_h").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > max_group_rows)
    listed = large.orderBy(F.desc("_rows")).limit(LISTED_GROUPS + 1).collect()
    found = []
    if len(listed) <= LISTED_GROUPS:
        for i in range(len(key_sets)):
            mine = [(r["_h"], r["_rows"]) for r in listed if r["k"] == i]
            table = spark.createDataFrame(mine, "_h long, _rows long") if mine else None
            found.append(HotGroups(table, len(mine), sum(n for _, n in mine)))
        return found
    written = staged(large, "hot")
    totals = {r["k"]: (r["n"], r["rows"]) for r in written.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("_rows").alias("rows")).collect()}
    for i in range(len(key_sets)):
        groups, rows = totals.get(i, (0, 0))
        found.append(HotGroups(written.filter(F.col("k") == i).select("_h", "_rows"), groups, rows) if groups else NO_GROUPS)
    return found


def attach(rows: DataFrame, groups: DataFrame, keys: Sequence[str], hot: HotGroups = NO_GROUPS,
           max_group_rows: int = MAX_GROUP_ROWS, how: str = "inner", spread: str | None = None) -> DataFrame:
    """Join a frame with few rows per key (`groups`) to many rows per key.

    Without keys `groups` is one row and is read as a scalar subquery. Rows of a hot key are spread
    over salts, and the matching `groups` rows are repeated once per salt. Any row-preserving or
    filtering join type works, because each row of `rows` meets each partner exactly once. Salts are
    hashes of the row (of its columns that can be hashed), so a repeated task salts alike; exact
    copies share a salt, and a partition they overfill is split by adaptive execution. The hash is made
    before any shuffle, so that columns nobody reads later are not shuffled for it; `spread` names a column
    that holds it already, as in a chain of joins.
    """
    if not keys:
        packed = groups.select(F.struct("*")).scalar()
        added = [c for c in groups.columns]
        return rows.withColumn("_packed", packed).select("*", *[F.col("_packed")[c].alias(c) for c in added]).drop("_packed")
    if not hot:
        return rows.join(groups, list(keys), how)
    hashed = rows.withColumn("_row", row_hash(rows) if spread is None else F.col(spread))
    salted_rows = _with_salts(hashed, keys, hot, max_group_rows)
    salted_rows = salted_rows.withColumn("_salt", F.pmod("_row", F.col("_salts"))).drop("_salts", "_row")
    salted_groups = _with_salts(groups, keys, hot, max_group_rows)
    salted_groups = salted_groups.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1))).drop("_salts")
    return salted_rows.join(salted_groups, [*keys, "_salt"], how).drop("_salt")


def _with_salts(df: DataFrame, keys: Sequence[str], hot: HotGroups, max_group_rows: int) -> DataFrame:
    """Add `_salts`: 1, or for a hot key the power of two that leaves at most `max_group_rows` rows for each salt."""
    salts = F.pow(F.lit(2), F.ceil(F.log2(F.ceil(F.col("_rows") / max_group_rows)))).cast("long")
    marked = df.withColumn("_key", key_hash(keys)).join(hot.joined().withColumnRenamed("_h", "_key"), "_key", "left")
    return marked.withColumn("_salts", F.coalesce(salts, F.lit(1).cast("long"))).drop("_key", "_rows")


def row_hash(df: DataFrame) -> Column:
    """A hash of the columns without a map, which has no hash."""
    return F.xxhash64(*[f.name for f in df.schema if "map<" not in f.dataType.simpleString()])


def split_hot_groups(df: DataFrame, keys: Sequence[str], order: Sequence[str], hot: HotGroups,
                     max_group_rows: int) -> DataFrame:
    """Add `_hot` and `_part`; the parts of a hot group follow each other in the given order.

    Rows of hot groups are ranged by key and by the whole order, whatever its types; ties in the first
    columns are cut by the later ones. The ranges are written to the shared folder, so that every plan
    over the result, and every repeated task, sees the same parts.
    """
    parts = max(2, -(-2 * hot.rows // max_group_rows))
    marked = df.withColumn("_h", key_hash(keys))
    chosen = marked.join(hot.joined(), "_h", "left_semi") if keys else marked
    ranged = chosen.drop("_h").repartitionByRange(parts, *keys, *order)
    ranged = staged(ranged.withColumns({"_hot": F.lit(True), "_part": F.spark_partition_id()}), "ranges")
    if not keys:
        return ranged
    rest = marked.join(hot.joined(), "_h", "left_anti").drop("_h")
    return ranged.unionByName(rest.withColumns({"_hot": F.lit(False), "_part": F.lit(-1)}))


def _value_parts(values: DataFrame, hot: HotGroups, keys: Sequence[str], max_group_rows: int) -> DataFrame:
    """Add `_part` to rows (keys, _v): hot groups are cut at sampled values, searched by bisection."""
    parts = max(2, -(-hot.rows // max_group_rows))
    values = values.withColumn("_h", key_hash(keys))
    values = values.join(hot.joined(), "_h", "left").drop("_h") if keys else values.withColumn("_rows", F.col("_h")).drop("_h")
    is_hot = F.col("_rows").isNotNull()
    share = min(1.0, 2000 * parts / max(hot.rows, 1))
    levels = [i / parts for i in range(1, parts)]
    points = values.filter(is_hot).sample(share, seed=1).approxQuantile("_v", levels, 1 / (4 * parts))
    inner = sorted({p for p in points if p not in (float("-inf"), float("inf"))}) or [0.0]
    edges = [float("-inf"), *inner, float("inf")]
    cut = Bucketizer(splits=edges, inputCol="_v", outputCol="_cut", handleInvalid="keep").transform(values)
    return cut.withColumn("_part", F.when(is_hot, F.col("_cut").cast("int")).otherwise(F.lit(-1))).drop("_cut", "_rows")


def rolling(df: DataFrame, aggregates: Mapping[str, Column], keys: Sequence[str], order: Sequence[str],
            rows: int = 10, max_group_rows: int = MAX_GROUP_ROWS, hot: HotGroups | None = None) -> DataFrame:
    """Aggregates over the current and the previous `rows - 1` rows of each group.

    `order` must be a total order within a group. Groups up to `max_group_rows` use one plain window.
    A larger group is cut into parts along its order. Every row with enough predecessors in its own
    part is final; the first and last `rows - 1` rows of each part are kept as edges, and a second
    window over the edges alone settles the first rows of each part. With no keys, all rows are one
    group.
    """
    hot = hot_groups(df, keys, max_group_rows) if hot is None else hot
    span = (-(rows - 1), 0)
    if not hot:
        frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*span)
        return df.withColumns({name: agg.over(frame) for name, agg in aggregates.items()})

    split = split_hot_groups(df, keys, order, hot, max_group_rows)
    part = Window.partitionBy(*keys, "_part").orderBy(*order)
    staged = split.withColumns(
        {
            **{name: agg.over(part.rowsBetween(*span)) for name, agg in aggregates.items()},
            "_rank": F.row_number().over(part),
            "_last": F.lead(F.lit(1), rows - 1).over(part).isNull() if rows > 1 else F.lit(False),
        }
    )
    is_head = F.col("_hot") & (F.col("_rank") < rows)
    settled = staged.filter(~is_head)
    edges = staged.filter(F.col("_hot") & ((F.col("_rank") < rows) | F.col("_last"))).drop(*aggregates)
    whole = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*span)
    heads = edges.withColumns({name: agg.over(whole) for name, agg in aggregates.items()}).filter(F.col("_rank") < rows)
    columns = [*df.columns, *aggregates]
    return settled.select(*columns).unionByName(heads.select(*columns))


def exact_quantiles(df: DataFrame, value: str, levels: Mapping[str, float], keys: Sequence[str] = (),
                    max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Linearly interpolated quantiles per group, one column per named level.

    Equal values are combined before they are ordered, and hot groups are cut into value ranges, so
    no task orders more than about `max_group_rows` values whatever the group sizes or ties. Ranges
    are counted first, and only those that hold a wanted rank are shuffled.
    """
    keys = list(keys)
    values = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    hot = hot_groups(values, keys, max_group_rows)
    values = _value_parts(values, hot, keys, max_group_rows) if hot else values.withColumn("_part", F.lit(-1))
    per_part = values.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_rows"))
    over_parts = Window.partitionBy(*keys).orderBy("_part")
    per_part = per_part.withColumns(
        {
            "_before": F.sum("_rows").over(over_parts.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_rows"),
            "_total": F.sum("_rows").over(Window.partitionBy(*keys)),
        }
    )
    ranks = {}
    for name, level in levels.items():
        place = F.lit(float(level)) * (F.col("_total") - 1)
        ranks[name] = (F.floor(place), F.ceil(place), place - F.floor(place))
    holds_a_rank = F.lit(False)
    for low, high, _ in ranks.values():
        for rank in (low, high):
            holds_a_rank = holds_a_rank | ((rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_rows")))
    wanted = per_part.filter(holds_a_rank)
    if not keys:  # two parts for each level at most; a shuffled join would bring all rows of a part, wanted or not, into one task
        wanted = F.broadcast(wanted)
    # Only parts that hold a wanted rank are tallied.
    held = values.join(wanted.select(*keys, "_part"), [*keys, "_part"], "left_semi") if hot else values
    tally = held.groupBy(*keys, "_part", "_v").agg(F.count(F.lit(1)).alias("_n"))
    within = Window.partitionBy(*keys, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    placed = tally.join(wanted, [*keys, "_part"]).withColumn("_end", F.col("_before") + F.sum("_n").over(within))

    def value_at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_end") - F.col("_n")) & (rank < F.col("_end")), F.col("_v")))

    picked = placed.groupBy(*keys).agg(
        *[value_at(low).alias(f"_{i}_low") for i, (low, _, _) in enumerate(ranks.values())],
        *[value_at(high).alias(f"_{i}_high") for i, (_, high, _) in enumerate(ranks.values())],
        *[F.max(share).alias(f"_{i}_share") for i, (_, _, share) in enumerate(ranks.values())],
    )
    mixed = [
        (F.col(f"_{i}_low") + (F.col(f"_{i}_high") - F.col(f"_{i}_low")) * F.col(f"_{i}_share")).alias(name)
        for i, name in enumerate(ranks)
    ]
    return picked.select(*keys, *mixed)
