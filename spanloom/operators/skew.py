"""Groups too large for one task: finding them, splitting them off, ranking inside them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from spanloom.staging import stage

# Key lists up to this length are broadcast. Where a list may be longer, only the keys with
# more than one part in BROADCAST_KEYS of all rows go on it: there are fewer of them than
# this, whatever the data, and no other key is large enough to burden a task.
BROADCAST_KEYS = 100_000


@dataclass(frozen=True)
class HeavyKeys:
    """The keys with more than ``limit`` rows, which no task should collect: (key, n) rows."""

    column: str
    limit: int
    rows: DataFrame
    count: int

    def spelled(self, column: str, expression: Column) -> "HeavyKeys":
        """The same keys in another column."""
        rows = self.rows.select(expression.alias(column), "n")
        return HeavyKeys(column, self.limit, rows, self.count)

    def giants(self) -> DataFrame:
        """At most BROADCAST_KEYS of the keys, with all of the largest."""
        if self.count <= BROADCAST_KEYS:
            return self.rows.select(self.column)
        total = self.rows.agg(F.sum("n")).first()[0]
        return self.rows.where(F.col("n") * BROADCAST_KEYS > total).select(self.column)


def heavy_keys(df: DataFrame, column: str, limit: int) -> HeavyKeys | None:
    """Keys with more than ``limit`` rows, or None when there are none.

    Reads the key column only and combines on the map side, so a key with most of the rows
    costs one partial row per task.
    """
    rows = df.groupBy(column).agg(F.count("*").alias("n")).where(F.col("n") > limit)
    found = rows.count()
    return HeavyKeys(column, limit, stage(rows, "heavy-keys"), found) if found else None


def split_heavy(df: DataFrame, heavy: HeavyKeys) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of heavy keys).

    The giants are split off by a broadcast list. If there are more heavy keys than that,
    the others are told by a count per key, in the partitioning that grouping by the key
    needs anyway.
    """
    giants = F.broadcast(heavy.giants())
    rest = df.join(giants, heavy.column, "left_anti")
    wide = df.join(giants, heavy.column, "left_semi")
    if heavy.count <= BROADCAST_KEYS:
        return rest, wide
    size = F.count("*").over(Window.partitionBy(heavy.column))
    sized = rest.withColumn("_size", size)
    light = sized.where(F.col("_size") <= heavy.limit).drop("_size")
    return light, wide.unionByName(sized.where(F.col("_size") > heavy.limit).drop("_size"))


def join_sized(
    rows: DataFrame, groups: DataFrame, key: str | list[str], size: str
) -> DataFrame:
    """Inner join of rows with one row per key that knows the key's row count in ``size``.

    A short list of groups is broadcast. Of a long one, the giants are, and the rows of the
    other keys meet their group in a shuffled join.
    """
    groups = stage(groups, "groups")
    keys, total = groups.agg(F.count("*"), F.sum(size)).first()
    if keys <= BROADCAST_KEYS:
        return rows.join(F.broadcast(groups), key)
    giant = F.col(size) * BROADCAST_KEYS > total
    few = F.broadcast(groups.where(giant))
    rest = rows.join(F.broadcast(groups.where(giant).select(key)), key, "left_anti")
    return rows.join(few, key).unionByName(rest.join(groups.where(~giant), key))


def ranged_row_number(df: DataFrame, key: str, order: list[str], out: str) -> DataFrame:
    """1-based row number inside each key, with a key spread over many tasks.

    The rows are range-partitioned and sorted by (key, order), which splits a large key at
    range boundaries; the position inside a partition plus the key's rows in the partitions
    before it is the row number. ``order`` must be unique inside a key.
    """
    placed = stage(
        df.repartitionByRange(key, *order)
        .sortWithinPartitions(key, *order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", 33)),
        "ranged",
    )
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(key, "_part")
        .agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select(key, "_part", "_first", "_before")
    )
    number = F.col("_before") + F.col("_at") - F.col("_first") + 1
    return (
        placed.join(offsets, [key, "_part"])
        .withColumn(out, number.cast("bigint"))
        .drop("_at", "_part", "_first", "_before")
    )


def row_number_in_group(
    df: DataFrame, key: str, order: list[str], out: str, heavy: HeavyKeys | None
) -> DataFrame:
    """Row number inside each key: a window for ordinary keys, ranges for the heavy ones."""
    window = Window.partitionBy(key).orderBy(*order)
    if heavy is None:
        return df.withColumn(out, F.row_number().over(window).cast("bigint"))
    light, wide = split_heavy(df, heavy)
    numbered = light.withColumn(out, F.row_number().over(window).cast("bigint"))
    return numbered.unionByName(ranged_row_number(wide, key, order, out))
