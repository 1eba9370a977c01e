"""Preorder places and levels in trees of any depth, by ranking the lists of their Euler tours.

Every node enters the tour once and leaves it once: element ``2 * rank`` and ``2 * rank + 1``. An element
points to the next one of its tour, so each has one successor and one predecessor at most, and no key of
the joins below is hot, whatever the shape of a tree. The number of entries from an element to the
end of its tour gives the place of a node, entries less exits give its level.

Lists are ranked in two steps. Each run of ``2 * RUN_NODES`` neighbouring
elements is followed inside one task, as arrays, to the first element outside. Only elements that such
a jump lands on remain; they are few if parents and children have near ranks, and none if a tree fits
a run. If those of a tree fit one task they are ranked there; else neighbours are joined, which
leaves fewer of them each round, or a few jumps are doubled: so many rounds as the logarithm of their number. What does not reach the end, for it hangs on a
span outside the tree or lies on a cycle, has no place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from spanloom.staging import stage

#: Nodes of a tree that a task follows at a time.
RUN_NODES = 131_072
#: Elements that are moved by every round of doubling, at most.
DOUBLED = 1_000_000
#: Where a list ends: at the end of the tour, and anywhere else.
END, LOST = -1, -2

_JUMP = "tree string, element bigint, target bigint, entries bigint, depth bigint"
_NAMES = ["tree", "element", "target", "entries", "depth"]


def follow(
    element: np.ndarray, target: np.ndarray, entries: np.ndarray, depth: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Jump from each element to the first target that is no element; the weights on the way added.

    Elements on a cycle get the target ``LOST``.
    """
    order = np.argsort(element, kind="stable")
    at = np.searchsorted(element, target, sorter=order)
    at[at == len(element)] = 0
    nearest = order[at]
    inside = element[nearest] == target
    own = np.arange(len(element))
    jump = np.where(inside, nearest, own)
    out = np.where(inside, LOST, target)
    # The last element of a run jumps to itself with no weight; its own is added at the end.
    entries_on, depth_on = np.where(inside, entries, 0), np.where(inside, depth, 0)
    for _ in range(max(1, int(len(element) - 1).bit_length()) + 1):
        entries_on, depth_on = entries_on + entries_on[jump], depth_on + depth_on[jump]
        jump = jump[jump]
    reached = ~inside[jump]
    return (
        np.where(reached, out[jump], LOST), entries_on + entries[jump], depth_on + depth[jump],
    )


def _follow_group(key, rows):
    element = rows["element"].to_numpy()
    target, entries, depth = follow(
        element, rows["target"].to_numpy(), rows["entries"].to_numpy(), rows["depth"].to_numpy()
    )
    frame = pd.DataFrame(
        {"element": element, "target": target, "entries": entries, "depth": depth}
    )
    frame.insert(0, "tree", key[0])
    return frame


def _rank_lists(jumps: DataFrame, run: int) -> DataFrame:
    """``jumps`` (tree, element, target, entries, depth) with every target at an end.

    If there are few elements in all, jumps are doubled, in fewer jobs. Else lists too long for a task lose
    about a quarter of their elements a round, until they fit one; then what was left out is placed,
    last round first. All rounds together move a few times the elements, where doubling moves all of
    them in every round.
    """
    largest = jumps.groupBy("tree").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    if largest <= run:
        return stage(jumps.groupBy("tree").applyInPandas(_follow_group, _JUMP), "ranked-lists")
    if jumps.count() <= DOUBLED:
        return _double(jumps, int(largest - 1).bit_length() + 1)
    removed = []
    while _most_under_way(jumps) > run // 2:
        both = stage(_halve(jumps, len(removed)), "list-jumps")
        jumps = both.where("not gone").drop("gone")
        removed.append(both.where("gone").drop("gone"))
    # What still has a way to go meets the ends that are known, and fits a task then.
    ended = jumps.where("target < 0")
    rest = _onward(jumps.where("target >= 0"), ended, F.col("target"))
    ranked = ended.unionByName(
        stage(rest.groupBy("tree").applyInPandas(_follow_group, _JUMP), "ranked-lists")
    )
    for gone in reversed(removed):
        found = _onward(gone.where("target >= 0"), ranked, F.lit(LOST)).unionByName(gone.where("target < 0"))
        ranked = ranked.unionByName(stage(found, "ranked-lists"))
    return ranked


def _most_under_way(jumps: DataFrame) -> int:
    """The most elements of a tree that have not reached an end."""
    counts = jumps.where("target >= 0").groupBy("tree").agg(F.count("*").alias("n"))
    return counts.agg(F.max("n")).first()[0] or 0


def _double(jumps: DataFrame, rounds: int) -> DataFrame:
    for _ in range(rounds):
        far = F.when(F.col("target") < 0, F.col("target")).otherwise(F.lit(LOST))
        jumps = stage(_onward(jumps, jumps, far), "list-jumps")
        if jumps.where("target >= 0").isEmpty():
            break
    return jumps


def _onward(jumps: DataFrame, known: DataFrame, otherwise: Column) -> DataFrame:
    """``jumps`` with those of the known elements that they land on added."""
    following = known.select(
        "tree", F.col("element").alias("target"), F.col("target").alias("_target"),
        F.col("entries").alias("_entries"), F.col("depth").alias("_depth"),
    )
    return jumps.join(following, ["tree", "target"], "left").select(
        "tree", "element", F.coalesce("_target", otherwise).alias("target"),
        (F.col("entries") + F.coalesce("_entries", F.lit(0))).alias("entries"),
        (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
    )


def _halve(jumps: DataFrame, number: int) -> DataFrame:
    """One round of ``_rank_lists``: ``jumps`` with ``gone``, true for the elements left out from here on.

    A coin is tossed for every element, by hash. One of heads that lands on one of tails takes its jump
    over, and the one of tails goes. No two neighbours go in a round, so what an element that went
    lands on is there after it.
    """
    heads = lambda c: F.xxhash64("tree", c, F.lit(number)) % 2 == 0
    takes = heads("element") & (F.col("target") >= 0) & ~heads("target")
    before = jumps.where(takes).select(
        "tree", F.col("target").alias("element"), F.col("element").alias("_element"),
        F.col("entries").alias("_entries"), F.col("depth").alias("_depth"),
    )
    met = jumps.where(~heads("element")).join(before, ["tree", "element"], "left")
    as_is = F.struct("element", "target", "entries", "depth", F.col("_element").isNotNull().alias("gone"))
    taken = F.struct(
        F.col("_element").alias("element"),
        # The last of a cycle.
        F.when(F.col("target") == F.col("_element"), LOST).otherwise(F.col("target")).cast("bigint").alias("target"),
        (F.col("entries") + F.col("_entries")).alias("entries"),
        (F.col("depth") + F.col("_depth")).alias("depth"), F.lit(False).alias("gone"),
    )
    rows = F.when(F.col("_element").isNull(), F.array(as_is)).otherwise(F.array(as_is, taken))
    return met.select("tree", F.inline(rows)).unionByName(
        jumps.where(~takes & heads("element")).withColumn("gone", F.lit(False))
    )


_EDGES = "tree string, parent bigint, rank bigint, _parent bigint, _rank bigint"
_PLACED = _EDGES + ", part int, kind string"


def _with_previous(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted edges with the edge before them in their tree, null without one.

    The first edge of a partition cannot know, and is marked; the last one is given a second time.
    """
    part, last = TaskContext.get().partitionId(), None

    def rows(tree, parent, rank, before, above, kind) -> pa.RecordBatch:
        columns = [tree, parent, rank, above, before, pa.array([part] * len(tree), pa.int32()), kind]
        names = ["tree", "parent", "rank", "_parent", "_rank", "part", "kind"]
        return pa.RecordBatch.from_arrays(columns, names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        held = last or pa.RecordBatch.from_arrays(
            [pa.nulls(1, c.type) for c in batch.columns], schema=batch.schema
        )
        shifted = [
            pa.concat_arrays([h, c.slice(0, batch.num_rows - 1)])
            for h, c in zip(held.columns, batch.columns)
        ]
        same = pc.fill_null(pc.equal(shifted[0], batch.column(0)), False)
        above, before = (pc.if_else(same, c, pa.scalar(None, c.type)) for c in shifted[1:])
        kinds = ["inner" if last else "first"] + ["inner"] * (batch.num_rows - 1)
        yield rows(*batch.columns, before, above, pa.array(kinds))
        last = batch.slice(batch.num_rows - 1)
    if last:
        none = pa.nulls(1, pa.int64())
        yield rows(*last.columns, none, none, pa.array(["last"]))


def edges_with_previous(edges: DataFrame) -> DataFrame:
    """(tree, parent, rank, _parent, _rank): every edge and the one before it in its tree.

    The order is (parent, rank). The edges are sorted in ranges, which split a parent with very many
    children; two edges of each range go to the driver, which joins the ranges' ends.
    """
    spark = edges.sparkSession
    placed = stage(
        edges.select("tree", "parent", "rank").repartitionByRange("tree", "parent", "rank")
        .sortWithinPartitions("tree", "parent", "rank").mapInArrow(_with_previous, _PLACED),
        "tour-edges",
    )
    ends = placed.where("kind <> 'inner'").collect()
    first = {r.part: r for r in ends if r.kind == "first"}
    last = {r.part: r for r in ends if r.kind == "last"}
    joined, before = [], None
    for part in sorted(first):
        edge = first[part]
        known = before is not None and before.tree == edge.tree
        joined.append((
            edge.tree, edge.parent, edge.rank, before.parent if known else None,
            before.rank if known else None,
        ))
        before = last[part]
    inner = placed.where("kind = 'inner'").drop("part", "kind")
    return inner.unionByName(spark.createDataFrame(joined, _EDGES))


def tour(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(tree, element, target, entries, depth): the successor of every entry and exit.

    ``nodes`` has (tree, rank, is_root), ``edges`` (tree, parent, rank); siblings follow by rank.
    """
    # Every edge with the one before it in its tree tells its own span the parent, and either the
    # parent its first child or the span before it the next sibling.
    long = lambda value: value.cast("bigint")
    none, same = F.lit(None), F.col("_parent").eqNullSafe(F.col("parent"))
    told = F.inline(F.array(
        F.struct(
            F.col("rank").alias("rank"), F.col("parent").alias("parent"),
            long(none).alias("child"), long(none).alias("sibling"),
        ),
        F.struct(
            F.when(same, F.col("_rank")).otherwise(F.col("parent")).alias("rank"),
            long(none).alias("parent"), F.when(~same, F.col("rank")).alias("child"),
            F.when(same, F.col("rank")).alias("sibling"),
        ),
    ))
    links = edges_with_previous(edges).select("tree", told)
    whole = (
        links.withColumn("is_root", F.lit(False))
        .unionByName(nodes.select("tree", "rank", "is_root"), allowMissingColumns=True)
        .groupBy("tree", "rank")
        .agg(*(F.max(c).alias(c) for c in ("parent", "child", "sibling", "is_root")))
    )
    rank = F.col("rank")
    leave = (
        F.when(F.col("is_root"), END)
        .when(F.col("sibling").isNotNull(), F.col("sibling") * 2)
        .when(F.col("parent").isNotNull(), F.col("parent") * 2 + 1).otherwise(LOST)
    )
    elements = F.array(
        F.struct(
            (rank * 2).alias("element"),
            F.coalesce(F.col("child") * 2, rank * 2 + 1).alias("target"),
            F.lit(1).cast("bigint").alias("entries"), F.lit(1).cast("bigint").alias("depth"),
        ),
        F.struct(
            (rank * 2 + 1).alias("element"), leave.cast("bigint").alias("target"),
            F.lit(0).cast("bigint").alias("entries"), F.lit(-1).cast("bigint").alias("depth"),
        ),
    )
    return whole.select("tree", F.inline(elements))


def preorder(nodes: DataFrame, edges: DataFrame, run_nodes: int = RUN_NODES) -> DataFrame:
    """(tree, rank, pos, level) of the nodes below each root, the root at 0.

    ``nodes`` (tree, rank, is_root): one root per tree, ranks from 1 and close together. ``edges``
    (tree, parent, rank): at most one per rank, none for a root. Nodes that no root reaches are left out.
    """
    run = F.expr(f"element div {2 * run_nodes}").alias("run")
    links = tour(nodes, edges).select("*", run)
    near = stage(links.groupBy("tree", "run").applyInPandas(_follow_group, _JUMP), "tour-jumps")
    landed = near.where("target >= 0").select("tree", F.col("target").alias("element")).distinct()
    landed = stage(near.join(landed, ["tree", "element"]), "tour-landings")
    if landed.isEmpty():
        ranked = near
    else:
        rest = _rank_lists(landed, 2 * run_nodes).select(
            "tree", F.col("element").alias("target"), F.col("target").alias("_target"),
            F.col("entries").alias("_entries"), F.col("depth").alias("_depth"),
        )
        ranked = near.join(rest, ["tree", "target"], "left").select(
            "tree", "element", F.coalesce("_target", "target").alias("target"),
            (F.col("entries") + F.coalesce("_entries", F.lit(0))).alias("entries"),
            (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
        )
    entered = ranked.where((F.col("target") == END) & (F.col("element") % 2 == 0)).select(
        "tree", F.expr("element div 2").alias("rank"), "entries", "depth"
    )
    # The root's entry has them all; what lies before another entry is the rest.
    size = entered.groupBy("tree").agg(F.max("entries").alias("size"))
    return entered.join(size, "tree").select(
        "tree", "rank", (F.col("size") - F.col("entries")).alias("pos"),
        (-F.col("depth")).alias("level"),
    )
