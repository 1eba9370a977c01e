"""Call trees: from the spans of a trace to its preorder steps and trace-level measures.

Every span is attached at most once: if an id occurs several times in a trace, its children belong to
the first of these spans (to the root, if the id is the root's). So a tree has no more steps than its
trace has spans, however often spans were sent, cycles cannot be reached from the root, and no
level needs a limit.

Traces of ordinary size are collected into one row and walked with higher-order functions:
one shuffle for everything. Traces with more spans than the caller's limit are one row per span:
places and levels come from ranking their Euler tours (``preorder``), so no task ever holds the spans of
one and the number of jobs does not follow its depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from spanloom.functions import day_start, minute_start
from spanloom.operators.preorder import preorder
from spanloom.operators.skew import HeavyKeys, join_sized, ranged_row_number, split_heavy
from spanloom.schemas import CLIENT_SEND
from spanloom.staging import stage

# Steps per collected array; longer call trees take several segments.
SEGMENT_STEPS = 1000

# Order of siblings, and of the spans of a trace, made total by the columns after the name.
# The payload follows these fields, so only exact copies compare equal.
SPAN_ORDER = ("begin", "lname", "spanid", "event", "parent")
PAYLOAD = ("name", "end", "receive", "error_count", "span_type", "region")
# Step fields besides position and level; callers may ask for more span columns.
STEP_FIELDS = ("name", "spanid", "parent", "begin", "end", "event", "error_count", "span_type")

MEASURES = (
    "traceid", "api", "trace_md5", "duration", "start_ms", "start_day", "minute_start", "day_start",
    "error_status", "rest_times", "mysql_times", "redis_times", "region", "steps_total",
)


@dataclass(frozen=True)
class Forest:
    """The call trees of a set of traces.

    ``inline`` has one row per ordinary trace: the measures and ``tree``, the array of steps.
    ``wide_summary`` / ``wide_steps`` hold the same for the large traces, one row per trace
    and one row per step; both are None when there are no large traces.
    """

    inline: DataFrame
    wide_summary: DataFrame | None = None
    wide_steps: DataFrame | None = None
    extra: tuple[str, ...] = ()

    def staged(self) -> "Forest":
        """The trees of the ordinary traces written for several outputs, as the others are: each reads
        the columns that it needs, and the number of files follows the bytes."""
        return replace(self, inline=stage(self.inline, "forest"))

    def summary(self) -> DataFrame:
        """One row per trace with its measures."""
        rows = self.inline.select(*MEASURES)
        if self.wide_summary is None:
            return rows
        return rows.unionByName(self.wide_summary.select(*MEASURES))

    def steps(self, *measures: str) -> DataFrame:
        """One row per step, with the named trace measures."""
        keys = ["traceid", *(m for m in measures if m != "traceid")]
        rows = self.inline.select(*keys, F.explode("tree").alias("t")).select(*keys, "t.*")
        if self.wide_steps is None:
            return rows
        wide = self.wide_steps
        if len(keys) > 1:
            wide = self._with_measures(wide, keys)
        return rows.unionByName(wide.select(*rows.columns))

    def segments(self, *measures: str) -> DataFrame:
        """One row per trace and run of at most SEGMENT_STEPS steps, in ``steps``."""
        keys = ["traceid", *(m for m in measures if m != "traceid")]
        runs = F.transform(
            F.sequence(F.lit(0), F.expr(f"cast((size(tree) - 1) div {SEGMENT_STEPS} as int)")),
            lambda k: F.struct(
                k.cast("bigint").alias("segment"),
                F.slice("tree", k * SEGMENT_STEPS + 1, SEGMENT_STEPS).alias("steps"),
            ),
        )
        rows = self.inline.select(*keys, F.inline(runs))
        if self.wide_steps is None:
            return rows
        step = F.struct("pos", "level", *STEP_FIELDS, *self.extra)
        wide = (
            self.wide_steps.groupBy("traceid", F.expr(f"pos div {SEGMENT_STEPS}").alias("segment"))
            .agg(F.sort_array(F.collect_list(step)).alias("steps"))
        )
        wide = self._with_measures(wide, keys)
        return rows.unionByName(wide.select(*rows.columns))

    def _with_measures(self, wide: DataFrame, keys: list[str]) -> DataFrame:
        measures = self.wide_summary.select(*keys, F.col("steps_total").alias("_size"))
        return join_sized(wide, measures, "traceid", "_size").drop("_size")


def build_forest(
    spans: DataFrame, heavy: HeavyKeys | None, extra: tuple[str, ...] = ()
) -> Forest:
    """Call trees of all traces; ``heavy`` lists the traces too large for one row.

    ``extra`` names span columns to carry on the steps besides the standard ones.
    """
    rows = spans.withColumn("lname", F.lower("name"))
    if heavy is None:
        return Forest(_inline(rows, extra), extra=extra)
    light, wide = split_heavy(rows, heavy)
    steps = _wide_steps(wide, extra)
    return Forest(_inline(light, extra), _wide_summary(steps), steps, extra)


# ---- ordinary traces: one row each ----------------------------------------------------------


def _once(df: DataFrame, expression: Column, name: str) -> DataFrame:
    """Add a costly column so that it is computed once however often it is used.

    Generating it from a one-element array keeps it out of reach of projection collapsing,
    which would repeat the expression at every use.
    """
    return df.select("*", F.explode(F.array(expression)).alias(name))


def sorted_spans(spans: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per trace: the spans in order, and the index of the root among them.

    The root is the first span whose id is the trace id, else the last span.
    """
    item = F.struct(*SPAN_ORDER, *PAYLOAD, *extra)
    grouped = spans.groupBy("traceid").agg(F.sort_array(F.collect_list(item)).alias("s"))
    found = F.array_position("s.spanid", F.col("traceid"))
    root = F.when(found > 0, found).otherwise(F.size("s")) - 1
    return grouped.select("traceid", "s", root.cast("int").alias("ri"))


# Levels walked between two looks at whether the frontier is empty.
LEVELS_AT_ONCE = 8
# Up to this many edges children are found by filtering, beyond it by sorted slices.
FEW_EDGES = 24


def _let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``name`` standing for ``value``, computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _tree_expression(extra: tuple[str, ...]) -> str:
    """SQL for the array of steps of a trace, from its sorted spans ``s`` and root index ``ri``."""
    edges = f"""
        filter(transform(s, (x, i) -> if(x.event = '{CLIENT_SEND}' and x.spanid <> x.parent and i <> ri,
                                         named_struct('parent', x.parent, 'i', i), null)),
               e -> e is not null)"""
    # Whether the span at a place is the one that its id's children belong to.
    owns = "if(id = ids[ri], j = ri, single or array_position(ids, id) = j + 1)"
    # The indexes of every span's children, in order.
    filtered = f"""
        transform(ids, (id, j) -> if({owns},
          transform(filter(edges, e -> e.parent = id), e -> e.i), cast(array() as array<int>)))"""
    sliced = _let(
        "e",
        """named_struct('parents', ordered.parent, 'children', ordered.i,
                        'distinct', array_distinct(ordered.parent))""",
        _let(
            "starts",
            """concat(transform(e.distinct, p -> array_position(e.parents, p)),
                      array(size(e.parents) + 1L))""",
            f"""transform(transform(ids, (id, j) ->
                   if({owns}, cast(array_position(e.distinct, id) as int), 0)), j ->
                 if(j = 0, cast(array() as array<int>),
                    slice(e.children, cast(starts[j - 1] as int),
                          cast(starts[j] - starts[j - 1] as int))))""",
        ),
    )
    below = _let("ids", "s.spanid", _let(
        "single", "size(array_distinct(ids)) = size(ids)",
        f"if(size(edges) <= {FEW_EDGES}, {filtered}, {_let('ordered', 'sort_array(edges)', sliced)})",
    ))
    # Level by level: children of the frontier become the next frontier. A node is its path
    # of span indexes, so sorting the nodes gives preorder.
    level = """
        if(size(acc.front) = 0, acc, named_struct(
          'done', concat(acc.done, acc.front),
          'front', flatten(transform(acc.front, p -> transform(
                     below[element_at(p, -1)], c -> concat(p, array(c)))))))"""
    walk = f"""
        aggregate(
          sequence(1, size(s), {LEVELS_AT_ONCE}),
          named_struct('done', cast(array() as array<array<int>>), 'front', array(array(ri))),
          (sofar, first) -> if(size(sofar.front) = 0, sofar, aggregate(
            sequence(1, {LEVELS_AT_ONCE}), sofar,
            (acc, l) -> {level})),
          acc -> sort_array(concat(acc.done, acc.front)))"""
    paths = _let(
        "edges", edges, f"if(size(edges) = 0, array(array(ri)), {_let('below', below, walk)})"
    )
    fields = ", ".join(
        f"'{f}', " + ("if(pos = 0, traceid, x.parent)" if f == "parent" else f"x.{f}")
        for f in (*STEP_FIELDS, *extra)
    )
    step = f"""named_struct(
        'pos', cast(pos as bigint), 'level', cast(size(p) - 1 as bigint), {fields})"""
    return f"transform({paths}, (p, pos) -> {_let('x', 's[element_at(p, -1)]', step)})"


def _inline(spans: DataFrame, extra: tuple[str, ...]) -> DataFrame:
    traces = sorted_spans(spans, extra)
    traces = _once(traces, F.expr(_tree_expression(extra)), "tree")
    root = F.col("s")[F.col("ri")]

    def times(kind: str) -> Column:
        return F.size(F.filter("tree", lambda t: t["span_type"] == kind)).cast("bigint")

    names = F.transform("tree", lambda t: F.coalesce(t["name"], F.lit("null")))
    return traces.select(
        "traceid",
        root["name"].alias("api"),
        F.md5(F.concat(F.array_join(names, "|"), F.lit("|"))).alias("trace_md5"),
        (root["end"] - root["begin"]).alias("duration"),
        root["begin"].alias("start_ms"),
        day_start(root["begin"]).alias("start_day"),
        minute_start(root["receive"]).alias("minute_start"),
        day_start(root["receive"]).alias("day_start"),
        F.exists("tree", lambda t: t["error_count"] > 0).alias("error_status"),
        times("RESTTEMPLATE").alias("rest_times"),
        times("MYSQL").alias("mysql_times"),
        times("REDIS").alias("redis_times"),
        root["region"].alias("region"),
        F.size("tree").cast("bigint").alias("steps_total"),
        "tree",
    )


# ---- large traces: one row per span ----------------------------------------------------------


def _parent_edges(ranked: DataFrame, owners: DataFrame, roots: DataFrame) -> DataFrame:
    """(tree, parent, rank): every attachable span with the rank of the span it hangs on.

    A parent with very many children has one row on the owners' side, so the run-time split of
    skewed joins applies to it.
    """
    children = (
        ranked.where((F.col("event") == CLIENT_SEND) & (F.col("spanid") != F.col("parent")))
        .select("traceid", "parent", "rank").join(roots, ["traceid", "rank"], "left_anti")
    )
    above = owners.select(
        "traceid", F.col("spanid").alias("parent"), F.col("rank").alias("parent_rank")
    )
    return children.join(above, ["traceid", "parent"]).select(
        F.col("traceid").alias("tree"), F.col("parent_rank").alias("parent"), "rank"
    )


def _wide_steps(spans: DataFrame, extra: tuple[str, ...]) -> DataFrame:
    columns = [*SPAN_ORDER, *PAYLOAD, *extra]
    # Only exact copies of a span may change places.
    base = spans.select("traceid", *columns)
    ranked = stage(ranged_row_number(base, "traceid", columns, "rank"), "wide-ranked")

    is_root = F.col("spanid") == F.col("traceid")
    roots = stage(
        ranked.groupBy("traceid")
        .agg(F.coalesce(F.min(F.when(is_root, F.col("rank"))), F.max("rank")).alias("rank")),
        "wide-roots",
    )
    chosen = ranked.join(roots.withColumn("is_root", F.lit(True)), ["traceid", "rank"], "left")
    nodes = chosen.select(
        F.col("traceid").alias("tree"), "rank", F.coalesce("is_root", F.lit(False)).alias("is_root"),
        "spanid",
    )
    # The span that takes the children of an id: the root, or else the first with the id.
    owners = nodes.groupBy(F.col("tree").alias("traceid"), "spanid").agg(
        F.coalesce(F.min(F.when(F.col("is_root"), F.col("rank"))), F.min("rank")).alias("rank")
    )
    edges = stage(_parent_edges(ranked, owners, roots), "wide-edges")
    placed = preorder(nodes.drop("spanid"), edges).withColumnRenamed("tree", "traceid")
    full = placed.join(ranked, ["traceid", "rank"])
    steps = full.select(
        "traceid",
        "pos",
        "level",
        *(f for f in (*STEP_FIELDS, *extra) if f != "parent"),
        F.when(F.col("pos") == 0, F.col("traceid")).otherwise(F.col("parent")).alias("parent"),
        "receive",
        F.col("region").alias("own_region"),
    )
    return stage(steps, "wide-steps")


def _digest_segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """md5 over the name segments of each trace, read in order and never held together."""
    current, digest = None, None
    for batch in batches:
        done = []
        for traceid, names in zip(batch["traceid"], batch["names"]):
            if traceid != current:
                if current is not None:
                    done.append((current, digest.hexdigest()))
                current, digest = traceid, hashlib.md5()
            digest.update(names.encode("utf-8"))
        yield pd.DataFrame(done, columns=["traceid", "trace_md5"])
    if current is not None:
        yield pd.DataFrame([(current, digest.hexdigest())], columns=["traceid", "trace_md5"])


def _wide_summary(steps: DataFrame) -> DataFrame:
    named = F.struct("pos", F.coalesce("name", F.lit("null")).alias("name"))
    names = F.transform(F.sort_array(F.collect_list(named)), lambda x: x["name"])
    segments = steps.groupBy("traceid", F.expr(f"pos div {SEGMENT_STEPS}").alias("segment")).agg(
        F.concat(F.array_join(names, "|"), F.lit("|")).alias("names")
    )
    # A digest cannot be split, but only the packed names pass here, in constant memory.
    digests = (
        segments.repartition("traceid")
        .sortWithinPartitions("traceid", "segment")
        .select("traceid", "names")
        .mapInPandas(_digest_segments, "traceid string, trace_md5 string")
    )

    def times(kind: str) -> Column:
        return F.count_if(F.col("span_type") == kind)

    root = F.max(F.when(F.col("pos") == 0, F.struct("name", "begin", "end", "receive", "own_region")))
    totals = steps.groupBy("traceid").agg(
        root.alias("root"),
        F.bool_or(F.col("error_count") > 0).alias("error_status"),
        times("RESTTEMPLATE").alias("rest_times"),
        times("MYSQL").alias("mysql_times"),
        times("REDIS").alias("redis_times"),
        F.count("*").alias("steps_total"),
    )
    summary = totals.join(digests, "traceid").select(
        "traceid",
        F.col("root.name").alias("api"),
        "trace_md5",
        (F.col("root.end") - F.col("root.begin")).alias("duration"),
        F.col("root.begin").alias("start_ms"),
        day_start(F.col("root.begin")).alias("start_day"),
        minute_start(F.col("root.receive")).alias("minute_start"),
        day_start(F.col("root.receive")).alias("day_start"),
        "error_status", "rest_times", "mysql_times", "redis_times",
        F.col("root.own_region").alias("region"),
        "steps_total",
    )
    return stage(summary, "wide-summary")
