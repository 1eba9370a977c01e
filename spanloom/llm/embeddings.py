"""Near-duplicate vectors by random-hyperplane hashing, exact cosine and components.

Each of several tables gives a vector the signs of its products with ``bits`` random
hyperplanes; vectors with equal signs share a bucket of the table. Two vectors at angle t agree
in a table with probability (1 - t / pi) ** bits. ``bits`` follows the number of distinct vectors
(their logarithm and ``EXTRA_BITS``), so that chance meetings stay few at any size, and the number
of tables is what finds a pair at the limit with probability ``recall``. All vectors of a bucket
are compared by their cosine in double precision; none is left out, and no bucket has a cap: one
of more than ``BLOCK`` vectors is cut into blocks at random, and every pair of blocks is a group
of its own. A pair that meets in several tables counts in the first.

Equal vectors are one entry with a count. A group of blocks gives link counts and the edges of a
spanning forest, never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spanloom.llm.components import connected_components, forest
from spanloom.staging import stage

LIMIT = 0.95
RECALL = 0.999
EXTRA_BITS = 3
LEAST_BITS, MOST_BITS = 8, 60
BLOCK = 512
SEED = 1729
#: Groups of up to this size are compared row against shifted row, larger ones as matrices.
SMALL = 16


def plan_tables(vectors: int, limit: float = LIMIT, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables) for so many distinct vectors."""
    bits = math.ceil(math.log2(max(vectors, 2))) + EXTRA_BITS
    bits = min(max(bits, LEAST_BITS), MOST_BITS)
    agree = (1.0 - math.acos(limit) / math.pi) ** bits
    return bits, math.ceil(math.log(1.0 - recall) / math.log(1.0 - agree))


def _matrix(column: pa.Array) -> list[np.ndarray]:
    """The vectors of a binary column of doubles."""
    return [np.frombuffer(v.as_buffer(), "<f8") for v in column]


def vectors_of(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, vector binary): doubles of length 1, or null where the vector links with nothing.

    That is a vector that is null, empty or zero, or has a null or non-finite component.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item in batch.column(1):
                values = item.values
                if values is None or len(values) == 0 or values.null_count:
                    out.append(None)
                    continue
                x = values.to_numpy(zero_copy_only=False).astype("<f8")
                top = np.abs(x).max()
                if not np.isfinite(top) or top == 0:
                    out.append(None)
                    continue
                x = x / top  # no overflow or underflow in the norm
                out.append((x / np.sqrt(x @ x) + 0.0).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.binary())], names=["vec_id", "vector"]
            )

    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), vector).mapInArrow(
        run, "vec_id bigint, vector binary"
    )


def _signatures(bits: int, tables: int):
    """(node, dimension, signs binary): the bucket of every table as 64-bit numbers."""
    weights = 1 << np.arange(bits, dtype=np.int64)
    planes: dict[int, np.ndarray] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dimensions, signs = [], []
            for x in _matrix(batch.column(1)):
                if len(x) not in planes:
                    draws = np.random.default_rng([SEED, len(x)])
                    planes[len(x)] = draws.standard_normal((tables * bits, len(x)))
                above = planes[len(x)] @ x > 0
                dimensions.append(len(x))
                signs.append((above.reshape(tables, bits) @ weights).astype("<i8"))
            flat = np.concatenate(signs) if signs else np.empty(0, "<i8")
            offsets = np.arange(len(signs) + 1, dtype=np.int32) * tables
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(dimensions, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                names=["node", "dimension", "signs"],
            )

    return run


def _pairs_inside(x: np.ndarray, group: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs (i < j) of one group with a cosine of at least ``limit``; groups are runs."""
    first, second = [], []
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    for start, size in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
        block = x[start : start + size]
        i, j = np.nonzero(np.triu(block @ block.T >= limit, 1))
        first.append(start + i)
        second.append(start + j)
    small = np.repeat(sizes <= SMALL, sizes)
    for shift in range(1, SMALL):
        i = np.flatnonzero(small[:-shift] & (group[:-shift] == group[shift:]))
        if not len(i):
            break
        i = i[np.einsum("ij,ij->i", x[i], x[i + shift]) >= limit]
        first.append(i)
        second.append(i + shift)
    if not first:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(first), np.concatenate(second)


def _compare(batch: pa.RecordBatch, limit: float) -> pa.RecordBatch:
    """Link counts and forest edges of the whole groups in a batch: rows (node, links, other)."""
    column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
    table = column["t"].to_numpy()
    node, copies = column["node"].to_numpy(), column["copies"].to_numpy()
    # Groups are numbered in this batch only.
    keys = np.stack([table, column["bucket"].to_numpy(), column["dimension"].to_numpy(),
                     column["i"].to_numpy(), column["j"].to_numpy()])
    number = np.cumsum(np.r_[0, (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
    side = column["side"].to_numpy()
    signs = column["signs"].flatten().to_numpy().reshape(len(node), -1)
    out_node, out_links, out_other = [], [], []
    dimension = column["dimension"].to_numpy()
    for d in np.unique(dimension):
        rows = np.flatnonzero(dimension == d)
        x = np.frombuffer(b"".join(v.as_py() for v in column["vector"].take(pa.array(rows))), "<f8")
        a, b = _pairs_inside(x.reshape(len(rows), d), number[rows], limit)
        a, b = rows[a], rows[b]
        # Between two blocks only pairs across count; a block meets itself in its own group.
        across = (keys[3][a] == keys[4][a]) | (side[a] != side[b])
        a, b = a[across], b[across]
        earlier = np.arange(signs.shape[1])[None, :] < table[a][:, None]
        new = ~((signs[a] == signs[b]) & earlier).any(axis=1)
        a, b = a[new], b[new]
        if not len(a):
            continue
        links = np.bincount(a, copies[b], len(node)) + np.bincount(b, copies[a], len(node))
        linked = np.flatnonzero(links)
        out_node.append(node[linked])
        out_links.append(links[linked].astype(np.int64))
        out_other.append(np.full(len(linked), -1, np.int64))
        by_group = np.argsort(number[a], kind="stable")
        cuts = np.flatnonzero(np.diff(number[a][by_group])) + 1
        for part in np.split(by_group, cuts):
            nodes, place = np.unique(np.concatenate([node[a[part]], node[b[part]]]), return_inverse=True)
            if len(nodes) == 2:
                root = np.zeros(2, np.int64)
            else:
                near = np.eye(len(nodes), dtype=bool)
                u, v = place[: len(part)], place[len(part) :]
                near[u, v] = near[v, u] = True
                root = forest(near)
            other = np.arange(len(nodes)) != root
            out_node.append(nodes[other])
            out_links.append(np.zeros(other.sum(), np.int64))
            out_other.append(nodes[root[other]])
    arrays = [np.concatenate(c) if c else np.empty(0, np.int64) for c in (out_node, out_links, out_other)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in arrays], names=["node", "links", "other"])


def _compare_groups(limit: float):
    """Over partitions sorted by group: each batch is compared up to its last whole group."""
    key = ("t", "bucket", "dimension", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if held is not None:
                batch = pa.concat_batches([held, batch])
            size = batch.num_rows
            if not size:
                continue
            last = np.ones(size, dtype=bool)
            for name in key:
                values = batch.column(name).to_numpy()
                last &= values == values[-1]
            whole = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            if whole:
                yield _compare(batch.slice(0, whole), limit)
            held = batch.slice(whole)
        if held is not None and held.num_rows:
            yield _compare(held, limit)

    return run


def near_links(entries: DataFrame, limit: float = LIMIT, recall: float = RECALL) -> DataFrame:
    """(node, links, other) from a written table (node, vector, copies) of distinct vectors.

    Rows with ``other`` = -1 carry links of a node, to be summed; the others are edges that
    connect what the links connect.
    """
    bits, tables = plan_tables(entries.count(), limit, recall)
    signed = entries.select("node", "vector").mapInArrow(
        _signatures(bits, tables), "node bigint, dimension int, signs array<bigint>"
    )
    signed = stage(signed, "signs")
    placed = signed.select("node", "dimension", F.posexplode("signs").alias("t", "bucket"))
    key = ["t", "bucket", "dimension"]
    shared = placed.groupBy(*key).agg(F.count("*").alias("_n")).where("_n > 1").withColumn(
        "_blocks", F.ceil(F.col("_n") / BLOCK).cast("int")
    )
    shared = stage(shared.drop("_n"), "buckets")
    met = placed.join(shared, key)
    # A block b of n goes to the groups (0, b) .. (b, b) .. (b, n - 1).
    block = F.pmod(F.xxhash64(F.lit(SEED), "node"), F.col("_blocks")).cast("int")
    met = met.withColumn("_block", block).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    ).select(
        "node", *key, F.least("_block", "_other").alias("i"), F.greatest("_block", "_other").alias("j"),
        (F.col("_block") < F.col("_other")).cast("int").alias("side"),
    )
    wide = met.join(entries, "node").join(signed.select("node", "signs"), "node")
    order = [*key, "i", "j"]
    grouped = wide.repartition(*order).sortWithinPartitions(*order)
    return stage(
        grouped.mapInArrow(_compare_groups(limit), "node bigint, links bigint, other bigint"), "vector-links"
    )


def near_duplicates(rows: DataFrame, limit: float = LIMIT, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding).

    Rows are linked if the cosine of their vectors is at least ``limit``; vectors of different
    length never are, and those that are null, zero or not finite link with nothing. n_links
    counts the other rows linked directly, repeated rows each; component_id is the smallest
    vec_id reachable, the row's own included; kept says that it is the row's own. Null ids take
    part but name no component, unless the whole component has none. An empty table gives an
    empty one, and other columns are not read.
    """
    vectors = stage(vectors_of(rows), "vectors")
    valid = vectors.where("vector is not null")
    entries = stage(
        valid.groupBy("vector").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()),
        "vector-entries",
    )
    links = near_links(entries.select("node", "vector", "copies"), limit, recall)
    counts = links.where("other = -1").groupBy("node").agg(F.sum("links").alias("_links"))
    groups = connected_components(
        links.where("other >= 0").select(F.col("node").alias("a"), F.col("other").alias("b")), "vectors"
    )
    named = entries.join(counts, "node", "left").join(groups, "node", "left").select(
        "vector", "first_id", F.coalesce("component", "node").alias("component"),
        (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    named = stage(named, "vectors-named")
    least = stage(named.groupBy("component").agg(F.min("first_id").alias("component_id")), "vectors-least")
    named = stage(named.join(least, "component").select("vector", "n_links", "component_id"), "vectors-found")
    found = valid.join(named, "vector").select("vec_id", "n_links", "component_id").unionByName(
        vectors.where("vector is null").select(
            "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
        )
    )
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
