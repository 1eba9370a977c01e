"""Near duplicates by SimHash, searched through a Gray-order hierarchical index.

Distinct fingerprints are sorted by Gray rank, so that neighbours in the order share many bits.
Every ``FANOUT`` consecutive ones form a leaf, every ``FANOUT`` leaves a node above, and so on up
to one root. A node knows the bits on which all fingerprints below agree (a mask) and their
values (a pattern): bitwise AND and OR of the group give both.

All pairs within ``max_bits`` are found by walking the index against itself, level by level, as
joins of node pairs with their children. Two nodes differ on the bits that both patterns fix by
no more than any two fingerprints below them do; pairs whose count exceeds ``max_bits`` go, with
all that is below. The last level compares the fingerprints of the leaf pairs that are left.
The search is exact: nothing is sampled, and no bucket has a size that could be exceeded, as a
node has ``FANOUT`` children whatever the data.

For n fingerprints spread at random a group at depth d bits meets those whose leading bits are
within ``max_bits`` of its own: n * log(n)^max_bits work in all, not n * n.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from spanloom.llm.components import connected_components, forest
from spanloom.llm.tables import slices, text_of, values, worker_state
from spanloom.operators.skew import ranged_row_number
from spanloom.staging import stage, stage_last

SHINGLE_WORDS = 3
MAX_BITS = 2
FANOUT = 64
HASH_SEED = 42
#: Shingles hashed and summed at once.
BLOCK = 65_536


def shingle_bits(text: str, words: int, parts: int = 1) -> list[int]:
    """SimHash of the word shingles in ``parts`` words of 64 bits, as signed numbers.

    Only A-Z are lower-cased; words end at the six ASCII white-space characters. The first word is
    made of the shingles' XXH64, the others of numbers mixed from it.
    """
    return _sum_bits(shingle_hashes(text, words), parts)


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of the word shingles, in order; a text of fewer words is one shingle."""
    tokens = text.encode().lower().split()
    if not tokens:
        return np.zeros(0, dtype="<u8")
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words))))
    return np.fromiter(
        (xxhash.xxh64_intdigest(s, HASH_SEED) for s in shingles), dtype="<u8",
        count=max(1, len(tokens) - words + 1),
    )


def _sum_bits(hashes: np.ndarray, parts: int) -> list[int]:
    if not len(hashes):
        return [0] * parts
    out = []
    for part in range(parts):
        ones = np.zeros(64, dtype=np.int64)
        for begin in range(0, len(hashes), BLOCK):
            block = hashes[begin : begin + BLOCK]
            block = _mixed(block, part) if part else block
            bits = np.unpackbits(block.view(np.uint8), bitorder="little")
            ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
        out.append(int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0]))
    return out


def _mixed(numbers: np.ndarray, stream: int) -> np.ndarray:
    """Other 64-bit numbers, one of each, by multiplication and shifts."""
    x = numbers + np.uint64(stream * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text, signed."""
    return shingle_bits(text, words)[0]


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_key, fp): one row per document; a null text counts as empty.

    ``text_key`` tells apart the documents that share an id.
    """
    return _per_text(docs, ["fp"], lambda text: shingle_bits(text, words))


def _per_text(docs: DataFrame, names: list[str], make: Callable[[str], list[int]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [make(text_of(t)) for t in values(batch.column(2))]
            columns = np.array(rows, dtype=np.int64).reshape(len(rows), len(names)).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c) for c in columns)],
                names=["doc_id", "text_key", *names],
            )

    schema = "doc_id bigint, text_key bigint, " + ", ".join(f"{n} bigint" for n in names)
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text"
    ).mapInArrow(run, schema)


def gray_rank(code: Column) -> Column:
    """Place of a 64-bit code in the Gray sequence, as a long that sorts like it."""
    rank = code
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))  # unsigned order


#: Numbers of one index; a power of the fan-out, so that nodes of different indexes stay apart.
INDEX_SIZE = 1 << 48


def in_gray_order(codes: DataFrame) -> DataFrame:
    """The rows of a written table with ``number``, their place (from 0) by Gray rank of ``fp``.

    A column ``part`` tells several indexes apart; numbers of part p begin at p * INDEX_SIZE.
    Rows of one code follow each other in any order.
    """
    if "part" not in codes.columns:
        codes = codes.withColumn("part", F.lit(0))
    ranked = codes.withColumn("_gray", gray_rank(F.col("fp"))).withColumn(
        "_tie", F.monotonically_increasing_id()
    )
    placed = ranged_row_number(ranked, "part", ["_gray", "_tie"], "_rank")
    number = F.col("part").cast("bigint") * INDEX_SIZE + F.col("_rank") - 1
    return placed.withColumn("number", number).drop("part", "_gray", "_tie", "_rank")


def _level(below: DataFrame) -> DataFrame:
    """Nodes over rows (number, low, high): children in order, and AND and OR over them."""
    child = F.struct("number", "low", "high")
    nodes = below.groupBy(F.expr(f"number div {FANOUT}").alias("node")).agg(
        F.sort_array(F.collect_list(child)).alias("children"),
        F.bit_and("low").alias("low"), F.bit_or("high").alias("high"),
    )
    return nodes.select(
        "node", F.col("children.low").alias("lows"), F.col("children.high").alias("highs"),
        "low", "high",
    )


def _child_pairs(leaf: bool, limits: list[int]):
    """Pairs of children within reach; for leaves, edges that connect what is within reach.

    ``limits`` has the bits in which two children may differ, by the number of bits they share.
    """
    limit, allowed = limits[-1], np.array(limits, dtype=np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(i).to_numpy() for i in (0, 1))
            ends, masks, patterns = [], [], []
            for side in (2, 4):
                low, high = batch.column(side), batch.column(side + 1)
                lows = low.flatten().to_numpy().view(np.uint64)
                highs = high.flatten().to_numpy().view(np.uint64)
                ends.append(np.concatenate([[0], np.cumsum(low.value_lengths().to_numpy())]))
                patterns.append(lows)
                masks.append(~(lows ^ highs))
            first, second = [], []
            for row in range(len(a)):
                left = slice(ends[0][row], ends[0][row + 1])
                right = slice(ends[1][row], ends[1][row + 1])
                differ = patterns[0][left][:, None] ^ patterns[1][right][None, :]
                if leaf:
                    distance = np.bitwise_count(differ)
                    near = distance <= limit
                else:
                    shared = masks[0][left][:, None] & masks[1][right][None, :]
                    near = np.bitwise_count(differ & shared) <= allowed[np.bitwise_count(shared)]
                if a[row] == b[row]:
                    near = np.triu(near, 1 if leaf else 0)
                if leaf:
                    i, j = np.nonzero(near)
                    sides = patterns[0][left], patterns[1][right]
                    inner = None if a[row] == b[row] else lambda: tuple(
                        forest(np.bitwise_count(c[:, None] ^ c[None, :]) <= limit) for c in sides
                    )
                    pairs = _edges(distance[i, j], i, j, a[row] * FANOUT, b[row] * FANOUT, inner)
                else:
                    i, j = np.nonzero(near)
                    pairs = a[row] * FANOUT + i, b[row] * FANOUT + j
                first.append(pairs[0])
                second.append(pairs[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x) if x else [], pa.int64()) for x in (first, second)],
                names=["a", "b"],
            )

    return run


def _edges(
    distance: np.ndarray, i: np.ndarray, j: np.ndarray, first: int, second: int,
    inner: Callable[[], tuple[np.ndarray, np.ndarray]] | None,
) -> tuple[np.ndarray, np.ndarray]:
    """Edges of the shortest spanning forest of the links (i, j) between two leaves (or inside one).

    Between two leaves (``inner`` gives the groups inside each) what is linked inside either counts
    as connected: those edges come from the pair of the leaf with itself. So two leaves of one dense
    group give one edge, and not one for each code.
    """
    if len(i) < 2:
        return first + i, second + j
    order = np.argsort(distance, kind="stable")
    i, j = i[order], j[order]
    u, v = first + i, second + j
    if inner is not None:
        left, right = inner()
        u, v = first + left[i], second + right[j]
        # Of the links between the same two groups the shortest.
        once = np.sort(np.unique(left[i] * (len(right) + 1) + right[j], return_index=True)[1])
        i, j, u, v = i[once], j[once], u[once], v[once]
    parent: dict[int, int] = {}

    def root(n: int) -> int:
        while (above := parent.setdefault(n, n)) != n:
            parent[n] = n = parent.setdefault(above, above)
        return n

    kept = []
    for at, (x, y) in enumerate(zip(u.tolist(), v.tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[x] = y
            kept.append(at)
    return first + i[kept], second + j[kept]


def _words_differ(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Differing bits of the rows i of ``left`` and j of ``right``, over all words."""
    return np.bitwise_count(left[i] ^ right[j]).sum(axis=1, dtype=np.int64)


def _block_links(reach: int, limit: int, limits: list[int], parts: int):
    """Links of a spanning forest between the codes below two nodes (a, b), given as the rows of
    their leaves: those whose first word is within ``reach`` and whose ``parts`` words are within
    ``limit``. Pairs of leaves are pruned by ``limits`` first, as in ``_child_pairs``.

    The two nodes are the key or, where the rows are those of many, each row (a, b) of ``pairs``.
    """
    allowed = np.array(limits, dtype=np.uint8)

    def run(key: tuple, rows: pa.Table, pairs: pa.Table | None = None) -> pa.Table:
        met = [tuple(k.as_py() for k in key)] if pairs is None else zip(pairs["a"].to_pylist(), pairs["b"].to_pylist())
        rows = rows.select(["leaf", "fp", "words"]).sort_by("leaf").combine_chunks()
        number = rows["leaf"].to_numpy()
        column = rows["fp"].combine_chunks()
        ends = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])
        flat = column.flatten().to_numpy().view(np.uint64)
        prints = [flat[x:y] for x, y in zip(ends, ends[1:])]
        low, high = (f.reduceat(flat, ends[:-1]) for f in (np.bitwise_and, np.bitwise_or))
        mask = ~(low ^ high)
        flat = rows["words"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, parts)
        words = [flat[x:y] for x, y in zip(ends, ends[1:])]
        inside: dict[int, np.ndarray] = {}

        def groups(leaf: int) -> np.ndarray:
            if leaf not in inside:
                p, w = prints[leaf], words[leaf]
                linked = np.bitwise_count(w[:, None] ^ w[None]).sum(axis=2, dtype=np.int64) <= limit
                inside[leaf] = forest(linked & (np.bitwise_count(p[:, None] ^ p[None]) <= reach))
            return inside[leaf]

        found = []
        for a, b in met:
            left, right = (
                np.arange(*np.searchsorted(number, [node * FANOUT, (node + 1) * FANOUT])) for node in (a, b)
            )
            shared = mask[left][:, None] & mask[right][None, :]
            differ = (low[left][:, None] ^ low[right][None, :]) & shared
            near = np.bitwise_count(differ) <= allowed[np.bitwise_count(shared)]
            if a == b:
                near = np.triu(near)
            for x, y in zip(*(side[at] for side, at in zip((left, right), np.nonzero(near)))):
                close = np.bitwise_count(prints[x][:, None] ^ prints[y][None, :]) <= reach
                i, j = np.nonzero(np.triu(close, 1) if x == y else close)
                differ = _words_differ(words[x], words[y], i, j)
                i, j, differ = i[differ <= limit], j[differ <= limit], differ[differ <= limit]
                if len(i):
                    inner = None if x == y else lambda: (groups(x), groups(y))
                    found.append(_edges(differ, i, j, number[x] * FANOUT, number[y] * FANOUT, inner))
        first, second = (np.concatenate(side) for side in zip(*found)) if found else ([], [])
        return pa.table({"a": pa.array(first, pa.int64()), "b": pa.array(second, pa.int64())})

    return run


def _walk(codes: DataFrame, limits: list[int], indexes: int, leaves: bool) -> DataFrame:
    """The links found in the leaves or, without ``leaves``, pairs (a, b) of the nodes above the
    leaves that are not pruned.
    """
    rows = codes.select("number", F.col("fp").alias("low"), F.col("fp").alias("high"))
    levels = [stage(_level(rows), "gray-level")]
    while levels[-1].count() > indexes:
        above = levels[-1].select(F.col("node").alias("number"), "low", "high")
        levels.append(stage(_level(above), "gray-level"))
    top = levels[-1].select("node")
    if not leaves and len(levels) == 1:
        top = top.select(F.expr(f"node div {FANOUT}").alias("node")).distinct()
    pairs = top.select(F.col("node").alias("a"), F.col("node").alias("b"))
    for depth, level in reversed(list(enumerate(levels))):
        if depth <= 1 and not leaves:
            break
        left = level.select(F.col("node").alias("a"), F.col("lows").alias("l1"), F.col("highs").alias("h1"))
        right = level.select(F.col("node").alias("b"), F.col("lows").alias("l2"), F.col("highs").alias("h2"))
        met = pairs.join(left, "a").join(right, "b").select("a", "b", "l1", "h1", "l2", "h2")
        found = met.mapInArrow(_child_pairs(depth == 0, limits), "a bigint, b bigint")
        pairs = stage(found, "gray-pairs")
    return pairs


def near_links(codes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links between the numbers of ``codes`` (number 0.., fp), in Gray order, that
    connect exactly the codes connected by steps of at most ``max_bits`` differing bits.
    """
    return _walk(codes, [max_bits] * 65, 1, True)


#: Nodes of a tile at most, and tiles that an index has at least, if it has as many nodes.
TILE_NODES, LEAST_TILES = 32, 8
#: Leaves that a round of comparisons moves at most, as a multiple of all there are.
ROUND_LEAVES = 4


def _compared(
    pairs: DataFrame, codes: DataFrame, reach: int, limit: int, limits: list[int], parts: int, indexes: int
) -> DataFrame:
    """The links of ``_block_links`` for pairs of nodes above the leaves of ``codes`` (number, fp, words).

    Nodes that follow each other are a tile. A leaf goes once to each pair of its tile that has a
    pair of nodes, not to each pair of nodes. The pairs of tiles are compared in rounds, each of
    which moves a bounded number of leaves: what it moved goes before the next, so that the disk does
    not grow with the pairs.
    """
    leaves = stage(
        codes.groupBy(F.expr(f"number div {FANOUT}").alias("leaf"))
        .agg(F.sort_array(F.collect_list(F.struct("number", "fp", "words"))).alias("c"))
        .select("leaf", "c.fp", F.flatten("c.words").alias("words")),
        "gray-leaves",
    )
    n = leaves.count()
    size = max(1, min(TILE_NODES, n // (FANOUT * indexes * LEAST_TILES)))
    dealt = pairs.select("a", "b", F.expr(f"a div {size}").alias("left"), F.expr(f"b div {size}").alias("right"))
    tiles = stage(dealt.select("left", "right").distinct(), "gray-tiles")
    ends = tiles.agg(F.sum(F.when(F.col("left") == F.col("right"), 1).otherwise(2))).first()[0] or 0
    rounds = max(1, math.ceil(ends * size * FANOUT / (ROUND_LEAVES * max(n, 1))))
    both = F.when(F.col("left") == F.col("right"), F.array("left")).otherwise(F.array("left", "right"))
    sides = tiles.select("left", "right", F.explode(both).alias("tile"))
    placed = leaves.withColumn("tile", F.expr(f"leaf div {FANOUT * size}"))
    links = []
    for i in range(rounds):
        now = F.pmod(F.xxhash64("left", "right"), F.lit(rounds)) == i
        met = sides.where(now).join(placed, "tile").select("left", "right", "leaf", "fp", "words")
        found = met.groupBy("left", "right").cogroup(dealt.where(now).groupBy("left", "right")).applyInArrow(
            _block_links(reach, limit, limits, parts), "a bigint, b bigint"
        )
        links.append(stage(found, "similar-forest"))
    return reduce(DataFrame.unionByName, links)


def _between_entries(links: DataFrame, codes: DataFrame) -> DataFrame:
    """The distinct links between the entries of the linked numbers."""
    left = codes.select(F.col("number").alias("a"), F.col("entry").alias("e"))
    right = codes.select(F.col("number").alias("b"), F.col("entry").alias("f"))
    found = links.join(left, "a").join(right, "b")
    return found.select(F.least("e", "f").alias("a"), F.greatest("e", "f").alias("b")).distinct()


def similar_links(
    codes: DataFrame, reach: int, limit: int, prune_bits: int | list[int], indexes: int,
    verify: Callable[[DataFrame], DataFrame], within: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(a, b): verified links between the entries of ``codes`` (number, entry, fp, words), that
    connect what all links within reach that ``verify`` passes do.

    ``codes`` holds several indexes, numbered apart; groups are pruned when they differ in more
    than ``prune_bits`` of the bits that both share (a list: by the number of these). In the leaves that are left codes are linked by
    ``reach`` of the 64 bits of ``fp`` and ``limit`` of all bits of ``words``. First a spanning forest
    of the links is verified, which connects groups of near copies without their pairs. A
    link that ``verify`` rejects may have stood for others: so then, in each group that the forest
    connects, all entries that are not connected yet are compared, and nothing is left out.
    ``within`` finds the links between the labels of such members (entry, group, label) without a
    row for each pair; without it their pairs are verified.
    """
    parts = len(codes.first()["words"]) if codes.head(1) else 1
    limits = [prune_bits] * 65 if isinstance(prune_bits, int) else prune_bits
    pairs = _walk(codes, limits, indexes, False)
    links = _compared(pairs, codes, reach, limit, limits, parts, indexes)
    tried = stage(_between_entries(links, codes), "similar-tried")
    passed = stage(verify(tried), "similar-passed")
    members = _open_members(tried, passed)
    if within is None:
        x, y = (members.select("group", *[F.col(n).alias(f"{n}_{end}") for n in ("entry", "label")]) for end in "ab")
        pairs = x.join(y, "group").where("entry_a < entry_b and label_a <> label_b")
        pairs = pairs.select(F.col("entry_a").alias("a"), F.col("entry_b").alias("b"))
        return passed.unionByName(verify(pairs.join(tried, ["a", "b"], "left_anti")))
    return passed.unionByName(within(members))


def _open_members(tried: DataFrame, passed: DataFrame) -> DataFrame:
    """(entry, group, label) of the groups that ``tried`` connects, ``passed`` does not, and that have
    pairs not tried; the label is the part that ``passed`` connects.
    """
    grouped = stage(
        connected_components(tried, "similar").select(F.col("node").alias("entry"), F.col("component").alias("group")),
        "similar-grouped",
    )
    known = connected_components(passed, "similar")
    members = stage(
        grouped.join(known, grouped["entry"] == known["node"], "left").select(
            "entry", "group", F.coalesce("component", "entry").alias("label")
        ),
        "similar-members",
    )
    links = tried.join(grouped, tried["a"] == grouped["entry"]).groupBy("group").agg(F.count("*").alias("_tried"))
    sizes = members.groupBy("group").agg(F.count("*").alias("_n"), F.min("label").alias("_x"), F.max("label").alias("_y"))
    unsettled = stage(
        sizes.join(links, "group").where("_x < _y and _tried < _n * (_n - 1) / 2").select("group"), "similar-unsettled"
    )
    return stage(members.join(unsettled, "group").select("entry", "group", "label"), "similar-open")


def near_duplicates(
    docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """(doc_id, text_key, fp, component_id, component_number) for every document.

    Documents are linked if their fingerprints differ in at most ``max_bits`` bits;
    component_id is the smallest doc_id reachable, the document's own included. Null and
    empty texts have the fingerprint 0 and link like others. Null ids take part but name no
    component: a component of null ids alone has a null one. Repeated rows are one document each
    and share a component. No documents give no rows. Only doc_id and text are read.

    component_number tells components apart, those of null ids too. Documents of one fingerprint
    are one entry of the index, so copies cost nothing there.
    """
    prints = stage(fingerprints(docs, words), "fingerprints")
    distinct = stage(
        prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct"
    )
    codes = stage(in_gray_order(distinct), "gray-codes")
    found = stage(connected_components(near_links(codes, max_bits), "simhash"), "simhash-groups")
    grouped = codes.join(found, codes["number"] == found["node"], "left").select(
        "fp", "first_id", F.coalesce("component", "number").alias("component")
    )
    grouped = stage(grouped, "simhash-codes")
    least = stage(
        grouped.groupBy("component").agg(F.min("first_id").alias("component_id")), "simhash-least"
    )
    named = stage(grouped.join(least, "component").drop("first_id"), "simhash-named")
    return prints.join(named, "fp").select(
        "doc_id", "text_key", "fp", "component_id", F.col("component").alias("component_number")
    )


def near_duplicate_report(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


# Similar documents: five-word shingles, Jaccard similarity, and four fingerprints.
SIMILAR_WORDS = 5
SIMILARITY = 0.8
#: Fingerprints of a text that its links are filtered on; more may be made to search by.
PARTS = 4
MOST_PARTS = 8
PRUNE_BITS = 2
#: Least chance that the search meets a link of exactly ``SIMILARITY``.
RECALL = 0.99
#: Standard deviations between the mean and the limits of bits; the exact check follows.
DEVIATIONS = 3.0


def differing_share(similarity: float) -> float:
    """Share of SimHash bits in which texts of a Jaccard similarity differ, on average."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def bit_limit(bits: int, similarity: float, deviations: float) -> int:
    """Bits in which such texts differ at most, up to so many standard deviations."""
    share = differing_share(similarity)
    return math.floor(bits * share + deviations * math.sqrt(bits * share * (1 - share)))


def within(bits: int, limit: int, share: float) -> float:
    """Probability that at most ``limit`` of so many independent bits differ."""
    return math.fsum(
        math.comb(bits, i) * share**i * (1 - share) ** (bits - i) for i in range(min(bits, limit) + 1)
    )


def plan_indexes(
    n: int, similarity: float = SIMILARITY, recall: float = RECALL
) -> tuple[int, list[int]]:
    """Indexes for n texts, and the bits by which groups may differ, by the number they share.

    Leaves of a random order share about log2(n / FANOUT) bits, so a fixed limit would lose more
    links the larger n is. Of all numbers of indexes, each with the least limit that gives the
    recall, the one with the fewest comparisons is taken. Groups that share more bits, those
    of dense leaves, may differ in more, so that a link has the same chance there.
    """
    share = differing_share(similarity)
    depth = min(64, max(0, math.ceil(math.log2(max(n, FANOUT) / FANOUT))))
    reach = bit_limit(64, similarity, DEVIATIONS)
    kept = within(64, reach, share)
    plans = []
    for parts in range(PARTS, MOST_PARTS + 1):
        chance = (1 - (1 - recall) ** (1 / parts)) / kept
        limits = [next(k for k in range(s + 1) if k == s or within(s, k, share) >= chance) for s in range(65)]
        flat = max(PRUNE_BITS, limits[depth])
        met = sum(math.comb(depth, i) for i in range(min(flat, depth) + 1))
        plans.append((parts * met, parts, [min(reach, max(flat, k)) for k in limits]))
    return min(plans)[1:]


def set_prints(text: str, words: int, parts: int) -> list[int]:
    """A digest of the set of shingles, and ``parts`` words of its SimHash."""
    hashes = np.unique(shingle_hashes(text, words))
    digest = xxhash.xxh3_64_intdigest(hashes.tobytes()) if len(hashes) else 0
    return [digest - (digest >> 63 << 64), *_sum_bits(hashes, parts)]


def shingle_sets(texts: DataFrame, words: int) -> DataFrame:
    """(entry, shingles): the distinct shingle hashes of the texts of (entry, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 32):
            sets = [np.unique(shingle_hashes(text_of(t), words)).view("<i8") for t in values(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["entry", "shingles"]
            )

    return texts.select("entry", "text").mapInArrow(run, "entry bigint, shingles array<bigint>")


#: Rows of a list of documents that is broadcast, so that the texts do not move.
BROADCAST_ROWS = 2_000_000


def sets_of_entries(wanted: DataFrame, entries: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """(entry, shingles), a written table, of the entries ``wanted`` (entry).

    ``place`` (text_key, doc_id) names a document of the entry. The texts stay where they are: the
    list of wanted ones goes to them, a long one in pieces, with a scan of the documents for each.
    """
    needed = stage(
        entries.join(wanted, "entry").select(
            "entry", F.col("place.text_key").alias("_key"), F.col("place.doc_id").alias("_id")
        ),
        "similar-needed",
    )
    keyed = docs.select(
        F.col("doc_id").cast("bigint").alias("_doc"), F.xxhash64("text").alias("_text"), "text"
    )
    match = (F.col("_text") == F.col("_key")) & F.col("_doc").eqNullSafe(F.col("_id"))
    pieces = max(1, math.ceil(needed.count() / BROADCAST_ROWS))
    texts = [
        keyed.join(F.broadcast(needed.where(F.pmod("_key", F.lit(pieces)) == i)), match) for i in range(pieces)
    ]
    sets = shingle_sets(reduce(DataFrame.unionByName, texts), words)
    return stage(sets.dropDuplicates(["entry"]), "similar-shingles")


def verified_links(
    links: DataFrame, entries: DataFrame, docs: DataFrame, words: int, similarity: float
) -> DataFrame:
    """The links (a, b) between entries (entry, place) whose shingle sets have the similarity.

    Only the texts of linked entries are read again, one for each.
    """
    ends = links.select(F.col("a").alias("entry")).unionByName(links.select(F.col("b").alias("entry")))
    sets = sets_of_entries(ends.distinct(), entries, docs, words)
    left = sets.select(F.col("entry").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("entry").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    return (
        links.join(left, "a").join(right, "b")
        .where(common >= similarity * (F.size("x") + F.size("y") - common))
        .select("a", "b")
    )


#: Shingles of a block of entries: at least, at most, and blocks that a group has between the two.
LEAST_BLOCK, MOST_BLOCK, GROUP_BLOCKS = 1 << 14, 1 << 18, 32
#: An entry counts as so many shingles at least, which bounds the entries of a block.
LEAST_WEIGHT = 64
#: Shingles whose occurrences in two blocks are counted at once.
SLAB = 4_096


def links_within(
    members: DataFrame, entries: DataFrame, docs: DataFrame, words: int, similarity: float
) -> DataFrame:
    """(a, b): links that connect the labels of each group of ``members`` (entry, group, label) as all
    pairs of its entries whose shingle sets have the similarity do.

    The entries of a group are dealt into blocks of a bounded number of shingles, those of a large label
    into blocks of their own; two blocks meet in a task, which gives out a spanning forest of the
    labels. Blocks of one label do not meet. So neither rows nor memory grow with a group's pairs.
    """
    sets = sets_of_entries(members.select("entry"), entries, docs, words)
    weight = F.greatest(F.size("shingles"), F.lit(LEAST_WEIGHT)).cast("bigint").alias("weight")
    sized = members.join(sets.select("entry", weight), "entry")
    labels = stage(sized.groupBy("group", "label").agg(F.sum("weight").alias("weight")), "similar-labels")
    size = F.least(F.lit(MOST_BLOCK), F.greatest(F.lit(LEAST_BLOCK), F.expr(f"sum(weight) div {GROUP_BLOCKS}")))
    sizes = labels.groupBy("group").agg(size.alias("size"))
    homes = stage(
        labels.join(sizes, "group").select(
            "group", "label", "weight", "size", F.when(F.col("weight") >= F.col("size"), F.col("label")).otherwise(-1).alias("home")
        ),
        "similar-homes",
    )
    counts = stage(
        homes.groupBy("group", "home").agg(F.ceil(F.sum("weight") / F.first("size")).alias("blocks")), "similar-blocks"
    )
    blocks = counts.select("group", "home", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"))
    x, y = (blocks.select("group", *[F.col(n).alias(f"{n}_{end}") for n in ("home", "block")]) for end in "ab")
    first, second = (F.struct(F.col(f"home_{end}").alias("home"), F.col(f"block_{end}").alias("block")) for end in "ab")
    pairs = x.join(y, "group").where((first <= second) & ((F.col("home_a") != F.col("home_b")) | (F.col("home_a") < 0)))
    key = ["group", "home_a", "block_a", "home_b", "block_b"]
    sides = pairs.select(*key, F.explode(F.array_distinct(F.array(first, second))).alias("_s")).select(*key, "_s.*")
    block = F.pmod(F.xxhash64("entry"), F.col("blocks")).alias("block")
    dealt = stage(
        members.join(homes.select("group", "label", "home"), ["group", "label"]).join(counts, ["group", "home"])
        .select("entry", "group", "label", "home", block).join(sets.where(F.size("shingles") > 0), "entry"),
        "similar-dealt",
    )
    met = sides.join(dealt, ["group", "home", "block"]).select(*key, "home", "block", "entry", "label", "shingles")
    return met.groupBy(*key).applyInArrow(_label_links(similarity), "a bigint, b bigint")


def _label_links(similarity: float):
    """Links between the labels of two blocks of entries, or of one: a spanning forest of them."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        _, home_a, block_a, home_b, block_b = (k.as_py() for k in key)
        rows = rows.combine_chunks()
        home, block, entry, label = (rows[n].to_numpy() for n in ("home", "block", "entry", "label"))
        column = rows["shingles"].combine_chunks()
        sizes = column.value_lengths().to_numpy().astype(np.int64)
        values, owners = column.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)
        sides = [np.flatnonzero((home == h) & (block == b)) for h, b in ((home_a, block_a), (home_b, block_b))]
        place, inside = np.zeros(len(sizes), dtype=np.int64), []
        for side in sides:
            place[side] = np.arange(len(side))
            mine = np.isin(owners, side)
            inside.append((values[mine], place[owners[mine]]))
        met = np.intersect1d(inside[0][0], inside[1][0])
        common = np.zeros((len(sides[0]), len(sides[1])), dtype=np.float32)
        for begin in range(0, len(met), SLAB):
            slab, has = met[begin : begin + SLAB], []
            for (shingles, owner), side in zip(inside, sides):
                at = np.minimum(np.searchsorted(slab, shingles), len(slab) - 1)
                hit = slab[at] == shingles
                has.append(np.zeros((len(side), len(slab)), dtype=np.float32))
                has[-1][owner[hit], at[hit]] = 1
            common += has[0] @ has[1].T
        common = common.astype(np.float64)
        total = sizes[sides[0]][:, None] + sizes[sides[1]][None, :]
        near = (common >= similarity * (total - common)) & (label[sides[0]][:, None] != label[sides[1]][None, :])
        i, j = (side[at] for side, at in zip(sides, np.nonzero(near)))
        parent: dict[int, int] = {}

        def root(n: int) -> int:
            while (above := parent.setdefault(n, n)) != n:
                parent[n] = n = parent.setdefault(above, above)
            return n

        kept = []
        joined = np.stack([label[i], label[j]], axis=1)
        for at in np.unique(joined, axis=0, return_index=True)[1] if len(i) else ():
            u, v = root(int(label[i[at]])), root(int(label[j[at]]))
            if u != v:
                parent[u] = v
                kept.append(at)
        return pa.table({"a": pa.array(entry[i[kept]] if kept else [], pa.int64()),
                         "b": pa.array(entry[j[kept]] if kept else [], pa.int64())})

    return run


def similar_documents(
    docs: DataFrame, words: int = SIMILAR_WORDS, similarity: float = SIMILARITY
) -> DataFrame:
    """(doc_id, text_key, component_number): documents linked if their shingles are similar.

    Linked are texts whose sets of word shingles have a Jaccard similarity of at least
    ``similarity``. Such texts differ in 15 of 100 SimHash bits, far more than a search by
    few differing bits finds. So several fingerprints of 64 bits are made of the same sets,
    each with an index of its own in which groups are pruned when they differ in more bits than
    ``plan_indexes`` allows; what one index prunes by chance another finds. Their number
    follows that of the documents, so that the search meets a link of similarity 0.8 with
    probability ``RECALL`` at every size. A link found is filtered on ``64 * PARTS`` bits and
    then decided by the exact similarity of the two sets (of 64-bit hashes). Texts of
    one set are one entry. Cases are those of ``near_duplicates``.
    """
    count, limits = plan_indexes(docs.count(), similarity)
    names = ["fp", *(f"fp{i}" for i in range(1, count))]

    def make(text: str) -> list[int]:
        worker_state(("simhash",), dict)  # what an earlier stage left in the worker goes
        return set_prints(text, words, count)

    spark = docs.sparkSession
    prints = _per_text(docs, ["set_key", *names], make)
    prints = stage(prints, "similar-prints")

    def numbered_entries() -> DataFrame:
        found = prints.groupBy("set_key", *names).agg(F.min(F.struct("text_key", "doc_id")).alias("place"))
        return stage(found, "similar-distinct").withColumn("entry", F.monotonically_increasing_id())

    def ordered_codes() -> DataFrame:
        parts = entries.select(
            "entry", F.array(*names[:PARTS]).alias("words"), F.posexplode(F.array(*names)).alias("part", "fp")
        )
        return in_gray_order(stage(parts, "similar-parts"))

    def links() -> DataFrame:
        codes = stage_last(spark, "similar-codes", ordered_codes)
        return similar_links(
            codes, bit_limit(64, similarity, DEVIATIONS), bit_limit(64 * PARTS, similarity, DEVIATIONS),
            limits, count, lambda links: verified_links(links, *check), lambda members: links_within(members, *check),
        )

    entries = stage_last(spark, "similar-entries", numbered_entries)
    check = (entries, docs, words, similarity)
    linked = stage_last(spark, "similar-linked", links)
    groups = connected_components(linked, "similar")
    numbered = stage(
        entries.join(groups, entries["entry"] == groups["node"], "left").select(
            "set_key", *names, F.coalesce("component", "entry").alias("component_number")
        ),
        "similar-groups",
    )
    return prints.join(numbered, ["set_key", *names]).select("doc_id", "text_key", "component_number")


def representatives(docs: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """The documents of which no near duplicate ranks earlier, with the columns of ``docs``.

    Of each group of ``found`` (those of ``similar_documents`` by default) the document with the
    smallest doc_id stays (null last, then by text hash); of rows with the same id and text one.
    """
    found = similar_documents(docs) if found is None else found
    rank = F.struct(
        F.col("doc_id").isNull().alias("last"), F.coalesce("doc_id", F.lit(0)).alias("id"), "text_key"
    )
    counts = stage(
        found.groupBy("component_number", "doc_id", "text_key").agg(F.count("*").alias("_n")), "simhash-counts"
    )
    best = stage(counts.groupBy("component_number").agg(F.min(rank).alias("best")), "simhash-best")
    told = stage(
        counts.join(best, "component_number").select(
            F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "_n", (rank == F.col("best")).alias("_stays")
        ),
        "simhash-told",
    )
    names = docs.columns
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"),
        F.col("doc_id").cast("bigint").alias("_doc"), F.xxhash64("text").alias("_text"),
    )
    match = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_key"))
    # The texts stay where they are, but for rows with the same id and text.
    apart = told.where("not _stays or _n > 1")
    n, again = apart.agg(F.count("*"), F.count_if("_stays")).first()
    if n > BROADCAST_ROWS:
        one = keyed.join(told.where("_stays"), match, "left_semi").dropDuplicates(["_doc", "_text"])
        return one.select("_row.*")
    one = keyed.join(F.broadcast(apart), match, "left_anti")
    if again:
        one = one.unionByName(
            keyed.join(F.broadcast(apart.where("_stays")), match, "left_semi").dropDuplicates(["_doc", "_text"])
        )
    return one.select("_row.*")
