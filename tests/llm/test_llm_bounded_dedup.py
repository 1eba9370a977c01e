import os
import random

import pyarrow as pa
from test_llm_dedup import groups

from spanloom.llm import lines, simhash
from spanloom.staging import staging_root

DOCS = "doc_id bigint, text string"


def bits(a, b):
    return sum((int(x) ^ int(y)).bit_count() for x, y in zip(a, b))


def test_the_forest_of_two_nodes_connects_what_their_links_do():
    """Dense leaves, and codes that other words hold together but not the first."""
    rng = random.Random(8)
    base = [rng.getrandbits(64) for _ in range(4)]
    rows, codes = [], {}
    for leaf in (0, 1, 64, 65):
        own = []
        for _ in range(40):
            words = [w ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 12))) for w in base]
            own.append([words[0], words])
        own.sort(key=lambda c: c[0])
        codes |= {leaf * 64 + n: w for n, (_, w) in enumerate(own)}
        signed = [[x - (x >> 63 << 64) for x in w] for _, w in own]
        rows.append({"leaf": leaf, "fp": [w[0] for w in signed], "words": [x for w in signed for x in w]})
    table = pa.Table.from_pylist(rows)
    run = simhash._block_links(8, 50, [64] * 65, 4)
    got = []
    for a, b in ((0, 0), (0, 1), (1, 1)):
        mine = table.filter(pa.array([r["leaf"] // 64 in (a, b) for r in rows]))
        out = run((pa.scalar(a), pa.scalar(b)), mine)
        got += zip(out["a"].to_pylist(), out["b"].to_pylist())
    linked = [
        (x, y) for x in codes for y in codes
        if x < y and bits(codes[x][:1], codes[y][:1]) <= 8 and bits(codes[x], codes[y]) <= 50
    ]
    assert len(got) < len(linked) and set(got) <= set(linked)
    assert groups(got, codes) == groups(linked, codes)


def test_leaves_move_once_for_each_pair_of_tiles_and_in_rounds(spark, monkeypatch):
    """Nothing is pruned here, so that all nodes of an index meet."""
    monkeypatch.setattr(simhash, "FANOUT", 4)
    moved, tables, real, write = spark.sparkContext.accumulator(0), [], simhash._block_links, simhash.stage

    def counted(*given):
        links = real(*given)

        def run(key, rows, pairs=None):
            moved.add(rows.num_rows)
            return links(key, rows) if pairs is None else links(key, rows, pairs)

        return run

    def staged(df, name):
        before, out = moved.value, write(df, name)
        tables.append((name, moved.value - before))
        return out

    monkeypatch.setattr(simhash, "_block_links", counted)
    monkeypatch.setattr(simhash, "stage", staged)
    rng, codes = random.Random(3), {}
    for part in (0, 1):
        fps = []
        for _ in range(60):
            base = rng.getrandbits(64)
            fps += [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for _ in range(10)]
        fps = [x - (x >> 63 << 64) for x in fps]
        frame = spark.createDataFrame([(i, x, part) for i, x in enumerate(fps)], "entry bigint, fp bigint, part int")
        codes[part] = (fps, frame)
    both = codes[0][1].unionByName(codes[1][1]).selectExpr("entry", "fp", "part", "array(fp) as words")
    ordered = write(simhash.in_gray_order(write(both, "codes")), "codes")
    links = simhash.similar_links(ordered, 9, 9, 64, 2, lambda found: found).select("a", "b").collect()
    near = [
        (i, j) for fps, _ in codes.values() for i in range(600) for j in range(i)
        if bits([fps[i] % 2**64], [fps[j] % 2**64]) <= 9
    ]
    assert groups([tuple(r) for r in links], range(600)) == groups(near, range(600))
    # 300 leaves, 38 nodes and 10 tiles in each index.
    rounds = [n for name, n in tables if name == "similar-forest"]
    assert len(rounds) > 1 and max(rounds) < 2 * simhash.ROUND_LEAVES * 300
    assert 300 * 9 < sum(rounds) == moved.value < 300 * 11


def test_labels_of_two_blocks_are_linked_by_exact_similarity():
    rng = random.Random(9)
    base = list(range(100))
    sets = [sorted({*rng.sample(base, rng.randint(80, 100)), *(1000 * i + n for n in range(rng.randint(0, 8)))}) for i in range(60)]
    label = [i % 11 for i in range(60)]
    rows = pa.table({
        "home": pa.array([-1] * 60), "block": pa.array([i % 2 for i in range(60)]), "entry": pa.array(range(60)),
        "label": pa.array(label), "shingles": pa.array(sets, pa.list_(pa.int64())),
    })
    got = []
    for x, y in ((0, 0), (0, 1), (1, 1)):
        out = simhash._label_links(0.8)(tuple(map(pa.scalar, (5, -1, x, -1, y))), rows.filter(pa.array([i % 2 in (x, y) for i in range(60)])))
        assert out.num_rows < 11
        got += zip(out["a"].to_pylist(), out["b"].to_pylist())

    def near(i, j):
        return len({*sets[i]} & {*sets[j]}) >= 0.8 * len({*sets[i]} | {*sets[j]})

    pairs = [(label[i], label[j]) for i in range(60) for j in range(i) if near(i, j) and label[i] != label[j]]
    assert all(near(i, j) for i, j in got) and pairs
    assert groups([(label[i], label[j]) for i, j in got], range(11)) == groups(pairs, range(11))


def test_a_group_whose_copies_are_just_too_far_apart(spark):
    """Each copy is similar to the first text or to none; no pair of them is."""
    rng = random.Random(4)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(300)]
    rows = [(0, " ".join(base))]
    for n in range(1, 90):
        copy, edits = list(base), 4 if n % 3 else 9
        for k in rng.sample(range(29), edits):
            copy[5 + 10 * k] = f"own{n}x{k}"
        rows.append((n, " ".join(copy)))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(296)} for _, t in rows]
    pairs = [(i, j) for i in range(90) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    want = groups(pairs, range(90))
    found = simhash.similar_documents(spark.createDataFrame(rows, DOCS)).collect()
    parts = {}
    for r in found:
        parts.setdefault(r.component_number, set()).add(want[r.doc_id])
    assert len(parts) == len(set(want.values())) > 2 and all(len(p) == 1 for p in parts.values())


def test_texts_do_not_move_when_representatives_stay(spark):
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, "b"), (3, "b"), (None, "b"), (None, "c"), (4, None), (4, None)]
    docs = spark.createDataFrame(rows, DOCS)
    found = simhash.near_duplicates(docs)
    best = {}
    for r in found.collect():
        best.setdefault(r.component_number, []).append(r.doc_id)
    kept = [r.doc_id for r in simhash.representatives(docs, found).collect()]
    assert len(kept) == len(best)
    one = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], DOCS)
    out = simhash.representatives(one, simhash.near_duplicates(one))
    assert "hashpartitioning" not in out._jdf.queryExecution().toString()


def test_units_are_gone_before_the_texts_move(spark):
    docs = spark.createDataFrame([(i, f"one line that is the same everywhere\nand one of number {i} alone") for i in range(9)], DOCS)
    root = staging_root(spark).removeprefix("file:")
    before = {n for n in os.listdir(root) if n.startswith(("units-", "repeated-units-"))}
    out = lines.remove_repeats(docs)
    assert {n for n in os.listdir(root) if n.startswith(("units-", "repeated-units-"))} == before
    assert sum(r.n_units for r in out.collect()) == 8
