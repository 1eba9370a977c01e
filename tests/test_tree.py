import random
import uuid
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import model
from model import frame, span
from spanloom.operators import preorder, skew, tree
from spanloom.operators.skew import heavy_keys, ranged_row_number
from spanloom.operators.spans import resolve_resent
from spanloom.operators.tree import build_forest
from spanloom.staging import stage


def by_trace(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["traceid"]].append(r)
    return groups


def edge_cases():
    rows = [
        # no root: the last span in order becomes the root
        span("noroot", "a", "x", begin=1), span("noroot", "b", "a", begin=2),
        span("noroot", "c", "b", begin=0),
        # two spans with the id of the trace
        span("tworoots", "tworoots", None, "second", begin=5, event="sr"),
        span("tworoots", "tworoots", "q", "first", begin=4),
        span("tworoots", "k", "tworoots", begin=6),
        # a span sent twice: its subtree repeats
        span("dup", "dup", None, "root", event="sr"),
        span("dup", "a", "dup", begin=1), span("dup", "a", "dup", begin=1),
        span("dup", "b", "a", begin=2), span("dup", "c", "b", begin=3),
        # its own parent, and a child that is not a client send
        span("self", "self", None, "root", event="sr"),
        span("self", "a", "a", begin=1), span("self", "b", "self", begin=1, event="sr"),
        span("self", "c", "b", begin=2),
        # equal begin, names that differ in case only
        span("case", "case", None, "root", event="sr"),
        span("case", "2", "case", "Get", begin=1), span("case", "1", "case", "get", begin=1),
        span("case", "3", "case", "A", begin=1),
        # a cycle below the root
        span("cycle", "cycle", None, "root", event="sr"),
        span("cycle", "a", "cycle", "x", begin=1), span("cycle", "cycle", "a", "y", begin=2),
        # one span only
        span("one", "one", None, "http:/", region="r1", error_count=1),
    ]
    chain = [span("deep", "deep", None, "root", event="sr", begin=0)]
    previous = "deep"
    for i in range(150):
        chain.append(span("deep", f"d{i}", previous, begin=i + 1))
        previous = f"d{i}"
    return rows + chain


def random_rows(seed, traces):
    rng = random.Random(seed)
    rows = []
    for t in range(traces):
        tid = f"t{t:03d}"
        ids = [f"{tid}-{i}" for i in range(rng.randint(1, 12))]
        if rng.random() < 0.8:
            ids[0] = tid
        for i, sid in enumerate(ids):
            parent = rng.choice(ids[:i] or [None]) if rng.random() < 0.9 else rng.choice(ids)
            rows.append(span(
                tid, sid, parent, rng.choice(["a", "A", "b", "Ü"]), begin=rng.randint(0, 4),
                event=rng.choice(["cs", "cs", "cs", "sr"]), error_count=int(rng.random() < 0.1),
                span_type=rng.choice(["REDIS", "MYSQL", "RESTTEMPLATE", "OTHER"]),
                region=rng.choice([None, "r1"]),
            ))
            if rng.random() < 0.03:
                rows.append(dict(rows[-1]))
    return rows


def expected(rows):
    summaries, steps = [], []
    for tid, group in by_trace(rows).items():
        summaries.append(model.summary(group))
        for pos, (level, s) in enumerate(model.preorder(group)):
            parent = tid if pos == 0 else s["parent"]
            steps.append((tid, pos, level, s["spanid"], parent, s["name"], s["event"]))
    return sorted(tuple(str(v) for v in s.values()) for s in summaries), sorted(map(str, steps))


def actual(forest):
    got = [tuple(str(v) for v in r) for r in forest.summary().collect()]
    columns = ["traceid", "pos", "level", "spanid", "parent", "name", "event"]
    steps = [str(tuple(r)) for r in forest.steps().select(*columns).collect()]
    return sorted(got), sorted(steps)


ROWS = edge_cases() + random_rows(7, 150)
SHALLOW = [r for r in ROWS if r["traceid"] != "deep"]


@pytest.mark.parametrize("few", [0, tree.FEW_EDGES])
def test_inline_trees_match_the_rules(spark, monkeypatch, few):
    monkeypatch.setattr(tree, "FEW_EDGES", few)
    assert actual(build_forest(frame(spark, ROWS), None)) == expected(ROWS)


@pytest.mark.parametrize("limit, run_nodes", [(0, 65_536), (3, 65_536), (0, 2), (3, 5)])
def test_ranked_trees_match_the_rules(spark, monkeypatch, limit, run_nodes):
    """Whole trees in a task, and runs of few nodes that are put together by joins."""
    plain = tree.preorder
    monkeypatch.setattr(tree, "preorder", lambda nodes, edges: plain(nodes, edges, run_nodes))
    spans = frame(spark, ROWS)
    heavy = heavy_keys(spans, "traceid", limit)
    assert heavy is not None
    assert actual(build_forest(spans, heavy)) == expected(ROWS)


def test_a_deep_chain_is_whole(spark):
    rows = [r for r in ROWS if r["traceid"] == "deep"]
    steps = build_forest(frame(spark, rows), None).steps()
    assert tuple(steps.agg(F.max("level"), F.count("*")).first()) == (150, 151)


def chain_sent(times, depth=30):
    rows = []
    for again in range(times):
        previous = None
        for i in range(depth + 1):
            sid = f"c{i}" if i else "chain"
            rows.append(span("chain", sid, previous, f"n{i}", begin=i * 1000, event="cs" if i else "sr",
                             receive=10_000 + again))
            previous = sid
    return rows


@pytest.mark.parametrize("limit", [None, 10])
def test_a_chain_sent_again_does_not_grow(spark, limit):
    """Copies become leaves; resolved by the store's key they are gone, in either job."""
    rows = chain_sent(3)
    spans = frame(spark, rows)
    heavy = limit and heavy_keys(spans, "traceid", limit)
    forest = build_forest(spans, heavy)
    assert actual(forest) == expected(rows)
    assert forest.summary().first().steps_total == 1 + 3 * 30
    once = build_forest(resolve_resent(spans), None).summary().first()
    assert once.steps_total == 31
    plain = build_forest(frame(spark, chain_sent(1)), None).summary().first()
    assert once.trace_md5 == plain.trace_md5


def test_a_parent_with_most_spans(spark):
    rows = [span("hot", "hot", None, "root", event="sr")]
    rows += [span("hot", f"{i:05d}", "hot", f"n{i % 7}", begin=i) for i in range(600)]
    rows += [span("hot", "leaf", "00300", begin=700)]
    spans = frame(spark, rows)
    assert actual(build_forest(spans, heavy_keys(spans, "traceid", 100))) == expected(rows)


def jobs_of(spark, work):
    """The number of Spark jobs that ``work`` takes."""
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    group = uuid.uuid4().hex
    context.setJobGroup(group, "counted")
    try:
        work()
        return len(tracker.getJobIdsForGroup(group))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def chain(spark, length, width=1):
    """A chain, each of whose spans has ``width - 1`` leaves besides."""
    return spark.range(length).selectExpr(
        f"id div {width} as at", f"id % {width} as leaf"
    ).selectExpr(
        "concat('n', at % 5) as name", "'c' as traceid",
        "if(at = 0 and leaf = 0, 'c', concat('s', at, '-', leaf)) as spanid",
        "case when at = 0 and leaf = 0 then null when at = (if(leaf = 0, 1, 0)) then 'c' "
        "else concat('s', at - if(leaf = 0, 1, 0), '-0') end as parent",
        "at * 10 + leaf as begin", "at * 10 + leaf + 5 as end", "5L as duration", "1000L as receive",
        "if(at = 0 and leaf = 0, 'sr', 'cs') as event", "'s' as service", "'1' as ip",
        "cast(null as string) as http_host", "0L as error_count", "'OTHER' as span_type",
        "cast(null as string) as region", "cast(null as string) as page_id",
    )


def test_a_chain_of_100000_spans_takes_few_jobs(spark, tmp_path):
    spans = stage(chain(spark, 100_000), "chain")
    heavy = heavy_keys(spans, "traceid", 2_048)
    found = []

    def work():
        steps = build_forest(spans, heavy).steps()
        found.append(steps.where("level = pos and spanid = if(pos = 0, 'c', concat('s', pos, '-0'))").count())

    assert jobs_of(spark, work) < 40
    assert found == [100_000]


def test_rounds_follow_the_logarithm_of_the_depth(spark, monkeypatch):
    """Doubling by joins: a chain eight times as deep takes three rounds more."""
    plain = tree.preorder
    monkeypatch.setattr(tree, "preorder", lambda nodes, edges: plain(nodes, edges, 4))
    counts = []
    for length in (300, 2_400):
        spans = stage(chain(spark, length, 3), "chain")
        forest = []
        counts.append(jobs_of(
            spark, lambda: forest.append(build_forest(spans, heavy_keys(spans, "traceid", 100)))
        ))
        rows = forest[0].steps().select("pos", "level", "spanid").orderBy("pos").collect()
        whole = [r.asDict() for r in spans.collect()]
        want = [(i, level, s["spanid"]) for i, (level, s) in enumerate(model.preorder(whole))]
        assert [tuple(r) for r in rows] == want
    assert counts[1] - counts[0] <= 12


def plain_places(parents, root):
    places, stack = {}, [(root, 0)]
    while stack:
        node, level = stack.pop()
        places[node] = (len(places), level)
        stack += [(c, level + 1) for c in sorted(parents, reverse=True) if parents[c] == node]
    return places


@pytest.mark.parametrize("run_nodes", [1, 4, 1_000])
def test_preorder_of_random_forests_with_cycles(spark, run_nodes):
    rng = random.Random(run_nodes)
    nodes, edges, want = [], [], set()
    for name in "abcdefgh":
        size = rng.randint(1, 40)
        root = rng.randint(1, size)
        parents = {
            r: rng.randint(1, size) for r in range(1, size + 1) if r != root and rng.random() < 0.9
        }
        if name < "d":  # shallow cycles are likely; these have none
            parents = {r: rng.randint(1, r - 1) for r in range(2, size + 1)}
            root = 1
        parents = {r: p for r, p in parents.items() if p != r}
        nodes += [(name, r, r == root) for r in range(1, size + 1)]
        edges += [(name, p, r) for r, p in parents.items()]
        want |= {(name, r, *place) for r, place in plain_places(parents, root).items()}
    got = preorder.preorder(
        spark.createDataFrame(nodes, "tree string, rank bigint, is_root boolean"),
        spark.createDataFrame(edges, "tree string, parent bigint, rank bigint"), run_nodes,
    )
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)


def test_segments_hold_every_step_once(spark, monkeypatch):
    monkeypatch.setattr(tree, "SEGMENT_STEPS", 4)
    spans = frame(spark, SHALLOW)
    for heavy in (None, heavy_keys(spans, "traceid", 3)):
        forest = build_forest(spans, heavy)
        segments = forest.segments("trace_md5")
        assert segments.where(F.size("steps") > 4).isEmpty()
        flat = segments.select("traceid", F.posexplode("steps").alias("at", "t"), "segment")
        got = flat.where(F.col("t.pos") == F.col("segment") * 4 + F.col("at")).select(
            "traceid", "t.pos", "t.level", "t.spanid", "t.parent", "t.name", "t.event"
        )
        assert sorted(str(tuple(r)) for r in got.collect()) == expected(SHALLOW)[1]


def test_results_do_not_depend_on_row_order_or_partitions(spark):
    shuffled = list(ROWS)
    random.Random(3).shuffle(shuffled)
    again = frame(spark, shuffled).repartition(7)
    assert actual(build_forest(again, None)) == expected(ROWS)


def test_ranged_row_number_splits_a_large_key(spark):
    rows = spark.range(5000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('k', id % 50)) as key", "id * 7919 % 5003 as v", "id"
    )
    placed = ranged_row_number(rows, "key", ["v", "id"], "n")
    from pyspark.sql import Window

    wanted = rows.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy("v", "id")))
    assert sorted(map(tuple, placed.select("key", "id", "n").collect())) == sorted(
        map(tuple, wanted.select("key", "id", "n").collect())
    )


def test_more_heavy_keys_than_may_be_broadcast(spark, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_KEYS", 2)
    spans = frame(spark, SHALLOW)
    heavy = heavy_keys(spans, "traceid", 3)
    assert heavy.count > 2 and heavy.giants().count() <= 2
    light, wide = skew.split_heavy(spans, heavy)
    sizes = {t: len(rows) for t, rows in by_trace(SHALLOW).items()}
    assert {r.traceid for r in light.collect()} == {t for t, n in sizes.items() if n <= 3}
    assert light.count() + wide.count() == len(SHALLOW)
    assert actual(build_forest(spans, heavy)) == expected(SHALLOW)


def test_sized_join_splits_the_giants(spark, monkeypatch):
    rows = spark.range(1000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 40)) as key", "id")
    groups = rows.groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("last"))
    wanted = sorted(map(str, rows.join(groups, "key").collect()))
    for keys in (3, 100):
        monkeypatch.setattr(skew, "BROADCAST_KEYS", keys)
        for key in ("key", ["key"]):
            assert sorted(map(str, skew.join_sized(rows, groups, key, "n").collect())) == wanted


def test_long_lists_move_a_few_times_in_all(spark, monkeypatch):
    """A binary tree numbered by levels, whose tour leaves every run at once: rounds do not each move it all."""
    monkeypatch.setattr(preorder, "DOUBLED", 0, raising=False)
    moved = []

    def counting(df, name):
        rows = stage(df, name)
        if name in ("list-jumps", "ranked-lists"):
            moved.append(rows.count())
        return rows

    monkeypatch.setattr(preorder, "stage", counting)
    n = 6_000
    nodes = spark.range(1, n + 1).selectExpr("'t' as tree", "id as rank", "id = 1 as is_root")
    edges = spark.range(2, n + 1).selectExpr("'t' as tree", "id div 2 as parent", "id as rank")
    got = preorder.preorder(nodes, edges, 64).orderBy("pos").collect()
    want, stack = [], [(1, 0)]
    while stack:
        rank, level = stack.pop()
        want.append((rank, level))
        stack += [(c, level + 1) for c in (2 * rank + 1, 2 * rank) if c <= n]
    assert [(r.rank, r.level) for r in got] == want
    assert sum(moved) < 10 * n


@pytest.mark.parametrize("run_nodes", [2, 7])
def test_halved_lists_of_random_forests_with_cycles(spark, monkeypatch, run_nodes):
    monkeypatch.setattr(preorder, "DOUBLED", 0, raising=False)
    test_preorder_of_random_forests_with_cycles(spark, run_nodes)
