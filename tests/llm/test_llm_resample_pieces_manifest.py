"""Resampling against a plain version, pieces against the library, proofs against a plain tree."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from spanloom.llm import manifest, pieces, resample
from spanloom.llm.tokens import tokenizer_path

# ---- resampling towards a target ------------------------------------------------------------

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
TEXTS = [
    None, "", " \n", "one", "The CAT sat.", "Ä b\x00c\x7fd 日本 ẞ", "a a a a a", "x" * 30_000,
    " ".join(f"w{i % 7}" for i in range(9_000)), "the cat sat on the mat " * 6, "same words here " * 9,
]


def plain_features(text, n):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]
    return len(words), [crc32(r.encode()) for r in runs]


def plain_resample(docs, target, percent, min_words, n, buckets):
    found = [(i, *plain_features(t, n)) for i, t in docs]
    corpus = Counter(c % buckets for _, _, crcs in found for c in crcs)
    wanted = Counter(c % buckets for t in target for c in plain_features(t, n)[1])
    s_all, t_all = sum(corpus.values()), sum(wanted.values())
    gain = [
        math.floor(1000 * math.log(
            (wanted[b] + 1) * (s_all + buckets) / ((corpus[b] + 1) * (t_all + buckets))))
        for b in range(buckets)
    ]
    rows = []
    for i, n_words, crcs in found:
        weight = sum(gain[c % buckets] for c in crcs) // len(crcs) if crcs else 0
        key = f"7:{'' if i is None else i}".encode()
        h = int(hashlib.sha256(key).hexdigest()[:8], 16)
        draw = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(crcs), weight, weight + draw, None, n_words])
    able = [r for r in rows if r[5] >= min_words]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for place, row in enumerate(able[: len(able) * percent // 100]):
        row[4] = place + 1
    return Counter(tuple(r[:5]) for r in rows)


@pytest.mark.parametrize("n, buckets, percent", [(2, 10_000, 25), (3, 70_000, 60), (1, 11, 100)])
def test_resampling_equals_the_plain_version(spark, n, buckets, percent):
    texts = TEXTS + [" ".join(random.Random(i).choices("a b c d e f g".split(), k=i)) for i in range(60)]
    rows = [(None if i % 17 == 4 else i, t) for i, t in enumerate(texts)] + [(9, texts[9])] * 2
    docs = spark.createDataFrame(
        [(*r, 1, "x") for r in rows], "doc_id bigint, text string, weight int, bucket string"
    ).repartition(5)
    target = spark.createDataFrame([("the cat sat",), (None,), ("a b c a b",)], "text string")
    got = resample.resample(docs, target, percent, 3, n, buckets)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = plain_resample(rows, [r[0] for r in target.collect()], percent, 3, n, buckets)
    assert Counter(map(tuple, got.collect())) == want


def test_resampling_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    target = docs.select("text")
    assert resample.resample(docs.limit(0), target).collect() == []
    assert resample.resample(docs, target.limit(0), 100, 1).where("rank = 1").count() == 1


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aZ09 éA\n.~@`日{", max_size=60))
def test_features_and_their_spans(text):
    found = list(resample.features(text))
    low = resample.lowered(text)
    assert sorted(b for b, _, _ in found) == sorted(c % 10_000 for c in plain_features(text, 2)[1])
    for bucket, start, end in found:
        words = WORDS.findall(low[start:end])
        assert crc32(" ".join(words).encode()) % 10_000 == bucket


def test_runs_cut_long_texts_at_gaps():
    text = "ab cd" * 4_000 + "z" * 5_000 + " q"
    words = [w for run in resample.word_runs(text) for w in run]
    assert [w for w, _ in words] == WORDS.findall(text)
    assert all(text[s:e] == w for w, (s, e) in words)


# ---- pieces ---------------------------------------------------------------------------------

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(pieces.MODEL))
MODEL = pieces.load_model(pieces.MODEL)


def ids_of(texts):
    return [np.frombuffer(x, "<i4").tolist() for x in pieces.Encoder(MODEL).encode_all(texts)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abeinstr  ▁\n\t019.,'é日本語\x00🙂ﬁ-_", max_size=80))
def test_ids_are_those_of_the_library(text):
    (ids,) = ids_of([text])
    assert ids == LIBRARY.encode(text)
    assert MODEL.decode(np.array(ids, dtype="<i4")) == LIBRARY.decode(ids)


def test_long_words_and_many_ties():
    rng = random.Random(3)
    texts = ["a" * n for n in range(70)] + [" " * n for n in range(70)]
    texts += ["".join(rng.choices("ab", k=400)) for _ in range(40)]
    texts += ["".join(rng.choices("etaoinshrdlu", k=5_000)) for _ in range(4)]
    texts += ["word " * 3_000, "日本語" * 2_000, "x\ny" * 900]
    assert ids_of(texts) == LIBRARY.encode(texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 270), st.integers(0, 31_999)), max_size=12))
def test_any_ids_are_decoded_like_the_library(ids):
    assert MODEL.decode(np.array(ids, dtype="<i4")) == LIBRARY.decode(ids)


def test_words_are_forgotten_and_runs_cut(monkeypatch):
    monkeypatch.setattr(pieces, "RUN_CHARS", 50)
    encoder = pieces.Encoder(MODEL, limit=3_000)
    rng = random.Random(8)
    for _ in range(50):
        texts = [" ".join(str(rng.random()) + "x" * rng.randint(0, 60) for _ in range(9)) for _ in range(4)]
        texts += ["", "   ", "  lead", "x" * 300]
        got = [np.frombuffer(x, "<i4").tolist() for x in encoder.encode_all(texts)]
        assert got == LIBRARY.encode(texts)
        assert len(encoder.known) < 400


def test_round_trip_of_edge_texts(spark, monkeypatch):
    texts = [None, "", " ", "a", "▁", " a▁b ", "\n\n", "w " * 40_000, "a", "🙂é\x00"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "b"), (3, "a")]
    docs = spark.createDataFrame(
        [(*r, "y", 3) for r in rows], "doc_id bigint, text string, ids string, decoded int"
    )
    want = Counter()
    for i, text in rows:
        ids = LIBRARY.encode(text or "")
        shas = [
            hashlib.sha256(x.encode()).hexdigest()
            for x in (",".join(map(str, ids)), LIBRARY.decode(ids))
        ]
        want[(i, len(ids), *shas)] += 1
    assert Counter(map(tuple, pieces.round_trip(docs).collect())) == want
    coded = pieces.encode(docs)
    assert coded.columns == ["doc_id", "text", "decoded", "ids"]
    assert pieces.decode(coded).columns == ["doc_id", "text", "ids", "decoded"]
    assert pieces.round_trip(docs.limit(0)).collect() == []


def test_other_models_are_refused(monkeypatch):
    class Lower:
        def __init__(self, model_file):
            pass

        def normalize(self, text):
            return text.lower()

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Lower)
    with pytest.raises(ValueError):
        pieces.PieceModel("other")


# ---- the manifest ---------------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, more=0):
    fields = (row[0], row[3], row[2], row[4] if row[4] is None else row[4] + more, row[1])
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return levels


def plain_path(levels, at):
    for level in levels[:-1]:
        yield (level[at ^ 1] if at ^ 1 < len(level) else ""), at & 1
        at >>= 1


def plain_audit(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, plain_leaf(row), row))
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {k: plain_levels([g[2] for g in sorted(groups[k], key=lambda g: g[:3])]) for k in keys}
    top = plain_levels([trees[k][-1][0] for k in keys])
    out = Counter()
    for n, k in enumerate(keys):
        for i, (_, _, leaf, row) in enumerate(sorted(groups[k], key=lambda g: g[:3])):
            path = [*plain_path(trees[k], i), *plain_path(top, n)]
            bad = row[0] is not None and row[4] is not None and crc32(str(row[0]).encode()) % 7 == 0
            node = plain_leaf(row, 1) if bad else leaf
            for other, odd in path:
                node = sha(other, node) if odd else sha(node, other)
            proof, root = sha(*(p[0] for p in path)), top[-1][0]
            assert (node == root) is not bad
            out[(row[0], leaf, trees[k][-1][0], root, proof, node, not bad)] += 1
    return out


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD = [
    (None, "t", "en", "s", 3), (None, None, None, None, None), (5, "aé", "", "s", None),
    (5, "aé", "", "s", None), (7, "x", ":", "s", 1), (14, "", "zz", None, 0), (14, "y", "zz", None, 0),
    (2**60 + 1, "big", "en", "s", 1), (-7, "neg", "en", "s", 1), (8, "long " * 50_000, "é", "s", 9),
]


@pytest.mark.parametrize("height", [1, 2, 3, 10])
@pytest.mark.parametrize("n", [1, 4, 37])
def test_proofs_of_every_row(spark, height, n):
    rows = ODD + [(i, f"w{i}", "de", "q", i) for i in range(n)]
    docs = spark.createDataFrame([(*r, "e") for r in rows], DOCS + ", grp string").repartition(3)
    got = manifest.audit(docs, height)
    assert Counter(map(tuple, got.collect())) == plain_audit(rows)


def test_one_row_and_no_row(spark):
    docs = spark.createDataFrame([(1, "a", None, None, 1)], DOCS)
    (row,) = manifest.audit(docs).collect()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == sha() and row.verified
    assert manifest.audit(docs.limit(0)).collect() == []
    assert manifest.build_manifest(docs.limit(0)).root is None


@pytest.mark.parametrize("levels", range(1, 12))
def test_layout_is_a_permutation_with_whole_halves(levels):
    places = manifest.addresses(levels)
    assert sorted(np.concatenate(places).tolist()) == list(range(2**levels - 1))
    upper = levels // 2
    assert sum(len(p) for p in places[:upper]) == 2**upper - 1
    assert all(p.max() < 2**upper - 1 for p in places[:upper])
    # Each tree below is a run of its own.
    size = 2 ** (levels - upper) - 1
    for depth in range(upper, levels):
        tree = np.arange(2**depth) >> (depth - upper)
        assert ((places[depth] - (2**upper - 1)) // size == tree).all()


@pytest.mark.parametrize("leaves, height", [(1, 0), (1, 3), (5, 3), (8, 3), (700, 10)])
def test_subtree_and_its_siblings(leaves, height):
    digests = [sha(str(i)) for i in range(leaves)]
    tree = manifest.Subtree.build(digests, height)
    for i in range(leaves):
        assert len(tree.siblings(i)) == height
        assert manifest.fold(digests[i], tree.siblings(i)) == tree.root
        assert manifest.fold(sha("other"), tree.siblings(i)) != tree.root or not height
