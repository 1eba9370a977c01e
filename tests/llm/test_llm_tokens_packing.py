import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from spanloom.llm import packing, tokens

DDL = "doc_id bigint, text string"
ALPHABET = [
    " ", " ", " ", "\n", "a", "the", "Straße", "é", "1", "²", ".", ",", "'s", "don't", "\xa0", " ",
    "\x1c", "\x85", "日本", "\t", "<|endoftext|>", "́", "\r\n", "🙂",
]
EDGE_TEXTS = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "\n\nfoo bar ", "x <|endoftext|> y", "w" * 5000,
    "word, word; (word) word.\nWord word " * 300,
]


def library(text):
    return tokens.load_tokenizer(tokens.TOKENIZER).encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(ALPHABET), max_size=24))
def test_pieces_give_the_tokens_of_the_library(parts):
    text = "".join(parts)
    ids = packing.document_ids(text, tokens.TOKENIZER, 1)
    assert ids.tolist() == library(text) + [1]


def test_merges_of_single_words_are_the_models():
    merge = tokens.merge_table(tokens.TOKENIZER)._core_bpe.encode_single_piece
    model = tokens.load_tokenizer(tokens.TOKENIZER).model
    rng = random.Random(2)
    words = [" " + "".join(rng.choices("etaoinshrdluéßж日", k=rng.randint(1, 30))) for _ in range(5_000)]
    words += [" " + w for w in ("the", "a", "Internationalization", "x" * 3_000)]
    for word in words:
        mapped = "".join(map(tokens.ByteLetters().__getitem__, word))
        assert merge(word.encode()) == [t.id for t in model.tokenize(mapped)]
    # Every token that a pre-token may be as a whole is reached by the merges.
    for token in model_tokens():
        assert merge(token.encode()) == [t.id for t in model.tokenize("".join(map(tokens.ByteLetters().__getitem__, token)))]


def model_tokens():
    library = tokens.load_tokenizer(tokens.TOKENIZER)
    found = (library.decode([i], skip_special_tokens=False) for i in range(library.get_vocab_size()))
    return [t for t in found if t.isalpha() or t[:1] == " " and t[1:].isalpha()]


def test_other_vocabularies_have_no_table():
    assert tokens.merge_table("word_bpe_49k.json") is None


SETTLED = "aZ éÀßɏ 09²¼\n\t\r.,'!?’—€¿«×ªstrelvmd  "


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=SETTLED, max_size=60))
def test_whole_texts_give_the_ids_of_the_library(text):
    assert tokens.WholeTexts(tokens.TOKENIZER).ids(text) == library(text)


def test_every_settled_character_in_every_place():
    whole = tokens.WholeTexts(tokens.TOKENIZER)
    chars = [c for c in map(chr, range(0x2100)) if tokens._SETTLED.fullmatch(c)]
    assert len(chars) > 500
    for c in chars:
        for text in (c, f"a{c}b", f" {c}1", f"1 {c}", f"{c}{c} .", f"'{c}s {c}'s", f"\n{c}\n\n{c}"):
            assert whole.ids(text) == library(text), text


def test_whole_texts_in_runs_and_left_to_the_library(monkeypatch):
    whole = tokens.WholeTexts(tokens.TOKENIZER)
    assert whole.ids("a <|endoftext|> b") is None and whole.ids("日本") is None and whole.ids("a\u00a0b") is None
    assert whole.ids("^" * 70_000) is None
    monkeypatch.setattr(tokens, "RUN_CHARS", 7)
    rng = random.Random(6)
    for _ in range(300):
        text = "".join(rng.choices(SETTLED, k=rng.randint(0, 80)))
        assert whole.ids(text) == library(text)


def test_cache_generations_keep_values_right(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED", 3)
    pieces = tokens.length_pieces(tokens.TOKENIZER, {"the": 1})
    rng = random.Random(5)
    for _ in range(300):
        text = " ".join(rng.choice(["the", "cat,", "sat", "on", "mats", "ünd", "x1"]) for _ in range(9))
        assert pieces.of(text) == len(library(text))
    assert len(pieces) <= 4 and len(pieces.old) <= 4


def test_counts_of_edge_texts(spark):
    rows = [(i, t) for i, t in enumerate(EDGE_TEXTS)] + [(None, "null id"), (1, ""), (5, "a"), (5, "a")]
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], DDL + ", n_tokens int, piece string")
    got = sorted(map(str, tokens.document_tokens(docs, limit=20).collect()))
    want = []
    for doc_id, text in rows:
        n = len(library(text))
        want.append(f"Row(doc_id={doc_id}, n_bytes={len((text or '').encode())}, n_tokens={n}, over_limit={n > 20})")
    assert got == sorted(want)
    counted = tokens.count_tokens(docs)
    assert counted.columns == ["doc_id", "text", "piece", "n_tokens"]
    assert tokens.count_tokens(docs.limit(0)).count() == 0


def check_pieces(rows, texts, window):
    """Each id in one piece, sequences without gaps and within the window."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
        assert r.length > 0
    for doc_id, text in texts.items():
        ids = np.array(library(text) + [1], "<u4")
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert bytes(r.ids) == ids[at : at + r.length].tobytes()
            at += r.length
        assert at == len(ids)
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= window
    return [sum(n for _, n in s) for s in by_sequence.values()]


def test_packing_round_trip(spark, monkeypatch):
    monkeypatch.setattr(packing, "SEGMENT", 3000)
    monkeypatch.setattr(packing, "BATCH_BYTES", 2000)
    texts = dict(enumerate(EDGE_TEXTS))
    docs = spark.createDataFrame([(i, t, 0, 0) for i, t in texts.items()], DDL + ", ids int, start int")
    for window in (16, 2048):
        rows = packing.pack(docs.coalesce(1), window, free_lengths=()).collect()
        check_pieces(rows, texts, window)
    digest = packing.packed_documents(docs).collect()
    rows = packing.pack(docs).collect()
    assert sorted((r.doc_id, r.start, r.ids_crc32) for r in digest) == sorted(
        (r.doc_id, r.start, zlib.crc32(bytes(r.ids))) for r in rows
    )
    assert packing.pack(docs.limit(0)).count() == 0


def test_repeated_and_null_ids_are_packed_each(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c"), (None, None)], DDL)
    rows = packing.pack(docs.coalesce(1)).collect()
    assert sum(r.length for r in rows) == 2 * (len(library("a b")) + 1) + len(library("c")) + 1 + 1


@pytest.mark.parametrize("seed", range(8))
def test_plan_is_the_cheapest(seed):
    """Against a quadratic search over all plans."""
    rng = random.Random(seed)
    at = sorted({0, *(rng.randint(1, 300) for _ in range(40))})
    at = [p for i, p in enumerate(at) if i == 0 or p - at[i - 1] <= 32]
    window, free = 32, (8, 16)
    while any(b - a > window for a, b in zip(at, at[1:])):
        at = sorted({*at, *(a + window for a, b in zip(at, at[1:]) if b - a > window)})
    penalty = [0.0] + [rng.choice([0.0, 4.0, 64.0]) for _ in at[1:]]

    def padding(n):
        return 0 if n in free else window - n

    best = [0.0] + [float("inf")] * (len(at) - 1)
    for j in range(1, len(at)):
        for i in range(j):
            if at[j] - at[i] <= window:
                cost = best[i] + padding(at[j] - at[i]) + penalty[j] + packing.PER_SEQUENCE
                best[j] = min(best[j], cost)
    plan = packing.best_windows(at, penalty, window, free)
    place = {p: i for i, p in enumerate(at)}
    cost = sum(
        padding(b - a) + penalty[place[b]] + packing.PER_SEQUENCE for a, b in zip(plan, plan[1:])
    )
    assert plan[0] == at[0] and plan[-1] == at[-1] and cost == pytest.approx(best[-1])


def test_frequent_pieces_are_those_from_some_frequency_on(spark):
    rows = [(f"p{i}", n) for i, n in enumerate([900, 500, 500, 40, 8, 8, 8, 2, 1, 1, 1, 1])] + [("q", 10**12)]
    counts = spark.createDataFrame(rows, "piece string, n bigint")
    for most, want in [(0, 0), (1, 1), (2, 2), (3, 2), (4, 4), (5, 5), (7, 5), (8, 8), (12, 9), (13, 13), (99, 13)]:
        got = tokens.frequent_pieces(counts, most)
        assert sorted(got) == sorted(p for p, _ in sorted(rows, key=lambda r: -r[1])[:want])
    assert tokens.frequent_pieces(counts.limit(0)) == []
    assert tokens.frequent_pieces(counts.where("n = 1"), 3) == []
