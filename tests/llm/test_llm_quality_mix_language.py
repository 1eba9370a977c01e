import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from spanloom.llm import langid, mixing, quality

# ---- quality --------------------------------------------------------------------------------


def plain_signals(text):
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    lines = [x for x in text.split("\n") if any(c not in " \t\n\x0b\x0c\r" for c in x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(hit), len(lines),
    )


@pytest.mark.parametrize("seed", range(6))
def test_signals_follow_the_definition(seed):
    rng = random.Random(seed)
    parts = ["a", "b", "#x", " ", "\n", "é|", "\x1c", "\t", " a b a b "]
    for _ in range(60):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        assert quality.signals(text) == plain_signals(text)


def test_binomial_tail_is_exact():
    for n, k, p in ((10, 0, 0.1), (50, 3, 0.02), (200, 9, 0.05), (5, 5, 0.5), (3000, 20, 0.01)):
        want = sum(
            Fraction(math.comb(n, i)) * Fraction(p) ** i * (1 - Fraction(p)) ** (n - i) for i in range(k + 1)
        )
        assert quality.binomial_tail(n, k, p) == pytest.approx(float(want), rel=1e-9)


def test_cutoffs_stop_at_the_first_failure():
    grid = [0.4, 0.3, 0.2, 0.1]
    good = np.array([1000, 0, 0, 1000, 0])  # above 0.1 and 0.2 there are 1000 good ones
    bad = np.array([0, 0, 0, 0, 50])
    assert quality.choose_cutoff(grid, good, bad, 0.01, 0.01) == 0.4
    assert quality.choose_cutoff(grid, np.array([20, 0, 0, 0, 0]), bad, 0.01, 0.01) is None
    assert quality.choose_cutoff(grid, good, np.zeros(5, int), 0.01, 0.01) is None
    assert quality.choose_cutoff(grid, good * 0, bad, 0.01, 0.01) is None


def words(rng, n=30):
    return " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))


def quality_tables(spark):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(1600):
        bad = i % 4 == 0
        docs.append((i, words(rng) + (" ".join(f" $#{k}" for k in range(20)) if bad else ""), "en" if i % 2 or bad else None, "x"))
        labels.append((i, 0 if bad else 1, 0))
    docs += [(5000, None, "en", "x"), (5001, "", "xx", "x"), (None, words(rng), "xx", "x"),
             (5002, words(rng) + " ".join(f" $#{k}" for k in range(30)), "xx", "x"), (1, docs[1][1], "en", "x")]
    labels += [(None, 1, 0), (3, None, 0), (3, 1, 0), (1, 1, 0), (99_999, 0, 1)]
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string, lang string, n_words string"),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), docs, labels,
    )


def test_verdicts(spark):
    docs, labels, rows, _ = quality_tables(spark)
    got = quality.judge(docs, labels, alpha=0.2).collect()
    assert len(got) == len(rows)
    by_id = {(r.doc_id, r.stratum): r for r in got}
    bad = [by_id[(i, "en")] for i in range(0, 1600, 4)]
    assert all("symbols" in r.rejected_by and not r.kept for r in bad)
    good = [r for r in got if r.doc_id is not None and r.doc_id < 1600 and r.doc_id % 4]
    assert sum(r.kept for r in good) >= 0.95 * len(good)
    assert by_id[(5000, "en")].base_failed and by_id[(5001, "xx")].n_words == 0
    # A stratum without labels has no cutoff: the base rules alone decide.
    assert by_id[(5002, "xx")].kept and by_id[(None, "xx")].kept and by_id[(5002, "xx")].symbols is None
    none = quality.verdicts(docs, labels.limit(0)).collect()
    assert all(r.kept != r.base_failed for r in none)
    assert quality.verdicts(docs.limit(0), labels).count() == 0


# ---- mixing ---------------------------------------------------------------------------------


def plain_targets(sizes):
    """The fixed point of sharing under the limit, in exact numbers."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, limited = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in limited)
        open_weight = sum(weight[s] for s in names if s not in limited)
        share = {s: Fraction(rest * weight[s], open_weight) for s in names if s not in limited}
        over = {s for s, t in share.items() if t > 3 * sizes[s]}
        if not over:
            return {s: float(3 * sizes[s] if s in limited else share[s]) for s in names}
        limited |= over


def mix_rows():
    rng = random.Random(4)
    rows = [(i, "w " * rng.randint(0, 40), rng.choice(["b", "b", "b", "é", "Z", "a", None])) for i in range(900)]
    rows += [(1000, None, "a"), (1001, "one two", "rare"), (None, "x y z", "a"), (1005, "w w", "b"), (1005, "w w", "b"),
             (1002, "", "empty")]
    return rows


def test_mix_sizes(spark):
    rows = mix_rows()
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id bigint, text string, source string, target double")
    got = mixing.mix_sizes(docs).collect()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    targets = plain_targets(sizes)
    assert len(got) == len(rows)
    source_of = {i: s for i, _, s in rows}
    taken = Counter()
    for r in got:
        if r.doc_id is not None:
            source = source_of[r.doc_id]
            assert r.source_size == sizes[source] and r.target == pytest.approx(targets[source])
            taken[source] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    for source in ("b", "é", "Z"):
        assert abs(taken[source] - targets[source]) < 0.2 * targets[source]
    again = mixing.mix_sizes(docs.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mix_sizes(docs.limit(0)).count() == 0


def test_mix_emits_the_copies(spark):
    rows = mix_rows()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, source string, _row string")
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    copies = Counter((r.doc_id, r.text) for r in out.collect())
    taken = {(r.doc_id, r.size): r.taken for r in mixing.mix_sizes(docs).collect()}
    repeats = Counter((i, t) for i, t, _ in rows)
    for (doc_id, text), n in repeats.items():
        size = len((text or "").split())
        if size:
            assert copies[(doc_id, text)] * size == n * taken[(doc_id, size)]


def test_a_corpus_without_words_stays_once(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id bigint, text string, source string")
    assert [(r.taken, r.target) for r in mixing.mix_sizes(docs).collect()] == [(0, 0.0), (0, 0.0)]
    assert mixing.mix(docs).count() == 2


# ---- languages ------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(5))
def test_automaton_knows_all_substrings(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice("abcé ") for _ in range(200))
    root = langid.linked_states(langid.suffix_automaton(text))

    def longest(word):
        return max((n for n in range(len(word) + 1) if word[:n] in text), default=0)

    def phrases(word):
        n = 0
        while word:
            word = word[max(1, longest(word)) :]
            n += 1
        return n

    for _ in range(200):
        word = "".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 12)))
        assert langid.count_phrases(word, root) == phrases(word)


def language_rows():
    rng = random.Random(8)
    syllables = {"aa": ["ka", "to", "mi", "ru"], "bb": ["sch", "ung", "ein", "ver"], "cc": ["eau", "ille", "que", "ment"]}
    rows = []
    for i in range(900):
        lang = rng.choice(list(syllables))
        text = " ".join("".join(rng.choices(syllables[lang], k=rng.randint(1, 4))) for _ in range(40))
        rows.append((i, lang, text))
    return rows


def test_held_out_accuracy_and_edge_texts(spark):
    import zlib

    rows = language_rows()
    odd = [(2000, "aa", None), (2001, "aa", ""), (2002, "bb", "123 $$ ...\n"), (None, "cc", "eau que ment"),
           (2003, None, "kato mi"), (2003, None, "kato mi"), (2004, "aa", "ka" * 50_000), (2005, "zz", "λλ")]
    docs = spark.createDataFrame([(*r, "s") for r in rows + odd], "doc_id bigint, lang string, text string, score string")
    got = langid.document_languages(docs).collect()
    assert len(got) == len(rows) + len(odd)
    want = {i: lang for i, lang, _ in rows}
    held = [r for r in got if r.held_out and r.doc_id in want]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert sum(r.lang_pred == want[r.doc_id] for r in held) >= 0.99 * len(held)
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].lang_pred for i in (2000, 2001, 2002)] == ["und"] * 3
    assert by_id[2003].lang_pred == by_id[2004].lang_pred == "aa" and by_id[None].lang_pred == "cc"
    assert all(0 <= r.score <= 1 for r in got)
    kept = langid.identified_documents(docs)
    assert kept.columns == docs.columns and kept.count() == len(got) - 3
    unlabelled = docs.selectExpr("doc_id", "cast(null as string) as lang", "text")
    assert {r.lang_pred for r in langid.document_languages(unlabelled).collect()} == {"und"}
    assert langid.document_languages(docs.limit(0)).count() == 0
