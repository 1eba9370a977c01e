"""Language identification by cross-parsing with suffix automata.

For every language a suffix automaton over labelled text knows all its substrings. A word is
parsed against it into phrases: each phrase is the longest match that begins where the last one
ended (a letter that the language never showed is a phrase of its own). Phrases are normalised by
the length of the text, which is the same for all languages, and the automata are built over
samples of one size; the language that needs the fewest wins, of equals the more frequent one.

Words are parsed with the spaces around them, and phrases end at word ends. So the counts of a word are the same wherever it stands, and a worker
keeps those it has seen; only new words are parsed. Texts are read whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from spanloom.llm.tables import rows_beside, slices, values, worker_state

#: Bounds of the labelled sample that a model is fitted on: about so many documents a language,
#: one piece of so many characters from each, and languages at most (the most frequent).
SAMPLE_DOCS = 48
SAMPLE_CHARS = 1024
LANGUAGES = 200
SEED = 7
#: Words a worker remembers, and the longest of them.
CACHED = 100_000
WORD_CHARS = 48
UNKNOWN = "und"

_CODE_BITS = 21  # a Unicode code point


def letter_runs(text: str) -> list[str]:
    """Maximal runs of letters, lower-cased."""
    return ["".join(run) for is_letter, run in groupby(text.lower(), str.isalpha) if is_letter]


def suffix_automaton(text: str) -> dict[int, int]:
    """Transitions (state << 21 | code point) -> state << 21; the root is 0."""
    nexts: list[dict] = [{}]
    link, length = [-1], [0]
    last = 0
    for char in text:
        code = ord(char)
        state = len(nexts)
        nexts.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and code not in nexts[p]:
            nexts[p][code] = state
            p = link[p]
        if p >= 0:
            q = nexts[p][code]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and nexts[p].get(code) == q:
                    nexts[p][code] = clone
                    p = link[p]
                link[q] = link[state] = clone
        last = state
    return {
        state << _CODE_BITS | code: target << _CODE_BITS
        for state, moves in enumerate(nexts) for code, target in moves.items()
    }


def linked_states(moves: dict[int, int]) -> dict:
    """The automaton as its root: each state is a dictionary from a letter to the next state."""
    states: dict[int, dict] = {0: {}}
    for key, target in moves.items():
        state = states.setdefault(key >> _CODE_BITS << _CODE_BITS, {})
        letter = chr(key & ((1 << _CODE_BITS) - 1))
        state[letter] = states.setdefault(target, {})
    return states[0]


def count_phrases(word: str, root: dict) -> int:
    """Phrases of the cross-parsing of a word."""
    phrases, state = 0, root
    for letter in word:
        following = state.get(letter)
        if following is None:
            if state is not root:
                phrases += 1
            following = root.get(letter)
            if following is None:
                phrases += 1
                following = root
        state = following
    return phrases + (state is not root)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is divisible by 5; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _automata(groups: pd.DataFrame) -> pd.DataFrame:
    """One row: the language's automaton, as two arrays, and how many documents it has."""
    groups = groups.sort_values(["piece"])
    text = " ".join(["", *(run for piece in groups["piece"] for run in letter_runs(piece)), ""])
    moves = suffix_automaton(text)
    return pd.DataFrame({
        "lang": [groups["lang"].iloc[0]],
        "states": [np.fromiter(moves.keys(), "<i8", len(moves)).tobytes()],
        "targets": [np.fromiter(moves.values(), "<i8", len(moves)).tobytes()],
        "n": [groups["n"].iloc[0]],
    })


def fit(labelled: DataFrame, docs: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> list[tuple]:
    """(language, states, targets), the most frequent first, from (doc_id, lang, text) rows.

    Which documents enter the bounded sample is decided by a hash of their id against the
    number of documents of the language, so any size of input gives about ``docs`` of them, and
    every run the same. The automata are built in parallel, one task a language.
    """
    known = labelled.where("lang is not null and doc_id is not null and text rlike '\\\\p{L}'")
    counts = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang")
    share = F.lit(float(docs)) / F.col("n")
    draw = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    start = F.pmod(F.xxhash64("doc_id"), F.greatest(F.length("text") - chars, F.lit(1))) + 1
    sample = (
        known.join(counts.limit(LANGUAGES), "lang").where(draw < share)
        .select("lang", "n", F.substr("text", start.cast("int"), F.lit(chars)).alias("piece"))
    )
    built = sample.groupBy("lang").applyInPandas(
        _automata, "lang string, states binary, targets binary, n bigint"
    )
    rows = sorted(built.collect(), key=lambda row: (-row.n, row.lang))
    return [(row.lang, row.states, row.targets) for row in rows]


class Parser:
    """Phrase counts of words in every language, remembered by word."""

    def __init__(self, model: list[tuple]):
        self.languages = [lang for lang, *_ in model]
        self.roots = [
            linked_states(dict(zip(np.frombuffer(s, "<i8").tolist(), np.frombuffer(t, "<i8").tolist())))
            for _, s, t in model
        ]
        self.known: dict[str, int] = {}
        self.counts = np.zeros((1024, len(model)), dtype=np.int64)
        self.used = 1  # row 0: no letters

    def _parse(self, runs: list[str]) -> int:
        """A new row with the phrases of some runs of letters."""
        if not runs:
            return 0
        if self.used == len(self.counts):
            self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
        self.counts[self.used] = [
            sum(count_phrases(f" {run} ", root) for run in runs) for root in self.roots
        ]
        self.used += 1
        return self.used - 1

    def _row(self, word: str) -> int:
        """The row of a word, which is that of its lower-case letters where it has one run."""
        row = self.known.get(word)
        if row is None:
            lower = word.lower()
            if lower != word:
                row = self._row(lower)
            elif word.isalpha():
                row = self._parse([word])
            elif word[:-1].isalpha():
                row = self._row(word[:-1])
            else:
                row = self._parse(letter_runs(word))
            if len(word) <= WORD_CHARS:
                self.known[word] = row
        return row

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: the share of the runner-up's phrases that the winner saves."""
        if len(self.known) > CACHED:
            self.known, self.used = {}, 1
        known, rows = self.known, []
        for word in (text or "").split():
            row = known.get(word)
            rows.append(self._row(word) if row is None else row)
        if not any(rows) or not self.languages:
            return UNKNOWN, 0.0
        phrases = self.counts[rows].sum(axis=0)
        order = np.argsort(phrases, kind="stable")
        if len(order) == 1:
            return self.languages[0], 1.0
        return self.languages[order[0]], float(1.0 - phrases[order[0]] / phrases[order[1]])


def identify(docs: DataFrame, model: list[tuple], passed: list[str] | None = None) -> DataFrame:
    """The columns ``passed`` (all by default) with ``lang_pred`` and ``score``.

    Predictions use the text alone. A null text, one without a letter, and every text if the
    model knows no language give ``und`` and 0. Ties go to the language with more documents.
    Repeated rows are predicted each; an empty table gives an empty one; columns named like the
    two results are replaced.
    """
    kept = [c for c in passed or docs.columns if c not in ("lang_pred", "score")]
    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    run = uuid.uuid4().hex
    # A text that is passed is read where it is and does not move twice.
    beside = "text" not in kept
    at = 0 if beside else kept.index("text")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = worker_state(("languages", run), lambda: Parser(shared.value))
        for batch in slices(batches):
            found = [parser.predict(text) for text in values(batch.column(at))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[beside:], pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())],
                names=[*kept, "lang_pred", "score"],
            )

    read = [F.col("text").alias("_read")] if beside else []
    return docs.select(*read, *kept).mapInArrow(predict, schema)


def fit_on_training_part(docs: DataFrame) -> list[tuple]:
    """The model learned from the documents that are not held out."""
    return fit(docs.select("doc_id", "lang", "text").where(~held_out(F.col("doc_id"))))


def document_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document."""
    model = fit_on_training_part(docs)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return identify(rows, model, ["doc_id", "held_out"])


def identified_documents(docs: DataFrame) -> DataFrame:
    """The documents whose language is found, with their own columns."""
    rest, columns = rows_beside(docs)
    kept = identify(docs.select(rest, F.col("text").alias("text")), fit_on_training_part(docs)).where(F.col("lang_pred") != UNKNOWN)
    return kept.select(*columns(F.col("text")))
