"""Token counts by a map-side lookup in two tiers.

A text is cut at every single space between two visible characters. The byte-level
pre-tokenizer cuts at each of these places too (a space joins the word after it, and nothing
matches across the start of such a word), so the tokens of a text are the tokens of its
pieces in order. Piece lengths come from

* tier 1, a broadcast table of the pieces that are most frequent in all texts, of at most
  ``FREQUENT`` entries of at most ``PIECE_CHARS`` characters, and
* tier 2, a cache in every Python worker, filled by encoding what tier 1 misses.

No piece is shuffled: the pieces of a text are counted in the task that reads it. Tier 1 is
chosen by counts that every task keeps in bounded space (rare pieces may be forgotten), so
the choice is approximate; the token counts are exact whatever it holds.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from array import array
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, functions as F

from spanloom.llm.tables import slices, text_of, values, worker_cache, worker_state
from spanloom.staging import stage

TOKENIZER = "byte_bpe_50k.json"
#: Entries of the broadcast table, candidates for it per task, and the longest piece in it.
FREQUENT = 65_536
CANDIDATES = 16_384
PIECE_CHARS = 48
#: Pieces that a task counts before it forgets the rarer ones.
COUNTED = 200_000
#: Entries of a generation of a worker's cache, which has two; of one for ids, where a piece is
#: encoded faster and takes more space.
CACHED = 400_000
CACHED_IDS = 100_000

#: The letters that the byte-level alphabet writes for bytes: visible Latin-1 for itself, the others
#: as the letters from U+0100 on, in order.
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _VISIBLE)}


class ByteLetters(dict):
    """A character in the byte-level alphabet: a letter for each of its UTF-8 bytes."""

    def __missing__(self, char: str) -> str:
        self[char] = "".join(chr(BYTE_LETTERS.get(b, b)) for b in char.encode())
        return self[char]


_byte_letters = ByteLetters()
_SPACE = _byte_letters[" "]

_SPACE_BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")


def tokenizer_path(name: str) -> str:
    """A file, or the name of one of the public tokenizers."""
    return name if os.path.exists(name) else public_tokenizers.path(name)


@worker_cache
def load_tokenizer(name: str):
    """The tokenizer of a Python worker, without truncation or padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path(name))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


#: Fixed value: how the byte-level pre-tokenizer cuts a text.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose classes no two versions of Unicode tell differently.
_SETTLED = re.compile("[\t\n\r -~¡-ɏ‘’“”–—…€]*")
#: Characters merged at a time, and the longest run without a place to cut that is.
RUN_CHARS = 16_384
LONGEST_RUN = 65_536


@worker_cache
def merge_table(name: str):
    """The tokenizer's own vocabulary as a table of tiktoken, which merges faster; or None.

    The ids are the tokenizer's if its vocabulary is the bytes and then the merges in their order, and it
    cuts texts by ``PRE_TOKENS`` and does nothing else to them.
    """
    import tiktoken

    whole = json.loads(load_tokenizer(name).to_str())
    model, cut = whole["model"], whole["pre_tokenizer"] or {}
    if model["type"] != "BPE" or any(model.get(k) for k in (
        "dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"
    )):
        return None
    if whole["normalizer"] or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space"):
        return None
    if not cut.get("use_regex", True):
        return None
    vocab = model["vocab"]
    letters = {chr(BYTE_LETTERS.get(b, b)): b for b in range(256)}
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    if sorted(vocab.get(c, -1) for c in letters) != list(range(256)) or [
        vocab.get(m) for m in merged
    ] != list(range(256, 256 + len(merged))):
        return None
    ranks = {bytes(map(letters.__getitem__, t)): vocab[t] for t in (*letters, *merged)}
    return tiktoken.Encoding(name, pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})


class WholeTexts:
    """Ids of whole texts by the merge table, where it is sure to give the library's."""

    def __init__(self, name: str):
        self.table = merge_table(name)
        added = load_tokenizer(name).get_added_tokens_decoder().values()
        self.special = [t.content for t in added]

    def ids(self, text: str) -> list[int] | None:
        """None for a text that the library's own way must be taken with."""
        if not self.table or not _SETTLED.fullmatch(text) or any(s in text for s in self.special):
            return None
        out: list[int] = []
        begin = 0
        while begin < len(text):
            cut = _SPACE_BETWEEN_WORDS.search(text, begin + RUN_CHARS)
            end = cut.start() if cut else len(text)
            if end - begin > LONGEST_RUN:
                return None
            out += self.table.encode_ordinary(text[begin:end])
            begin = end
        return out


class UnsafeCut(Exception):
    """A space is not between two visible characters: the text must be cut with more care."""


class Pieces(dict):
    """Values of pieces that follow a space, found when they are first asked for.

    ``measure`` makes a value of token ids, ``join`` the value of a text of those of its pieces.
    The cache has two generations: when the young one is full it becomes the old one, and what
    is asked for again moves back. The pieces of ``frequent`` always stay.
    """

    def __init__(
        self, measure: Callable, join: Callable, tokenizer, frequent: dict, limit: int,
        merge: Callable | None = None,
    ):
        super().__init__(frequent)
        self.merge = merge
        self.measure, self.join = measure, join
        self.encode_ids = tokenizer.encode
        self.tokenize = tokenizer.model.tokenize
        self.bytelevel = type(tokenizer.pre_tokenizer).__name__ == "ByteLevel"
        self.marks = {c: self.encode(c) for c in ",.;:!?"} if self.bytelevel else {}
        self.frequent, self.old = frequent, {}
        self.limit = limit + len(frequent)

    def encode(self, text: str):
        return self.measure(self.encode_ids(text, add_special_tokens=False).ids)

    def _value(self, piece: str):
        if self.bytelevel and piece.isalpha():
            # Letters are one pre-token: the model alone gives the library's tokens.
            if self.merge:
                return self.measure(self.merge(b" " + piece.encode()))
            mapped = piece if piece.isascii() else "".join(map(_byte_letters.__getitem__, piece))
            return self.measure([t.id for t in self.tokenize(_SPACE + mapped)])
        if piece[-1] in self.marks and piece[:-1].isalpha():
            return self[piece[:-1]] + self.marks[piece[-1]]
        return self.encode(" " + piece)

    def __missing__(self, piece: str):
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise UnsafeCut
        value = self.old.pop(piece, None)
        if value is None:
            value = self._value(piece)
        if len(piece) <= PIECE_CHARS:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
                self.update(self.frequent)
            self[piece] = value
        return value

    def of(self, text: str):
        """The value of a text."""
        first, *rest = text.split(" ")
        try:
            if rest and (not first or first[-1].isspace()):
                raise UnsafeCut
            return self.encode(first) + self.join(map(self.__getitem__, rest))
        except UnsafeCut:
            first, *rest = _SPACE_BETWEEN_WORDS.split(text)
            # Only the last piece can still end with white space.
            rest, last = rest[:-1], rest[-1:]
            found = [self[p] for p in rest] + [self.encode(" " + p) for p in last]
            return self.encode(first) + self.join(found)


def id_pieces(name: str) -> Pieces:
    """Token ids of pieces as little-endian 32-bit bytes."""
    table = merge_table(name)
    return Pieces(
        lambda ids: array("I", ids).tobytes(), b"".join, load_tokenizer(name), {}, CACHED_IDS,
        table and table._core_bpe.encode_single_piece,
    )


def length_pieces(name: str, frequent: dict[str, int]) -> Pieces:
    """Numbers of tokens of pieces."""
    return Pieces(len, sum, load_tokenizer(name), frequent, CACHED)


def _count_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for text in values(batch.column(0)):
            counts.update(text_of(text).split(" ")[1:])
            if len(counts) > COUNTED:
                counts = Counter(dict(counts.most_common(COUNTED // 4)))
    top = [
        (piece, n)
        for piece, n in counts.most_common(CANDIDATES)
        if len(piece) <= PIECE_CHARS and piece and not (piece[0].isspace() or piece[-1].isspace())
    ]
    yield pa.RecordBatch.from_pydict(
        {"piece": pa.array([p for p, _ in top], pa.string()),
         "n": pa.array([n for _, n in top], pa.int64())}
    )


def frequent_pieces(counts: DataFrame, most: int = FREQUENT) -> list[str]:
    """The pieces of (piece, n) from some frequency on, as many as ``most`` allows.

    The frequency is read off the numbers of pieces in sixteenths of an octave, of which there are
    about a thousand, so neither a task nor the driver sees more than ``most`` pieces.
    """
    step = F.floor(F.log2("n") * 16).alias("step")
    counts = stage(counts.select("piece", step), "piece-counts")
    sizes = dict(counts.groupBy("step").count().collect())
    least, total = None, 0
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > most:
            break
        least = at
    if least is None:
        return []
    return [r.piece for r in counts.where(F.col("step") >= least).select("piece").collect()]


def frequent_lengths(docs: DataFrame, tokenizer: str = TOKENIZER) -> dict[str, int]:
    """Tier 1: token counts of the most frequent pieces of all texts."""
    counts = docs.select("text").mapInArrow(_count_pieces, "piece string, n bigint")
    found = frequent_pieces(counts.groupBy("piece").agg(F.sum("n").alias("n")))
    pieces = length_pieces(tokenizer, {})
    return {piece: pieces[piece] for piece in found}


def count_tokens(
    docs: DataFrame,
    tokenizer: str = TOKENIZER,
    text: str = "text",
    out: str = "n_tokens",
    passed: list[str] | None = None,
) -> DataFrame:
    """The columns ``passed`` (all by default) and the tokens of each text in ``out``.

    Counts are those of the whole text as the tokenizers library gives them, without special
    tokens added and with special strings inside texts handled as its default. A null or empty
    text has 0. Repeated rows are counted each; an empty table gives an empty one; other
    columns, null or not, are passed through, but for one named like ``out``, which goes.
    """
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(
        frequent_lengths(docs.select(F.col(text).alias("text")), tokenizer)
    )
    run = uuid.uuid4().hex
    kept = [c for c in passed or docs.columns if c != out]
    schema = docs.select(*kept).schema.add(out, "long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = worker_state(
            ("lengths", tokenizer, run), lambda: length_pieces(tokenizer, table.value)
        )
        for batch in slices(batches):
            counts = array("q")
            for value in values(batch.column(0)):
                counts.append(pieces.of(value) if value else 0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(counts, pa.int64())], names=[*kept, out]
            )

    return docs.select(F.col(text).alias("_counted"), *kept).mapInArrow(count, schema)


def document_tokens(docs: DataFrame, limit: int = 1024, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether the text exceeds ``limit`` tokens."""
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes")
    counted = count_tokens(
        docs.select("doc_id", "text", n_bytes), tokenizer, passed=["doc_id", "n_bytes"]
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
