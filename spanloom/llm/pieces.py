"""SentencePiece BPE encoding in vectorised merge rounds, and decoding.

For models that leave the text as it is but for a space put before it, write spaces as U+2581
and spell characters outside the vocabulary in bytes; others are refused. No piece goes
from a visible character on to a space, so a text falls into words, each its spaces and what
follows, that never merge with one another. Characters that no longer piece contains stand
alone. Words that a worker has not seen are encoded together:

* their symbols lie in one flat array, cut further wherever two neighbours occur together in no piece;
* every round looks up the rank of each pair, takes the smallest of each segment, and merges
  its occurrences from the left, as many as the library would merge in a row: up to and with the
  first one whose new neighbours rank at or before it;
* merged symbols are compacted away, segments without a pair leave the arrays, and the rounds
  end when none remains.

So the result is that of merging the best pair, leftmost first, one at a time.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType

from spanloom.llm.tables import text_of, values, worker_state
from spanloom.llm.tokens import tokenizer_path

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Characters that are cut into words at a time, and the longest word that is remembered.
RUN_CHARS = 1_000_000
WORD_CHARS = 48
#: Bytes of remembered words and ids per worker, with what their objects take.
CACHE_BYTES = 96_000_000
OBJECT_BYTES = 160
#: Bytes of ids or of text in an output batch.
BATCH_BYTES = 4_000_000

_NONE = np.iinfo(np.int64).max
# What an identity normaliser leaves alone.
_PROBE = " a  b\t ﬁＡé　​\n "


class PieceModel:
    """Vocabulary and merge table of a model, and the rounds over them."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        library = SentencePieceProcessor(model_file=path)
        if library.normalize(_PROBE) != SPACE + _PROBE.replace(" ", SPACE):
            raise ValueError(f"{path}: the text must stay as it is but for a space before it")
        size = self.size = library.get_piece_size()
        names = [library.id_to_piece(i) for i in range(size)]
        self.byte_ids = {int(names[i][3:5], 16): i for i in range(size) if library.is_byte(i)}
        if len(self.byte_ids) < 256:
            raise ValueError(f"{path}: characters outside the vocabulary must be spelled in bytes")
        special = [
            library.is_byte(i) or library.is_control(i) or library.is_unknown(i)
            for i in range(size)
        ]
        # Internally a space stands for the space symbol.
        pieces = {
            name.replace(SPACE, " "): i for i, name in enumerate(names) if not special[i]
        }
        self._surfaces(library, names)

        # A symbol is the id of a piece, or the size plus the code point of another character.
        self.width = size + 0x110000
        self.symbols = size + np.arange(0x110000, dtype=np.int64)
        for piece, i in pieces.items():
            if len(piece) == 1:
                self.symbols[ord(piece)] = i
        order = {s: r for r, s in enumerate(sorted({-library.get_score(i) for i in pieces.values()}))}
        table: dict[int, tuple[int, int]] = {}
        pairs: set[int] = set()
        joined: set[str] = set()
        for piece, i in pieces.items():
            if len(piece) == 1:
                continue
            joined.update(piece)
            pairs.update(ord(a) << 21 | ord(b) for a, b in zip(piece, piece[1:]))
            for k in range(1, len(piece)):
                left, right = self._symbol(piece[:k], pieces), self._symbol(piece[k:], pieces)
                if left is not None and right is not None:
                    table[left * self.width + right] = (i, order[-library.get_score(i)])
        self.keys = np.array(sorted(table), dtype=np.int64)
        self.merged = np.array([table[k][0] for k in self.keys.tolist()], dtype=np.int64)
        self.ranks = np.array([table[k][1] for k in self.keys.tolist()], dtype=np.int64)
        self.pairs = np.array(sorted(pairs), dtype=np.int64)
        self.words = re.compile(self._word_pattern(pieces, joined)).findall
        self.crossing = any(re.search("[^ ] ", p) for p in pieces)

    def _symbol(self, text: str, pieces: dict[str, int]) -> int | None:
        if text in pieces:
            return pieces[text]
        return self.size + ord(text) if len(text) == 1 else None

    @staticmethod
    def _word_pattern(pieces: dict[str, int], joined: set[str]) -> str:
        if any(re.search("[^ ] ", p) for p in pieces):
            return r"(?s).+"
        alone = re.escape("".join(c for c in map(chr, range(128)) if c not in joined and c != " "))
        return f" *[^ {alone}]+| +|[{alone}]"

    def _surfaces(self, library, names: list[str]) -> None:
        """What each id decodes to, in bytes."""
        unknown = library.decode([library.unk_id()])
        self.surface = [
            b"" if library.is_control(i)
            else unknown.encode() if library.is_unknown(i)
            else bytes([int(name[3:5], 16)]) if library.is_byte(i)
            else name.replace(SPACE, " ").encode()
            for i, name in enumerate(names)
        ]
        self.is_control = [library.is_control(i) for i in range(len(names))]
        self.unknown = library.unk_id()
        self.is_byte = np.array([library.is_byte(i) for i in range(len(names))])

    # ---- encoding ---------------------------------------------------------------------------

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair, and what it merges to."""
        key = left * self.width + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        found = self.keys[at] == key
        return np.where(found, self.ranks[at], _NONE), self.merged[at]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit bytes."""
        chars = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths)
        cut = np.ones(len(chars), dtype=bool)  # a segment begins here
        if len(chars) > 1:
            key = chars[:-1] << 21 | chars[1:]
            near = np.searchsorted(self.pairs, key)
            near[near == len(self.pairs)] = 0
            cut[1:] = self.pairs[near] != key
        cut[ends[:-1]] = True
        places, symbols = self._merge(self.symbols[chars], np.cumsum(cut) - 1)
        bounds = np.searchsorted(places, ends).tolist()
        out, begin = [], 0
        flat = symbols.astype("<i4")
        odd = symbols >= self.size
        spelled = np.add.reduceat(odd, [0, *bounds[:-1]]).tolist() if odd.any() else None
        for w, end in enumerate(bounds):
            if spelled is None or not spelled[w]:
                out.append(flat[begin:end].tobytes())
            else:
                ids: list[int] = []
                for s in symbols[begin:end].tolist():
                    if s < self.size:
                        ids.append(s)
                    else:
                        ids.extend(self.byte_ids[b] for b in chr(s - self.size).encode())
                out.append(np.array(ids, dtype="<i4").tobytes())
            begin = end
        return out

    def _merge(self, symbol: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and symbols that remain when no segment has a pair in the table."""
        place = np.arange(len(symbol))
        done_at, done = [], []
        rank = np.full(len(symbol), _NONE)  # of a symbol with the one after it
        target = np.zeros(len(symbol), dtype=np.int64)
        self._rank_at(np.arange(len(symbol)), symbol, segment, rank, target)
        while len(symbol):
            starts = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
            sizes = np.diff(np.append(starts, len(symbol)))
            least = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            open_ = least != _NONE
            if not open_.all():
                done_at.append(place[~open_])
                done.append(symbol[~open_])
                place, symbol, segment, rank, target, least = (
                    x[open_] for x in (place, symbol, segment, rank, target, least)
                )
                if not len(symbol):
                    break
            at = self._leftmost(np.flatnonzero(rank == least), symbol, segment, least, target)
            symbol[at] = target[at]
            keep = np.ones(len(symbol), dtype=bool)
            keep[at + 1] = False
            here = np.cumsum(keep)[at] - 1
            place, symbol, segment, rank, target = (
                x[keep] for x in (place, symbol, segment, rank, target)
            )
            changed = np.zeros(len(symbol), dtype=bool)
            changed[here] = True
            changed[here[here > 0] - 1] = True
            self._rank_at(np.flatnonzero(changed), symbol, segment, rank, target)
        if not done:
            return place, symbol
        place, symbol = np.concatenate(done_at), np.concatenate(done)
        order = np.argsort(place, kind="stable")
        return place[order], symbol[order]

    def _rank_at(self, at, symbol, segment, rank, target) -> None:
        """Look up the pairs that begin at the given places."""
        rank[at] = _NONE
        inner = at[at + 1 < len(symbol)]
        inner = inner[segment[inner] == segment[inner + 1]]
        rank[inner], target[inner] = self._ranks(symbol[inner], symbol[inner + 1])

    def _leftmost(self, at, symbol, segment, least, target) -> np.ndarray:
        """Of the places of best pairs, those that are merged one after the other from the left."""
        run = np.concatenate(([True], np.diff(at) != 1))
        first = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - first) % 2 == 0]
        if len(at) == 1:
            return at
        merged, best, own = target[at], least[at], segment[at]
        # On the left stands what was merged just before, or the symbol as it was.
        after = np.concatenate(([False], at[1:] - at[:-1] == 2))
        has_left = (at > 0) & (segment[at - 1] == own)
        left = np.where(after & has_left, np.concatenate(([0], merged[:-1])), symbol[at - 1])
        nearer = has_left & (self._ranks(left, merged)[0] <= best)
        beyond = np.minimum(at + 2, len(symbol) - 1)
        has_right = (at + 2 < len(symbol)) & (segment[beyond] == own)
        nearer |= has_right & (self._ranks(merged, symbol[beyond])[0] <= best)
        if not nearer.any():
            return at
        # In each segment nothing after the first pair that brings a nearer one.
        before = np.cumsum(nearer) - nearer
        begins = np.concatenate(([True], own[1:] != own[:-1]))
        base = np.repeat(before[begins], np.diff(np.append(np.flatnonzero(begins), len(at))))
        return at[before == base]

    # ---- decoding ---------------------------------------------------------------------------

    def decode(self, ids: np.ndarray) -> str:
        """Text of a sequence of ids; bytes that are no UTF-8 become U+FFFD each."""
        listed = ids.tolist()
        parts = [self.surface[i] for i in listed]
        for k, i in enumerate(listed):
            if not self.is_control[i]:
                # The space before the text goes, if the text begins with a piece.
                if not self.is_byte[i] and i != self.unknown and parts[k][:1] == b" ":
                    parts[k] = parts[k][1:]
                break
        data = b"".join(parts)
        try:
            return data.decode()
        except UnicodeDecodeError:
            return "".join(self._decode_runs(ids, parts))

    def _decode_runs(self, ids: np.ndarray, parts: list[bytes]) -> Iterator[str]:
        begin = 0
        spelled = self.is_byte[ids]
        for end in [*(np.flatnonzero(np.diff(spelled)) + 1).tolist(), len(parts)]:
            data = b"".join(parts[begin:end])
            begin = end
            while data:
                try:
                    yield data.decode()
                    break
                except UnicodeDecodeError as error:
                    yield data[: error.start].decode() + "�"
                    data = data[error.start + 1 :]


@functools.lru_cache(maxsize=2)
def load_model(name: str) -> PieceModel:
    return PieceModel(tokenizer_path(name))


class Encoder:
    """Encodes texts with a model; remembers the ids of words up to a number of bytes."""

    def __init__(self, model: PieceModel, limit: int = CACHE_BYTES):
        self.model, self.limit = model, limit
        self.known: dict[str, bytes] = {}
        self.held = 0

    def _runs(self, text: str) -> Iterator[str]:
        """The text with its first space, cut before spaces that follow visible characters."""
        text = " " + text.replace(SPACE, " ")
        begin = 0
        while len(text) - begin > RUN_CHARS and not self.model.crossing:
            gap = re.compile("(?<=[^ ]) ").search(text, begin + RUN_CHARS)
            if not gap:
                break
            yield text[begin : gap.start()]
            begin = gap.start()
        yield text[begin:] if begin else text

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit bytes."""
        out: list[list[bytes]] = [[] for _ in texts]
        waiting, chars = [], 0
        for k, text in enumerate(texts):
            for run in self._runs(text) if text else ():
                waiting.append((k, self.model.words(run)))
                chars += len(run)
                if chars >= RUN_CHARS:
                    self._encode(waiting, out)
                    waiting, chars = [], 0
        self._encode(waiting, out)
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]

    def _encode(self, waiting: list[tuple[int, list[str]]], out: list[list[bytes]]) -> None:
        if self.held > self.limit:
            self.known, self.held = {}, 0
        known = self.known
        new = list({w for _, words in waiting for w in words if w not in known})
        once: dict[str, bytes] = {}
        if new:
            for word, ids in zip(new, self.model.encode_words(new)):
                known[word] = ids
                if len(word) > WORD_CHARS:
                    once[word] = ids
                else:
                    self.held += OBJECT_BYTES + len(word) + len(ids)
        for k, words in waiting:
            out[k].append(b"".join(map(known.__getitem__, words)))
        for word in once:
            del known[word]


def _texts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Runs of rows whose first column holds about so many characters or ids at most."""
    for batch in batches:
        begin, held, run = 0, 0, []
        for k, value in enumerate(values(batch.column(0))):
            run.append(value)
            held += len(value or "") + 64
            if held >= size:
                yield batch.slice(begin, k + 1 - begin), run
                begin, held, run = k + 1, 0, []
        if run:
            yield batch.slice(begin), run


def _with(batch: pa.RecordBatch, column: pa.Array, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns[1:], column], names=names)


def encode(
    docs: DataFrame, model: str = MODEL, text: str = "text", out: str = "ids",
    passed: list[str] | None = None,
) -> DataFrame:
    """The columns ``passed`` (all by default) and the ids of each whole text in ``out``.

    The ids are those of the sentencepiece library without begin and end ids. A null or empty
    text has an empty array. Texts of any length are encoded whole, repeated rows each; an empty
    table gives an empty one; other columns, null or not, are passed through, but for one named like
    ``out``, which goes.
    """
    kept = [c for c in passed or docs.columns if c != out]
    schema = docs.select(*kept).schema.add(out, ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_state(("pieces", model), lambda: Encoder(load_model(model)))
        for batch, texts in _texts(batches, BATCH_BYTES):
            found = encoder.encode_all([text_of(t) for t in texts])
            ends = np.cumsum([0, *map(len, found)]) // 4
            ids = pa.array(np.frombuffer(b"".join(found), dtype="<i4"))
            column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)
            yield _with(batch, column, [*kept, out])

    return docs.select(F.col(text).alias("_encoded"), *kept).mapInArrow(run, schema)


def decode(
    docs: DataFrame, model: str = MODEL, ids: str = "ids", out: str = "decoded",
    passed: list[str] | None = None,
) -> DataFrame:
    """The columns ``passed`` (all by default) and the text of each array of ids in ``out``.

    A null or empty array gives an empty text; ids must be those of the model. Other columns are
    passed through, but for one named like ``out``, which goes.
    """
    kept = [c for c in passed or docs.columns if c != out]
    schema = docs.select(*kept).schema.add(out, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = worker_state(("piece texts", model), lambda: load_model(model))
        for batch in batches:
            lists = batch.column(0)
            begin = 0
            while begin < batch.num_rows:
                texts, held = [], 0
                for k in range(begin, batch.num_rows):
                    found = lists[k].values
                    texts.append(state.decode(np.asarray(found)) if found is not None else "")
                    held += len(texts[-1]) + 64
                    if held >= BATCH_BYTES:
                        break
                part = batch.slice(begin, len(texts))
                begin += len(texts)
                yield _with(part, pa.array(texts, pa.string()), [*kept, out])

    return docs.select(F.col(ids).alias("_decoded"), *kept).mapInArrow(run, schema)


def round_trip(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, and the SHA-256 of the ids and of the text decoded from them."""
    coded = encode(docs.select("doc_id", "text"), model, passed=["doc_id"])
    texts = decode(coded, model)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return texts.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
