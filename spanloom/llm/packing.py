"""Packing documents into fixed windows, in their order, by dynamic programming.

The tokens of a partition's documents form one stream. Permitted cuts are the ends of
documents, the ends of sentences, and, only inside a sentence longer than a window, every
``FORCED`` tokens. Among all ways to cut the stream into windows of at most ``window`` tokens
the one with the least sum of padding and cut penalties is taken:

    cost(j) = min over cuts i of  cost(i) + padding(j - i) + penalty(j)

Padding is ``window - length``, so within reach the best i is that with the smallest
``cost(i) + i``, which a monotone queue hands out in constant time for each cut. Windows whose
length is one of ``free_lengths`` (powers of two) need no padding; those few are looked up.

The stream is planned in segments of at least ``SEGMENT`` tokens; the last window of a segment
is planned again with the next, so a task holds one segment and not its partition.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from spanloom.llm.tables import slices, text_of, values, worker_cache, worker_state
from spanloom.llm.tokens import TOKENIZER, WholeTexts, id_pieces, load_tokenizer

WINDOW = 2048
FREE_LENGTHS = (512, 1024)
#: Costs, in tokens of padding: a cut inside a document at the end of a sentence, one inside a
#: sentence, and one sequence more.
SENTENCE_CUT = 4.0
FORCED_CUT = 64.0
PER_SEQUENCE = 1.0
FORCED = 64
SEGMENT = 262_144
#: Bytes of ids in an output batch.
BATCH_BYTES = 4_000_000

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


@worker_cache
def sentence_ends(tokenizer: str) -> np.ndarray:
    """For every id, whether its text ends a sentence or a line."""
    library = load_tokenizer(tokenizer)
    size = library.get_vocab_size()
    ends = np.zeros(size, dtype=bool)
    for i in range(size):
        ends[i] = library.decode([i], skip_special_tokens=False).endswith((".", "!", "?", "\n"))
    return ends


def _encoders(tokenizer: str):
    return worker_state(("ids", tokenizer), lambda: (id_pieces(tokenizer), WholeTexts(tokenizer)))


def document_ids(text: str, tokenizer: str, closing: int) -> np.ndarray:
    """Ids of a whole text and the closing id."""
    end = np.array([closing], dtype=np.uint32)
    if not text:
        return end
    pieces, whole = _encoders(tokenizer)
    ids = whole.ids(text)
    if ids is not None:
        return np.array([*ids, closing], dtype=np.uint32)
    return np.concatenate([np.frombuffer(pieces.of(text), dtype=np.uint32), end])


def cuts(lengths: np.ndarray, ids: np.ndarray, ends: np.ndarray, window: int):
    """Positions where the stream may be cut, first and last included, and their penalties."""
    n = len(ids)
    penalty = np.full(n + 1, np.inf)
    penalty[1:][ends[ids]] = SENTENCE_CUT
    penalty[0] = 0.0
    penalty[np.cumsum(lengths)] = 0.0
    at = np.flatnonzero(np.isfinite(penalty))
    step = min(FORCED, window)
    for i in np.flatnonzero(np.diff(at) > window):
        inside = np.arange(at[i] + step, at[i + 1], step)
        penalty[inside] = FORCED_CUT
    at = np.flatnonzero(np.isfinite(penalty))
    return at.tolist(), penalty[at].tolist()


def best_windows(
    at: list[int], penalty: list[float], window: int, free_lengths: tuple[int, ...]
) -> list[int]:
    """The cuts of the cheapest plan, first and last included."""
    cost = [0.0] * len(at)
    back = [0] * len(at)
    place = {p: i for i, p in enumerate(at)} if free_lengths else {}
    queue = deque([(float(at[0]), 0)])  # (cost + position, cut), both increasing
    for j in range(1, len(at)):
        p = at[j]
        while at[queue[0][1]] < p - window:
            queue.popleft()
        key, i = queue[0]
        best = key + window - p
        for length in free_lengths:
            k = place.get(p - length)
            if k is not None and cost[k] < best:
                best, i = cost[k], k
        total = best + penalty[j] + PER_SEQUENCE
        cost[j], back[j] = total, i
        key = total + p
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    plan, j = [at[-1]], len(at) - 1
    while j:
        j = back[j]
        plan.append(at[j])
    return plan[::-1]


class _Stream:
    """Documents of one partition that are not yet in a finished window."""

    def __init__(self, tokenizer: str, window: int, free_lengths: tuple[int, ...], number: int):
        _encoders(tokenizer)  # first: what an earlier stage left in the worker goes
        self.ends = sentence_ends(tokenizer)
        self.window, self.free_lengths = window, free_lengths
        self.sequence = number << 33
        self.docs: list[tuple] = []  # (doc_id, ids, first id that is waiting)
        self.waiting = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.docs.append((doc_id, ids, 0))
        self.waiting += len(ids)

    def finish(self, last: bool) -> Iterator[tuple]:
        """Rows of the planned windows; but for the last call the last window stays."""
        if not self.docs:
            return
        lengths = np.array([len(ids) - first for _, ids, first in self.docs])
        ids = np.concatenate([ids[first:] for _, ids, first in self.docs])
        plan = best_windows(*cuts(lengths, ids, self.ends, self.window), self.window, self.free_lengths)
        if not last:
            plan.pop()
        docs = iter(self.docs)
        doc_id, ids, first = next(docs)
        for begin, end in zip(plan, plan[1:]):
            offset = 0
            while offset < end - begin:
                if first == len(ids):
                    doc_id, ids, first = next(docs)
                length = min(len(ids) - first, end - begin - offset)
                piece = ids[first : first + length].astype("<u4", copy=False).tobytes()
                yield doc_id, first, length, piece, len(ids), self.sequence, offset
                first += length
                offset += length
            self.sequence += 1
        self.docs = [d for d in [(doc_id, ids, first), *docs] if d[2] < len(d[1])]
        self.waiting = sum(len(ids) - first for _, ids, first in self.docs)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )


def pack(
    docs: DataFrame,
    window: int = WINDOW,
    tokenizer: str = TOKENIZER,
    closing: int = 1,
    free_lengths: tuple[int, ...] = FREE_LENGTHS,
) -> DataFrame:
    """Pieces of documents in sequences: ``PIECES``.

    A document is the ids of its whole text without added special tokens, and ``closing``. A
    null or empty text is the closing id alone. Every id lies in one piece; ``start`` counts
    the ids of its document before the piece, ``offset`` those of its sequence. ``ids`` are
    little-endian unsigned 32-bit numbers. Documents keep the order in which their partition
    delivers them, repeated rows are packed each, null doc_ids stay null, and other columns
    are not read. A sequence is ``window`` long at most; each partition closes its last one.

    No row is shuffled. The number of a sequence is made of its partition and its place there,
    so a task that runs again gives the same rows.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
         ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
         ("offset", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = _Stream(tokenizer, window, free_lengths, TaskContext.get().partitionId())

        def rows() -> Iterator[tuple]:
            for batch in slices(batches):
                for doc_id, text in zip(values(batch.column(0)), values(batch.column(1))):
                    stream.add(doc_id, document_ids(text_of(text), tokenizer, closing))
                    if stream.waiting >= SEGMENT:
                        yield from stream.finish(last=False)
            yield from stream.finish(last=True)

        ready, held = [], 0
        for row in rows():
            ready.append(row)
            held += len(row[3])
            if held >= BATCH_BYTES:
                yield _batch(ready, schema)
                ready, held = [], 0
        if ready:
            yield _batch(ready, schema)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, PIECES)


def packed_documents(docs: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their ids in place of the ids."""
    return pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )
