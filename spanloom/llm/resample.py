"""Importance resampling towards a target distribution of hashed word features.

Texts are lower-cased in A-Z only and pre-tokenised by an untrained regex Split of the
tokenizers library, which gives words with their offsets. Features are windows over
consecutive offset pairs, runs of 1 to ``MAX_WORDS`` words joined by one space, and a
feature's bucket is its CRC-32 modulo ``BUCKETS``. The CRC of a window is that of the window
one word shorter carried on over a space and the next word, so no feature is put together.

Two histograms, of the corpus and of the target, give every bucket a gain: the log ratio of
its smoothed shares. A document's weight is the mean gain of its features, and the documents
with the largest weight plus a Gumbel draw by hash are a sample without replacement.

Texts are tokenised once. The buckets of each document are written as packed numbers, which
the histogram and the sum of gains then read; a histogram has ``BUCKETS`` rows at most.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from spanloom.llm.tables import text_of, values, worker_state
from spanloom.operators.skew import ranged_row_number
from spanloom.staging import stage

#: What stands between words, after A-Z became a-z: all ASCII but digits and small letters.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
MAX_WORDS = 2
BUCKETS = 10_000
SCALE = 1000
MIN_WORDS = 20
PERCENT = 25
SEED = 7
#: Characters handed to the splitter at a time; it is fastest on short runs.
RUN_CHARS = 2_000
#: Words of at most this many characters, and how many of them, a worker remembers.
WORD_CHARS = 40
KNOWN_WORDS = 200_000
#: Bytes of buckets in an output batch.
BATCH_BYTES = 4_000_000

_GAP = re.compile(GAP)


@functools.lru_cache(maxsize=1)
def _splitter():
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    return Split(Regex(GAP + "+"), "removed")


def lowered(text: str) -> str:
    """The text with A-Z as a-z and nothing else changed."""
    return text.encode().lower().decode()


def word_runs(text: str) -> Iterator[list[tuple[str, tuple[int, int]]]]:
    """(word, (start, end)) of a lower-cased text, in lists; no word spans two of them.

    Offsets are characters of the whole text. A run ends at a gap, so a text of any length is
    split in pieces of bounded size, but for a word that is longer itself.
    """
    split = _splitter().pre_tokenize_str
    begin = 0
    while begin < len(text):
        gap = _GAP.search(text, begin + RUN_CHARS)
        end = gap.start() if gap else len(text)
        words = split(text[begin:end])
        yield [(w, (s + begin, e + begin)) for w, (s, e) in words] if begin else words
        begin = end


def features(text: str, max_words: int = MAX_WORDS, buckets: int = BUCKETS):
    """(bucket, start, end) of every feature of a text, by its last word and its length.

    The span reaches from the start of the first word to the end of the last in the lower-cased
    text, which has the characters of the text one for one.
    """
    window: list[tuple[int, int]] = []  # (CRC, start) of the runs that end at the last word
    for run in word_runs(lowered(text)):
        for word, (start, end) in run:
            data = word.encode()
            tail = b" " + data
            window = [(crc32(data), start)] + [
                (crc32(tail, crc), s) for crc, s in window[: max_words - 1]
            ]
            for crc, s in window:
                yield crc % buckets, s, end


class _Words(dict):
    """CRC-32 of a word, and the word after a space, as bytes."""

    def __missing__(self, word: str) -> tuple[int, bytes]:
        data = word.encode()
        value = crc32(data), b" " + data
        if len(word) <= WORD_CHARS:
            if len(self) >= KNOWN_WORDS:
                self.clear()
            self[word] = value
        return value


def feature_crcs(text: str, max_words: int, words: _Words) -> tuple[int, np.ndarray]:
    """Number of words, and the CRC-32 of all features of a text."""
    out: list[int] = []
    n = 0
    window: list[int] = []
    for run in word_runs(lowered(text)):
        n += len(run)
        if max_words == 2:
            last = window[0] if window else None
            for word, _ in run:
                crc, tail = words[word]
                out.append(crc)
                if last is not None:
                    out.append(crc32(tail, last))
                last = crc
            window = [] if last is None else [last]
        else:
            for word, _ in run:
                crc, tail = words[word]
                window = [crc, *[crc32(tail, c) for c in window[: max_words - 1]]]
                out.extend(window)
    return n, np.array(out, dtype=np.uint32)


def _packed(buckets: int) -> np.dtype:
    return np.dtype("<u2" if buckets <= 65_536 else "<u4")


def document_buckets(
    docs: DataFrame, max_words: int = MAX_WORDS, buckets: int = BUCKETS
) -> DataFrame:
    """doc_id, n_words and the buckets of all features, packed; a null text has none."""
    kind = _packed(buckets)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("buckets", pa.binary())]
    )

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_state(("resample words",), _Words)
        rows, held = [], 0
        for part in batches:
            for doc_id, text in zip(values(part.column(0)), values(part.column(1))):
                n, crcs = feature_crcs(text_of(text), max_words, words)
                rows.append((doc_id, n, (crcs % buckets).astype(kind).tobytes()))
                held += len(rows[-1][2]) + 64
                if held >= BATCH_BYTES:
                    yield batch(rows)
                    rows, held = [], 0
        if rows:
            yield batch(rows)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "doc_id bigint, n_words bigint, buckets binary"
    )


def histogram(bucketed: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs; a task sends one row per bucket at most."""
    kind = _packed(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for part in batches:
            for packed in values(part.column(0)):
                counts += np.bincount(np.frombuffer(packed, kind), minlength=buckets)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at), "n": pa.array(counts[at])})

    rows = (
        bucketed.select("buckets").mapInArrow(run, "bucket bigint, n bigint")
        .groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    )
    counts = np.zeros(buckets, dtype=np.int64)
    for row in rows:
        counts[row.bucket] = row.n
    return counts


def bucket_gains(corpus: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The floored log ratio of each bucket's share of the target and of the corpus."""
    s_all, t_all, size = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array([
        math.floor(scale * math.log((t + 1) * (s_all + size) / ((s + 1) * (t_all + size))))
        for s, t in zip(corpus.tolist(), target.tolist())
    ], dtype=np.int64)


def gain_weights(bucketed: DataFrame, gains: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight: the floored mean gain, 0 without features."""
    kind = _packed(len(gains))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            sizes, weights = [], []
            for packed in values(part.column(2)):
                at = np.frombuffer(packed, kind)
                sizes.append(len(at))
                weights.append(int(gains[at].sum()) // len(at) if len(at) else 0)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(sizes, pa.int64()),
                 pa.array(weights, pa.int64())],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return bucketed.select("doc_id", "n_words", "buckets").mapInArrow(
        run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint"
    )


def gumbel(doc_id: Column, seed: int = SEED, scale: int = SCALE) -> Column:
    """A floored Gumbel draw that depends on the seed and the id alone; a null id is empty."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-scale * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    max_words: int = MAX_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document.

    ``target`` has the texts whose distribution is wanted, ``text`` like ``docs``. Of the N
    documents of ``min_words`` words or more the floor(percent * N / 100) with the highest
    score are drawn and ranked from 1; ``rank`` is null elsewhere. Ties go to the smaller
    doc_id, a null doc_id last, and then to fewer features.

    A null or empty text, or one without a word, has no feature and weight 0. Texts of any
    length count whole. Repeated rows are scored and drawn each. An empty corpus gives an
    empty result, and an empty target leaves the smoothed uniform distribution. Other columns,
    however named, are not read.
    """
    bucketed = stage(document_buckets(docs, max_words, buckets), "resample-buckets")
    wanted = document_buckets(
        target.select(F.lit(None).cast("bigint").alias("doc_id"), "text"), max_words, buckets
    )
    gains = bucket_gains(histogram(bucketed, buckets), histogram(wanted, buckets))
    scored = gain_weights(bucketed, gains).withColumn(
        "score", F.col("weight") + gumbel(F.col("doc_id"), seed)
    )
    scored = stage(scored, "resample-scores")
    able = F.col("n_words") >= min_words
    drawn = scored.where(able).count() * percent // 100
    # Ascending order that puts high scores first and null ids last.
    ordered = scored.where(able).select(
        "*", F.lit(0).alias("_all"), (-F.col("score")).alias("_low"),
        F.col("doc_id").isNull().alias("_no_id"),
    )
    order = ["_low", "_no_id", "doc_id", "n_features"]
    ranked = ranged_row_number(ordered, "_all", order, "_place")
    rank = F.when(F.col("_place") <= drawn, F.col("_place"))
    columns = ("doc_id", "n_features", "weight", "score")
    return ranked.select(*columns, rank.alias("rank")).unionByName(
        scored.where(~able).select(*columns, F.lit(None).cast("bigint").alias("rank"))
    )
