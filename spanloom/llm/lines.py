"""Substring dedup by hashing lines and sentences over the whole corpus.

Units of a text are its lines (split at ``\\n``) of at least ``LINE_WORDS`` words and, from the start
of every sentence, the shortest run of sentences with at least ``SENTENCE_WORDS`` words, on one line
or over several, so that a passage put into a longer line is found too, and one of short
sentences or short lines as well. A unit is normalised (lower case, white space collapsed) and
stands for a 128-bit digest. Of all units with one digest the earliest stays, by doc_id (null
last), text digest and place; the others are removed, but for what lies in that earliest one.
Spans keep the offsets of the original text, in characters; those that overlap are one.

Only digests and places are grouped over the corpus, with minima combined on the map side; texts
move once, to meet the spans that are cut out of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from spanloom.llm.tables import rows_beside, slices, values
from spanloom.staging import stage, stage_last

LINE_WORDS = 4
SENTENCE_WORDS = 8
#: Covers a line without a gap.
SENTENCE = re.compile(r"[^.!?]+[.!?]*|[.!?]+")

SPANS = "array<struct<start:bigint,end:bigint>>"
_UNIT = "doc_id bigint, text_key bigint, start bigint, end bigint, digest binary"


def _words(unit: str) -> list[bytes]:
    return unit.lower().encode().split()


def _digest(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def units(
    text: str, line_words: int = LINE_WORDS, sentence_words: int = SENTENCE_WORDS
) -> Iterator[tuple[int, int, bytes]]:
    """(start, end, digest) of the units of a text; a line ends after its line break, a run before it.

    The only sentence of a line that is a unit is not given again.
    """
    # Runs that are still short: (start, words so far), as many as have words under the least number.
    waiting: list[tuple[int, list[bytes]]] = []
    start = 0
    for line in text.split("\n"):
        end = min(start + len(line) + 1, len(text))
        words = _words(line)
        if whole := len(words) >= line_words:
            yield start, end, _digest(words)
        for piece in SENTENCE.finditer(line) if words else ():
            own = _words(piece.group())
            if not own:
                continue
            alone = whole and len(own) == len(words)
            waiting.append((start + piece.start(), []))
            kept = []
            for first, so_far in waiting:
                so_far += own
                if len(so_far) < sentence_words:
                    kept.append((first, so_far))
                elif not (alone and first == start + piece.start()):
                    yield first, start + piece.end(), _digest(so_far)
            waiting = kept
        start = end


def _units_of(docs: DataFrame, line_words: int, sentence_words: int) -> DataFrame:
    names = ("doc_id", "text_key", "start", "end", "digest")
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [
                (doc_id, key, *unit)
                for doc_id, key, text in zip(*(values(c) for c in batch.columns))
                if text
                for unit in units(text, line_words, sentence_words)
            ]
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=list(names)
            )

    return docs.select("doc_id", "text_key", "text").mapInArrow(run, _UNIT)


def repeated_spans(
    docs: DataFrame, line_words: int = LINE_WORDS, sentence_words: int = SENTENCE_WORDS
) -> DataFrame:
    """(doc_id, text_key, spans) of the documents (doc_id, text_key, text) that lose something."""
    found = stage(_units_of(docs, line_words, sentence_words), "units")
    rank = F.struct(
        F.col("doc_id").isNull().alias("last"), F.coalesce("doc_id", F.lit(0)).alias("id"),
        "text_key", "start",
    )
    earliest = stage(
        found.groupBy("digest").agg(F.min(F.struct(rank.alias("rank"), "end")).alias("_first"), F.count("*").alias("_n"))
        .where("_n > 1").select(F.col("digest").alias("_digest"), "_first"),
        "repeated-units",
    )
    first = F.col("_first.rank")
    same_text = (
        (rank["last"] == first["last"]) & (rank["id"] == first["id"]) & (F.col("text_key") == first["text_key"])
    )
    begin = F.when(same_text, F.greatest("start", "_first.end")).otherwise(F.col("start"))
    later = found.join(earliest, F.col("digest") == F.col("_digest")).where(rank > first)
    later = later.select("doc_id", "text_key", begin.alias("start"), "end").where(F.col("start") < F.col("end"))
    return later.groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans")
    )


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans by start, those that overlap as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def remove_repeats(
    docs: DataFrame, line_words: int = LINE_WORDS, sentence_words: int = SENTENCE_WORDS
) -> DataFrame:
    """``docs`` with repeated units cut out of ``text``, and two columns more.

    ``removed`` holds the spans (start, end) of the original text that went, ``n_units`` of
    them; null and empty texts stay as they are. All rows stay, even if nothing of their text
    does. Rows with the same doc_id and text count as one occurrence: each keeps the same part.
    Documents with a null id rank last. An empty table gives an empty one. Other columns
    pass through; those named ``removed`` and ``n_units`` are replaced.
    """
    kept = [c for c in docs.columns if c not in ("removed", "n_units")]
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"),
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text",
    )
    texts = keyed.select("doc_id", "text_key", "text")
    # The units are gone before the texts move.
    spans = stage_last(
        docs.sparkSession, "repeated-spans",
        lambda: repeated_spans(texts, line_words, sentence_words).select(
            F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "spans"
        ),
    )
    joined = keyed.join(
        spans, (F.col("text_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left"
    ).select(
        "text", "spans",
        *[F.col("_row").getField(c).alias(f"_c{i}") for i, c in enumerate(kept) if c != "text"],
    )
    at = kept.index("text")
    names = [f"_c{i}" for i in range(len(kept))]
    fields = docs.select(*[f"`{c}`" for c in kept]).schema
    schema = StructType(
        [StructField(n, f.dataType) for n, f in zip(names, fields)]
        + StructType.fromDDL(f"removed {SPANS}, n_units bigint").fields
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, removed = [], []
            for text, found in zip(values(batch.column(0)), values(batch.column(1))):
                outer = _joined([(s["start"], s["end"]) for s in found]) if found else []
                if outer:
                    edges = [0, *(x for span in outer for x in span), len(text)]
                    text = "".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                texts.append(text)
                removed.append([{"start": a, "end": b} for a, b in outer])
            rest = list(batch.columns[2:])
            rest.insert(at, pa.array(texts, batch.schema.field(0).type))
            spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            counts = pa.array([len(r) for r in removed], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(removed, spans_type), counts], names=[*names, "removed", "n_units"]
            )

    out = joined.mapInArrow(cut, schema)
    return out.select(
        *[F.col(n).alias(c) for n, c in zip(names, kept)], "removed", "n_units"
    )


def cut_documents(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with repeats cut out of the text; a column n_chars follows it."""
    rest, columns = rows_beside(docs)
    cut = remove_repeats(docs.select(rest, "doc_id", F.col("text").alias("text"))).select(*columns(F.col("text")))
    if "n_chars" not in docs.columns:
        return cut
    kind = docs.schema["n_chars"].dataType
    return cut.withColumn("n_chars", F.length("text").cast(kind))


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, the text that is left, removed units, their characters, and their spans as text."""
    out = remove_repeats(docs.select("doc_id", "text"))
    spans = F.transform("removed", lambda s: F.concat(s["start"], F.lit("-"), s["end"]))
    chars = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return out.select(
        "doc_id", "text", F.col("n_units").alias("n_removed"), chars.alias("removed_chars"),
        F.concat_ws(",", spans).alias("removed_spans"),
    )


ORACLE = r"""
with l as (
  select doc_id, text, unnest(string_split(text, chr(10))) as line,
         generate_subscripts(string_split(text, chr(10)), 1) as n
  from documents where text <> ''),
lo as (select *, coalesce(sum(length(line) + 1) over (partition by doc_id order by n
                  rows between unbounded preceding and 1 preceding), 0)::bigint as start from l),
s as (select doc_id, n, start as line_start, unnest(parts) as part, generate_subscripts(parts, 1) as k
      from (select *, regexp_extract_all(line, '[^.!?]+[.!?]*|[.!?]+') as parts from lo)),
so as (select *, (line_start + coalesce(sum(length(part)) over (partition by doc_id, n order by k
                  rows between unbounded preceding and 1 preceding), 0))::bigint as start,
              regexp_extract_all(lower(part), '[^\x20\x09-\x0D]+') as words from s),
p as (select doc_id, n, start, start + length(part) as stop, words,
             count(*) over (partition by doc_id, n) as on_line,
             sum(len(words)) over (partition by doc_id order by n, k) as upto
      from so where len(words) > 0),
w as (select doc_id, flatten(list(words order by upto)) as all_words from p group by doc_id),
runs as (
  select a.doc_id, a.start, b.stop, a.upto - len(a.words) as before, b.upto
  from (select *, upto - len(words) + 8 as target from p) a
  asof join p b on a.doc_id = b.doc_id and a.target <= b.upto
  where not (a.on_line = 1 and a.upto = b.upto)),
u as (
  select doc_id, start, least(start + length(line) + 1, length(text))::bigint as stop,
         regexp_extract_all(lower(line), '[^\x20\x09-\x0D]+') as words, 4 as least_words from lo
  union all
  select doc_id, start, stop, list_slice(all_words, before::bigint + 1, upto::bigint), 8 from runs join w using (doc_id)),
f as (select *, first_value(doc_id) over digest as first_doc, first_value(start) over digest as first_start,
             first_value(stop) over digest as first_stop
      from (select doc_id, start, stop, array_to_string(words, ' ') as unit from u where len(words) >= least_words)
      window digest as (partition by unit order by doc_id, start, stop)),
g as (select doc_id, case when doc_id = first_doc then greatest(start, first_stop) else start end as start, stop
      from f where doc_id > first_doc or start > first_start),
h as (select *, max(stop) over (partition by doc_id order by start, stop
                rows between unbounded preceding and 1 preceding) as reached
      from (select distinct * from g where start < stop)),
i as (select *, count(*) filter (where reached is null or start >= reached)
                over (partition by doc_id order by start, stop rows unbounded preceding) as part from h),
gone as (select doc_id, min(start) as start, max(stop) as stop from i group by doc_id, part),
spans as (select doc_id, count(*) as n_removed, sum(stop - start)::bigint as removed_chars,
                 string_agg(start || '-' || stop, ',' order by start) as removed_spans
          from gone group by doc_id),
kept as (
  select doc_id, coalesce(lag(stop) over (partition by doc_id order by start), 0) as start, start as stop from gone
  union all
  select doc_id, max(stop), null from gone group by doc_id),
left_over as (
  select doc_id, string_agg(substring(text, start::bigint + 1, (coalesce(stop, length(text)) - start)::bigint), ''
                            order by start) as text
  from kept join documents using (doc_id) group by doc_id)
select d.doc_id, case when s.doc_id is null then d.text else x.text end as text,
       coalesce(s.n_removed, 0)::bigint as n_removed, coalesce(s.removed_chars, 0)::bigint as removed_chars,
       coalesce(s.removed_spans, '') as removed_spans
from documents d left join spans s using (doc_id) left join left_over x using (doc_id)
"""
