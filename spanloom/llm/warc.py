"""WARC archives: written by Spark's text writer, read by a Python data source.

Writing. A record is one string and ends with the two line breaks that the format asks for, so
the text source, with a line feed between its rows, writes valid archives to any file system
that Spark reaches, with its commit protocol behind it: a task that runs again leaves no half
file. Each file is one gzip member of UTF-8 records. Of equal payloads of at least
``LEAST_BYTES`` one is stored; the others are revisit records that name it.

Reading. ``spark.read.format("warc")`` plans partitions of whole files, up to ``partitionBytes``
each. A record's headers are parsed first. If its type or a header fails a predicate, its block is
skipped by its length and nothing of it is decoded; a payload that the asked schema lacks is skipped
too. Predicates come as options (``recordTypes``, ``header.<name>``) or, in a session with
``spark.sql.python.filterPushdown.enabled`` and with the option ``pushFilters``, from the query's
filters.
"""

from __future__ import annotations

import gzip
import os
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from spanloom.staging import new_folder, stage

LEAST_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = (
    "record_type string, record_id string, refers_to string, target_uri string, "
    "payload_digest string, payload_bytes bigint, headers map<string,string>, payload binary"
)
#: Columns that are a header's value.
HEADER_OF = {
    "record_type": "warc-type", "record_id": "warc-record-id", "refers_to": "warc-refers-to",
    "target_uri": "warc-target-uri", "payload_digest": "warc-payload-digest",
}
PARTITION_BYTES = 128 << 20
BATCH_BYTES = 4 << 20


# ---- writing --------------------------------------------------------------------------------


def _page_urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    """A header line; null without a value, and without line breaks or blanks inside it."""
    for char, code in (("\r", "%0D"), ("\n", "%0A"), ("\t", "%09"), (" ", "%20")):
        value = F.replace(value, F.lit(char), F.lit(code))
    return F.concat(F.lit(f"{name}: "), value)


def records(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(value): one WARC record per row of (page_id, url, html).

    A null html is an empty payload, a null url gives no target URI, a null page_id an empty
    number. Of equal payloads of at least ``least_bytes`` bytes the row with the largest page_id
    is the response (each such row, if rows repeat it); if all ids are null, all are.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"),
        F.sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).alias("size"),
    )
    stored = stage(
        rows.where(F.col("size") >= least_bytes).groupBy("digest", "size")
        .agg(F.max("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1 and first_id is not null").drop("n"),
        "payloads",
    )
    joined = rows.join(stored, ["digest", "size"], "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    crlf = F.lit("\r\n")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"), F.lit("\r\n\r\n"),
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    headers = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.when(revisit, F.lit("WARC-Type: revisit")).otherwise(F.lit("WARC-Type: response")),
        _header("WARC-Record-ID", _page_urn(F.col("page_id"))),
        F.lit(f"WARC-Date: {DATE}"),
        _header("WARC-Target-URI", F.col("url")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, _header("WARC-Refers-To", _page_urn(F.col("first_id")))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    # The writer adds the last line feed.
    return joined.select(F.concat(headers, crlf, crlf, block, F.lit("\r\n\r")).alias("value"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> None:
    """Write the pages as gzip-compressed WARC files into a new folder."""
    records(pages, least_bytes).write.option("compression", "gzip").option("lineSep", "\n").text(path)


# ---- reading --------------------------------------------------------------------------------


@dataclass
class Archives(InputPartition):
    paths: list[str]


def _local(path: str) -> str | None:
    """The path in the local (or mounted) file system, None if it is elsewhere."""
    if path.startswith("file:"):
        return unquote(urlsplit(path).path)
    return None if "://" in path else path


def _archives(path: str) -> list[tuple[str, int]]:
    """(location, bytes) of the files of a folder, or of one file, by name."""
    here = _local(path)
    if here is not None and os.path.isfile(here):
        return [(here, os.path.getsize(here))]
    if here is not None:
        found = [
            (os.path.join(top, name), os.path.getsize(os.path.join(top, name)))
            for top, _, names in os.walk(here) for name in names
        ]
    else:
        import pyarrow.fs

        system, inner = pyarrow.fs.FileSystem.from_uri(path)
        prefix = path.rstrip("/")[: -len(inner.rstrip("/"))]
        files = system.get_file_info(pyarrow.fs.FileSelector(inner, recursive=True))
        found = [(prefix + f.path, f.size) for f in files if f.type == pyarrow.fs.FileType.File]
    return sorted(f for f in found if not os.path.basename(f[0]).startswith(("_", ".")))


def _open(path: str):
    here = _local(path)
    if here is not None:
        raw = open(here, "rb")
    else:
        import pyarrow.fs

        system, inner = pyarrow.fs.FileSystem.from_uri(path)
        raw = system.open_input_stream(inner, compression=None, buffer_size=1 << 20)
    return gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw


class _Lines:
    """Header lines and counted blocks of a stream, read in large pieces."""

    def __init__(self, stream, piece: int = 1 << 20):
        self.stream, self.piece = stream, piece
        self.held, self.at = b"", 0

    def _more(self) -> bool:
        new = self.stream.read(self.piece)
        self.held, self.at = self.held[self.at :] + new, 0
        return bool(new)

    def _holds(self, size: int) -> bool:
        """Whether so many bytes are there, after as much reading as that takes."""
        while len(self.held) - self.at < size:
            if not self._more():
                return False
        return True

    def headers(self) -> bytes | None:
        """The next header block, without its blank line; None at the end."""
        # A piece may end between the two bytes of a line break.
        while self._holds(2) and self.held[self.at : self.at + 2] == b"\r\n":
            self.at += 2
        if self.at == len(self.held):
            return None
        while (end := self.held.find(b"\r\n\r\n", self.at)) < 0:
            if not self._more():
                raise ValueError("a WARC record ends inside its headers")
        block, self.at = self.held[self.at : end], end + 4
        return block

    def take(self, size: int) -> bytes:
        if not self._holds(size):
            raise ValueError("a WARC record ends inside its block")
        block, self.at = self.held[self.at : self.at + size], self.at + size
        return block

    def skip(self, size: int) -> None:
        while (there := len(self.held) - self.at) < size:
            size -= there
            self.at = len(self.held)
            if not self._more():
                raise ValueError("a WARC record ends inside its block")
        self.at += size


def _fields(block: bytes) -> dict[str, str]:
    """Headers by lower-case name."""
    out = {}
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def read_records(
    stream, types: frozenset[str], wanted: dict[str, frozenset[str]], payload: bool
) -> Iterator[dict]:
    """Records that pass: the columns of ``SCHEMA``; a payload only if asked for."""
    lines = _Lines(stream)
    while (block := lines.headers()) is not None:
        fields = _fields(block)
        size = int(fields["content-length"])
        passes = not types or fields.get("warc-type") in types
        if not (passes and all(fields.get(k) in v for k, v in wanted.items())):
            lines.skip(size)
            continue
        row = {column: fields.get(name) for column, name in HEADER_OF.items()}
        row |= {"headers": fields, "payload_bytes": size, "payload": None}
        if fields.get("content-type", "").startswith("application/http"):
            stored = fields.get("warc-type") != "revisit"
            if stored and payload:
                head, _, body = lines.take(size).partition(b"\r\n\r\n")
                row["payload"] = body
            else:
                head = lines.headers()
                lines.skip(size - len(head) - 4)
            row["payload_bytes"] = int(_fields(head).get("content-length", size - len(head) - 4))
        elif payload:
            row["payload"] = lines.take(size)
        else:
            lines.skip(size)
        yield row


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.path = options["path"]
        self.schema = schema
        self.size = int(options.get("partitionbytes", PARTITION_BYTES))
        types = options.get("recordtypes", "")
        self.types = frozenset(t for t in types.split(",") if t)
        self.wanted = {
            name.removeprefix("header."): frozenset([value])
            for name, value in options.items() if name.startswith("header.")
        }

    def partitions(self) -> list[InputPartition]:
        groups, held = [], 0
        for path, size in _archives(self.path):
            if not groups or held + size > self.size:
                groups.append([])
                held = 0
            groups[-1].append(path)
            held += size
        return [Archives(paths) for paths in groups]

    def read(self, partition: Archives) -> Iterator[pa.RecordBatch]:
        names = self.schema.fieldNames()
        schema = to_arrow_schema(self.schema)
        rows, held = [], 0
        for path in partition.paths if partition else []:
            with _open(path) as stream:
                for row in read_records(stream, self.types, self.wanted, "payload" in names):
                    rows.append({name: row[name] for name in names})
                    held += 500 + len(row["payload"] or b"")
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class FilteringWarcReader(WarcReader):
    """For sessions that push filters down to Python sources; others refuse such a reader."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if name in HEADER_OF:
                given = f.value if isinstance(f, In) else (f.value,)
                accepted = frozenset(given)
                header = HEADER_OF[name]
                self.wanted[header] = self.wanted.get(header, accepted) & accepted
            elif not (isinstance(f, IsNotNull) and f.attribute == ("record_type",)):
                yield f


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        options = {k.lower(): v for k, v in self.options.items()}
        kind = FilteringWarcReader if options.get("pushfilters") == "true" else WarcReader
        return kind(options, schema)


def read_archives(
    spark: SparkSession, path: str, record_types: tuple[str, ...] = (), schema: str = SCHEMA
) -> DataFrame:
    """Records of a folder of archives. An empty folder gives no rows."""
    spark.dataSource.register(WarcSource)
    reader = spark.read.format("warc").schema(schema).option("recordTypes", ",".join(record_types))
    pushed = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return reader.option("pushFilters", pushed.lower()).load(path)


def page_id(urn: Column) -> Column:
    """The number in a page's URN, null without one."""
    return F.nullif(F.regexp_extract(urn, r"^<urn:page:(-?\d*)>$", 1), F.lit("")).cast("bigint")


def stored_pages(pages: DataFrame) -> DataFrame:
    """Pages after a round trip: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Sizes and digests of responses are taken from the payloads that were read back, those of
    revisits from their headers.
    """
    spark = pages.sparkSession
    path = new_folder(spark, "warc")
    write_archives(pages, path)
    schema = (
        "record_type string, record_id string, refers_to string, payload_digest string, "
        "payload_bytes bigint, payload binary"
    )
    found = read_archives(spark, path, ("response", "revisit"), schema)
    return found.select(
        page_id(F.col("record_id")).alias("page_id"),
        F.coalesce(F.octet_length("payload").cast("bigint"), "payload_bytes").alias("payload_bytes"),
        F.coalesce(F.sha1("payload"), F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        "record_type",
        page_id(F.col("refers_to")).alias("refers_to"),
    )


ORACLE = """
with p as (select page_id, octet_length(encode(coalesce(html, ''))) as size, sha1(coalesce(html, '')) as digest from pages),
f as (select digest, max(page_id) as first_id from p where size >= 1000 group by digest having count(*) > 1)
select page_id, size::bigint as payload_bytes, p.digest as payload_digest,
       case when first_id <> page_id then 'revisit' else 'response' end as record_type,
       case when first_id <> page_id then first_id end as refers_to
from p left join f on p.digest = f.digest and p.size >= 1000
"""
