import gzip
import hashlib
import io
import os
import random
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spanloom.llm import html, langid, lines, packing, tables, tokens, warc

# ---- WARC -----------------------------------------------------------------------------------

PAGES = "page_id bigint, url string, html string, digest string"


def page_rows():
    long, other = "<p>ü\r\n\r\nWARC/1.1\r\n" * 80, "y" * 1000
    rows = [
        (1, "http://a/", long), (2, "http://b/\r\nX: y z", long), (7, None, long), (3, "u", "short"), (4, "u", "short"),
        (5, "u", None), (6, "u", ""), (8, "u", other), (9, "u", "y" * 999), (10, "u", "y" * 999),
        (11, "u", other), (11, "u", other), (None, "u", long), (12, "u", "z" * 300_000),
    ]
    return [(*r, "x") for r in rows]


def plain_pages(rows):
    out = []
    for page_id, _, text, _ in rows:
        payload = (text or "").encode()
        same = [i for i, _, t, _ in rows if (t or "").encode() == payload and i is not None]
        revisit = len(payload) >= 1000 and same and page_id != max(same)
        out.append((
            page_id, len(payload), hashlib.sha1(payload).hexdigest(),
            "revisit" if revisit else "response", max(same) if revisit else None,
        ))
    return out


def test_warc_round_trip(spark):
    rows = page_rows()
    got = warc.stored_pages(spark.createDataFrame(rows, PAGES)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain_pages(rows)))
    assert warc.stored_pages(spark.createDataFrame([], PAGES)).count() == 0


def test_predicates_and_partitions(spark, tmp_path):
    rows = page_rows()
    path = str(tmp_path / "w")
    warc.write_archives(spark.createDataFrame(rows, PAGES).repartition(3), path)
    assert all(f.endswith(".gz") for f in os.listdir(path) if f.startswith("part"))
    every = warc.read_archives(spark, path)
    assert every.count() == len(rows)
    revisits = warc.read_archives(spark, path, ("revisit",), "record_id string, refers_to string")
    assert revisits.count() == sum(p[3] == "revisit" for p in plain_pages(rows))
    one = spark.read.format("warc").option("header.WARC-Record-ID", "<urn:page:12>").load(path).collect()
    assert [len(r.payload) for r in one] == [300_000] and one[0].headers["warc-type"] == "response"
    many = spark.read.format("warc").option("partitionBytes", "1").load(path)
    assert many.rdd.getNumPartitions() == 3
    # Line breaks in a URL cannot add headers.
    uri = every.where(warc.page_id(F.col("record_id")) == 2).first().target_uri
    assert uri == "http://b/%0D%0AX:%20y%20z"


def test_pushed_filters(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_archives(spark.createDataFrame(page_rows(), PAGES), path)
    key = "spark.sql.python.filterPushdown.enabled"
    spark.conf.set(key, "true")
    try:
        read = warc.read_archives(spark, path).where("record_type = 'revisit'")
        assert read.count() == 4
        assert "ArrayBuffer(record_type" not in read._jdf.queryExecution().optimizedPlan().toString()
        mixed = warc.read_archives(spark, path).where("record_type in ('revisit') and payload_bytes > 1500")
        assert mixed.count() == 3
    finally:
        spark.conf.unset(key)


def test_unwanted_blocks_are_not_decoded():
    class Counting(io.BytesIO):
        pass

    record = b"WARC/1.0\r\nWARC-Type: %s\r\nContent-Length: 6\r\n\r\n\xff\xfe\r\n\r\n\r\n\r\n"
    data = record % b"metadata" + record % b"resource"
    rows = list(warc.read_records(Counting(data), frozenset({"resource"}), {}, True))
    assert [(r["record_type"], r["payload"], r["payload_bytes"]) for r in rows] == [("resource", b"\xff\xfe\r\n\r\n", 6)]
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(data[:-12]), frozenset(), {}, True))
    members = gzip.compress(record % b"a") + gzip.compress(record % b"b")
    assert len(list(warc.read_records(gzip.GzipFile(fileobj=io.BytesIO(members)), frozenset(), {}, False))) == 2


@pytest.mark.parametrize("payload", [True, False])
def test_pieces_may_end_anywhere(payload):
    class Cut(io.BytesIO):
        """The first read ends at ``at``, the others give ``piece`` bytes."""

        def __init__(self, data, at, piece):
            super().__init__(data)
            self.at, self.piece = at, piece

        def read(self, size=-1):
            return super().read(self.at if self.tell() < self.at else self.piece)

    http = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n"
    data = b""
    for n, kind in enumerate((b"response", b"revisit", b"response", b"metadata")):
        body = b"" if kind == b"revisit" else b"x\r\n\r\n"
        block = body if kind == b"metadata" else http % 6 + body
        media = b"" if kind == b"metadata" else b"Content-Type: application/http\r\n"
        data += b"WARC/1.1\r\nWARC-Type: %s\r\nWARC-Record-ID: <urn:page:%d>\r\n" % (kind, n) + media
        data += b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"
    plain = list(warc.read_records(io.BytesIO(data), frozenset(), {}, payload))
    assert [r["record_id"] for r in plain] == [f"<urn:page:{n}>" for n in range(4)]
    for at in range(1, len(data)):
        for piece in (1, 1 << 20):
            assert list(warc.read_records(Cut(data, at, piece), frozenset(), {}, payload)) == plain


# ---- HTML -----------------------------------------------------------------------------------

CASES = {
    "": "",
    "plain  text\n here": "plain text here",
    "<p>a<p>b <b>c</b>d": "a\n\nb cd",
    "<title>t</title><body>x<br>y<br><br>z": "x\ny\n\nz",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e": "* a\n* b\n  * c\n* d\n\ne",
    "<ol start=9><li>a<li>b</ol>": "9. a\n10. b",
    "<script>if (a < b) {}</script>x<style>p{}</style><noscript>n</noscript>": "x",
    "<div hidden>a</div><div style='COLOR:red; display : none'>b</div><i style='visibility:hidden'>c</i>d": "d",
    "<pre>a  b\n  c</pre>": "a  b\n  c",
    "a &amp; b &lt;c&gt; &nbsp;": "a & b <c> \xa0",
    "<table><tr><th>name<th>n<tr><td>x<td>10<tr><td>longer<td>2</table>": "name    n\nx       10\nlonger  2",
    "<table><tr><td colspan=2>wide one<td>c<tr><td>a<td>b<td>d</table>": "wide one  c\na  b  d",
    "<table><tr><td>a<br>b<td>c</table>": "a  c\nb",
    "<table><tr><td><table><tr><td>in<td>ner</table><td>out</table>": "in  ner  out",
    "<dl><dt>t<dd>d<dt>u<dd>e</dl>": "t\n  d\nu\n  e",
    "x</b></p></div>y</table>z": "xyz",
    "<details><summary>s</summary>no</details><details open><summary>t</summary>yes</details>": "s\nt\nyes",
    "<p>un<closed": "un<closed",
    "<blockquote>q</blockquote>r": "  q\n\nr",
    "<li>a<li>b": "* a\n* b",
    "<td>a<td>b": "a b",
}


@pytest.mark.parametrize("page", CASES)
def test_rendering(page):
    assert html.render(page).split() == CASES[page].split()
    if page not in ("a &amp; b &lt;c&gt; &nbsp;", "<table><tr><td colspan=2>wide one<td>c<tr><td>a<td>b<td>d</table>"):
        assert html.render(page) == CASES[page]


def test_deep_and_broken_pages_keep_their_text():
    deep = "<div>" * 5000 + "core" + "</div>" * 5000
    assert html.render(deep) == "core"
    assert html.render("<ul><li>" * 2000 + "x").endswith("x")
    assert "end" in html.render("<table>" * 300 + "<tr><td>end")
    assert html.render("<!-- c -->a<![CDATA[b]]><?php x ?>c").startswith("a")


@pytest.mark.parametrize("depth", [3, 117, 118, 119, 120, 130, 3000])
def test_hidden_content_stays_hidden_at_any_depth(depth):
    deep = "<div>" * depth

    def words(inner):
        return html.render(deep + inner).split()

    assert words("<p hidden>SECRET</p><script>var x=1;</script>") == []
    assert words("<p hidden>S<b>T</b>S</p>seen") == ["seen"]
    assert words("<p hidden>S<p>seen<p>too") == ["seen", "too"]
    assert words("<div style='display:none'>S<div>S</div>S<br>S</div>seen") == ["seen"]
    assert words("<div hidden>S</b></i>S</div><span>seen</span>") == ["seen"]
    assert words("<ul><li hidden>S<ul><li>S</ul>S<li>seen</ul>") == [*["*"] * (depth < 118), "seen"]
    assert words("<section><p hidden>S</section>seen") == ["seen"]
    assert words("a<style>p{}</style>b</div>c") == (["ab", "c"])


def test_cells_that_span_rows_move_the_next_rows():
    page = "<table><tr><td rowspan=2>ab<td>c<tr><td>d<tr><td>e<td>f</table>"
    assert html.render(page) == "ab  c\n    d\ne   f"
    page = "<table><tr><td>a<td rowspan=2 colspan=2>b<td>c<tr><td>d<td>e</table>"
    assert [line.split() for line in html.render(page).split("\n")] == [["a", "b", "c"], ["d", "e"]]
    wide = "<table><tr><td rowspan=99999999 colspan=100>x" + "<tr><td>y" * 200 + "</table>"
    assert html.render(wide).split() == ["x"] + ["y"] * 200


def test_tables_against_a_plain_grid():
    rng = random.Random(5)
    for _ in range(200):
        rows = [
            [(f"c{rng.randrange(10 ** rng.randrange(1, 8))}", rng.choice([1, 1, 1, 2, 3])) for _ in range(rng.randrange(1, 5))]
            for _ in range(rng.randrange(1, 6))
        ]
        page = "<table>" + "".join(
            "<tr>" + "".join(f"<td rowspan={n}>{text}" for text, n in row) for row in rows) + "</table>"
        grid = {}
        for y, row in enumerate(rows):
            x = 0
            for text, n in row:
                while (y, x) in grid:
                    x += 1
                grid.update({(y + i, x): text if i == 0 else "" for i in range(n)})
                x += 1
        width = max(x for _, x in grid) + 1
        widths = [max(len(grid.get((y, x), "")) for y in range(len(rows))) for x in range(width)]
        want = []
        for y in range(len(rows)):
            cells = (grid.get((y, x), "").ljust(widths[x] + 2 if widths[x] else 0) for x in range(width))
            want.append("".join(cells).rstrip())
        assert html.render(page) == "\n".join(want).strip("\n")


def test_wide_cells_and_open_comments_stay_small():
    page = "<table><tr><td>" + "x" * 20_000 + "<td>y" + "<tr><td>a<td>b" * 2000 + "</table>"
    lines = html.render(page).split("\n")
    assert lines[0] == "x" * 20_000 + "  y" and set(lines[1:]) == {"a  b"}
    many = "<table><tr>" + "<td>0123456789" * 2000 + "<tr><td colspan=100>" * 1 + "<td>z" * 20 + "</table>"
    assert len(html.render(many)) < 30_000
    start = time.time()
    assert html.render("seen" + "<!--" * 200_000) == "seen"
    assert html.render("<!-- a > b -->seen<!-->too<!--x--!>end<!-- cut") == "seentooend"
    assert html.render("<script><!-- x </script>seen") == "seen"
    assert time.time() - start < 20


def test_pages_table(spark):
    rows = [(1, "u", "<p>a<p>b"), (1, "u", "<p>a<p>b"), (2, None, None), (None, "u", ""), (3, "u", "x" * 200_000)]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id bigint, url string, html string, text string")
    got = html.page_texts(pages).collect()
    assert sorted((str(r.page_id), r.n_chars, r.n_lines) for r in got) == [
        ("1", 4, 3), ("1", 4, 3), ("2", 0, 0), ("3", 200_000, 1), ("None", 0, 0)]
    assert html.extract_text(pages).columns == ["page_id", "url", "html", "text"]
    assert html.page_texts(pages.limit(0)).count() == 0


# ---- the pipeline ---------------------------------------------------------------------------


def test_pipeline_stages(spark, tmp_path):
    import random

    rng = random.Random(1)
    syllables = {"en": ["tha", "ing", "er"], "fr": ["eau", "que", "oi"]}

    def text(lang, n=80):
        return " ".join("".join(rng.choices(syllables[lang], k=3)) + str(rng.randint(0, 9999)) for _ in range(n))

    shared = "This very passage is found in several of the documents at hand."
    rows = [(i, text("en" if i % 3 else "fr") + "\n" + shared + "\n" + text("en"), "en" if i % 3 else "fr", f"s{i % 4}", 1) for i in range(60)]
    rows += [(100 + i, rows[i][1], rows[i][2], "s9", 1) for i in range(20)]
    rows += [(200, None, None, None, None), (201, "... 123", "en", "s1", 7), (202, "", "en", "s1", 0)]
    ddl = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    folder = str(tmp_path)
    spark.createDataFrame(rows, ddl).write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        kept.append(docs)
        if name != "packing":
            assert docs.columns == [c.split()[0] for c in ddl.split(", ")]
    ids = [sorted(r.doc_id for r in d.select("doc_id").collect()) for d in kept]
    assert ids[0] == sorted(set(range(60)) | set(range(100, 120)))
    assert ids[1] == list(range(60))
    assert ids[2] == ids[1]
    assert [r.doc_id for r in kept[2].where(F.contains("text", F.lit(shared))).collect()] == [0]
    assert all(r.n_chars == len(r.text) for r in kept[2].collect())
    assert set(ids[3]) <= set(ids[2]) and set(ids[4]) == set(ids[3])
    run = corpus_pipeline.run(spark, folder)
    assert run.columns == kept[4].columns and run.agg(F.sum("length")).first()[0] == kept[4].agg(F.sum("length")).first()[0]


def test_stages_take_an_empty_table(spark):
    ddl = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame([], ddl)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").count() == 0


def test_the_last_stage_holds_the_tokens(spark):
    import zlib

    from spanloom.llm import tokens

    text = "Words of a document, all of which are in the packed corpus."
    docs = spark.createDataFrame([(4, text, "en", "s", len(text))], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    name, stage = corpus_pipeline.STAGES[-1]
    rows = stage(spark, docs, "").collect()
    ids = [int.from_bytes(r.ids[i : i + 4], "little") for r in rows for i in range(0, len(r.ids), 4)]
    assert name == "packing" and tokens.load_tokenizer(tokens.TOKENIZER).decode(ids[:-1]) == text
    assert all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) and len(r.ids) == 4 * r.length for r in rows)


@pytest.mark.parametrize("operator, step, stage", [
    (langid, "identify", langid.identified_documents), (lines, "remove_repeats", lines.cut_documents),
])
def test_a_text_moves_once(spark, monkeypatch, operator, step, stage):
    """Beside the text no struct holds it again; names of other cases and odd columns stay."""
    moved = []
    real = getattr(operator, step)
    monkeypatch.setattr(operator, step, lambda docs, *more: moved.append(docs.schema) or real(docs, *more))
    rows = [(1, "en", "a b c d e", "x"), (2, None, None, "y"), (3, "en", "a b c d e\nf g h i", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, Text string, `odd.name` string")
    out = stage(docs)
    assert out.columns == docs.columns
    assert str(moved[0].jsonValue()).lower().count("'text'") == 1
    got = {r["doc_id"]: tuple(r) for r in out.collect()}
    assert got[1] == rows[0] and got[3][0::3] == (3, None)


def test_what_a_state_is_made_of_goes_with_it():
    """The tokenizers of an earlier stage do not stay in the worker."""
    packing.document_ids("some words", tokens.TOKENIZER, 1)
    packing.sentence_ends(tokens.TOKENIZER)
    tables.worker_state(("another stage",), dict)
    assert [f.cache_info().currsize for f in (tokens.load_tokenizer, tokens.merge_table, packing.sentence_ends)] == [0] * 3
