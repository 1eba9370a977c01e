"""Bounded batches, counts that expire, and minutes merged over batches."""

from types import SimpleNamespace

from pyspark.sql import functions as F

from model import frame, span
from spanloom.operators.stats import chain_stats
from spanloom.plans import jobs, queries
from spanloom.sinks import tables as t
from spanloom.sources import messages as msg
from spanloom.streaming.minutes import closed_minutes, summaries
from spanloom.streaming.words import expiring_word_count, file_texts


class Reader:
    """Stands for the reader of a session: keeps what it is told."""

    def __init__(self):
        self.told, self.source = {}, None

    def format(self, name):
        self.source = name
        return self

    def options(self, **options):
        self.told.update(options)
        return self

    def load(self):
        return SimpleNamespace(select=lambda *columns: columns)


def test_options_of_the_topic_reader():
    reader = Reader()
    columns = msg.kafka_payloads(
        SimpleNamespace(readStream=reader), "h:1", "spans", "g", 50_000, 64, "earliest"
    )
    assert columns == ("value", "timestamp") and reader.source == "kafka"
    assert reader.told == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "spans", "kafka.group.id": "g",
        "kafka.max.partition.fetch.bytes": 5_242_880, "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": 50_000, "minPartitions": 64,
    }
    plain = Reader()
    msg.kafka_payloads(SimpleNamespace(readStream=plain), "h:1", "spans", "g")
    assert not {"maxOffsetsPerTrigger", "minPartitions"} & set(plain.told)
    assert plain.told["startingOffsets"] == "latest"


def test_a_backlog_comes_in_bounded_batches(spark, tmp_path):
    source = str(tmp_path / "in")
    for n in range(6):
        rows = [(bytearray(b"x"), 1000 * (10 * n + i)) for i in range(n + 1)]
        spark.createDataFrame(rows, "value binary, ms bigint").select(
            "value", F.timestamp_millis("ms").alias("timestamp")
        ).coalesce(1).write.mode("append").parquet(source)
    sizes = {}
    payloads = msg.file_payloads(spark, source, max_files=2)
    query = (
        payloads.writeStream.foreachBatch(lambda batch, n: sizes.update({n: batch.count()}))
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sizes == {0: 3, 1: 7, 2: 11}


def test_words_are_forgotten_after_the_timeout(spark, tmp_path):
    root = str(tmp_path)
    minutes = [(0, "aa bb"), (5, "aa"), (14, "aa cc"), (30, "aa"), (41, "bb aa"), (500, "end")]
    rows_in_state = []

    def start():
        source = file_texts(spark, f"{root}/in", "text string, ts timestamp")
        query = (
            expiring_word_count(source, "10 minutes").writeStream.outputMode("append")
            .foreachBatch(lambda batch, n: t.write_batch(batch, root, "out", n))
            .option("checkpointLocation", f"{root}/c").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        rows_in_state.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])

    for minute, text in minutes:
        spark.createDataFrame([(text, minute * 60)], "text string, s bigint").select(
            "text", F.timestamp_seconds("s").alias("ts")
        ).write.mode("append").parquet(f"{root}/in")
        start()
    got = t.read_table(spark, root, "out").select(
        "word", F.expr("unix_seconds(first) div 60"), F.expr("unix_seconds(last) div 60"), "n"
    )
    assert sorted(map(tuple, got.collect())) == [
        ("aa", 0, 14, 3), ("aa", 30, 30, 1), ("aa", 41, 41, 1), ("bb", 0, 0, 1), ("bb", 41, 41, 1),
        ("cc", 14, 14, 1),
    ]
    # A closed count leaves the state: at the end only the last word is there.
    assert max(rows_in_state) <= 3 and rows_in_state[-1] == 1


def test_a_minute_of_several_batches_is_one_row(spark, tmp_path):
    root = str(tmp_path)
    minute = 60_000

    def trace(name, at, length):
        at += 1_000 * minute
        return span(name, name, None, "api", begin=at, end=at + length, event="sr", receive=at + 10_000)

    batches = [
        [trace("a", 0, 5), trace("b", minute, 9)], [trace("c", 10, 8), trace("d", minute + 1, 1)],
        [trace("e", 20, 100)], [trace("z", 900 * minute, 1)],
    ]
    every = []
    for n, rows in enumerate(batches):
        spans = frame(spark, rows)
        summary = jobs.forest_of(spans).summary()
        every += rows
        t.write_batch(summary, root, "summary", n)
    out = []
    stream = closed_minutes(summaries(spark, f"{root}/summary", max_files=1), "10 minutes")
    stream.writeStream.outputMode("append").foreachBatch(
        lambda batch, n: out.extend(batch.collect())
    ).option("checkpointLocation", f"{root}/c").trigger(availableNow=True).start().awaitTermination()
    whole = chain_stats(jobs.forest_of(frame(spark, every)).summary(), "minute_start")
    want = whole.where("minute_start < 1900 * 60 - 3600").select(*out[0].asDict()).collect()
    assert sorted(map(str, out)) == sorted(map(str, want)) and len(out) == 2
    assert sorted(r.times for r in out) == [2, 3]


def test_batches_of_minutes_follow_bytes_not_files(spark, tmp_path):
    root, day = str(tmp_path), 86_400_000
    ends = [span(f"t{i}", f"t{i}", None, "api", begin=day + i, end=day + i + 5, event="sr", receive=day + 9_000) for i in range(40)]
    last = span("z", "z", None, "api", begin=2 * day, end=2 * day + 1, event="sr", receive=2 * day + 9_000)
    summary = jobs.forest_of(frame(spark, [*ends, last])).summary()
    t.write_batch(summary.repartition(20, "traceid"), root, "summary", 0)
    assert len([*tmp_path.glob("summary/*/*.parquet")]) > 8
    out = []
    stream = closed_minutes(summaries(spark, f"{root}/summary", max_bytes=queries.SUMMARY_BYTES), "10 minutes")
    query = stream.writeStream.outputMode("append").foreachBatch(
        lambda batch, n: out.extend(batch.collect())
    ).option("checkpointLocation", f"{root}/c").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [41]
    assert [r.times for r in out] == [40]


def test_copies_of_a_word_meet_before_they_move(spark):
    from spanloom.streaming.words import counted_words

    rows = [("a b a", 0), ("a  b", 0), ("   ", 9), (None, 0), ("a", 3)]
    texts = spark.createDataFrame(rows, "text string, s bigint").selectExpr("text", "timestamp_seconds(s) ts").coalesce(1)
    got = counted_words(texts, "text", "ts").selectExpr("word", "unix_seconds(ts)", "n").collect()
    told = sorted((tuple(r) for r in got if r[0] is not None), key=str)
    assert told == [("", 0, 1), ("a", 0, 3), ("a", 3, 1), ("b", 0, 2), ("null", 0, 1)]
    assert max(r[1] for r in got) == 9
