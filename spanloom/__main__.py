"""``python -m spanloom online|daily``: the stream over a Kafka topic, and the day's job."""

from __future__ import annotations

import argparse
import signal
import time

from pyspark.sql import SparkSession

from spanloom.plans.jobs import daily_job, owner_days
from spanloom.schemas import TagKeys
from spanloom.session import MERGE_SESSIONS
from spanloom.sources.messages import kafka_payloads
from spanloom.streaming.job import TraceStream


def main() -> None:
    parser = argparse.ArgumentParser(prog="spanloom")
    parser.add_argument("job", choices=("online", "daily"))
    parser.add_argument("--root", required=True, help="folder of the result tables")
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--topic", help="topic of the span messages; the online job needs it")
    parser.add_argument("--group", help="consumer group prefix; the online job needs it")
    parser.add_argument("--seconds", type=int, default=60, help="time between micro-batches")
    parser.add_argument("--max-messages", type=int, help="messages of a micro-batch at most")
    parser.add_argument("--min-partitions", type=int, help="tasks that read a micro-batch at least")
    parser.add_argument("--starting", default="latest", help="where a new stream starts in the topic")
    parser.add_argument("--redo", action="store_true", help="daily: run the days again that own the day's traces")
    parser.add_argument("--as-of", type=int, help="end of the daily scan, epoch ms; now if unset")
    parser.add_argument("--region-tag", default=TagKeys.region)
    parser.add_argument("--page-tag", default=TagKeys.from_page)
    parser.add_argument("--final", action="store_true", help="analyze what waits when stopped")
    args = parser.parse_args()
    if args.job == "online" and not (args.servers and args.topic and args.group):
        parser.error("online needs --servers, --topic and --group")

    tags = TagKeys(region=args.region_tag, from_page=args.page_tag)
    state = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    spark = (
        SparkSession.builder.appName("spanloom")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.streaming.stateStore.providerClass", state)
        .config(MERGE_SESSIONS, "true")
        .getOrCreate()
    )
    if args.job == "daily":
        as_of = args.as_of or int(time.time() * 1000)
        day = as_of // 86_400_000 * 86_400
        for owner in owner_days(spark, args.root, day, day) if args.redo else ():
            daily_job(spark, args.root, owner * 1000, tags=tags)
        daily_job(spark, args.root, as_of, tags=tags)
        return
    stream = TraceStream(args.root, tags=tags, trigger_seconds=args.seconds)
    payloads = kafka_payloads(
        spark, args.servers, args.topic, args.group, args.max_messages, args.min_partitions,
        args.starting,
    )
    query = stream.start_ticking(payloads)
    signal.signal(signal.SIGTERM, lambda *_: query.stop())
    query.awaitTermination()
    if args.final and query.lastProgress:
        stream.flush(spark, query.lastProgress["batchId"], int(time.time() * 1000))


if __name__ == "__main__":
    main()
