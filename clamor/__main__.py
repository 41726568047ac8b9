"""Run the streaming job: ``spark-submit clamor/__main__.py --help``.

Messages come from a topic, or from JSON-lines files in a folder.  With ``--live-folder``
a second query keeps running counts by minute.  ``--compact-to``, ``--snapshot`` and
``--history`` work on the store alone and end.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession

from clamor.operators.mentions import valid_rows
from clamor.session import configure
from clamor.sources.messages import RECORDS_PER_TRIGGER, decode, file_stream, topic_stream
from clamor.sources.store import MentionStore
from clamor.streaming.job import (
    DELAY,
    live_mentions,
    run_of,
    start,
    use_state_settings,
    write_live_buckets,
)


def main() -> None:
    parser = argparse.ArgumentParser(prog="clamor")
    parser.add_argument("--root", required=True, help="folder of the stored tables")
    parser.add_argument("--checkpoint", required=True, help="checkpoint folder of the query")
    parser.add_argument("--brand", required=True, help="brand named in batch records")
    parser.add_argument("--trigger-seconds", type=int, default=10)
    parser.add_argument("--delay", default=DELAY, help="how late messages may be")
    parser.add_argument("--drain", action="store_true", help="work off what is there and end")
    parser.add_argument("--records-per-trigger", type=int, default=RECORDS_PER_TRIGGER)
    parser.add_argument("--files-per-trigger", type=int, default=1)
    parser.add_argument("--live-folder", help="folder of running counts by minute")
    parser.add_argument("--live-checkpoint", help="checkpoint folder of those")
    parser.add_argument("--live-delay", default="10 minutes", help="how late messages may be")
    parser.add_argument("--compact-to", help="fold all batches into a new store at this folder")
    parser.add_argument("--snapshot", type=int, help="write a snapshot of so many nodes per label")
    parser.add_argument("--history", help="folder of facts scored elsewhere, to be added")
    source = parser.add_mutually_exclusive_group()
    source.add_argument("--folder", help="folder of JSON-lines files")
    source.add_argument("--servers", help="bootstrap servers of the topic")
    parser.add_argument("--topic", default="mentions")
    options = parser.parse_args()

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = configure(SparkSession.builder.appName("clamor").getOrCreate())
    store = MentionStore(spark, options.root)
    if options.history:
        store.load_history(spark.read.parquet(options.history))
        store.rebuild_ledgers(options.brand, run_of(spark, options.checkpoint))
    if options.snapshot:
        store.write_graph_snapshot(options.snapshot)
    if options.compact_to:
        store.compact(MentionStore(spark, options.compact_to), "compacted")
    if not (options.folder or options.servers):
        if not (options.history or options.snapshot or options.compact_to):
            parser.error("one of --folder and --servers is needed")
        return

    def values(session: SparkSession) -> DataFrame:
        if options.folder:
            return file_stream(session, options.folder, options.files_per_trigger)
        return topic_stream(session, options.servers, options.topic, options.records_per_trigger)

    seconds = None if options.drain else options.trigger_seconds
    queries = [
        start(values(spark), options.root, options.checkpoint, options.brand, seconds, options.delay)
    ]
    if options.live_folder:
        own = configure(spark.newSession())
        use_state_settings(own)
        counted = live_mentions(valid_rows(decode(values(own))), options.live_delay)
        queries.append(
            write_live_buckets(
                counted, options.live_folder, options.live_checkpoint, seconds, "append"
            )
        )
    for query in queries:
        query.awaitTermination()


if __name__ == "__main__":
    main()
