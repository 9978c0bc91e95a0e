"""Run the enrichment stream from a topic to two topics, or from files to files.

``spark-submit lakeloom/streaming/enrich_job.py --servers kafka:9092 --source raw --checkpoint /jobs/enrich``
``spark-submit lakeloom/streaming/enrich_job.py --source /events/raw --sink /events --checkpoint /jobs/enrich --drain``
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from lakeloom.session import build_session
from lakeloom.streaming import events, jobs


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--source", required=True, help="topic, or folder of Parquet files with key and value")
    parser.add_argument("--servers", help="Kafka servers; without them source and sink are folders")
    parser.add_argument("--sink", help="folder with one subfolder per topic")
    parser.add_argument("--enriched-topic", default=events.ENRICHED_TOPIC)
    parser.add_argument("--failed-topic", default=events.FAILED_TOPIC)
    parser.add_argument("--checkpoint", required=True, help="shared folder that keeps the position")
    parser.add_argument("--max-offsets", type=int, help="most messages of a micro-batch")
    parser.add_argument("--max-files", type=int, help="most files of a micro-batch")
    parser.add_argument("--min-partitions", type=int, help="least tasks that read a topic")
    parser.add_argument("--drain", action="store_true", help="stop when nothing is left to read")
    args = parser.parse_args(argv)
    if not args.servers and not args.sink:
        parser.error("--sink is needed without --servers")

    spark = build_session("enrich")
    if args.servers:
        raw = jobs.read_kafka(spark, args.servers, args.source, min_partitions=args.min_partitions, max_offsets=args.max_offsets)
    else:
        raw = jobs.read_files(spark, args.source, max_files=args.max_files)
    routed = events.route(raw, enriched_topic=args.enriched_topic, failed_topic=args.failed_topic)
    if args.servers:
        query = jobs.write_kafka(routed, args.servers, args.checkpoint, args.drain)
    else:
        query = jobs.write_topics(routed, args.sink, args.checkpoint, args.drain)
    query.awaitTermination()


if __name__ == "__main__":
    main()
