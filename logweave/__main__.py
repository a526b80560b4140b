"""Command line: ``python -m logweave <program> [options]``.

Runs one of the programs in ``logweave.apps`` over a folder of text files
(``--input``), a socket (``--socket host:port``) or a Kafka topic
(``--kafka servers/topic``).  ``--available-now`` drains the input and stops.
"""

from __future__ import annotations

import argparse
import sys

from logweave import apps
from logweave.session import get_spark
from logweave.sources import streams

STREAM_APPS = ("log-parser", "log-sql", "log-alarmer", "sessionizer", "hourly-status", "strict-urls",
               "word-count-per-batch")


def _lines(spark, a):
    if a.socket:
        host, port = a.socket.rsplit(":", 1)
        return streams.socket_lines(spark, host, int(port))
    if a.kafka:
        servers, topic = a.kafka.split("/", 1)
        return streams.kafka_lines(spark, servers, topic)
    return streams.text_dir_stream(spark, a.input)


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="logweave")
    p.add_argument("program", choices=STREAM_APPS + ("popular-words", "text-lengths", "word-count", "line-count"))
    p.add_argument("--input", help="folder of text files (stream) or a file (batch programs)")
    p.add_argument("--socket", help="host:port line source")
    p.add_argument("--kafka", help="bootstrap-servers/topic")
    p.add_argument("--archive", help="folder with Tweets_* sub-folders (replay programs)")
    p.add_argument("--checkpoint", help="checkpoint folder (required for streams)")
    p.add_argument("--out", help="output folder (log-sql)")
    p.add_argument("--interval", default="1 second", help="micro-batch interval")
    p.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    p.add_argument("--master", default=None)
    a = p.parse_args(argv)
    spark = get_spark(a.master, app=f"logweave-{a.program}")
    opts = {"available_now": a.available_now, "interval": a.interval}
    if a.program == "word-count":
        apps.word_count(spark, a.input).show(20, truncate=False)
        return 0
    if a.program == "line-count":
        apps.line_count(spark, a.input).show()
        return 0
    if not a.checkpoint:
        p.error("--checkpoint is required for stream programs")
    if a.program == "popular-words":
        qs = [apps.popular_words(spark, a.archive, a.checkpoint, **opts)]
    elif a.program == "text-lengths":
        qs = [apps.text_lengths(spark, a.archive, a.checkpoint, **opts)]
    else:
        lines = _lines(spark, a)
        if a.program == "log-parser":
            qs = apps.log_parser(lines, a.checkpoint, **opts)
        elif a.program == "log-sql":
            qs = [apps.log_sql(lines, a.checkpoint, a.out, **opts)]
        elif a.program == "log-alarmer":
            qs = [apps.log_alarmer(spark, lines, a.checkpoint, **opts)[0]]
        elif a.program == "sessionizer":
            qs = [apps.sessionizer(lines, a.checkpoint, **opts)]
        elif a.program == "hourly-status":
            qs = [apps.hourly_status(lines, a.checkpoint, **opts)]
        elif a.program == "strict-urls":
            qs = [apps.strict_urls(lines, a.checkpoint, **opts)]
        else:
            qs = [apps.word_count_per_batch(lines, a.checkpoint, **opts)]
    for q in qs:
        q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
