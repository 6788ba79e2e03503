"""Start the three topic jobs: ``spark-submit --py-files ... app.py --servers ...``."""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from touchline.session import build_session
from touchline.sinks.changelog import write_kafka
from touchline.sources.topics import kafka_stream
from touchline.streaming import jobs
from touchline.streaming.health import ProgressListener

# Default topic names.
INPUT_TOPIC = "raw-events"
OUTPUT_TOPIC = "processed-events"
ATTRIBUTED_TOPIC = "attributed-events"
EXPOSURE_TOPIC = "exposure-events"


def topic_jobs(
    read: Callable[[str], DataFrame],
    publish: Callable[[DataFrame, int], None],
    root: str,
    input_topic: str = INPUT_TOPIC,
    attributed_topic: str = ATTRIBUTED_TOPIC,
    exposure_topic: str = EXPOSURE_TOPIC,
    store_clicks: bool = False,
    archive_table: str | None = None,
    attributed_table: str | None = None,
    click_table: str | None = None,
) -> dict[str, DataStreamWriter]:
    """The jobs by name, ready to start; tables and checkpoints go below ``root``.

    ``archive_table`` and ``attributed_table`` name catalog tables whose format has
    MERGE; they are upserted in place of the archives below ``root``.
    """
    clicks = f"{root}/click_events" if store_clicks and not click_table else None
    sinks = jobs.EventSinks(
        archive=f"{root}/events",
        publish=publish,
        clicks=clicks,
        archive_table=archive_table,
        click_table=click_table,
    )
    checkpoint = f"{root}/checkpoints"
    return {
        "events": jobs.event_job(read(input_topic), sinks, f"{checkpoint}/events"),
        "attributed": jobs.attributed_job(
            read(attributed_topic),
            f"{root}/attributed_events",
            f"{checkpoint}/attributed",
            archive_table=attributed_table,
        ),
        "exposure": jobs.exposure_job(
            read(exposure_topic), f"{root}/exposure_events", f"{checkpoint}/exposure"
        ),
    }


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--servers", required=True, help="Kafka bootstrap servers")
    parser.add_argument("--root", required=True, help="folder of tables and checkpoints")
    parser.add_argument("--input-topic", default=INPUT_TOPIC)
    parser.add_argument("--output-topic", default=OUTPUT_TOPIC)
    parser.add_argument("--attributed-topic", default=ATTRIBUTED_TOPIC)
    parser.add_argument("--exposure-topic", default=EXPOSURE_TOPIC)
    parser.add_argument("--store-clicks", action="store_true", help="keep the click store")
    parser.add_argument("--archive-table", help="table with MERGE for the event archive")
    parser.add_argument("--attributed-table", help="table with MERGE for attributed events")
    parser.add_argument("--click-table", help="catalog table for the click store")
    parser.add_argument("--max-records", type=int, help="records per micro-batch and topic")
    parser.add_argument(
        "--kafka-option", action="append", default=[], metavar="NAME=VALUE",
        help="client option, such as kafka.security.protocol=SASL_SSL",
    )
    args = parser.parse_args(argv)
    options = dict(option.split("=", 1) for option in args.kafka_option)
    spark = build_session("touchline")

    def read(topic: str) -> DataFrame:
        return kafka_stream(spark, args.servers, topic, max_records=args.max_records, **options)

    def publish(log: DataFrame, batch_id: int) -> None:
        write_kafka(log, args.servers, args.output_topic, **options)

    started = topic_jobs(
        read,
        publish,
        args.root,
        args.input_topic,
        args.attributed_topic,
        args.exposure_topic,
        args.store_clicks,
        args.archive_table,
        args.attributed_table,
        args.click_table,
    )
    spark.streams.addListener(ProgressListener(spark, f"{args.root}/progress"))
    for name, job in started.items():
        job.queryName(name).start()
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
