"""Topic records from Kafka or from files that hold an exported topic.

All yield ``value`` text and, where known, ``partition``, ``offset`` and the time at
which the topic took the record, ready for :func:`touchline.operators.decode.decode`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from touchline import schemas



def _records(rows: DataFrame) -> DataFrame:
    taken = F.col("timestamp").alias(schemas.RECORD_TIME)
    return rows.select(F.col("value").cast("string").alias("value"), "partition", "offset", taken)


def kafka_options(
    servers: str,
    topic: str,
    starting: str = "latest",
    max_records: int | None = None,
    **options: str,
) -> dict[str, str]:
    """Options of a Kafka scan.

    ``max_records`` limits a whole micro-batch, not a single poll.  Security
    and client settings go through ``options`` with their ``kafka.`` prefix.
    """
    chosen = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        **options,
    }
    if max_records is not None:
        chosen["maxOffsetsPerTrigger"] = str(max_records)
    return chosen


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """The live topic; needs the Kafka connector on the classpath."""
    chosen = kafka_options(servers, topic, **options)
    return _records(spark.readStream.format("kafka").options(**chosen).load())


def kafka_backfill(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """The retained topic as a batch."""
    chosen = kafka_options(servers, topic, starting="earliest", **options)
    return _records(spark.read.format("kafka").options(**chosen).load())


def exported_stream(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    fmt: str = "parquet",
    schema: T.StructType = schemas.TOPIC_RECORDS,
) -> DataFrame:
    """Files of an exported topic, arriving as a stream.

    Give ``schemas.TIMED_RECORDS`` where the export has the time of each record.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def exported(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType = schemas.TOPIC_RECORDS,
) -> DataFrame:
    """Files of an exported topic as a batch."""
    return spark.read.schema(schema).format(fmt).load(path)


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files with one record per line; there is no source position."""
    return spark.read.text(path)
