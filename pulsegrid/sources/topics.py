"""The metrics topic as a streaming source and sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TopicConfig
from ..functions.documents import encode


def read_options(config: TopicConfig) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": config.bootstrap_servers,
        "subscribe": config.topic,
        "startingOffsets": config.starting_offsets,
        "groupIdPrefix": config.group_id,
    }
    if config.max_records_per_trigger:
        options["maxOffsetsPerTrigger"] = str(config.max_records_per_trigger)
    if config.min_partitions:
        options["minPartitions"] = str(config.min_partitions)
    return options


def write_options(config: TopicConfig) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": config.bootstrap_servers,
        "topic": config.topic,
        "kafka.compression.type": "gzip",
    }


def topic_stream(spark: SparkSession, config: TopicConfig) -> DataFrame:
    """Messages of the topic as ``value`` text. Needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .options(**read_options(config))
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def folder_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Messages from files of JSON lines, in place of a topic."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def as_messages(records: DataFrame) -> DataFrame:
    """One JSON text per record."""
    return records.select(encode("*").alias("value"))


def write_topic(records: DataFrame, config: TopicConfig, checkpoint: str):
    """Publish a stream of records, gzip-compressed."""
    return (
        as_messages(records)
        .writeStream.format("kafka")
        .options(**write_options(config))
        .option("checkpointLocation", checkpoint)
        .start()
    )


def write_folder(records: DataFrame, path: str) -> None:
    """Write a batch of records as gzip-compressed JSON lines."""
    as_messages(records).write.mode("append").option("compression", "gzip").text(path)
