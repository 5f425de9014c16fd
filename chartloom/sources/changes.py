"""Change topics: JSON envelopes from Kafka or from a folder of text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.schemas import change_envelope
from chartloom.sources.keyed import POSITION

# Time first: topics and partitions have offsets of their own, which say nothing about each other.
POSITION_TYPE = T.StructType(
    [
        T.StructField("ts_ms", T.LongType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)
SOURCE = "__source"


def read_kafka_changes(
    spark: SparkSession, servers: str, topics: str, per_trigger: int | None = None, **options: str
) -> DataFrame:
    """Streaming envelopes of Kafka topics from the earliest offset on.

    Needs the Kafka connector of the Spark distribution on the class path.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .option("startingOffsets", "earliest")
        .options(**options)
    )
    if per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load().select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset")


def read_file_changes(spark: SparkSession, path: str, per_trigger: int | None = None) -> DataFrame:
    """Streaming envelopes, one per line, of the files that appear in a folder."""
    reader = spark.readStream.format("text")
    if per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.load(path).select("value")


def decode(df: DataFrame, after: T.StructType) -> DataFrame:
    """Envelope text to typed columns: source name, row after the change, position of the change.

    The position is the time of the event, then topic, partition and offset where they are known. It is null without a
    time. Text that is no JSON gives a row without an after-image.
    """
    event = F.from_json("value", change_envelope(after))
    time = F.col("__event.payload.ts_ms").cast("long")
    known = {f.name: F.col(f.name) if f.name in df.columns else F.lit(None) for f in POSITION_TYPE.fields[1:]}
    fields = [known[f.name].cast(f.dataType).alias(f.name) for f in POSITION_TYPE.fields[1:]]
    position = F.when(time.isNotNull(), F.struct(time.alias("ts_ms"), *fields))
    return df.withColumn("__event", event).select(
        F.col("__event.schema.name").alias(SOURCE),
        F.col("__event.payload.after").alias("after"),
        F.col("__event.payload.op").alias("op"),
        position.alias(POSITION),
    )


def typed_rows(df: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """JSON rows to columns of a declared schema."""
    return df.select(F.from_json(column, schema).alias("__row")).select("__row.*")
