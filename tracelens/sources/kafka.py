"""Kafka topics of task events.

Thin wiring of Spark's own Kafka source and sink to the wire formats of
``tracelens.functions.codec``.  The Kafka connector is a separate Spark
package; when it is not on the classpath these functions raise a clear
error (the codecs themselves work everywhere and are tested with files).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codec
from ..operators.filters import keep_types
from ..schema import EVENT_TIME, FINISH, SUBMIT

# Topic names used by the trace jobs.
FILTERED_TOPIC = "filteredTasks"
ALL_TASKS_TOPIC = "ft"


class KafkaUnavailable(RuntimeError):
    pass


def _check(err: Exception):
    msg = str(err)
    if "kafka" in msg.lower() and ("find data source" in msg.lower() or "not found" in msg.lower()):
        raise KafkaUnavailable(
            "the Spark Kafka connector (spark-sql-kafka) is not on the classpath") from err
    raise err


def read_task_topic(spark: SparkSession, servers: str, topic: str, fmt: str = "json",
                    group_id: str | None = None, starting_offsets: str = "earliest",
                    stream: bool = True) -> DataFrame:
    """Task events from a topic, from the earliest offset by default."""
    r = spark.readStream if stream else spark.read
    r = (r.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    if group_id:
        r = r.option("kafka.group.id", group_id)
    try:
        raw = r.load()
    except Exception as e:  # noqa: BLE001
        _check(e)
    df = codec.decode(raw, fmt, keep=("partition", "offset"), mode="FAILFAST")
    # the tie break: unique over partitions, in offset order inside one
    seq = F.shiftleft(F.col("partition").cast("long"), 48).bitwiseOR(F.col("offset"))
    df = df.withColumn("event_seq", seq).drop("partition", "offset")
    return df.withColumn(EVENT_TIME, F.timestamp_micros("timestamp"))


def write_task_topic(df: DataFrame, servers: str, topic: str, fmt: str = "json",
                     checkpoint: str | None = None):
    """Write task events to a topic (batch or stream)."""
    out = codec.encode(df, fmt)
    try:
        if df.isStreaming:
            w = (out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
                 .option("topic", topic))
            if checkpoint:
                w = w.option("checkpointLocation", checkpoint)
            return w.start()
        (out.write.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("topic", topic).save())
        return None
    except Exception as e:  # noqa: BLE001
        _check(e)


def export_filtered_tasks(df: DataFrame, servers: str, topic: str = FILTERED_TOPIC,
                          types=(SUBMIT, FINISH), fmt: str = "json", checkpoint: str | None = None):
    """J4 export: SUBMIT / FINISH task events to the filtered topic."""
    return write_task_topic(keep_types(df, *types), servers, topic, fmt, checkpoint)


def export_task_events(df: DataFrame, servers: str, topic: str = ALL_TASKS_TOPIC,
                       fmt: str = "json", checkpoint: str | None = None):
    """Every task event to the topic."""
    return write_task_topic(df, servers, topic, fmt, checkpoint)
