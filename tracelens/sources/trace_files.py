"""Task and job events from the trace's comma-separated files
(usually gzipped, one file per part, read as text).

Files are tokenized once by Spark's CSV scan with every field a string and
quoting off (a plain comma split), then validated and converted by column
expressions: no schema inference and no Python per row.  Token counting
follows the record format: trailing empty fields are not counted.  Task
rows need at least 9 tokens (missing limits give 0.0, a missing flag false,
an empty machine id -1; fields after the 13th are ignored); job rows need
exactly 8.  An unknown event code gives a NULL type.  ``parse_*_lines`` do
the same for a string column (e.g. a Kafka value).

Modes: ``PERMISSIVE`` keeps every row and adds ``_corrupt_record`` (the raw
line for bad rows, NULL for good ones); ``DROPMALFORMED`` drops bad rows;
``FAILFAST`` raises on the first bad row.

``event_seq`` (the tie break for equal timestamps) is
``monotonically_increasing_id()`` for batch reads: it follows line order
within a file and file order within a partition.  Gzip files are not
splittable, so every file is read by one task in order and re-execution
reproduces the ids.  Streams use a hash of the record instead (ids must not
restart with every micro-batch).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import EVENT_TIME, JOB_COLUMNS, TASK_COLUMNS, ensure_seq

MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")


def _tokens(value: Column) -> Column:
    # trailing empty fields do not count
    return F.split(F.regexp_replace(value, ",+$", ""), ",", -1)


def _try(tok: Column, typ: str) -> Column:
    return tok.try_cast(typ)


def _blank(tok: Column) -> Column:
    return tok.isNull() | (tok == "")


TASK_WIDTH, JOB_WIDTH = 13, 8


def _field_count(fields: list[Column]) -> Column:
    """Number of fields up to the last non-empty one (trailing empty fields
    do not count)."""
    return F.coalesce(F.greatest(*[F.when(~_blank(f), F.lit(i + 1)) for i, f in enumerate(fields)]),
                      F.lit(0))


def _task_columns(fields: list[Column], n: Column, raw: Column) -> list[Column]:
    """Fields 0..12 (strings, missing ones NULL) and the field count ->
    typed task columns and ``_corrupt_record`` (``raw`` for bad rows)."""
    def at(i):
        return fields[i]

    machine = F.when(_blank(at(4)), F.lit(-1).cast("long")).otherwise(_try(at(4), "long"))
    code = _try(at(5), "int")
    cols = {
        "timestamp": _try(at(0), "long"),
        "missing_info": F.coalesce(at(1), F.lit("")),
        "job_id": _try(at(2), "long"),
        "task_index": _try(at(3), "int"),
        "machine_id": machine,
        "event_type": F.when(code.between(0, 8), code),
        "username": F.coalesce(at(6), F.lit("")),
        "scheduling_class": _try(at(7), "int"),
        "priority": _try(at(8), "int"),
        "max_cpu": F.when(n > 9, _try(at(9), "double")).otherwise(F.lit(0.0)),
        "max_ram": F.when(n > 10, _try(at(10), "double")).otherwise(F.lit(0.0)),
        "max_disk": F.when(n > 11, _try(at(11), "double")).otherwise(F.lit(0.0)),
        "different_machine": F.when(n > 12, _try(at(12), "int") > 0).otherwise(F.lit(False)),
    }
    required = ["timestamp", "job_id", "task_index", "machine_id", "scheduling_class", "priority"]
    bad = (n < 9) | code.isNull()
    for c in required:
        bad = bad | cols[c].isNull()
    for i, c in ((9, "max_cpu"), (10, "max_ram"), (11, "max_disk"), (12, "different_machine")):
        bad = bad | ((n > i) & cols[c].isNull())
    return [cols[c].alias(c) for c in TASK_COLUMNS] + [F.when(bad, raw).alias("_corrupt_record")]


def _job_columns(fields: list[Column], n: Column, raw: Column) -> list[Column]:
    def at(i):
        return fields[i]

    code = _try(at(3), "int")
    cols = {
        "timestamp": _try(at(0), "long"),
        "missing_info": F.coalesce(at(1), F.lit("")),
        "job_id": _try(at(2), "long"),
        "event_type": F.when(code.between(0, 8), code),
        "username": F.coalesce(at(4), F.lit("")),
        "scheduling_class": _try(at(5), "int"),
        "job_name": F.coalesce(at(6), F.lit("")),
        "logical_job_name": F.coalesce(at(7), F.lit("")),
    }
    bad = (n != 8) | code.isNull()
    for c in ("timestamp", "job_id", "scheduling_class"):
        bad = bad | cols[c].isNull()
    return [cols[c].alias(c) for c in JOB_COLUMNS] + [F.when(bad, raw).alias("_corrupt_record")]


def parse_task_lines(lines: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Text lines (a string column, e.g. a Kafka value) -> ``keep`` columns, task columns +
    ``_corrupt_record``.  Files are better read with ``read_task_events``,
    which lets the CSV scan tokenize each line once."""
    tok = _tokens(F.col(value))
    fields = [F.get(tok, i) for i in range(TASK_WIDTH)]
    return lines.select(*keep, *_task_columns(fields, F.size(tok), F.col(value)))


def parse_job_lines(lines: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Text lines -> ``keep`` columns, job columns + ``_corrupt_record``."""
    tok = _tokens(F.col(value))
    fields = [F.get(tok, i) for i in range(JOB_WIDTH + 1)]
    return lines.select(*keep, *_job_columns(fields, F.size(tok), F.col(value)))


def _csv(reader, path: str, width: int) -> DataFrame:
    # every field a string; no quoting (the trace has none, and a plain
    # comma split is the record format); empty fields read as NULL
    schema = ", ".join(f"_c{i} string" for i in range(width))
    return (reader.schema(schema).option("sep", ",").option("quote", "\u0000")
            .option("mode", "PERMISSIVE").option("enforceSchema", "true").csv(path))


def _parse_fields(df: DataFrame, width: int, columns) -> DataFrame:
    fields = [F.col(f"_c{i}") for i in range(width)]
    raw = F.concat_ws(",", *[F.coalesce(f, F.lit("")) for f in fields])
    return df.select(*columns(fields, _field_count(fields), raw))


def parse_task_files(spark: SparkSession, path: str, stream: bool = False,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Task-event files -> task columns + ``_corrupt_record``.  Rows with 9
    to 13 fields are legal; fields after the 13th are ignored (as the record
    format does).  ``_corrupt_record`` echoes the fields of a bad row."""
    r = spark.readStream if stream else spark.read
    if stream and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return _parse_fields(_csv(r, path, TASK_WIDTH), TASK_WIDTH, _task_columns)


def parse_job_files(spark: SparkSession, path: str, stream: bool = False,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Job-event files -> job columns + ``_corrupt_record`` (exactly 8 fields)."""
    r = spark.readStream if stream else spark.read
    if stream and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return _parse_fields(_csv(r, path, JOB_WIDTH + 1), JOB_WIDTH + 1, _job_columns)


def apply_mode(parsed: DataFrame, mode: str) -> DataFrame:
    mode = mode.upper()
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    bad = F.col("_corrupt_record").isNotNull()
    if mode == "PERMISSIVE":
        return parsed
    if mode == "DROPMALFORMED":
        return parsed.where(~bad).drop("_corrupt_record")
    checked = parsed.where(
        F.when(bad, F.raise_error(F.concat(F.lit("Invalid event record: "),
                                           F.col("_corrupt_record")))).otherwise(F.lit(True)))
    return checked.drop("_corrupt_record")


def _finish(df: DataFrame, with_time: bool) -> DataFrame:
    df = df.withColumn("event_seq", F.monotonically_increasing_id())
    if with_time:
        df = df.withColumn(EVENT_TIME, F.timestamp_micros("timestamp"))
    return df


def read_task_events(spark: SparkSession, path: str, mode: str = "FAILFAST",
                     with_time: bool = True) -> DataFrame:
    """A directory (or glob) of task-event files, gzipped or plain."""
    return _finish(apply_mode(parse_task_files(spark, path), mode), with_time)


def read_job_events(spark: SparkSession, path: str, mode: str = "FAILFAST",
                    with_time: bool = True) -> DataFrame:
    """A directory (or glob) of job-event files."""
    return _finish(apply_mode(parse_job_files(spark, path), mode), with_time)


def task_lines(tasks: DataFrame) -> DataFrame:
    """Task events -> trace lines (file field order; machine -1 written as an
    empty field, the flag as 0/1)."""
    def s(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    fields = [s("timestamp"), s("missing_info"), s("job_id"), s("task_index"),
              F.when(F.col("machine_id") == -1, F.lit("")).otherwise(s("machine_id")),
              s("event_type"), s("username"), s("scheduling_class"), s("priority"),
              s("max_cpu"), s("max_ram"), s("max_disk"),
              F.when(F.col("different_machine"), F.lit("1")).otherwise(F.lit("0"))]
    return tasks.select(F.concat_ws(",", *fields).alias("value"))


def write_task_events(tasks: DataFrame, path: str, compression: str = "gzip",
                      mode: str = "overwrite") -> None:
    """Write task events as trace files (one gzipped part per partition)."""
    task_lines(tasks).write.mode(mode).option("compression", compression).text(path)


def bad_records(parsed: DataFrame) -> DataFrame:
    """The rejected lines of a PERMISSIVE read."""
    return parsed.where(F.col("_corrupt_record").isNotNull()).select("_corrupt_record")


def split_rejects(parsed: DataFrame, path: str) -> tuple[DataFrame, DataFrame, dict]:
    """A dead-letter output: one scan of a PERMISSIVE read (files or wire
    values) writes good rows and rejects under ``path``, a new folder that the cluster
    shares.  Returns the good rows, the rejects (with ``_corrupt_record``
    and the columns that the read kept), and the numbers of both."""
    bad = F.col("_corrupt_record").isNotNull()
    seen = Observation()
    counted = parsed.observe(seen, F.count_if(~bad).alias("accepted"), F.count_if(bad).alias("rejected"))
    counted.withColumn("_rejected", bad).write.partitionBy("_rejected").parquet(path)
    both = parsed.sparkSession.read.schema(
        T.StructType([*parsed.schema.fields, T.StructField("_rejected", T.BooleanType())])).parquet(path)
    good = both.where("NOT _rejected").drop("_rejected", "_corrupt_record")
    return good, both.where("_rejected").drop("_rejected"), dict(seen.get)


def stream_task_events(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                       mode: str = "FAILFAST") -> DataFrame:
    """S1 as a stream: new files in ``path`` become micro-batches."""
    parsed = parse_task_files(spark, path, stream=True, max_files_per_trigger=max_files_per_trigger)
    df = ensure_seq(apply_mode(parsed, mode))
    return df.withColumn(EVENT_TIME, F.timestamp_micros("timestamp"))


def stream_job_events(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                      mode: str = "FAILFAST") -> DataFrame:
    parsed = parse_job_files(spark, path, stream=True, max_files_per_trigger=max_files_per_trigger)
    df = ensure_seq(apply_mode(parsed, mode))
    return df.withColumn(EVENT_TIME, F.timestamp_micros("timestamp"))
