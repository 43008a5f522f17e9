"""Wire formats for task events (both directions), as column
expressions -- no Python per row.

JSON (S8): one object per event with the record's field names; the event
type travels by name.  Text (S9): comma separated, job id first; the last
field (missing info) is written only when non-empty.  Decoding the text
form knows all nine type names (not just SUBMIT and FINISH).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import TASK_COLUMNS, event_type_code, event_type_name

# JSON field name for each task column, in record order.
JSON_FIELDS = {
    "job_id": "jobId",
    "task_index": "taskIndex",
    "timestamp": "timestamp",
    "machine_id": "machineId",
    "event_type": "eventType",
    "username": "username",
    "scheduling_class": "schedulingClass",
    "priority": "priority",
    "max_cpu": "maxCPU",
    "max_ram": "maxRAM",
    "max_disk": "maxDisk",
    "different_machine": "differentMachine",
    "missing_info": "missingInfo",
}

JSON_SCHEMA = T.StructType([
    T.StructField("jobId", T.LongType()),
    T.StructField("taskIndex", T.IntegerType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("machineId", T.LongType()),
    T.StructField("eventType", T.StringType()),
    T.StructField("username", T.StringType()),
    T.StructField("schedulingClass", T.IntegerType()),
    T.StructField("priority", T.IntegerType()),
    T.StructField("maxCPU", T.DoubleType()),
    T.StructField("maxRAM", T.DoubleType()),
    T.StructField("maxDisk", T.DoubleType()),
    T.StructField("differentMachine", T.BooleanType()),
    T.StructField("missingInfo", T.StringType()),
])

# Text field order.
TEXT_ORDER = ["job_id", "task_index", "timestamp", "machine_id", "event_type", "username",
              "scheduling_class", "priority", "max_cpu", "max_ram", "max_disk",
              "different_machine", "missing_info"]


def to_json_value(df: DataFrame) -> Column:
    """Task columns -> JSON string."""
    fields = []
    for c, name in JSON_FIELDS.items():
        v = event_type_name(c) if c == "event_type" else F.col(c)
        fields.append(v.alias(name))
    return F.to_json(F.struct(*fields))


def parse_json(value: Column | str) -> Column:
    """JSON string -> one struct of the record's fields (parse once, then
    pick fields with ``json_fields``; picking fields straight off
    ``from_json`` makes Spark parse the text once per field)."""
    value = F.col(value) if isinstance(value, str) else value
    return F.from_json(value.cast("string"), JSON_SCHEMA)


def json_fields(parsed: Column | str) -> list[Column]:
    """Struct from ``parse_json`` -> task columns (in ``TASK_COLUMNS`` order)."""
    s = F.col(parsed) if isinstance(parsed, str) else parsed
    by_col = {c: s.getField(name) for c, name in JSON_FIELDS.items()}
    by_col["event_type"] = event_type_code(by_col["event_type"])
    by_col["machine_id"] = F.coalesce(by_col["machine_id"], F.lit(-1).cast("long"))
    for c in ("max_cpu", "max_ram", "max_disk"):
        by_col[c] = F.coalesce(by_col[c], F.lit(0.0))
    by_col["different_machine"] = F.coalesce(by_col["different_machine"], F.lit(False))
    return [by_col[c].alias(c) for c in TASK_COLUMNS]


def to_text_value(df: DataFrame) -> Column:
    """Task columns -> comma separated line (missing info only when set)."""
    parts = []
    for c in TEXT_ORDER:
        if c == "event_type":
            parts.append(event_type_name(c))
        elif c == "missing_info":
            parts.append(F.when(F.col(c) != "", F.col(c)))  # NULL is skipped
        else:
            parts.append(F.col(c).cast("string"))
    return F.concat_ws(",", *parts)


def from_text_value(value: Column | str) -> list[Column]:
    """Comma separated line -> task columns; a field that is no number of its
    type is NULL."""
    value = F.col(value) if isinstance(value, str) else value
    tok = F.split(value.cast("string"), ",", -1)

    def at(i: int) -> Column:
        return F.get(tok, i)

    by_col = {
        "job_id": at(0).try_cast("long"),
        "task_index": at(1).try_cast("int"),
        "timestamp": at(2).try_cast("long"),
        "machine_id": at(3).try_cast("long"),
        "event_type": event_type_code(at(4)),
        "username": at(5),
        "scheduling_class": at(6).try_cast("int"),
        "priority": at(7).try_cast("int"),
        "max_cpu": at(8).try_cast("double"),
        "max_ram": at(9).try_cast("double"),
        "max_disk": at(10).try_cast("double"),
        "different_machine": F.lower(F.trim(at(11))) == "true",
        "missing_info": F.coalesce(at(12), F.lit("")),
    }
    return [by_col[c].alias(c) for c in TASK_COLUMNS]


def text_token_count(value: Column | str) -> Column:
    """Fields of a line, without empty ones at its end."""
    value = F.col(value) if isinstance(value, str) else value
    return F.size(F.split(F.regexp_replace(value.cast("string"), ",+$", ""), ",", -1))


def encode(df: DataFrame, fmt: str = "json", key: str | None = "job_id") -> DataFrame:
    """Rows of task events -> (key, value) strings, the shape a Kafka sink takes."""
    value = to_json_value(df) if fmt == "json" else to_text_value(df)
    cols = [value.alias("value")]
    if key:
        cols.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*cols)


#: Fields that a record must hold (JSON has defaults for the others).
REQUIRED = {"json": ("job_id", "task_index", "timestamp", "event_type", "scheduling_class", "priority")}
REQUIRED["text"] = (*REQUIRED["json"], "machine_id", "max_cpu", "max_ram", "max_disk")
TEXT_FIELDS = 12


def decode(df: DataFrame, fmt: str = "json", value: str = "value",
           keep: tuple[str, ...] = (), mode: str = "FAILFAST") -> DataFrame:
    """(value) strings -> task events; ``keep`` columns are passed through.

    A value is bad if it is null, no JSON object, has fewer than 12 text
    fields, or if a required field is missing or no number or event name.
    ``mode`` as in the file readers: FAILFAST ends the job, DROPMALFORMED leaves
    bad values out, PERMISSIVE keeps them with ``_corrupt_record``, the value
    (empty for a null one)."""
    from ..sources.trace_files import apply_mode

    raw = F.col(value).cast("string").alias("_raw")
    if fmt == "json":
        parsed = df.select(*keep, raw, parse_json(value).alias("_rec"))
        rows = parsed.select(*keep, *json_fields("_rec"), "_raw")
        bad = F.lit(False)
    else:
        rows = df.select(*keep, *from_text_value(value), raw, text_token_count(value).alias("_n"))
        bad = F.col("_n").isNull() | (F.col("_n") < TEXT_FIELDS)
    for c in REQUIRED[fmt]:
        bad = bad | F.col(c).isNull()
    corrupt = F.when(bad, F.coalesce("_raw", F.lit(""))).alias("_corrupt_record")
    return apply_mode(rows.select(*keep, *TASK_COLUMNS, corrupt), mode)
