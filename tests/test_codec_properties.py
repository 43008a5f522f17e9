"""Property tests: any task row survives encode -> decode (JSON and text)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from tracelens.functions import codec
from tracelens.schema import TASK_COLUMNS, TASK_SCHEMA

LONG = st.integers(min_value=-(2**62), max_value=2**62)
INT = st.integers(min_value=-(2**30), max_value=2**30)
DOUBLE = st.floats(allow_nan=False, allow_infinity=False, width=64)
# the text format is comma separated: free text must not contain commas
TEXT = st.text(alphabet=st.characters(blacklist_characters=",\n\r", blacklist_categories=("Cs",)),
               max_size=12)

ROW = st.tuples(LONG, TEXT, LONG, INT, LONG, st.integers(0, 8), TEXT, INT, INT, DOUBLE, DOUBLE,
                DOUBLE, st.booleans())

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def _df(spark, rows):
    schema = T.StructType(TASK_SCHEMA.fields)
    return spark.createDataFrame(rows, schema)


@SETTINGS
@given(rows=st.lists(ROW, min_size=1, max_size=40))
def test_json_roundtrip_property(spark, rows):
    df = _df(spark, rows)
    back = codec.decode(codec.encode(df, "json"), "json").collect()
    assert sorted(map(tuple, back)) == sorted(map(tuple, df.select(*TASK_COLUMNS).collect()))


@SETTINGS
@given(rows=st.lists(ROW, min_size=1, max_size=40))
def test_text_roundtrip_property(spark, rows):
    # the text form drops an empty missing_info field, which decodes as ""
    df = _df(spark, rows)
    back = codec.decode(codec.encode(df, "text"), "text").collect()
    assert sorted(map(tuple, back)) == sorted(map(tuple, df.select(*TASK_COLUMNS).collect()))
