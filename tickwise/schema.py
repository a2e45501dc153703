"""Column names and fixed schemas shared by every operator.

Time is a BIGINT of epoch nanoseconds: Spark's TIMESTAMP keeps microseconds, which would lose the 8,333,333 ns spacing
of a 120 Hz sensor.  ``seq`` is the row's place in its source and breaks ties wherever "first" or "row order" matters.
"""

from pyspark.sql import types as T

TS = "ts_ns"
SEQ = "seq"
GAP = "gap_ms"
FILLED = "was_filled"
STATUS = "status"
CELL = "cell"

# Nominal spacing of a 120 Hz channel, and the longest run of cells a value may be carried forward.
SAMPLE_INTERVAL_NS = 8_333_333
FILL_LIMIT = 3

CHANNEL_FILE = T.StructType([T.StructField(TS, T.LongType()), T.StructField("value", T.DoubleType())])

LABELS = T.StructType([
    T.StructField("start_ns", T.LongType()),
    T.StructField("end_ns", T.LongType()),
    T.StructField("fault_type", T.StringType()),
    T.StructField("ord", T.IntegerType()),
])


def feature_names(target: str, status: str | None = None) -> list[str]:
    """The model's input columns, in order. The rolling mean and the filled marker are deliberately not among them."""
    names = [target, f"{target}_delta", f"{target}_rolling_std", f"{target}_dev_from_mean", GAP]
    return names + [status] if status else names
