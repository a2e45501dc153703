"""Ordered work on keyed series that never puts one long series into one task.

Most series are short, and ``Window.partitionBy(series)`` is the right plan for them.  A series with more than
``chunk_rows`` rows is *hot*: its rows get a position through a range shuffle, are cut into chunks of equal row count,
and every chunk also receives the last ``halo`` rows of the chunk before it, so that any frame reaching back at most
``halo`` rows sees exactly what it would have seen in the whole series.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickwise.functions.columns import floor_div
from tickwise.schema import SEQ, TS
from tickwise.session import is_small, settle

CHUNK_ROWS = 1_000_000
PERCENTILE_BINS = 65_536
ORDER = (TS, SEQ)


def hot_series(df: DataFrame, keys: Sequence[str], chunk_rows: int | None = None) -> DataFrame | None:
    """Keys of the series too long for one task, or None. There are at most rows / chunk_rows of them."""
    limit = chunk_rows or CHUNK_ROWS
    long_ones = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit).drop("_n")
    return None if long_ones.isEmpty() else settle(long_ones)


def split_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(short series, long series)."""
    marks = F.broadcast(hot) if is_small(hot) else hot
    return df.join(marks, list(keys), "left_anti"), df.join(marks, list(keys), "left_semi")


def attach(df: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join a settled one-row-per-key table: by broadcast when it is small, otherwise by shuffle."""
    side = F.broadcast(per_key) if is_small(per_key) else per_key
    return df.join(side, list(keys), how)


def add_positions(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER) -> DataFrame:
    """Add ``_pos``, the 0-based place of each row in its series, without gathering any series.

    Range partitioning on (keys, order) balances rows however they are spread over keys and times.  The sorted blocks
    are settled first, because block numbers are only meaningful for one concrete partitioning.
    """
    keys = list(keys)
    blocks = settle(
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_block", F.shiftright("_mid", 33))
    )
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        blocks.groupBy(*keys, "_block")
        .agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .select(*keys, "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    return (
        blocks.join(starts, [*keys, "_block"])
        .withColumn("_pos", F.col("_before") + F.col("_mid") - F.col("_first"))
        .drop("_block", "_mid", "_first", "_before")
    )


def with_halo(df: DataFrame, position: str, halo: int, chunk_rows: int) -> DataFrame:
    """Add ``_chunk``, copying the last ``halo`` rows of every chunk into the next one as well."""
    if halo > chunk_rows:
        raise ValueError("a halo must not be longer than a chunk")
    own = floor_div(F.col(position), chunk_rows)
    if halo == 0:
        return df.withColumn("_chunk", own)
    shared = F.col(position) % F.lit(chunk_rows) >= F.lit(chunk_rows - halo)
    return df.withColumn("_chunk", F.explode(F.when(shared, F.array(own, own + 1)).otherwise(F.array(own))))


def own_rows(df: DataFrame, position: str, chunk_rows: int) -> DataFrame:
    """Drop the copies made by ``with_halo``."""
    return df.where(F.col("_chunk") == floor_div(F.col(position), chunk_rows))


def over_series(
    df: DataFrame,
    keys: Sequence[str],
    step: Callable[[DataFrame, WindowSpec], DataFrame],
    *,
    halo: int,
    order: Sequence[str] = ORDER,
    hot: DataFrame | None | str = "check",
    chunk_rows: int | None = None,
) -> DataFrame:
    """Apply ``step(df, window)``, where ``window`` runs along each series and no frame reaches back over ``halo`` rows."""
    keys, order, size = list(keys), list(order), chunk_rows or CHUNK_ROWS
    if isinstance(hot, str):
        hot = hot_series(df, keys, size)
    if hot is None:
        return step(df, Window.partitionBy(*keys).orderBy(*order))
    short, long = split_hot(df, keys, hot)
    pieces = with_halo(add_positions(long, keys, order), "_pos", halo, size)
    done = own_rows(step(pieces, Window.partitionBy(*keys, "_chunk").orderBy("_pos")), "_pos", size)
    return step(short, Window.partitionBy(*keys).orderBy(*order)).unionByName(done.drop("_pos", "_chunk"))


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    name: str = "row",
    *,
    order: Sequence[str] = ORDER,
    hot: DataFrame | None | str = "check",
    chunk_rows: int | None = None,
) -> DataFrame:
    """0-based row number along each series."""
    keys = list(keys)
    if isinstance(hot, str):
        hot = hot_series(df, keys, chunk_rows)

    def short_numbers(d: DataFrame) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return d.withColumn(name, rank.cast("long") - 1)

    if hot is None:
        return short_numbers(df)
    short, long = split_hot(df, keys, hot)
    return short_numbers(short).unionByName(add_positions(long, keys, order).withColumnRenamed("_pos", name))


def running(
    df: DataFrame,
    keys: Sequence[str],
    sums: dict[str, Column] | None = None,
    lasts: dict[str, Column] | None = None,
    *,
    order: Sequence[str] = ORDER,
    hot: DataFrame | None | str = "check",
    chunk_rows: int | None = None,
) -> DataFrame:
    """Running sums and last-seen values from the start of each series, in two levels for a hot series.

    ``sums`` and ``lasts`` map a new column to the expression to accumulate.  In a hot series each chunk is reduced to
    one summary row, the summaries are accumulated, and every row adds what came before its own chunk.
    """
    keys, size = list(keys), chunk_rows or CHUNK_ROWS
    sums, lasts = sums or {}, lasts or {}
    if isinstance(hot, str):
        hot = hot_series(df, keys, size)

    def accumulate(d: DataFrame, w: WindowSpec) -> DataFrame:
        upto = w.rowsBetween(Window.unboundedPreceding, 0)
        for name, value in sums.items():
            d = d.withColumn(name, F.coalesce(F.sum(value).over(upto), F.lit(0)))
        for name, value in lasts.items():
            d = d.withColumn(name, F.last(value, ignorenulls=True).over(upto))
        return d

    plain = Window.partitionBy(*keys).orderBy(*order)
    if hot is None:
        return accumulate(df, plain)
    short, long = split_hot(df, keys, hot)
    pieces = with_halo(add_positions(long, keys, order), "_pos", 0, size)
    summary = pieces.groupBy(*keys, "_chunk").agg(
        *[F.sum(v).alias(f"_{n}_part") for n, v in sums.items()],
        *[F.max_by(v, F.when(v.isNotNull(), F.col("_pos"))).alias(f"_{n}_part") for n, v in lasts.items()],
    )
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(
        *keys,
        "_chunk",
        *[F.coalesce(F.sum(f"_{n}_part").over(earlier), F.lit(0)).alias(f"_{n}_carry") for n in sums],
        *[F.last(f"_{n}_part", ignorenulls=True).over(earlier).alias(f"_{n}_carry") for n in lasts],
    )
    done = accumulate(pieces, Window.partitionBy(*keys, "_chunk").orderBy("_pos")).join(carried, [*keys, "_chunk"])
    for name in sums:
        done = done.withColumn(name, F.col(name) + F.col(f"_{name}_carry")).drop(f"_{name}_carry")
    for name in lasts:
        done = done.withColumn(name, F.coalesce(F.col(name), F.col(f"_{name}_carry"))).drop(f"_{name}_carry")
    return accumulate(short, plain).unionByName(done.drop("_pos", "_chunk"))


def _between(low: Column, high: Column, share: Column) -> Column:
    """Linear interpolation, also where the distance of two doubles is beyond any double."""
    apart = high - low
    return F.when(F.abs(apart) == float("inf"), low * (1 - share) + high * share).otherwise(low + apart * share)


def percentile_per_key(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    share: float,
    name: str,
    *,
    hot: DataFrame | None | str = "check",
    chunk_rows: int | None = None,
) -> DataFrame:
    """Exact percentile with linear interpolation, one row per key; NULL values do not count.

    Short series are sorted, each in one task, and the two values around the wanted rank are picked.  For a hot key the
    equal values are counted first (measured gaps have few different ones), then bins of values, and the bin that
    holds the wanted ranks is divided again until it is one value, however uneven the values are.
    """
    keys = list(keys)
    if isinstance(hot, str):
        hot = hot_series(df, keys, chunk_rows)
    present = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))

    def direct(d: DataFrame) -> DataFrame:
        along, whole = Window.partitionBy(*keys).orderBy("_v"), Window.partitionBy(*keys)
        ranked = d.withColumn("_i", F.row_number().over(along) - 1).withColumn(
            "_rank", (F.count(F.lit(1)).over(whole) - 1) * F.lit(share))
        around = ranked.where(F.col("_i").isin(F.floor("_rank"), F.ceil("_rank")))
        low, high, rest = F.min("_v"), F.max("_v"), F.max(F.col("_rank") - F.floor("_rank"))
        return around.groupBy(*keys).agg(_between(low, high, rest).alias(name))

    if hot is None:
        return direct(present)
    # One pass over the input; the short and the long series are told apart in the counted values.
    counts = settle(present.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")))
    short, values = split_hot(counts, keys, hot)
    whole = Window.partitionBy(*keys)
    total = short.withColumn("_rank", (F.sum("_c").over(whole) - 1) * F.lit(share))
    total = total.withColumn("_low", F.floor("_rank")).withColumn("_high", F.ceil("_rank")).withColumn(
        "_upto", F.sum("_c").over(whole.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)))
    def at(target: str) -> Column:
        hit = (F.col("_upto") > F.col(target)) & (F.col("_upto") - F.col("_c") <= F.col(target))
        return F.max(F.when(hit, F.col("_v")))

    def between(d: DataFrame) -> DataFrame:
        low, high, rest = at("_low"), at("_high"), F.max(F.col("_rank") - F.col("_low"))
        return d.groupBy(*keys).agg(_between(low, high, rest).alias(name))

    return between(total).unionByName(_narrowed(values, keys, share, name))


def _narrowed(values: DataFrame, keys: Sequence[str], share: float, name: str) -> DataFrame:
    """The percentile of hot keys from counted values (``_v``, ``_c``), without ever bringing a bin's values together.

    Bins of equal width are counted with their least and largest value. If the two wanted ranks fall into two bins, these
    values are the answer; if into one, that bin is divided again, until it holds a single value.
    """
    keys = list(keys)
    rank = (F.col("_n") - 1) * F.lit(share)
    state = values.groupBy(*keys).agg(F.sum("_c").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    state = settle(state.select(*keys, "_lo", "_hi", F.lit(0).cast("long").alias("_skip"), rank.alias("_rank")))
    found = None
    while found is None or not state.isEmpty():
        inside = attach(values, state, keys).where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
        # Halved where the distance of the two ends is beyond any double.
        unit = F.when(F.col("_hi") - F.col("_lo") == float("inf"), F.lit(0.5)).otherwise(F.lit(1.0))
        low_end, high_end = F.col("_lo") * unit, F.col("_hi") * unit
        scaled = F.floor((F.col("_v") * unit - low_end) / (high_end - low_end) * PERCENTILE_BINS)
        slot = F.when(F.col("_hi") > F.col("_lo"), F.least(scaled, F.lit(PERCENTILE_BINS - 1))).otherwise(F.lit(0))
        along = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
        bins = inside.withColumn("_slot", slot).groupBy(*keys, "_slot", "_skip", "_rank").agg(
            F.sum("_c").alias("_c"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
        bins = bins.withColumn("_upto", F.col("_skip") + F.sum("_c").over(along))

        def at(target: Column, what: Column) -> Column:
            return F.max(F.when((F.col("_upto") > target) & (F.col("_upto") - F.col("_c") <= target), what))

        low, high = F.floor("_rank"), F.ceil("_rank")
        turn = settle(bins.groupBy(*keys, "_rank").agg(
            at(low, F.col("_slot")).alias("_a"), at(high, F.col("_slot")).alias("_b"), at(low, F.col("_min")).alias("_lo"),
            at(low, F.col("_max")).alias("_hi"), at(high, F.col("_min")).alias("_next"),
            at(low, F.col("_upto") - F.col("_c")).alias("_skip")))
        apart, single = F.col("_a") != F.col("_b"), F.col("_lo") == F.col("_hi")
        upper = F.when(apart, F.col("_next")).otherwise(F.col("_hi"))
        answer = _between(F.col("_hi"), upper, F.col("_rank") - low)
        ready = turn.where(apart | single).select(*keys, answer.alias(name))
        found = ready if found is None else found.unionByName(ready)
        state = turn.where(~(apart | single)).select(*keys, "_lo", "_hi", "_skip", "_rank")
    return found
