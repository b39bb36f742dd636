"""Operators on keyed series: one value per key and order position.

Scale notes
-----------
* Every operator needs its rows clustered by the key and sorted by the order
  column, so operators chained on one key share a single exchange.
* Rolling sums are differences of running sums. A running frame is O(1) per
  row, whereas Spark evaluates a sliding frame anew for each row (200 additions
  per row for a 200-row mean). Values are fixed-point integers while summed, so
  the differences are exact.
* A DATE order column bounds a key at one row per calendar day. For finer order
  columns, where one key may hold much of the table, operators work on pieces
  of keys (``piecewise``); each knows how many rows it looks back or ahead.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = ("stock_id",)
ORDER = "date"

# Weights fall to 2**-EMA_BITS, past double precision, over a block of an exponential mean.
EMA_BITS = 60

# Rows one task takes of a key whose order column sets no bound.
PIECE_ROWS = 50_000

# Bytes of input files that one task takes of series dealt out by key; compressed rows have about ten bytes or more.
DEALT_BYTES = 4 << 20


def series_window(by: Sequence[str] = KEY, order: str = ORDER) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(order)


def running(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def dealt(df: DataFrame, by: Sequence[str] = KEY) -> DataFrame:
    """``df`` dealt out by key to as many tasks as the size of the files behind it asks for.

    Windows over the key use this exchange instead of their own. Partitions that
    adaptive execution joins grow to its target size in compressed bytes, many times
    that in sorts; these hold about the same number of rows whatever the table's
    size. Leave tables alone that are stored by key, and small ones stay as they are.
    """
    spark = df.sparkSession
    make, hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
    paths = [make(make(f).getParent(), make(f).getName()) for f in df.inputFiles()]
    size = sum(p.getFileSystem(hadoop).getFileStatus(p).getLen() for p in paths)
    tasks = size // DEALT_BYTES + 1
    return df.repartition(tasks, *by) if tasks > spark.sparkContext.defaultParallelism else df


class Unit:
    """How the values of a column are summed without loss.

    Decimals of up to twelve digits become integers in units of their last
    place (bigint sums hold nine million of the largest), longer decimals stay
    decimals, integers integers; doubles are summed as doubles, and NaN and
    infinite ones count as missing.
    """

    def __init__(self, kind: T.DataType):
        self.kind = kind
        small = isinstance(kind, T.DecimalType) and kind.precision <= 12
        self.places = kind.scale if small else 0
        self.small = small

    @classmethod
    def of(cls, df: DataFrame, value: str) -> Unit:
        return cls(df.schema[value].dataType)

    def __call__(self, value: str | Column) -> Column:
        value = F.col(value) if isinstance(value, str) else value
        if self.small:
            return (value * 10 ** self.places).cast("bigint")
        if isinstance(self.kind, T.DecimalType):
            return value.cast(T.DecimalType(38, self.kind.scale))
        if isinstance(self.kind, T.IntegralType):
            return value.cast("bigint")
        value = value.cast("double")
        return F.when(F.abs(value) < float("inf"), value)


def tail(total: str, n: int, window: WindowSpec) -> Column:
    """Sum over the last ``n`` rows, given the running sum ``total``."""
    return F.col(total) - F.coalesce(F.lag(total, n).over(window), F.lit(0))


def first_difference(df: DataFrame, value: str, out: str = "diff", *, by: Sequence[str] = KEY,
                     order: str = ORDER, slice_of: Column | None = None) -> DataFrame:
    def work(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        return rows.withColumn(out, F.col(value) - F.lag(value).over(series_window(keys, order)))

    return piecewise(df, work, halo=1, by=by, order=order, slice_of=slice_of)


def min_history(df: DataFrame, n: int, *, by: Sequence[str] = KEY) -> DataFrame:
    """Rows of keys that have at least ``n`` rows.

    Counts are combined before the exchange, then joined back; the join side is
    broadcast by the planner only while it is small. ``df`` is read twice.
    """
    enough = df.groupBy(*by).count().filter(F.col("count") >= n).drop("count")
    return df.join(enough, list(by), "left_semi")


def sma(df: DataFrame, value: str, outs: Mapping[str, int], *, by: Sequence[str] = KEY,
        order: str = ORDER, slice_of: Column | None = None) -> DataFrame:
    """Simple moving averages; null until ``n`` rows, or if one of them is null.

    Decimals are averaged as they are, to their last place."""
    unit = Unit.of(df, value)

    def work(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        w = series_window(keys, order)
        out = rows.withColumns({
            "_total": F.coalesce(F.sum(unit(value)).over(running(w)), F.lit(0)),
            "_seen": F.count(unit(value)).over(running(w)),
        })
        return out.withColumns({name: mean_of(n, unit, w) for name, n in outs.items()}).drop("_total", "_seen")

    return piecewise(df, work, halo=max(outs.values()), by=by, order=order, slice_of=slice_of)


def mean_of(n: int, unit: Unit, window: WindowSpec) -> Column:
    """Mean of the last ``n`` rows, from the running sums ``_total`` and ``_seen``."""
    return F.when(tail("_seen", n, window) == n,
                  tail("_total", n, window).cast("double") / F.lit(float(n * 10 ** unit.places)))


def rsi_of(gain: Column, loss: Column) -> Column:
    """Relative strength from the summed gains and losses; null where both are 0."""
    return (F.when((loss == 0) & (gain > 0), F.lit(100.0))
            .when(loss > 0, 100.0 - 100.0 / (1.0 + gain.cast("double") / loss.cast("double"))))


def rsi(df: DataFrame, value: str, n: int = 14, out: str = "rsi", *, by: Sequence[str] = KEY,
        order: str = ORDER, slice_of: Column | None = None) -> DataFrame:
    """RSI over plain rolling sums; the first row of a key counts as no change."""
    in_units = Unit.of(df, value)

    def work(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        w = series_window(keys, order)
        unit = in_units(value)
        moves = rows.withColumn("_move", F.coalesce(unit - F.lag(unit).over(w), F.lit(0)))
        sums = moves.withColumns({
            "_n": F.row_number().over(w),
            "_gain": F.sum(F.greatest("_move", F.lit(0))).over(running(w)),
            "_loss": F.sum(F.greatest(-F.col("_move"), F.lit(0))).over(running(w)),
        })
        strength = F.when(F.col("_n") >= n, rsi_of(tail("_gain", n, w), tail("_loss", n, w)))
        return sums.withColumn(out, strength).drop("_move", "_n", "_gain", "_loss")

    return piecewise(df, work, halo=n, by=by, order=order, slice_of=slice_of)


class Decay:
    """Exponential weights of one span, arranged for block-wise running sums.

    With ``r = 1 - alpha`` and rows numbered ``i`` inside blocks of ``size``:

        scaled(i) = sum(weight * x * r**-j for j <= i)      in the block
        ema(i)    = r**i * scaled(i) + r**(i + 1) * ema(last row of the block before)

    The last rows of all blocks before are composed in order, so nothing of a
    series is left out.
    """

    def __init__(self, span: int, size: int | None = None):
        self.alpha = 2.0 / (span + 1.0)
        self.keep = 1.0 - self.alpha
        self.size = size or self.block()

    def block(self) -> int:
        """Rows until a weight is 2**-EMA_BITS, which keeps powers in range."""
        return max(1, math.ceil(EMA_BITS * math.log(2) / -math.log(self.keep))) if self.keep > 0 else 1

    def power(self, exponent: Column) -> Column:
        return F.exp(exponent * F.lit(math.log(self.keep)))

    @property
    def row(self) -> Column:
        return F.col("_pos") % self.size

    @property
    def block_column(self) -> str:
        return f"_b{self.size}"

    def scaled(self, value: Column, by: Sequence[str]) -> Column:
        weight = F.when(F.col("_pos") == 0, 1.0).otherwise(self.alpha)
        window = running(Window.partitionBy(*by, self.block_column).orderBy("_pos"))
        return F.sum(weight * value * self.power(-self.row)).over(window)

    def whole(self, scaled: str, by: Sequence[str]) -> Column:
        """The mean, from the scaled sums of the block and the ends of all blocks before."""
        # Ordered by block and position, which is the sort that ``scaled`` left.
        before = Window.partitionBy(*by).orderBy(self.block_column, "_pos").rowsBetween(Window.unboundedPreceding, -1)
        ends = F.when(self.row == self.size - 1, F.col(scaled) * self.power(F.lit(self.size - 1)))
        # The list has one number per block of the series so far.
        composed = F.aggregate(F.collect_list(ends).over(before), F.lit(0.0),
                               lambda carry, end: carry * self.keep ** self.size + end)
        return self.power(self.row) * F.col(scaled) + self.power(self.row + 1) * composed


def block_size(spans: Sequence[int]) -> int:
    """Rows that an exponential mean of any of ``spans`` looks back."""
    return max((Decay(s).block() for s in spans if s > 1), default=1)


def in_blocks(df: DataFrame, decays: Sequence[Decay], by: Sequence[str], order: str) -> DataFrame:
    """Adds the row position in the key and the block number for each size of block."""
    out = df.withColumn("_pos", (F.row_number().over(series_window(by, order)) - 1).cast("int"))
    return out.withColumns({d.block_column: F.floor(F.col("_pos") / d.size).cast("int") for d in decays})


def _without_blocks(df: DataFrame, decays: Sequence[Decay]) -> DataFrame:
    return df.drop("_pos", *{d.block_column for d in decays})


def same_blocks(spans: Sequence[int]) -> list[Decay]:
    """Decays of the spans; all in blocks of one size, hence one sort, where the range of doubles allows."""
    decays = [Decay(s) for s in spans]
    size = max(d.size for d in decays)
    if all(d.keep <= 0 or size * -math.log(d.keep) < 600 for d in decays):
        decays = [Decay(s, size) for s in spans]
    return decays


def ema(df: DataFrame, value: str, outs: Mapping[str, int], *, by: Sequence[str] = KEY,
        order: str = ORDER, slice_of: Column | None = None) -> DataFrame:
    """Exponential moving averages ``y = a*x + (1-a)*y_before``, ``a = 2/(span+1)``,
    starting at the first value. Drop null values first."""
    real = {name: span for name, span in outs.items() if span > 1}
    decays = dict(zip(real, same_blocks(list(real.values())))) if real else {}
    x = F.col(value).cast("double")

    def work(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        out = in_blocks(rows, list(decays.values()), keys, order)
        for name, decay in decays.items():
            out = out.withColumn(f"_s_{name}", decay.scaled(x, keys))
        out = out.withColumns({n: decays[n].whole(f"_s_{n}", keys) if n in decays else x for n in outs})
        return _without_blocks(out, list(decays.values())).drop(*(f"_s_{n}" for n in decays))

    return piecewise(df, work, halo=block_size(list(outs.values())), by=by, order=order, slice_of=slice_of)


def macd(df: DataFrame, value: str, fast: int = 12, slow: int = 26, signal: int = 9, *,
         line_out: str = "macd_value", signal_out: str = "macd_signal", by: Sequence[str] = KEY,
         order: str = ORDER, slice_of: Column | None = None) -> DataFrame:
    """Fast minus slow EMA, and the EMA of that line."""
    decays = same_blocks([fast, slow, signal])

    def work(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        out = macd_in_blocks(in_blocks(rows, decays, keys, order), F.col(value).cast("double"), decays,
                             line_out, signal_out, keys)
        return _without_blocks(out, decays)

    return piecewise(df, work, halo=block_size([fast, slow, signal]), by=by, order=order, slice_of=slice_of)


def macd_in_blocks(df: DataFrame, x: Column, decays: Sequence[Decay], line_out: str, signal_out: str,
                   by: Sequence[str], also: Mapping[str, Column] | None = None, keep_means: bool = False) -> DataFrame:
    """MACD of rows already in blocks; ``also`` are columns over the key window
    to work out in the same pass, ``keep_means`` adds ``ema_fast`` and ``ema_slow``."""
    f, s, g = decays
    out = df.withColumns({"_sf": f.scaled(x, by), "_ss": s.scaled(x, by)})
    out = out.withColumns({"ema_fast": f.whole("_sf", by), "ema_slow": s.whole("_ss", by), **(also or {})})
    out = out.withColumn(line_out, F.col("ema_fast") - F.col("ema_slow"))
    out = out.withColumn("_sg", g.scaled(F.col(line_out), by))
    out = out.withColumn(signal_out, g.whole("_sg", by)).drop("_sf", "_ss", "_sg")
    return out if keep_means else out.drop("ema_fast", "ema_slow")


def indicators(df: DataFrame, value: str, *, fast_sma: int, slow_sma: int, rsi_length: int,
               macd_spans: tuple[int, int, int], by: Sequence[str] = KEY,
               order: str = ORDER, slice_of: Column | None = None, piece_rows: int = PIECE_ROWS,
               keep_means: bool = False) -> DataFrame:
    """All indicators in one exchange and two sorts.

    Adds ``sma_fast, sma_slow, rsi, macd_value, macd_signal`` as doubles, and
    ``ema_fast, ema_slow`` and the row's place ``_pos`` in its key (or piece) if the means are to be kept.
    """
    decays = same_blocks(macd_spans)
    unit = Unit.of(df, value)

    def work(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        w = series_window(keys, order)
        key_w = Window.partitionBy(*keys).orderBy(decays[0].block_column, "_pos")
        # Derived columns start after the first window, so that the exchange
        # under it moves only the key, the order and the value.
        out = in_blocks(rows.withColumn("_prev", F.lag(value).over(w)), decays, keys, order)
        out = out.withColumn("_unit", unit(value)) \
            .withColumn("_move", F.coalesce(F.col("_unit") - unit("_prev"), F.lit(0))).drop("_prev")
        out = macd_in_blocks(
            out, F.col(value).cast("double"), decays, "macd_value", "macd_signal", keys,
            also={
                "_total": F.coalesce(F.sum("_unit").over(running(key_w)), F.lit(0)),
                "_seen": F.count("_unit").over(running(key_w)),
                "_gain": F.sum(F.greatest("_move", F.lit(0))).over(running(key_w)),
                "_loss": F.sum(F.greatest(-F.col("_move"), F.lit(0))).over(running(key_w)),
            }, keep_means=keep_means)
        strength = rsi_of(tail("_gain", rsi_length, key_w), tail("_loss", rsi_length, key_w))
        out = out.withColumns({
            "sma_fast": mean_of(fast_sma, unit, key_w),
            "sma_slow": mean_of(slow_sma, unit, key_w),
            "rsi": F.when(F.col("_pos") >= rsi_length - 1, strength),
        })
        out = out.drop("_unit", "_move", "_total", "_seen", "_gain", "_loss")
        return out.drop(decays[0].block_column) if keep_means else _without_blocks(out, decays)

    return piecewise(df, work, halo=max(block_size(macd_spans), slow_sma, fast_sma, rsi_length), by=by, order=order,
                     slice_of=slice_of, piece_rows=piece_rows)


def crosses(df: DataFrame, a: str, b: str, *, up: str = "cross_up", down: str = "cross_down",
            by: Sequence[str] = KEY, order: str = ORDER, slice_of: Column | None = None) -> DataFrame:
    """Flags rows where ``a`` passes ``b``; strict on both sides, false on a key's first row."""
    def work(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        rose, fell = cross_conditions(a, b, series_window(keys, order))
        return rows.withColumns({up: rose, down: fell})

    return piecewise(df, work, halo=1, by=by, order=order, slice_of=slice_of)


def cross_conditions(a: str, b: str, window: WindowSpec) -> tuple[Column, Column]:
    now_a, now_b = F.col(a), F.col(b)
    old_a, old_b = F.lag(a).over(window), F.lag(b).over(window)
    rose = F.coalesce((now_a > now_b) & (old_a < old_b), F.lit(False))
    fell = F.coalesce((now_a < now_b) & (old_a > old_b), F.lit(False))
    return rose, fell


def forward_return_of(value: str, horizon: int, window: WindowSpec) -> Column:
    x = F.col(value).cast("double")
    return F.try_divide(F.lead(x, horizon).over(window), x) - 1.0


def forward_return(df: DataFrame, value: str, outs: Mapping[str, int], *, by: Sequence[str] = KEY,
                   order: str = ORDER, slice_of: Column | None = None) -> DataFrame:
    """Return to the row ``h`` positions on; null for the last ``h`` rows of a key."""
    def work(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        w = series_window(keys, order)
        return rows.withColumns({name: forward_return_of(value, h, w) for name, h in outs.items()})

    return piecewise(df, work, halo=0, ahead=max(outs.values()), by=by, order=order, slice_of=slice_of)


def latest_per_key(df: DataFrame, *, by: Sequence[str] = KEY, order: str = ORDER) -> DataFrame:
    """The last row of each key; rows are reduced before the exchange."""
    names = [c for c in df.columns if c not in by]
    last = df.groupBy(*by).agg(F.max_by(F.struct(*names), order).alias("_last"))
    return last.select(*by, "_last.*")


def last_rows(df: DataFrame, n: int, *, by: Sequence[str] = KEY, order: str = ORDER) -> DataFrame:
    """The last ``n`` rows of each key. Input partitions drop all others before the exchange."""
    w = Window.partitionBy(*by).orderBy(F.col(order).desc())
    return df.withColumn("_back", F.row_number().over(w)).filter(F.col("_back") <= n).drop("_back")


_FROM_SINCE = 999_999


def since_with_halo(df: DataFrame, since, halo: int, *, by: Sequence[str] = KEY, order: str = ORDER,
                    partition: str = "month") -> DataFrame:
    """The rows from date ``since`` on, and at least the ``halo`` rows before it
    of each key that has rows from then on.

    Rows are counted per key and month before the exchange; from the counts
    comes the date each key has to start from. The earliest of them prunes a
    table partitioned by month (yyyymm), the rest is left out per key.
    """
    since = F.lit(since).cast("date")

    def month(day):
        return F.year(day) * 100 + F.month(day)

    # Months before ``since``, and one bucket after them for all rows from then on.
    bucket = F.when(F.col(order) < since, month(F.col(order))).otherwise(_FROM_SINCE)
    counts = df.groupBy(*by, bucket.alias("_month")).agg(F.count("*").alias("_n"), F.min(order).alias("_first"))
    later = Window.partitionBy(*by).orderBy(F.col("_month").desc()).rowsBetween(Window.unboundedPreceding, -1)
    older = F.col("_month") < _FROM_SINCE
    needed = counts.withColumns({
        "_later": F.sum(F.when(older, F.col("_n")).otherwise(0)).over(later),
        "_live": F.max("_month").over(later),
    }).filter(older & (F.col("_live") == _FROM_SINCE) & (F.col("_later") < halo))
    starts = needed.groupBy(*by).agg(F.min("_first").alias("_from"))
    first = F.least(starts.agg(F.min("_from").alias("first")).scalar(), since)
    recent = df.filter(F.col(order) >= first)
    if partition in df.columns:
        recent = recent.filter(F.col(partition) >= month(first))
    kept = recent.join(starts, list(by), "left")
    return kept.filter(F.col(order) >= F.least("_from", since)).drop("_from")


def fine_slices(df: DataFrame, rows: int, *, by: Sequence[str] = KEY, order: str = ORDER) -> DataFrame:
    """Adds ``_slice``: the day of a timestamp, or, on days where a key has more
    than ``rows`` rows, the second, and where a second has more, the microsecond.

    Counts are combined before the exchange; only slices that are too large are
    joined back, to be cut finer.
    """
    out = df.withColumn("_slice", F.date_trunc("day", order))
    for finer in (F.date_trunc("second", order), F.col(order).cast("timestamp")):
        large = out.groupBy(*by, "_slice").agg(F.count("*").alias("_n")).filter(F.col("_n") > rows) \
            .select(*(F.col(k).alias(f"_l_{k}") for k in by), F.col("_slice").alias("_l_slice"), F.lit(True).alias("_large"))
        match = F.col("_slice") == F.col("_l_slice")
        for k in by:
            match &= F.col(k) == F.col(f"_l_{k}")
        out = out.join(large, match, "left").withColumn("_slice", F.when(F.col("_large"), finer).otherwise(F.col("_slice"))) \
            .select(*df.columns, "_slice")
    return out


def split_series(df: DataFrame, slice_of: Column | None, *, rows: int, halo: int, ahead: int = 0,
                 by: Sequence[str] = KEY, order: str = ORDER) -> DataFrame:
    """Cuts each key into pieces of ``rows`` positions, each with the ``halo``
    rows before and the ``ahead`` rows after it, and adds ``piece`` and ``is_halo``.

    Any operator that looks back at most ``halo`` rows and forward at most
    ``ahead`` gives, with ``by=[*by, "piece"]`` and the halo rows dropped after
    it, what it gives on whole keys, while no task holds more than
    ``rows + halo + ahead`` rows of a key. An EMA looks back one block
    (``block_size``).

    ``slice_of`` maps the order column to coarse, increasing slices that one
    task can sort; None finds them for timestamps from the counts. Row counts
    per slice are combined before the exchange; only their small table is
    scanned per key. ``df`` is read several times, so pass a stored table where
    it is costly.
    """
    if halo > rows or ahead > rows:
        raise ValueError("halo and ahead must not exceed rows")
    sliced = fine_slices(df, rows, by=by, order=order) if slice_of is None else df.withColumn("_slice", slice_of)
    counts = sliced.groupBy(*by, "_slice").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*by, "_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*by, "_slice").orderBy(order)
    at = (sliced.join(starts, [*by, "_slice"])
          .withColumn("_at", F.col("_start") + F.row_number().over(within) - 1)
          .withColumns({"_home": F.floor(F.col("_at") / rows), "_off": F.col("_at") % rows}))
    homes = F.array_compact(F.array(
        F.col("_home"),
        F.when(F.col("_off") >= rows - halo, F.col("_home") + 1),
        F.when((F.col("_off") < ahead) & (F.col("_home") > 0), F.col("_home") - 1)))
    return (at.withColumn("piece", F.explode(homes))
            .withColumn("is_halo", F.col("piece") != F.col("_home"))
            .drop("_slice", "_start", "_at", "_home", "_off"))


def stays_whole(df: DataFrame, order: str = ORDER) -> bool:
    """Whether one task can hold a key whatever the table's size.

    A DATE column allows one row per calendar day and key. A timestamp sets no
    such bound, and its keys are cut by slices found from the counts.
    """
    kind = df.schema[order].dataType
    if isinstance(kind, T.DateType):
        return True
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return False
    raise ValueError(f"give slice_of for {order!r} ({kind.simpleString()}): slices that one task can sort")


def piecewise(df: DataFrame, work: Callable[[DataFrame, Sequence[str]], DataFrame], *, halo: int, ahead: int = 0,
              by: Sequence[str] = KEY, order: str = ORDER, slice_of: Column | None = None,
              piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``work(rows, keys)`` on whole keys if they are bounded, else on pieces of them.

    ``halo`` and ``ahead`` are how many rows the work looks back and forward.
    """
    if slice_of is None and stays_whole(df, order):
        return work(df, list(by))
    rows = max(piece_rows, halo, ahead)
    pieces = split_series(df, slice_of, rows=rows, halo=halo, ahead=ahead, by=by, order=order)
    return work(pieces, [*by, "piece"]).filter(~F.col("is_halo")).drop("piece", "is_halo")
