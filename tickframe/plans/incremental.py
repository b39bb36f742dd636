"""Features of new bars from a small state per key, whatever the length of the history.

The state of a key is all that its next rows depend on: the exponential means in
full precision, the closes that the rolling windows still hold, the last date,
and its last two feature rows. A run reads the state, the months that the ingest
job noted as changed, and nothing else.

A bar older than its key's state changes the rows after it, but only as far as
the means reach: ``REACH`` rows on, the weight of any bar is under 2^-60. Keys that
got such bars are built anew over the months that hold the late bars and so many
rows before and after them. Which months these are follows from the rows per key and
month at the first run and the notes of later ones, which are kept for that.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe import schemas as S
from tickframe.operators import series, store
from tickframe.plans import features as plans
from tickframe.plans import month_ends
from tickframe.session import scratch, stage

# Closes that the longest rolling window reaches back over; one more for the first change of price.
HELD = max(S.SLOW_SMA, S.FAST_SMA, S.RSI_LENGTH + 1)
# Rows over which a bar bears on others, and as many as a row looks back.
REACH = max(series.block_size(plans.MACD_SPANS), S.SLOW_SMA)
INDICATORS = [c for c in S.FEATURES.names if c not in S.SERIES_KEY]
RECENT = T.ArrayType(T.StructType([T.StructField(f.name, f.dataType) for f in S.FEATURES.fields[1:]]))
STATE = T.StructType([
    T.StructField("stock_id", T.IntegerType()), T.StructField("date", T.DateType()),
    T.StructField("ema_fast", T.DoubleType()), T.StructField("ema_slow", T.DoubleType()),
    T.StructField("macd_signal", T.DoubleType()), T.StructField("closes", T.ArrayType(S.PRICE)),
    T.StructField("recent", RECENT),
])
ARRIVALS = T.StructType([
    T.StructField("stock_id", T.IntegerType()), T.StructField("month", T.IntegerType()),
    T.StructField("first", T.DateType()), T.StructField("last", T.DateType()), T.StructField("n", T.LongType()),
])


def _indicators(bars: DataFrame) -> DataFrame:
    return series.indicators(bars.select("stock_id", "date", "close_price"), "close_price", fast_sma=S.FAST_SMA,
                             slow_sma=S.SLOW_SMA, rsi_length=S.RSI_LENGTH, macd_spans=plans.MACD_SPANS, keep_means=True)


def _ending(rows: DataFrame) -> DataFrame:
    """Indicator rows at storage precision, with marks, so that what is read of them later needs no sort: ``_whole`` the
    feature rows, ``_recent`` a key's last two of them, ``_back`` how many rows of its key come after a row."""
    by = Window.partitionBy("stock_id")
    means = [F.col(c).alias(f"_{c}") for c in ("ema_fast", "ema_slow", "macd_signal")]
    out = rows.select("stock_id", "date", "close_price", *means, "_pos", *plans.stored_columns())
    out = out.withColumn("_whole", reduce(Column.__and__, (F.col(c).isNotNull() for c in INDICATORS)))
    out = out.withColumns({"_back": F.max("_pos").over(by) - F.col("_pos"), "_newest": F.max(F.when(F.col("_whole"), F.col("date"))).over(by)}).drop("_pos")
    older = F.max(F.when(F.col("_whole") & (F.col("date") < F.col("_newest")), F.col("date"))).over(by)
    out = out.withColumn("_from", F.coalesce(older, "_newest"))
    return out.withColumn("_recent", F.col("_whole") & (F.col("date") >= F.col("_from"))).drop("_newest", "_from")


def _features(ending: DataFrame) -> DataFrame:
    return ending.filter("_whole").select(*S.FEATURES.names)


def _ends(ending: DataFrame) -> DataFrame:
    """Per key the last date with its means, the last ``HELD`` closes and the last two feature rows, null where there are none."""
    row = F.struct(*S.FEATURES.names[1:])
    means = F.struct("date", F.col("_ema_fast").alias("ema_fast"), F.col("_ema_slow").alias("ema_slow"), F.col("_macd_signal").alias("macd_signal"))
    ends = ending.filter((F.col("_back") < HELD) | F.col("_recent")).groupBy("stock_id").agg(
        F.max(F.when(F.col("_back") == 0, means)).alias("_last"),
        F.array_sort(F.collect_list(F.when(F.col("_back") < HELD, F.struct("date", "close_price")))).alias("_held"),
        F.array_sort(F.collect_list(F.when(F.col("_recent"), row))).alias("_rows"))
    return ends.select("stock_id", "_last.*", F.col("_held.close_price").alias("closes"),
                       F.when(F.size("_rows") > 0, F.col("_rows").cast(RECENT)).alias("recent"))


def from_history(bars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Features and state of whole histories."""
    ending = stage(_ending(_indicators(bars)), "indicators")
    return _features(ending), _ends(ending).select(*STATE.names)


def from_state(state: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Features of ``new`` bars, all later than their key's state, and the state after them.

    The held closes stand before the new rows, numbered up to 0; row 0 also
    carries the means, as the value an exponential mean starts from. Keys
    without state start at their first row.
    """
    held = state.select("stock_id", "ema_fast", "ema_slow", F.col("macd_signal").alias("_start"),
                        F.posexplode("closes").alias("_at", "close_price"), (1 - F.size("closes")).alias("_first"))
    started = F.col("_at") + F.col("_first") == 0
    before = held.select("stock_id", (F.col("_at") + F.col("_first")).alias("_pos"), F.lit(None).cast("date").alias("date"),
                         "close_price", *(F.when(started, F.col(c)).alias(f"_x_{c}") for c in ("ema_fast", "ema_slow")),
                         F.when(started, F.col("_start")).alias("_signal"))
    known = state.select("stock_id", F.lit(1).alias("_known"))
    w = Window.partitionBy("stock_id").orderBy("date")
    numbered = new.join(known, "stock_id", "left") \
        .withColumn("_pos", (F.row_number().over(w) - 1 + F.coalesce("_known", F.lit(0))).cast("int"))
    x = F.col("close_price").cast("double")
    rows = before.unionByName(numbered.select(
        "stock_id", "_pos", "date", "close_price", x.alias("_x_ema_fast"), x.alias("_x_ema_slow"), F.lit(None).cast("double").alias("_signal")))

    fast, slow, signal = decays = series.same_blocks(plans.MACD_SPANS)
    by, block = ["stock_id"], decays[0].block_column
    key_w = Window.partitionBy("stock_id").orderBy(block, "_pos")
    unit = series.Unit(S.PRICE)
    out = rows.withColumn(block, F.floor(F.col("_pos") / decays[0].size).cast("int")) \
        .withColumns({"_unit": unit("close_price"), "_prev": F.lag("close_price").over(key_w)}) \
        .withColumn("_move", F.coalesce(F.col("_unit") - unit("_prev"), F.lit(0)))
    out = out.withColumns({
        "_sf": fast.scaled(F.col("_x_ema_fast"), by), "_ss": slow.scaled(F.col("_x_ema_slow"), by),
        "_total": F.coalesce(F.sum("_unit").over(series.running(key_w)), F.lit(0)),
        "_seen": F.count("_unit").over(series.running(key_w)),
        "_gain": F.sum(F.greatest("_move", F.lit(0))).over(series.running(key_w)),
        "_loss": F.sum(F.greatest(-F.col("_move"), F.lit(0))).over(series.running(key_w)),
    })
    live = F.col("_pos") >= 0
    out = out.withColumns({"ema_fast": F.when(live, fast.whole("_sf", by)), "ema_slow": F.when(live, slow.whole("_ss", by))})
    line = F.coalesce("_signal", F.col("ema_fast") - F.col("ema_slow"))
    out = out.withColumn("_line", line).withColumn("_sg", signal.scaled(F.col("_line"), by))
    strength = series.rsi_of(series.tail("_gain", S.RSI_LENGTH, key_w), series.tail("_loss", S.RSI_LENGTH, key_w))
    out = out.withColumns({
        "macd_value": F.col("ema_fast") - F.col("ema_slow"), "macd_signal": F.when(live, signal.whole("_sg", by)),
        "sma_fast": series.mean_of(S.FAST_SMA, unit, key_w), "sma_slow": series.mean_of(S.SLOW_SMA, unit, key_w),
        "rsi": F.when(F.col("_seen") >= S.RSI_LENGTH, strength)})
    # What the held closes were needed for is done; they are in the state as they are.
    fresh = out.filter(F.col("date").isNotNull()).select("stock_id", "_pos", "date", "close_price", "ema_fast", "ema_slow", "macd_value",
                                                        "macd_signal", "sma_fast", "sma_slow", "rsi")
    ending = stage(_ending(fresh), "new-rows")

    # A key of which nothing new was found keeps its state.
    old = state.select("stock_id", *(F.col(c).alias(f"_old_{c}") for c in STATE.names[1:]))
    after = _ends(ending).join(old, "stock_id", "full_outer")
    joined = {"closes": (HELD, T.ArrayType(S.PRICE)), "recent": (2, RECENT)}

    def grown(name: str) -> Column:
        n, kind = joined[name]
        parts = [F.coalesce(F.col(c).cast(kind), F.array().cast(kind)) for c in (f"_old_{name}", name)]
        return _end(F.concat(*parts), n)

    means = {c: F.when(F.col("date").isNull(), F.col(f"_old_{c}")).otherwise(F.col(c)) for c in STATE.names[1:] if c not in joined}
    return _features(ending), after.select("stock_id", *(c.alias(n) for n, c in means.items()), *(grown(n).alias(n) for n in joined)).select(*STATE.names)


def _end(array: Column, n: int) -> Column:
    """The last ``n`` entries."""
    return F.when(F.size(array) <= n, array).otherwise(F.slice(array, -n, n))


# ---- the stored state: one folder per version, the newest complete one counts

def _versions(spark: SparkSession, root: str) -> list[str]:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(f"{root}/state")
    system = path.getFileSystem(context._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    found = [f.getPath() for f in system.listStatus(path) if f.isDirectory()]
    done = [p for p in found if system.exists(context._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(p.getName() for p in done)


def stored_state(spark: SparkSession, root: str) -> DataFrame | None:
    versions = _versions(spark, root)
    return spark.read.schema(STATE).parquet(f"{root}/state/{versions[-1]}") if versions else None


def save_state(spark: SparkSession, root: str, state: DataFrame) -> None:
    versions = _versions(spark, root)
    number = int(versions[-1]) + 1 if versions else 0
    state.select(*STATE.names).write.mode("overwrite").parquet(f"{root}/state/{number:012d}")
    # A reader of the version before may still be at work.
    for old in versions[:-1]:
        _clear(spark, f"{root}/state/{old}")


def _clear(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def build(spark: SparkSession, root: str, *, anew: bool = False) -> None:
    """Brings the feature table and the state up to date with the bars.

    ``anew`` builds everything from the whole history, as does the first run. A
    run that fails may be run again: the notes of new bars are cleared last.
    """
    with scratch(spark):
        _build(spark, root, anew)
        month_ends.bring_up(spark, root)


def write_features(spark: SparkSession, root: str, rows: DataFrame, anew: bool = False, staged_already: bool = False) -> None:
    """Feature rows into the table; the month ends that they change go before. Say ``staged_already`` of rows written aside."""
    if anew:
        month_ends.forget(spark, root, 0)
    store.merge_rows(rows, f"{root}/features", S.FEATURES, S.SERIES_KEY, distinct_keys=True, staged_already=staged_already,
                     before=lambda month: month_ends.forget(spark, root, month))


def _build(spark: SparkSession, root: str, anew: bool) -> None:
    bars = store.open_table(spark, f"{root}/bars", S.BARS)
    state = None if anew else stored_state(spark, root)
    # The notes are read once; what is noted meanwhile waits for the next run.
    notes = f"{root}/arrivals"
    files = arrivals_files(spark, notes)
    arrivals = stage(spark.read.schema(ARRIVALS).parquet(*files) if files else spark.createDataFrame([], ARRIVALS), "arrivals")
    if state is None:
        features, after = from_history(bars)
        write_features(spark, root, features, anew=True, staged_already=True)
        # All bars have been read, so what was noted of them is replaced by what there is.
        bars.groupBy("stock_id", store.MONTH).agg(F.min("date").alias("first"), F.max("date").alias("last"), F.count("*").alias("n")) \
            .write.mode("overwrite").parquet(f"{root}/noted")
        save_state(spark, root, after)
        for path in files:
            _clear(spark, path)
        return
    if not arrivals.isEmpty():
        keys = arrivals.groupBy("stock_id").agg(F.min("first").alias("first"))
        late = stage(keys.join(state.select("stock_id", "date"), "stock_id").filter(F.col("first") <= F.col("date")).select("stock_id"), "late")
        touched = state.join(keys, "stock_id", "left_semi").join(late, "stock_id", "left_anti")
        # Months are few, so the filter on them is a list that prunes folders.
        months = [r[0] for r in arrivals.select("month").distinct().collect()]
        dated = keys.join(late, "stock_id", "left_anti").join(state.select("stock_id", F.col("date").alias("_until")), "stock_id", "left")
        new = bars.filter(F.col(store.MONTH).isin(months)).join(dated, "stock_id") \
            .filter(F.col("_until").isNull() | (F.col("date") > F.col("_until"))).select("stock_id", "date", "close_price")
        features, after = from_state(touched, new)
        if not late.isEmpty():
            noted = arrivals_files(spark, f"{root}/noted")
            counts = spark.read.schema(ARRIVALS).parquet(*noted, *files).groupBy("stock_id", store.MONTH).agg(F.sum("n").alias("n"))
            again, again_after = late_rows(bars, late, arrivals, counts, state)
            features, after = features.unionByName(again), after.unionByName(again_after)
        write_features(spark, root, features, staged_already=True)
        save_state(spark, root, state.join(keys, "stock_id", "left_anti").select(*STATE.names).unionByName(after))
    for path in files:
        _keep(spark, path, f"{root}/noted")


def _keep(spark: SparkSession, path: str, folder: str) -> None:
    """Puts a note that was worked on with the others; a name that is there already is the same note."""
    context = spark.sparkContext
    source, target = (context._jvm.org.apache.hadoop.fs.Path(x) for x in (path, folder))
    system = source.getFileSystem(context._jsc.hadoopConfiguration())
    system.mkdirs(target)
    system.rename(source, context._jvm.org.apache.hadoop.fs.Path(target, source.getName()))


def _needed(counts: DataFrame, spans: DataFrame, reach: int) -> DataFrame:
    """stock_id, month, _open: the months that hold ``first`` to ``last`` of ``spans`` and ``reach`` rows on either side,
    with a mark where there are months beyond them (1 before, 2 after, 3 both)."""
    by = Window.partitionBy("stock_id")
    at, low, high = F.col(store.MONTH), F.col("_low"), F.col("_high")
    spans = spans.select("stock_id", *((F.year(d) * 100 + F.month(d)).alias(n) for d, n in (("first", "_low"), ("last", "_high"))))
    # Rows between a month and the span, without the month's own.
    backwards, forwards = (by.orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (at.desc(), at.asc()))
    nearer = F.when(at < low, F.sum(F.when(at < low, F.col("n"))).over(backwards)) \
        .when(at > high, F.sum(F.when(at > high, F.col("n"))).over(forwards))
    held = counts.join(spans, "stock_id").withColumn("_taken", F.coalesce(nearer, F.lit(0)) < reach)
    beyond = [F.max((~F.col("_taken") & side).cast("int")).over(by) for side in (at < low, at > high)]
    return held.withColumn("_open", beyond[0] + 2 * beyond[1]).filter("_taken").select("stock_id", store.MONTH, "_open")


def late_rows(bars: DataFrame, late: DataFrame, arrivals: DataFrame, counts: DataFrame, state: DataFrame,
              reach: int = REACH) -> tuple[DataFrame, DataFrame]:
    """For the keys ``late``: the features that may have changed, and the states after that.

    A note may stand for rows that were never stored, so the rows read are
    counted again; keys of which too few were found are built from their whole
    history.
    """
    spans = stage(arrivals.join(late, "stock_id").groupBy("stock_id").agg(F.min("first").alias("first"), F.max("last").alias("last")), "spans")
    months = stage(_needed(counts, spans, reach), "months")
    # Months are few, so the filter on them is a list that prunes folders.
    listed = [r[0] for r in months.select(store.MONTH).distinct().collect()]
    near = stage(bars.filter(F.col(store.MONTH).isin(listed)).join(months, ["stock_id", store.MONTH]).join(spans, "stock_id"), "near")
    found = near.groupBy("stock_id").agg(F.count_if(F.col("date") < F.col("first")).alias("_before"),
                                         F.count_if(F.col("date") > F.col("last")).alias("_after"), F.max("_open").alias("_open"))
    short = ((F.col("_open") % 2 == 1) & (F.col("_before") < reach)) | ((F.col("_open") >= 2) & (F.col("_after") < reach))
    known = stage(found.select("stock_id", short.alias("_short"), (F.col("_open") >= 2).alias("_inner")), "known")
    windowed = known.filter(~F.col("_short"))
    features, ends = from_history(near.join(windowed, "stock_id", "left_semi").select(*S.BARS.names))
    features = features.join(spans, "stock_id").filter(F.col("date") >= F.col("first")).select(*S.FEATURES.names)
    # Where rows are left after the window, the state is what it was.
    inner = windowed.filter("_inner").select("stock_id")
    after = ends.join(inner, "stock_id", "left_anti").unionByName(state.join(inner, "stock_id", "left_semi").select(*STATE.names))
    whole = late.join(windowed, "stock_id", "left_anti")
    if not whole.isEmpty():
        again, again_after = from_history(bars.join(whole, "stock_id", "left_semi"))
        features, after = features.unionByName(again), after.unionByName(again_after)
    return features, after


def arrivals_files(spark: SparkSession, notes: str) -> list[str]:
    """The note files that are there now."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(notes)
    system = path.getFileSystem(context._jsc.hadoopConfiguration())
    return [f.getPath().toString() for f in system.listStatus(path) if f.isFile()] if system.exists(path) else []


def newest(state: DataFrame):
    """The newest date of the state's feature rows, or None."""
    return state.select(F.explode("recent.date").alias("date")).agg(F.max("date")).first()[0]


def last_features(state: DataFrame) -> DataFrame:
    """The last two feature rows of each key, all that the newest ranking reads."""
    return state.select("stock_id", F.inline("recent")).select(*S.FEATURES.names)
