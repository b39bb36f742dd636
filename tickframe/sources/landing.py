"""Vendor files: reading, header flattening, ticker keys, typing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe import schemas as S
from tickframe.session import stage

# Vendor field names and the stored columns they feed.
VENDOR_FIELDS = {
    "Open": "open_price",
    "High": "high_price",
    "Low": "low_price",
    "Close": "close_price",
    "Adj Close": "adjusted_close_price",
    "Volume": "volume",
}


TEXT = ("csv", "json")


def vendor_schema(text: bool) -> T.StructType:
    number = T.StringType() if text else T.DoubleType()
    day = T.StringType() if text else T.DateType()
    return T.StructType([T.StructField("Ticker", T.StringType()), T.StructField("Date", day),
                         *(T.StructField(f, number) for f in VENDOR_FIELDS)])


def read_landing(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed vendor files, with ``_line`` (the text of a line that cannot be read, else null) and ``_file``.

    Text formats are read as text and typed later, so a bad cell costs its row, not
    the file, and a bad line is kept as it is.
    """
    if fmt in TEXT:
        return from_lines(spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file")), fmt)
    return spark.read.schema(vendor_schema(text=False)).format(fmt).load(path) \
        .select("*", F.lit(None).cast("string").alias("_line"), F.col("_metadata.file_path").alias("_file"))


def _cells(header: str) -> list[str]:
    return [c.strip(' "\ufeff') for c in header.split(",")]


def from_lines(lines: DataFrame, fmt: str, keep: Sequence[str] = ()) -> DataFrame:
    """Vendor fields as text from lines (``value``, ``_file``) of CSV or JSON files, with ``_line`` as in ``read_landing``.

    A CSV file's header says which cell is which, whatever their order; further
    columns are left out, missing ones are null. A line with more or fewer cells
    than its header, one that is no JSON object, and every line of a CSV file
    without a header that names ticker and date, are unreadable. Lines of spaces
    are skipped. Cells do not hold line breaks. ``keep`` passes further columns through.
    """
    fields = vendor_schema(text=True).names
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_line"}
    lines = lines.filter(F.col("value").rlike("\\S"))
    if fmt == "json":
        kinds = ", ".join(f"`{f}` string" for f in [*fields, "_line"])
        parsed = lines.withColumn("_row", F.from_json("value", kinds, options)) \
            .withColumn("_bad", F.when(F.col("_row").isNull(), F.col("value")).otherwise(F.col("_row._line")))
    else:
        names = F.transform(F.split("value", ","), lambda c: F.btrim(c, F.lit(' "\ufeff')))
        # Few lines hold both words, so few are cut to see whether they are cells.
        is_header = F.col("value").contains("Ticker") & F.col("value").contains("Date") \
            & F.array_contains(names, "Ticker") & F.array_contains(names, "Date")
        headers = stage(lines.filter(is_header).groupBy("_file").agg(F.min("value").alias("_header")), "headers")
        # A row per file; lines stay where they are, as a file's lines may be more than a task can take.
        parsed = lines.filter(~is_header).join(F.broadcast(headers), "_file", "left")
        row, nothing = F.lit(None), F.lit(None).cast("string")
        # As many as there are layouts; files share them.
        for header in (r[0] for r in headers.select("_header").distinct().collect()):
            cells = _cells(header)
            known = {c: k for k, c in enumerate(cells) if c in fields}
            if len(known) < sum(c in fields for c in cells):
                continue  # a name twice: which cell counts cannot be told
            kinds = ", ".join([*(f"`{c}` string" if c in fields else f"_x{k} string" for k, c in enumerate(cells)), "_line string"])
            # Through an array of one, as each field taken of the expression itself would parse the line again.
            read = F.transform(F.array(F.from_csv("value", kinds, options)), lambda cells: F.struct(
                *((cells.getField(f) if f in known else nothing).alias(f) for f in fields), cells.getField("_line").alias("_line")))
            row = F.when(F.col("_header") == F.lit(header), read[0]).otherwise(row)
        kind = T.StructType([T.StructField(f, T.StringType()) for f in [*fields, "_line"]])
        parsed = parsed.withColumn("_row", row.cast(kind)) \
            .withColumn("_bad", F.when(F.col("_row").isNull(), F.col("value")).otherwise(F.col("_row._line")))
    return parsed.select(*(F.when(F.col("_bad").isNull(), F.col("_row").getField(f)).alias(f) for f in fields),
                         F.col("_bad").alias("_line"), "_file", *keep)


def ticker_of(symbol: str | Column, suffix: str = S.MARKET_SUFFIX) -> Column:
    return F.concat(symbol, F.lit(suffix))


def symbol_of(ticker: str | Column, suffix: str = S.MARKET_SUFFIX) -> Column:
    ticker = F.col(ticker) if isinstance(ticker, str) else ticker
    cut = F.substring(ticker, F.lit(1), F.length(ticker) - F.lit(len(suffix)))
    return F.when(ticker.endswith(suffix), cut).otherwise(ticker)


def flatten_header(df: DataFrame, sep: str = "|") -> DataFrame:
    """``field|ticker`` columns of a single ticker become ``field`` columns."""
    return df.withColumnsRenamed({c: c.split(sep)[0] for c in df.columns if sep in c})


def wide_to_long(df: DataFrame, ids: tuple[str, ...] = ("Date",), sep: str = "|") -> DataFrame:
    """``field|ticker`` columns of many tickers become one row per ticker.

    Each input row turns into its own output rows, so nothing is shuffled.
    """
    fields: dict[str, dict[str, str]] = {}
    for column in df.columns:
        if sep in column:
            field, ticker = column.split(sep, 1)
            fields.setdefault(ticker, {})[field] = column
    names = list(dict.fromkeys(f for by_field in fields.values() for f in by_field))

    def record(ticker: str, by_field: Mapping[str, str]) -> Column:
        cells = (F.col(f"`{by_field[n]}`") if n in by_field else F.lit(None) for n in names)
        return F.struct(F.lit(ticker).alias("Ticker"), *(c.alias(n) for c, n in zip(cells, names)))

    return df.select(*ids, F.inline(F.array(*(record(t, f) for t, f in fields.items()))))


def typed_rows(landed: DataFrame, stocks: DataFrame, suffix: str = S.MARKET_SUFFIX, keep: Sequence[str] = ()) -> DataFrame:
    """Every landed row as a bar, with its ticker and its date as it came, the text of an unreadable line, and its file.

    A cell that does not parse becomes null, and so does the key of a ticker
    that no stock has: such rows make rejects, none is lost. ``keep`` passes
    further columns through.
    """
    price = S.PRICE.simpleString()

    def typed(field: str, column: str) -> Column:
        cell = F.col(f"`{field}`")
        return (cell.try_cast("double").try_cast("bigint") if column == "volume"
                else cell.try_cast(price)).alias(column)

    rows = landed.select(F.col("Ticker").alias("ticker"), symbol_of("Ticker", suffix).alias("symbol"),
                         F.col("Date").cast("string").alias("date_text"), F.col("Date").try_cast("date").alias("date"),
                         *(typed(f, c) for f, c in VENDOR_FIELDS.items()),
                         *((F.col(c) if c in landed.columns else F.lit(None).cast("string")).alias(c[1:]) for c in ("_line", "_file")), *keep)
    return rows.join(stocks.select("stock_id", "symbol"), "symbol", "left") \
        .select(*S.BARS.names, "ticker", "date_text", "line", "file", *keep)


def to_bars(landed: DataFrame, stocks: DataFrame, suffix: str = S.MARKET_SUFFIX) -> DataFrame:
    """Typed bars of known symbols; a cell that does not parse becomes null."""
    return typed_rows(landed, stocks, suffix).filter(F.col("stock_id").isNotNull()).select(*S.BARS.names)
