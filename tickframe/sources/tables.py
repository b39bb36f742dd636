"""The stored tables: bootstrap, scans and the seed dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe import schemas as S
from tickframe.operators import store

# The seed companies, symbol and name, in order of their number.
SEED_STOCKS = [
    ("ADANIENT", "Adani Enterprises Ltd."),
    ("ADANIPORTS", "Adani Ports and Special Economic Zone Ltd."),
    ("APOLLOHOSP", "Apollo Hospitals Enterprise Ltd."),
    ("ASIANPAINT", "Asian Paints Ltd."),
    ("AXISBANK", "Axis Bank Ltd."),
    ("BAJAJ-AUTO", "Bajaj Auto Ltd."),
    ("BAJFINANCE", "Bajaj Finance Ltd."),
    ("BAJAJFINSV", "Bajaj Finserv Ltd."),
    ("BPCL", "Bharat Petroleum Corporation Ltd."),
    ("BHARTIARTL", "Bharti Airtel Ltd."),
    ("BRITANNIA", "Britannia Industries Ltd."),
    ("CIPLA", "Cipla Ltd."),
    ("COALINDIA", "Coal India Ltd."),
    ("DIVISLAB", "Divis Laboratories Ltd."),
    ("DRREDDY", "Dr. Reddys Laboratories Ltd."),
    ("EICHERMOT", "Eicher Motors Ltd."),
    ("GRASIM", "Grasim Industries Ltd."),
    ("HCLTECH", "HCL Technologies Ltd."),
    ("HDFCBANK", "HDFC Bank Ltd."),
    ("HDFCLIFE", "HDFC Life Insurance Company Ltd."),
    ("HEROMOTOCO", "Hero MotoCorp Ltd."),
    ("HINDALCO", "Hindalco Industries Ltd."),
    ("HINDUNILVR", "Hindustan Unilever Ltd."),
    ("ICICIBANK", "ICICI Bank Ltd."),
    ("ITC", "ITC Ltd."),
    ("INDUSINDBK", "IndusInd Bank Ltd."),
    ("INFY", "Infosys Ltd."),
    ("JSWSTEEL", "JSW Steel Ltd."),
    ("KOTAKBANK", "Kotak Mahindra Bank Ltd."),
    ("LTIM", "LTIMindtree Ltd."),
    ("LT", "Larsen & Toubro Ltd."),
    ("M&M", "Mahindra & Mahindra Ltd."),
    ("MARUTI", "Maruti Suzuki India Ltd."),
    ("NTPC", "NTPC Ltd."),
    ("NESTLEIND", "Nestle India Ltd."),
    ("ONGC", "Oil & Natural Gas Corporation Ltd."),
    ("POWERGRID", "Power Grid Corporation of India Ltd."),
    ("RELIANCE", "Reliance Industries Ltd."),
    ("SBILIFE", "SBI Life Insurance Company Ltd."),
    ("SBIN", "State Bank of India"),
    ("SUNPHARMA", "Sun Pharmaceutical Industries Ltd."),
    ("TCS", "Tata Consultancy Services Ltd."),
    ("TATACONSUM", "Tata Consumer Products Ltd."),
    ("TATAMOTORS", "Tata Motors Ltd."),
    ("TATASTEEL", "Tata Steel Ltd."),
    ("TECHM", "Tech Mahindra Ltd."),
    ("TITAN", "Titan Company Ltd."),
    ("ULTRACEMCO", "UltraTech Cement Ltd."),
    ("UPL", "UPL Ltd."),
    ("WIPRO", "Wipro Ltd."),
]

TABLES = {
    "stocks": (S.STOCKS, None),
    "bars": (S.BARS, store.MONTH),
    "features": (S.FEATURES, store.MONTH),
    "recommendations": (S.RECOMMENDATIONS, "date"),
}


def seed_stocks(spark: SparkSession) -> DataFrame:
    rows = [(n, symbol, name, None) for n, (symbol, name) in enumerate(SEED_STOCKS, 1)]
    return spark.createDataFrame(rows, S.STOCKS)


def add_seed(stocks: DataFrame, seed: DataFrame) -> DataFrame:
    """Adds seed companies whose symbol is not there yet, numbered after the
    highest number in use."""
    last = stocks.agg(F.coalesce(F.max("stock_id"), F.lit(0)).alias("last")).scalar()
    numbered = seed.withColumn("stock_id", (F.col("stock_id") + last).cast("int"))
    return store.insert_if_absent(stocks, numbered, ["symbol"], order="stock_id")


def bootstrap(spark: SparkSession, root: str) -> None:
    """Creates the tables that do not exist yet; running it again changes nothing."""
    for name, (schema, partition) in TABLES.items():
        rows = seed_stocks(spark) if name == "stocks" else spark.createDataFrame([], schema)
        if partition == store.MONTH:
            rows = store.with_month(rows)
        writer = rows.write.mode("ignore")
        (writer.partitionBy(partition) if partition else writer).parquet(f"{root}/{name}")


def scan(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One stored table under its own columns."""
    schema, partition = TABLES[name]
    return store.open_table(spark, f"{root}/{name}", schema, partition).select(*schema.names)


def series_of(table: DataFrame, stock_id: int, price: str = "close_price") -> DataFrame:
    """One key's series in date order; the filter reaches the files."""
    return table.filter(F.col("stock_id") == stock_id).select("date", price).orderBy("date")
