"""Small hand-made tables."""

import datetime as dt

START = dt.date(2001, 1, 1)


def day(n: int) -> dt.date:
    return START + dt.timedelta(days=n)


def closes(spark, by_key):
    """``{stock_id: [close, ...]}`` as daily rows, out of order on purpose."""
    rows = [(k, day(i), None if p is None else float(p)) for k, prices in by_key.items()
            for i, p in enumerate(prices)]
    rows = rows[::2] + rows[1::2][::-1]
    df = spark.createDataFrame(rows, "stock_id int, date date, close_price double")
    return df.withColumn("close_price", df.close_price.cast("decimal(10,2)"))


def returns(spark, by_strategy):
    rows = [(s, day(i), float(r)) for s, rs in by_strategy.items() for i, r in enumerate(rs) if r is not None]
    return spark.createDataFrame(rows, "strategy string, date date, ret double")


def stocks(spark, names):
    rows = [(i, s, f"{s} Ltd", None) for i, s in names.items()]
    return spark.createDataFrame(rows, "stock_id int, symbol string, company_name string, sector string")


def column(df, name, key="stock_id", value=1, order="date"):
    return [r[name] for r in df.filter(f"{key} = {value!r}").orderBy(order).collect()]


def operators_of(df) -> list[str]:
    """Names of the physical operators before adaptive changes, one per line of the plan."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line.strip(" +-:*()0123456789") for line in text.splitlines()]


def count_of(df, operator: str) -> int:
    return sum(line.startswith(operator) for line in operators_of(df))
