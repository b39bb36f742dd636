"""The same queries in SQL for another engine, written from the definitions:
sliding frames for rolling means, a recursive query for the exponential ones.
"""

from __future__ import annotations

import re

from tickframe.sources.tables import SEED_STOCKS

# Named steps, each reading tables or steps above it.
STEPS = {
    "stocks": """
        select cast(s_suppkey + 1 as integer) as stock_id,
               translate(lpad(cast(s_suppkey + 1 as varchar), 10, '0'), '0123456789', 'ABCDEFGHIJ') as symbol,
               s_name as company_name, n_name as sector
        from supplier left join nation on s_nationkey = n_nationkey""",
    "active": "select cast(s_suppkey + 1 as integer) as stock_id from supplier where s_acctbal > 0",
    "ticks": """
        select cast(l_suppkey + 1 as integer) as stock_id, cast(l_shipdate as date) as date,
               cast(round(1000.0 + l_extendedprice % 100, 2) as decimal(10,2)) as px, l_quantity as q,
               row_number() over (partition by l_suppkey, cast(l_shipdate as date)
                   order by l_orderkey, l_linenumber, l_partkey, l_extendedprice) as k,
               count(*) over (partition by l_suppkey, cast(l_shipdate as date)) as n
        from lineitem""",
    "bars": """
        select stock_id, date, max(case when k = 1 then px end) as open_price, max(px) as high_price,
               min(px) as low_price, max(case when k = n then px end) as close_price,
               max(case when k = n then px end) as adjusted_close_price, cast(sum(q) as bigint) as volume
        from ticks group by stock_id, date""",
    "raw_bars": """
        select stock_id, date, open_price, high_price, low_price,
               case when (stock_id * 31 + (date - date '1995-01-01')) % 89 <> 0 then close_price end as close_price,
               adjusted_close_price,
               case when (stock_id * 31 + (date - date '1995-01-01')) % 97 = 0 then 0 else volume end as volume
        from bars""",
    "good_bars": """
        select * from raw_bars
        where open_price is not null and high_price is not null and low_price is not null
          and close_price is not null and volume is not null and volume > 0""",
    "stored_bars": "select * from good_bars where date < date '1999-01-01'",
    "vendor": """
        select b.*, s.symbol, b.stock_id * 17 + (b.date - date '1995-01-01') as spot,
               case when close_price is null then 'missing close_price' when volume <= 0 then 'no volume' end as reason
        from raw_bars b join stocks s on s.stock_id = b.stock_id""",
    "closes": """
        select stock_id, date, close_price, cast(close_price * 100 as bigint) as cents,
               row_number() over (partition by stock_id order by date) as n
        from bars""",
    "moves": """
        select *, coalesce(cents - lag(cents) over (partition by stock_id order by date), 0) as move
        from closes""",
    "rolled": """
        select *,
          case when n >= 50 then sum(cents) over (partition by stock_id order by date
               rows between 49 preceding and current row) end as s50,
          case when n >= 200 then sum(cents) over (partition by stock_id order by date
               rows between 199 preceding and current row) end as s200,
          case when n >= 14 then sum(greatest(move, 0)) over (partition by stock_id order by date
               rows between 13 preceding and current row) end as gain,
          case when n >= 14 then sum(greatest(-move, 0)) over (partition by stock_id order by date
               rows between 13 preceding and current row) end as loss
        from moves""",
    "strength": """
        select *, case when loss = 0 and gain > 0 then 100.0
                       when loss > 0 then 100e0 - 100e0 / (1e0 + cast(gain as double) / cast(loss as double)) end as rsi
        from rolled""",
    "smooth": """
        select stock_id, n, date, cast(close_price as double) as e12, cast(close_price as double) as e26,
               0e0 as line, 0e0 as sig
        from closes where n = 1
        union all
        select c.stock_id, c.n, c.date,
               (2e0/13) * cast(c.close_price as double) + (1 - 2e0/13) * s.e12,
               (2e0/27) * cast(c.close_price as double) + (1 - 2e0/27) * s.e26,
               ((2e0/13) * cast(c.close_price as double) + (1 - 2e0/13) * s.e12)
             - ((2e0/27) * cast(c.close_price as double) + (1 - 2e0/27) * s.e26),
               0.2e0 * (((2e0/13) * cast(c.close_price as double) + (1 - 2e0/13) * s.e12)
             - ((2e0/27) * cast(c.close_price as double) + (1 - 2e0/27) * s.e26)) + 0.8e0 * s.sig
        from smooth s join closes c on c.stock_id = s.stock_id and c.n = s.n + 1""",
    "far": """
        select stock_id, n, date, cast(close_price as double) as f5, cast(close_price as double) as f12,
               cast(close_price as double) as f200, 0e0 as sig
        from closes where n = 1
        union all
        select c.stock_id, c.n, c.date, (2e0/6) * cast(c.close_price as double) + (1 - 2e0/6) * s.f5,
               (2e0/13) * cast(c.close_price as double) + (1 - 2e0/13) * s.f12,
               (2e0/201) * cast(c.close_price as double) + (1 - 2e0/201) * s.f200,
               0.2e0 * (((2e0/13) * cast(c.close_price as double) + (1 - 2e0/13) * s.f12)
             - ((2e0/201) * cast(c.close_price as double) + (1 - 2e0/201) * s.f200)) + 0.8e0 * s.sig
        from far s join closes c on c.stock_id = s.stock_id and c.n = s.n + 1""",
    "features": """
        select r.stock_id, r.date, r.close_price,
               cast(((2 * s50 + 50) // 100) / 100e0 as decimal(10,2)) as sma_50,
               cast(((2 * s200 + 200) // 400) / 100e0 as decimal(10,2)) as sma_200,
               cast(rsi as decimal(5,2)) as rsi_14,
               cast(line as decimal(10,2)) as macd_value, cast(sig as decimal(10,2)) as macd_signal
        from strength r join smooth m on m.stock_id = r.stock_id and m.n = r.n
        where s200 is not null and rsi is not null""",
    "before": """
        select *, lag(sma_50) over w as p50, lag(sma_200) over w as p200,
               lag(macd_value) over w as pv, lag(macd_signal) over w as ps
        from features window w as (partition by stock_id order by date)""",
    "signals": """
        select *, case when sma_50 > sma_200 and p50 < p200 then 1
                       when sma_50 < sma_200 and p50 > p200 then -1 else 0 end as trend_signal,
               cast(100 - rsi_14 as double) as momentum_score,
               case when macd_value > macd_signal and pv < ps then 100 else 0 end as macd_score
        from before""",
    "scored": """
        select *, ((trend_signal + 1) * 50) * 0.4e0 + momentum_score * 0.3e0 + macd_score * 0.3e0 as she_score
        from signals""",
    "ahead": """
        select *, cast(lead(close_price, 10) over w as double) / cast(close_price as double) - 1e0 as future_return,
               cast(lead(close_price, 1) over w as double) / cast(close_price as double) - 1e0 as daily_return
        from scored window w as (partition by stock_id order by date)""",
    "panel": """
        select a.stock_id, s.symbol, a.date, trend_signal, momentum_score, macd_score,
               cast(close_price as double) as close_price, future_return,
               case when future_return > 0.02e0 then 1 else 0 end as target, daily_return, she_score
        from ahead a join stocks s on s.stock_id = a.stock_id
        where future_return is not null and daily_return is not null""",
    "latest": """
        select l.*, s.symbol, s.company_name
        from (select *, row_number() over (partition by stock_id order by date desc) as back from scored) l
        join stocks s on s.stock_id = l.stock_id
        where back = 1""",
    "latest_models": """
        select *, she_score as score, 'SHE' as model_type from latest
        union all select *, momentum_score as score, 'LEM' as model_type from latest""",
    "recs": """
        select * replace ((select max(date) from latest) as date), date as data_date from (select *, cast(row_number() over (partition by model_type order by score desc, symbol)
                                      as integer) as rank from latest_models)
        where rank <= 5""",
    "day": """
        select c.*, s.symbol, s.company_name from scored c join stocks s on s.stock_id = c.stock_id
        where date = (select max(date) from features)""",
    "day_models": """
        select *, she_score as score, 'SHE' as model_type from day
        union all select *, momentum_score as score, 'LEM' as model_type from day""",
    "day_recs": """
        select * from (select *, cast(row_number() over (partition by model_type order by score desc, symbol)
                                      as integer) as rank from day_models)
        where rank <= 5""",
    "test_rows": "select * from panel where date >= date '2000-01-01'",
    "by_strategy": """
        select 'she' as strategy, date, symbol, daily_return, she_score as score from test_rows
        union all select 'trend', date, symbol, daily_return, cast(trend_signal as double) from test_rows
        union all select 'momentum', date, symbol, daily_return, momentum_score from test_rows
        union all select 'macd', date, symbol, daily_return, cast(macd_score as double) from test_rows""",
    "placed": """
        select *, row_number() over (partition by strategy, date order by score desc, symbol) as place,
               count(*) over (partition by strategy, date) as names
        from by_strategy""",
    "rets": """
        select strategy, date, case when max(names) < 5 then 0e0
               else avg(case when place <= 5 then daily_return end) end as ret
        from placed group by strategy, date
        union all
        select 'benchmark', date, avg(daily_return) from test_rows group by date""",
    "grown": """
        select *, product(1 + ret) over (partition by strategy order by date) as equity from rets""",
    "fallen": """
        select *, max(equity) over (partition by strategy order by date) as peak from grown""",
    "basics": """
        select r.strategy, count(*) as n, product(1 + r.ret) - 1 as total, stddev_samp(r.ret) * sqrt(252) as vol,
               min((r.equity - r.peak) / r.peak) as dd,
               stddev_samp(case when r.ret < 0 then r.ret end) * sqrt(252) as down,
               covar_samp(r.ret, b.ret) as cov, avg(case when r.ret > 0 then 1e0 else 0e0 end) as wins
        from fallen r left join rets b on b.date = r.date and b.strategy = 'benchmark'
        group by r.strategy""",
    "bench": "select var_samp(ret) as bvar, product(1 + ret) - 1 as btotal, count(*) as bn from rets where strategy = 'benchmark'",
    "measures": """
        select strategy, pow(1 + total, 252e0 / n) - 1 as cagr, vol, dd, down, wins,
               case when bvar <> 0 then cov / bvar else 0 end as beta, pow(1 + btotal, 252e0 / bn) - 1 as bcagr
        from basics, bench""",
    "messages": """
        select conv_id, turn, regexp_replace(concat(case when conv_id % 3 = 0
                 then concat(translate(lpad(cast(conv_id % 100 + 1 as varchar), 10, '0'),
                                       '0123456789', 'ABCDEFGHIJ'), ' ') else '' end, text),
               '[^ -~]', '_', 'g') as message
        from conversations where role = 'user'""",
    "train_days": """
        select date, count(*) as n from panel where date <= date '1999-12-31' group by date""",
    "train_folds": """
        select date, cast(floor((sum(n) over (order by date) - n / 2e0) * 6 / sum(n) over ()) as integer) as fold
        from train_days""",
}

# Queries of the learned score: a stump, one split whose halves score by their share of positive labels.
STUMP_STEPS = {
    "labels": """
        select trend_signal as t, macd_score as m, 2e0 * target - 1 as y from panel where date <= date '1999-12-31'""",
    "cuts": """
        select 0 as feature, -0.5e0 as cut union all select 0, 0.5e0 union all select 1, 50e0""",
    "halves": """
        select feature, cut, case when feature = 0 then t else m end <= cut as low, count(*) as n, sum(y) as s
        from labels cross join cuts group by all""",
    "gains": """
        select feature, cut, sum(s * s / n) as gain from halves group by feature, cut having count(*) = 2""",
    "split": "select feature, cut from gains order by gain desc, feature, cut limit 1",
    "leaves": """
        select low, 100e0 / (1 + exp(-2 * s / n)) as score from halves join split using (feature, cut)""",
    "with_lem": """
        select p.*, l.score as lem_score from panel p cross join split x
        join leaves l on l.low = (case when x.feature = 0 then p.trend_signal else p.macd_score end <= x.cut)""",
    "lem_latest": """
        select p.*, l.score as lem_score from latest p cross join split x
        join leaves l on l.low = (case when x.feature = 0 then p.trend_signal else p.macd_score end <= x.cut)""",
}
# The learned score for real: 100 trees of depth 3, trained here by the same rules. A row of ``boosted`` is a combination
# of signals after so many trees (f null) or a split that was made for the next one.
TREES, DEPTH, RATE = 100, 3, "0.1e0"


def _level(k: int) -> str:
    """The steps that cut the nodes of level k at their best splits."""
    return f"""
        sums{k} as materialized (
            select node, f, x, sum(w)::double as w, sum(g)::double as g from
                (select node, unnest([0, 1, 2]) as f, unnest([t, m, d]) as x, w, g from level{k} where w > 0) group by node, f, x),
        runs{k} as (
            select *, lead(x) over by_value as next, sum(w) over by_value as wl, sum(g) over by_value as gl,
                   sum(w) over (partition by node, f) as wt, sum(g) over (partition by node, f) as gt
            from sums{k} window by_value as (partition by node, f order by x)),
        gains{k} as (
            select node, f, (x + next) / 2e0 as cut, next,
                   wl * (wt - wl) / (wl + (wt - wl)) * ((gl / wl - (gt - gl) / (wt - wl)) * (gl / wl - (gt - gl) / (wt - wl))) as gain
            from runs{k} where next is not null),
        best{k} as materialized (
            select * from (select *, row_number() over (partition by node order by gain desc, f, next) as place from gains{k})
            where place = 1 and gain > 0),
        level{k + 1} as materialized (
            select l.* replace (case when b.node is null then l.node
                when case b.f when 0 then l.t when 1 then l.m else l.d end <= b.cut then 2 * l.node else 2 * l.node + 1 end as node)
            from level{k} l left join best{k} b on b.node = l.node)"""


TREE_STEPS = {
    "cells": """
        select t, m, d, sum(pos)::bigint as pos, sum(neg)::bigint as neg from (
            select cast(trend_signal as double) as t, momentum_score as m, cast(macd_score as double) as d,
                   case when date <= date '1999-12-31' and target = 1 then 1 else 0 end as pos,
                   case when date <= date '1999-12-31' and target = 0 then 1 else 0 end as neg from panel
            union all select cast(trend_signal as double), momentum_score, cast(macd_score as double), 0, 0 from latest)
        group by t, m, d""",
    "boosted": f"""
        select 0 as i, t, m, d, pos, neg, ln(sum(pos) over ()::double / sum(neg) over ()::double) as raw,
               null::integer as f, null::double as gain from cells
        union all
        (with level0 as materialized (
            select *, floor(1e0 / (1e0 + exp(-raw)) * 16777216e0 + 0.5e0)::bigint as q from boosted where i < {TREES} and f is null),
        level1 as materialized (
            select i, t, m, d, pos, neg, raw, 1 as node, pos + neg as w, pos * (16777216 - q) - neg * q as g,
                   (pos + neg) * ((q * (16777216 - q)) // 16777216) as h from level0),
        {",".join(_level(k) for k in range(1, DEPTH + 1))},
        leaves as (
            select node, case when sum(h) > 0 then sum(g)::double / sum(h)::double else 0e0 end * {RATE} as v
            from level{DEPTH + 1} where w > 0 group by node)
        select i + 1, t, m, d, pos, neg, raw + v, null::integer, null::double from level{DEPTH + 1} join leaves using (node)
        union all {" union all ".join(f"select (select any_value(i) + 1 from level1), null, null, null, null, null, null, f, gain from best{k}"
                                      for k in range(1, DEPTH + 1))})""",
    "with_lem": f"""
        select p.*, 100e0 / (1e0 + exp(-b.raw)) as lem_score from panel p join boosted b
        on b.i = {TREES} and b.f is null and b.t = p.trend_signal and b.m = p.momentum_score and b.d = p.macd_score""",
    "lem_latest": f"""
        select p.*, 100e0 / (1e0 + exp(-b.raw)) as lem_score from latest p join boosted b
        on b.i = {TREES} and b.f is null and b.t = p.trend_signal and b.m = p.momentum_score and b.d = p.macd_score""",
}
STUMP_STRATEGY = """
        union all select 'lem', date, symbol, daily_return, lem_score from with_lem where date >= date '2000-01-01'"""

_DOUBLE_BAR = """cast(open_price as double) as open_price, cast(high_price as double) as high_price,
    cast(low_price as double) as low_price, cast(close_price as double) as close_price,
    cast(adjusted_close_price as double) as adjusted_close_price, volume"""
_DOUBLE_FEATURES = """cast(sma_50 as double) as sma_50, cast(sma_200 as double) as sma_200,
    cast(rsi_14 as double) as rsi_14, cast(macd_value as double) as macd_value,
    cast(macd_signal as double) as macd_signal"""
_DETAIL = """cast(trend_signal as double) as trend_signal, momentum_score,
    cast(macd_score as double) as macd_score"""
_UPSERTED = f"""
    select stock_id, date, cast(sma_50 as double) + case when date >= date '1999-01-01' then 1 else 0 end as sma_50,
           cast(sma_200 as double) as sma_200, cast(rsi_14 as double) as rsi_14,
           cast(macd_value as double) as macd_value, cast(macd_signal as double) as macd_signal
    from features"""
_PANEL = """
    select stock_id, symbol, date, trend_signal, round(momentum_score, 9) as momentum_score, macd_score,
           round(close_price, 9) as close_price, round(future_return, 9) as future_return, target,
           round(daily_return, 9) as daily_return
    from panel"""
_FEATURES = f"select stock_id, date, {_DOUBLE_FEATURES} from features"
_SCAN = f"select f.stock_id, f.date, s.symbol, {_DOUBLE_FEATURES}"


def _untidy_check(column: str) -> str:
    return f"select 'null {column}' as \"check\", count(*) as failures from untidy where {column} is null"


_WELCH = """
    , w as (select avg(case when strategy = 'she' then ret end) as ma, avg(case when strategy = 'macd' then ret end) as mb,
                   var_samp(case when strategy = 'she' then ret end) as va,
                   var_samp(case when strategy = 'macd' then ret end) as vb,
                   count(case when strategy = 'she' then ret end) as na,
                   count(case when strategy = 'macd' then ret end) as nb from rets),
    t as (select (ma - mb) / sqrt(va/na + vb/nb) as t_stat,
                 pow(va/na + vb/nb, 2) / (pow(va/na, 2) / (na - 1) + pow(vb/nb, 2) / (nb - 1)) as df from w),
    area as (select sum(case when k in (0, 20000) then 1 when k % 2 = 1 then 4 else 2 end
                        * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(df * pi())
                        * pow(1 + pow(k * abs(t_stat) / 20000e0, 2) / df, -(df + 1) / 2))
                    * any_value(abs(t_stat)) / 20000e0 / 3 as inside
             from t, generate_series(0, 20000) g(k))
    select round(t_stat, 6) as t_stat, round(df, 6) as df, round(1 - 2 * inside, 6) as p_value,
           case when 1 - 2 * inside < 0.05 then 'significant' else 'not significant' end as verdict
    from t, area"""

_CONTEXT = """
    , lines as (select string_agg(concat('- Rank ', rank, ': ', symbol, ', Score: ',
                    cast(cast(cast(score as decimal(18,6)) as decimal(18,2)) as varchar), chr(10)), '' order by rank) as text,
                    max(date) as date from day_recs where model_type = 'LEM'),
    known as (select distinct symbol, trend_signal, momentum_score, macd_score from day_recs),
    asked as (select conv_id, turn, regexp_extract_all(upper(message), '\\b([A-Z&]+)\\b', 1)[1] as word from messages)
    select conv_id, turn,
           concat('Today''s Date: ', strftime(l.date, '%Y-%m-%d'), chr(10),
                  '--- Top 5 ML Model (LEM) Recommendations ---', chr(10), l.text,
                  case when k.symbol is not null then concat(
                      chr(10), '--- Detailed Scores for ', k.symbol, ' ---', chr(10),
                      '- Trend Signal: ', cast(cast(trend_signal as double) as varchar), chr(10),
                      '- Momentum Score: ', cast(momentum_score as varchar), chr(10),
                      '- MACD Score: ', cast(cast(macd_score as double) as varchar), chr(10),
                      '(Note: Trend is -1, 0, or 1. Momentum and MACD are 0-100).') else '' end) as context
    from asked a cross join lines l left join known k on k.symbol = a.word"""


def _wide(value: str, source: str, label: str = "date", digits: int = 9) -> str:
    names = ("she", "trend", "momentum", "macd", "benchmark")
    columns = ", ".join(f"max(case when strategy = '{s}' then round({value}, {digits}) end) as {s}" for s in names)
    return f"select {label}, {columns} from {source} group by date"


def _seed_rows() -> str:
    quoted = ((n, s, c.replace("'", "''")) for n, (s, c) in enumerate(SEED_STOCKS, 1))
    return ", ".join(f"({n}, '{s}', '{c}')" for n, s, c in quoted)


FINAL = {
    "clean_bars": f"select stock_id, date, {_DOUBLE_BAR} from good_bars",
    "rejects": f"""select stock_id, date, {_DOUBLE_BAR},
        case when open_price is null then 'missing open_price' when high_price is null then 'missing high_price'
             when low_price is null then 'missing low_price' when close_price is null then 'missing close_price'
             when volume is null then 'missing volume' else 'no volume' end as reason
        from raw_bars where open_price is null or high_price is null or low_price is null
           or close_price is null or volume is null or volume <= 0""",
    "bars_insert_if_absent": f"""
        , final as (select * from stored_bars union all
          select * replace (close_price + 1 as close_price) from good_bars g
          where not exists (select 1 from stored_bars s where s.stock_id = g.stock_id and s.date = g.date))
        select stock_id, date, {_DOUBLE_BAR} from final""",
    "features_upsert": _UPSERTED,
    "merged_feature_table": _UPSERTED,
    "replace_dates": """
        , batch as (select stock_id, date, 1e0 as close_price from bars
                    where date >= date '2000-01-01' and close_price >= 1050)
        select stock_id, date, cast(close_price as double) as close_price from bars
        where date not in (select date from batch) union all select * from batch""",
    "dq_report": """
        , untidy as (select * from raw_bars union all select * from raw_bars where volume >= 45),
        known as (select s.* from stocks s where stock_id in (select stock_id from active))
        """ + " union all ".join([
            *("(" + _untidy_check(c) + ")" for c in ("stock_id", "date", "open_price", "high_price", "low_price",
                                                     "close_price", "volume")),
            """(select 'rejected bar', count(*) from untidy where open_price is null or high_price is null
                or low_price is null or close_price is null or volume is null or volume <= 0)""",
            """(select 'duplicate bar', count(*) from
                (select 1 from untidy group by stock_id, date having count(*) > 1))""",
            "(select 'orphan bar', count(*) from untidy where stock_id not in (select stock_id from known))",
            "(select 'short history', count(*) from (select 1 from untidy group by stock_id having count(*) < 540))",
            "(select 'null symbol', count(*) from known where symbol is null)",
            "(select 'duplicate stock_id', count(*) from (select 1 from known group by stock_id having count(*) > 1))",
            "(select 'duplicate symbol', count(*) from (select 1 from known group by symbol having count(*) > 1))",
        ]),
    "orphan_bars": """select stock_id, count(*) as row_count from bars
        where stock_id not in (select stock_id from active) group by stock_id""",
    "wide_to_long_bars": """
        select date, sector as ticker, cast(max(high_price) as double) as high, cast(min(low_price) as double) as low,
               cast(sum(volume) as bigint) as volume
        from bars join stocks using (stock_id) where sector is not null group by date, sector""",
    "ticker_key": "select stock_id, symbol || '.NS' as ticker, symbol from stocks",
    "landed_bars": f"select stock_id, date, {_DOUBLE_BAR} from good_bars",
    "stock_scan": "select stock_id, symbol, company_name, sector from stocks",
    "seed_stocks": f"""
        , seed(n, symbol, company_name) as (values {_seed_rows()})
        select * from stocks union all
        select cast(n + (select max(stock_id) from stocks) as integer), symbol, company_name, null
        from seed where symbol not in (select symbol from stocks)""",
    "stream_ingest": f"""
        , first_run as (select * from stored_bars union all
          select * replace (close_price + 1 as close_price) from good_bars g where date < date '2000-01-01'
          and not exists (select 1 from stored_bars s where s.stock_id = g.stock_id and s.date = g.date)),
        final as (select * from first_run union all
          select * replace (close_price + 2 as close_price) from good_bars g
          where not exists (select 1 from first_run s where s.stock_id = g.stock_id and s.date = g.date))
        select stock_id, date, {_DOUBLE_BAR} from final""",
    "bar_series": "select stock_id, date, cast(close_price as double) as close_price, cast(n as integer) as position from closes",
    "min_history": """select stock_id, date, cast(close_price as double) as close_price from closes
        where stock_id in (select stock_id from closes group by stock_id having count(*) >= 540)""",
    "first_difference": """select stock_id, date, cast(close_price as double) as close_price,
        cast(close_price - lag(close_price) over (partition by stock_id order by date) as double) as diff from closes""",
    "sma": """select stock_id, date, cast(close_price as double) as close_price, s50 / 5000e0 as sma_50,
        s200 / 20000e0 as sma_200 from rolled""",
    "sma_with_gaps": """
        , gaps as (select stock_id, date, close_price, cast(close_price * 100 as bigint) as cents from raw_bars)
        select stock_id, date, cast(close_price as double) as close_price,
          case when count(cents) over (partition by stock_id order by date rows between 4 preceding and current row) = 5
            then sum(cents) over (partition by stock_id order by date rows between 4 preceding and current row) / 500e0
          end as sma_5,
          case when count(cents) over (partition by stock_id order by date rows between 49 preceding and current row) = 50
            then sum(cents) over (partition by stock_id order by date rows between 49 preceding and current row) / 5000e0
          end as sma_50
        from gaps""",
    "rsi": """select stock_id, date, round(cast(close_price as double), 6) as close_price,
        round(rsi, 6) as rsi_14 from strength""",
    "ema_far_spans": """select s.stock_id, s.date, cast(close_price as double) as close_price, round(f5, 4) as ema_5,
        round(f200, 4) as ema_200 from far s join closes c on c.stock_id = s.stock_id and c.n = s.n""",
    "macd_far_spans": """select s.stock_id, s.date, cast(close_price as double) as close_price, round(f12 - f200, 4) as macd_value,
        round(sig, 4) as macd_signal from far s join closes c on c.stock_id = s.stock_id and c.n = s.n""",
    "ema": """select s.stock_id, s.date, cast(close_price as double) as close_price, round(e12, 4) as ema_12,
        round(e26, 4) as ema_26 from smooth s join closes c on c.stock_id = s.stock_id and c.n = s.n""",
    "macd": """select s.stock_id, s.date, cast(close_price as double) as close_price, round(line, 4) as macd_value,
        round(sig, 4) as macd_signal from smooth s join closes c on c.stock_id = s.stock_id and c.n = s.n""",
    "forward_return": """select stock_id, date, cast(close_price as double) as close_price,
        round(cast(lead(close_price, 1) over w as double) / cast(close_price as double) - 1e0, 9) as ret_1,
        round(cast(lead(close_price, 10) over w as double) / cast(close_price as double) - 1e0, 9) as ret_10
        from closes window w as (partition by stock_id order by date)""",
    "features": _FEATURES,
    "features_in_pieces": _FEATURES,
    "features_since": _FEATURES + " where date >= date '2000-01-01'",
    "crosses": """select stock_id, date, trend_signal = 1 as golden, trend_signal = -1 as death from signals
        where trend_signal <> 0""",
    "trend_signal": "select stock_id, date, trend_signal from signals",
    "momentum_score": "select stock_id, date, momentum_score from signals",
    "macd_score": "select stock_id, date, macd_score from signals",
    "she_score": "select stock_id, date, round(she_score, 6) as she_score from scored",
    "feature_scan": f"{_SCAN} from features f join stocks s on s.stock_id = f.stock_id",
    "training_scan": f"""{_SCAN}, cast(b.close_price as double) as close_price
        from (select * exclude (close_price) from features) f join stocks s on s.stock_id = f.stock_id
        join bars b on b.stock_id = f.stock_id and b.date = f.date""",
    "panel": _PANEL,
    "panel_from_tables": _PANEL,
    "panel_in_pieces": _PANEL,
    "label_profile": """select target, count(*) as row_count, min(date) as first_date, max(date) as last_date
        from panel group by target""",
    "symbol_profile": """select symbol, count(*) as row_count, min(date) as first_date, max(date) as last_date
        from panel group by symbol""",
    "split_profile": """select case when date <= date '1999-12-31' then 'train' else 'test' end as split,
        count(*) as row_count, min(date) as first_date, max(date) as last_date from panel
        where date <= date '1999-12-31' or date >= date '2000-01-01' group by 1""",
    "latest_per_key": f"select stock_id, date, {_DOUBLE_FEATURES} from latest",
    "top5_she": f"select date, data_date, rank, stock_id, round(score, 6) as score, model_type, {_DETAIL} from recs where model_type = 'SHE'",
    "recommendations": f"select date, data_date, rank, stock_id, round(score, 6) as score, model_type, {_DETAIL} from recs",
    "latest_recommendations": f"""select date, data_date, rank, symbol, company_name, round(score, 6) as score, model_type, {_DETAIL}
        from recs""",
    "daily_ingest_table": f"select stock_id, date, {_DOUBLE_BAR} from vendor where spot % 83 <> 0 and spot % 79 <> 0 and reason is null",
    "daily_ingest_rejects": """
        select case when spot % 83 = 0 then 'NO' else '' end || symbol || '.NS' as ticker,
               case when spot % 79 = 0 then 'notadate' else cast(date as varchar) end as date_text,
               cast(open_price as double) as open_price, cast(high_price as double) as high_price,
               cast(low_price as double) as low_price, cast(close_price as double) as close_price, volume,
               case when spot % 83 = 0 then 'unknown ticker' when spot % 79 = 0 then 'missing date' else reason end as reason
        from vendor where spot % 83 = 0 or spot % 79 = 0 or reason is not null""",
    "vendor_csv_any_order": f"""select stock_id, date, {_DOUBLE_BAR.replace("cast(adjusted_close_price as double)",
        "case when (10 + ascii(right(symbol, 1))) % 3 <> 2 then cast(adjusted_close_price as double) end")}
        from vendor where spot % 83 <> 0 and spot % 79 <> 0 and reason is null""",
    "rejects_of_two_days": """
        , sent as (
            select *, case when spot % 83 = 0 then 'NO' else '' end || symbol || '.NS' as ticker,
                   case when spot % 79 = 0 then 'notadate' else cast(date as varchar) end as day from vendor),
        torn as (select *, ascii(right(symbol, 1)) % 5 = 0 and day like '%-17' as off from sent)
        select case when not off then ticker end as ticker, case when not off then day end as date_text,
               case when not off then cast(open_price as double) end as open_price,
               case when not off then cast(high_price as double) end as high_price,
               case when not off then cast(low_price as double) end as low_price,
               case when not off then cast(close_price as double) end as close_price, case when not off then volume end as volume,
               case when off then '{"Ticker": "' || ticker || '", "Date": "' || day end as line,
               case when off then 'unreadable line' when spot % 83 = 0 then 'unknown ticker'
                    when spot % 79 = 0 then 'missing date' else reason end as reason
        from torn where off or spot % 83 = 0 or spot % 79 = 0 or reason is not null""",
    "stream_then_features": _FEATURES,
    "stream_vendor_files": f"""
        , usable as (select * from vendor where spot % 83 <> 0 and spot % 79 <> 0 and reason is null)
        select stock_id, date, {_DOUBLE_BAR} from usable where date < date '2000-01-01' union all
        select stock_id, date, {_DOUBLE_BAR.replace("cast(close_price as double)", "cast(close_price + 1 as double)")}
        from usable where date >= date '2000-01-01'""",
    "bootstrap_twice": """select 'stocks' as name, count(*) as row_count from stocks union all select 'bars', 0
        union all select 'features', 0 union all select 'recommendations', 0""",
    "empty_metrics": "select cast(0 as bigint) as row_count from rets limit 1",
    "daily_features_table": _FEATURES,
    "daily_rank_table": """
        , seen as (select * from scored where date < date '2000-01-01' or stock_id % 3 > 0),
        days(day) as (values (date '2000-01-01'), ((select max(date) from seen))),
        newest as (select d.day, s.*, row_number() over (partition by d.day, s.stock_id order by s.date desc) as back
                   from days d join seen s on s.date <= d.day),
        ranked as (select n.*, t.symbol, row_number() over (partition by day order by she_score desc, t.symbol) as place
                   from newest n join stocks t on t.stock_id = n.stock_id where back = 1)
        select day as date, date as data_date, cast(place as integer) as rank, symbol, round(she_score, 6) as score
        from ranked where place <= 5""",
    "bars_with_parents": f"select stock_id, date, {_DOUBLE_BAR} from good_bars where stock_id % 9 > 0",
    "rejects_of_rules": f"""
        , judged as (select *, case when open_price is null then 'missing open_price' when high_price is null then 'missing high_price'
            when low_price is null then 'missing low_price' when close_price is null then 'missing close_price'
            when volume is null then 'missing volume' when stock_id % 9 = 0 then 'unknown stock_id'
            when volume <= 0 then 'no volume' end as reason from raw_bars)
        select stock_id, date, {_DOUBLE_BAR}, reason from judged where reason is not null""",
    "rankings_of_past_dates": """
        , days(day) as (values (date '1997-02-01'), (date '1998-12-31'), (date '2000-05-17')),
        newest as (select d.day, s.*, row_number() over (partition by d.day, s.stock_id order by s.date desc) as back
                   from days d join scored s on s.date <= d.day),
        ranked as (select n.*, t.symbol, row_number() over (partition by day order by she_score desc, t.symbol) as place
                   from newest n join stocks t on t.stock_id = n.stock_id where back = 1)
        select day as date, date as data_date, cast(place as integer) as rank, symbol, round(she_score, 6) as score
        from ranked where place <= 5""",
    "recommendation_response": """select s.date, cast(s.rank as integer) as position, s.symbol as she_symbol,
        round(s.score, 6) as she_score, l.symbol as lem_symbol, round(l.score, 6) as lem_score
        from (select * from day_recs where model_type = 'SHE') s
        join (select * from day_recs where model_type = 'LEM') l on l.rank = s.rank""",
    "score_lookup": f"select date, symbol, {_DETAIL} from day_recs order by model_type, rank limit 1",
    "score_json": f"""select stock_id, concat('{{"trend_signal":', cast(cast(trend_signal as double) as varchar),
        ',"momentum_score":', cast(momentum_score as varchar), ',"macd_score":',
        cast(cast(macd_score as double) as varchar), '}}') as json, {_DETAIL} from latest""",
    "topn_returns": "select strategy, date, round(ret, 9) as ret from rets where strategy = 'she'",
    "benchmark_returns": "select strategy, date, round(ret, 9) as ret from rets where strategy = 'benchmark'",
    "base_strategy_returns": "select strategy, date, round(ret, 9) as ret from rets",
    "returns_wide": _wide("ret", "rets"),
    "metrics": """select strategy, round(cagr * 100, 6) as cagr_pct, round(vol * 100, 6) as annualized_volatility_pct,
        round(case when vol = 0 then 0 else cagr / vol end, 6) as sharpe_ratio,
        round(case when down = 0 then 0 else cagr / down end, 6) as sortino_ratio,
        round(case when dd = 0 then 0 else cagr / abs(dd) end, 6) as calmar_ratio,
        round(dd * 100, 6) as max_drawdown_pct, round((cagr - beta * bcagr) * 100, 6) as alpha_pct,
        round(beta, 6) as beta, round(wins * 100, 6) as win_rate_pct from measures""",
    "strategy_summary": """select strategy, round(cagr * 100, 2) as cagr_pct,
        round(case when vol = 0 then 0 else cagr / vol end, 2) as sharpe_ratio,
        round(dd * 100, 2) as max_drawdown_pct from measures""",
    "equity_curve": _wide("equity", "grown", "strftime(date, '%Y-%m-%d') as label", 6),
    "drawdown_curve": _wide("(equity - peak) / peak * 100", "fallen", digits=6),
    "chart_json": """select date, max(case when strategy = 'she' then round(ret, 12) end) as she_returns,
        max(case when strategy = 'momentum' then round(ret, 12) end) as momentum_returns,
        max(case when strategy = 'benchmark' then round(ret, 12) end) as benchmark_returns from rets group by date""",
    "welch_t": _WELCH,
    "chat_context": _CONTEXT,
    "mention_any": """
        , words as (select distinct conv_id, turn,
            unnest(regexp_extract_all(upper(message), '\\b([A-Z&]+)\\b', 1)) as symbol from messages)
        select * from words where symbol in (select symbol from day_recs)""",
    "first_mention": """select conv_id, turn,
        regexp_extract_all(upper(message), '\\b([A-Z&]+)\\b', 1)[1] as word from messages""",
    "time_folds": """select fold, count(*) as row_count, min(p.date) as first_date, max(p.date) as last_date
        from panel p join train_folds f on f.date = p.date group by fold""",
    "fold_counts": """select fold, trend_signal, momentum_score, macd_score, target, cast(count(*) as double) as weight
        from panel p join train_folds f on f.date = p.date group by all""",
    "lem_score_checks": """select symbol, count(*) as scored, cast(0 as bigint) as out_of_range,
        cast(0 as bigint) as differing from test_rows group by symbol""",
    "importance_checks": "select cast(3 as bigint) as features, 1e0 as total, cast(0 as bigint) as negative from bars limit 1",
    "lem_tuned": """select cast(4 as bigint) as settings, cast(0 as bigint) as bad_f1, count(*) as scored,
        cast(0 as bigint) as bad_scores, true as best_refitted from test_rows""",
    "training_counts": """select trend_signal, momentum_score, macd_score, target, cast(count(*) as double) as weight
        from panel where date <= date '1999-12-31' group by all""",
}


# The same reports with the stump's score among the strategies.
STUMP_FINAL = {
    "lem_stump_scores": """select symbol, date, round(lem_score, 9) as lem_score from with_lem
        where date >= date '2000-01-01'""",
    "lem_stump_importance": """select f.feature, case when x.feature = f.n then 1e0 else 0e0 end as importance
        from (values (0, 'trend_signal'), (1, 'macd_score'), (2, 'momentum_score')) f(n, feature) cross join split x""",
    "lem_stump_top5": """
        , models as (select *, she_score as s, 'SHE' as model_type from lem_latest
          union all select *, lem_score as s, 'LEM' as model_type from lem_latest),
        ranked as (select *, row_number() over (partition by model_type order by s desc, symbol) as place from models)
        select (select max(date) from lem_latest) as date, date as data_date, cast(place as integer) as rank, stock_id,
               round(s, 6) as score, model_type from ranked where place <= 5""",
    "lem_stump_returns": FINAL["base_strategy_returns"],
    "lem_stump_metrics": FINAL["metrics"],
    "lem_stump_summary": FINAL["strategy_summary"],
    "lem_stump_significance": _WELCH.replace("'macd'", "'#'").replace("'she'", "'lem'").replace("'#'", "'she'"),
    "lem_stump_equity_curve": FINAL["equity_curve"].replace("select ", "select max(case when strategy = 'lem' then round(equity, 6) end) as lem, ", 1),
}


_NAMES = """case strategy when 'lem' then 'Learned Ensemble (LEM)' when 'she' then 'Simple Heuristic (SHE)'
    when 'trend' then 'Trend-Following Only' when 'momentum' then 'Momentum (RSI) Only' when 'macd' then 'MACD Crossover Only'
    else 'Benchmark (Equal-Weight)' end"""
# The same reports with the score of the trees.
TREE_FINAL = {
    "lem_scores": STUMP_FINAL["lem_stump_scores"].replace(", 9)", ", 6)"),
    "lem_scores_from_table": STUMP_FINAL["lem_stump_scores"].replace(", 9)", ", 6)"),
    "lem_top5": STUMP_FINAL["lem_stump_top5"],
    "lem_metrics": f"""select {_NAMES} as "Strategy", round(cagr * 100, 6) as "CAGR (%)",
        round(vol * 100, 6) as "Annualized Volatility (%)",
        round(case when vol = 0 then 0 else cagr / vol end, 6) as "Sharpe Ratio",
        round(case when down = 0 then 0 else cagr / down end, 6) as "Sortino Ratio",
        round(case when dd = 0 then 0 else cagr / abs(dd) end, 6) as "Calmar Ratio",
        round(dd * 100, 6) as "Max Drawdown (%)",
        round(case when strategy = 'benchmark' then 0e0 else (cagr - beta * bcagr) * 100 end, 6) as "Alpha (vs. Benchmark)",
        round(case when strategy = 'benchmark' then 1e0 else beta end, 6) as "Beta (vs. Benchmark)",
        round(wins * 100, 6) as "Win Rate (%)" from measures""",
    "lem_summary": STUMP_FINAL["lem_stump_summary"],
    "lem_significance": STUMP_FINAL["lem_stump_significance"],
    "lem_equity_curve": """select strftime(date, '%Y-%m-%d') as label,
        max(case when strategy = 'lem' then round(equity, 6) end) as lem, max(case when strategy = 'she' then round(equity, 6) end) as she,
        max(case when strategy = 'benchmark' then round(equity, 6) end) as benchmark
        from grown where strategy in ('lem', 'she', 'benchmark') group by date""",
    "feature_importance": """
        , shares as (select f, sum(gain) / sum(sum(gain)) over (partition by i) as share from boosted where f is not null group by i, f),
        named(f, feature) as (values (0, 'Trend Signal'), (1, 'Momentum (RSI)'), (2, 'MACD Signal'))
        select feature, round(coalesce(sum(share), 0) / (select sum(share) from shares), 9) as importance
        from named left join shares using (f) group by feature""",
    "daily_rank_both": """
        , models as (select *, she_score as s, 'SHE' as model_type from lem_latest
          union all select *, lem_score as s, 'LEM' as model_type from lem_latest),
        ranked as (select *, row_number() over (partition by model_type order by s desc, symbol) as place from models)
        select (select max(date) from lem_latest) as date, date as data_date, cast(place as integer) as rank, symbol,
               round(s, 6) as score, model_type from ranked where place <= 5""",
    "lem_refit": FINAL["lem_tuned"].replace("cast(4 as", "cast(81 as"),
}


def _statement(final: str, steps: dict[str, str]) -> str:
    """``final`` after the steps it reads, directly or through others, in order."""
    found: set[str] = set()
    todo = [final]
    while todo:
        words = set(re.findall(r"[a-z_0-9]+", todo.pop()))
        fresh = {name for name in steps if name in words} - found
        found |= fresh
        todo += [steps[name] for name in fresh]
    texts = ",\n".join(f"{name} as ({steps[name]})" for name in steps if name in found)
    return f"with recursive {texts}\n{final}"


def statements() -> dict[str, str]:
    out = {name: _statement(final, STEPS) for name, final in FINAL.items()}
    # The stump's steps come after the panel they read, and before the strategies that they join.
    before = dict(list(STEPS.items())[:list(STEPS).index("by_strategy")])
    after = dict(list(STEPS.items())[list(STEPS).index("by_strategy"):])
    steps = {**before, **STUMP_STEPS, **after, "by_strategy": STEPS["by_strategy"] + STUMP_STRATEGY}
    trees = {**before, **TREE_STEPS, **after, "by_strategy": STEPS["by_strategy"] + STUMP_STRATEGY}
    return (out | {name: _statement(final, steps) for name, final in STUMP_FINAL.items()}
            | {name: _statement(final, trees) for name, final in TREE_FINAL.items()})
