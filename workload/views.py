"""Bar tables derived from the given tables.

The same statement text runs on Spark and on DuckDB; `{events}` and the like stand for the tables.
Every view covers its whole source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Asset class and exchange of a numeric symbol.
CLASS_OF = (
    "case when {k} % 7 = 3 then 'INDEX' when {k} % 7 = 4 then 'ETF' "
    "when {k} % 7 = 5 then 'COMMODITY' when {k} % 7 = 6 then 'FOREX' else 'EQUITY' end"
)
EXCHANGE_OF = "case when {k} % 3 = 0 then 'NSE' when {k} % 3 = 1 then 'BSE' else 'MULTI' end"


def _class_of(key: str) -> str:
    return CLASS_OF.replace("{k}", key)


def _exchange_of(key: str) -> str:
    return EXCHANGE_OF.replace("{k}", key)


VIEWS = {
    # Many bars per symbol and day, `seq` unique, every kind of anomaly.
    "raw_bars": f"""
        select cast(user_id as string) as symbol, {_class_of('user_id')} as asset_type,
          cast(user_id as string) as storage_key, cast(ts as date) as date, event_id as seq,
          value as open,
          case when event_type = 'signup' then null
               when event_type = 'error' and user_id % 5 <> 0 then value * 0.9e0
               else value * 1.1e0 end as high,
          value * 0.95e0 as low,
          case when event_type = 'click' and user_id % 5 <> 0 then value * 1.25e0
               when event_type = 'view' and user_id % 5 <> 0 then value * 0.8e0
               else value end as close,
          value as adj_close,
          case when event_type = 'purchase' then -event_id else event_id end as volume,
          cast(0 as double) as dividends, cast(0 as double) as stock_splits
        from {{events}}""",
    # Years of history with wide gaps; the shift by supplier reaches back before 1990.
    "history_bars": f"""
        select cast(l_suppkey as string) as symbol, {_class_of('l_suppkey')} as asset_type,
          cast(l_suppkey as string) as storage_key,
          case when l_suppkey % 4 = 0
               then cast(cast(l_shipdate as date) - interval '10' year as date)
               else cast(l_shipdate as date) end as date,
          l_extendedprice as open, l_extendedprice + l_quantity as high,
          l_extendedprice - l_quantity as low,
          l_extendedprice * (1 + l_tax - l_discount) as close,
          cast(l_quantity as bigint) as volume
        from {{lineitem}}""",
    "universe": f"""
        select cast(c_custkey as string) as symbol, c_name as name, '' as isin,
          {_exchange_of('c_custkey')} as exchange, c_mktsegment as sector, '' as industry,
          cast(null as date) as listing_date, {_class_of('c_custkey')} as asset_type,
          '' as yfinance_ticker, cast(c_custkey as string) as storage_key
        from {{customer}}""",
    # Names with every character a storage key replaces, known tickers in odd letter case.
    "odd_symbols": f"""
        select p_partkey as id,
          case when p_partkey % 6 = 0 then p_name
               when p_partkey % 6 = 1 then '^' || p_name || '=F'
               when p_partkey % 6 = 2 then p_name || '/' || p_type
               when p_partkey % 6 = 3 then
                 case when p_size % 4 = 0 then 'Nifty 50' when p_size % 4 = 1 then 'sensex'
                      when p_size % 4 = 2 then 'INDIA VIX' else 'NIFTY MIDCAP 50' end
               when p_partkey % 6 = 4 then
                 case when p_size % 3 = 0 then 'gold' when p_size % 3 = 1 then 'Crude Oil'
                      else 'COPPER' end
               else case when p_size % 3 = 0 then 'usdinr' when p_size % 3 = 1 then 'JPYINR'
                         else 'USD/INR' end end as symbol,
          {_class_of('p_size')} as asset_type, {_exchange_of('p_partkey')} as exchange,
          case when p_partkey % 11 = 0 then p_brand else '' end as yfinance_ticker,
          case when p_partkey % 2 = 0 then 'NSE ' || p_name || ' Index'
               else 'BSE ' || p_name end as name
        from {{part}}""",
    "vendor_bars": """
        select cast(l_shipdate as date) as "Date", l_extendedprice as "Open",
          l_extendedprice + l_tax as "High", l_extendedprice - l_tax as "Low",
          l_extendedprice * (1 - l_discount) as "Close",
          l_extendedprice * (1 - l_discount) as "Adj Close",
          cast(l_quantity as bigint) as "Volume",
          case when l_linenumber = 1 then null else l_tax end as "Stock Splits",
          l_returnflag as "Return Flag", cast(l_partkey as string) as "Symbol"
        from {lineitem}""",
    # Numbers as text, some of them unreadable.
    "text_bars": """
        select event_id as seq, cast(user_id as string) as symbol, cast(ts as date) as date,
          case when event_type = 'click' then cast(value as string) || 'd'
               when event_type = 'view' then ' ' || cast(event_id as string) || ' '
               when event_type = 'error' then event_type
               when event_type = 'signup' then cast(event_id as string) || 'e-2'
               else 'NaN' end as open,
          case when event_type = 'click' then '0x' || cast(event_id as string)
               when event_type = 'view' then cast(event_id as string) || '.75'
               when event_type = 'error' then props
               when event_type = 'signup' then '-' || cast(event_id as string) || '.5'
               else null end as volume
        from {events}""",
    "listing_text": """
        select case when c.c_custkey % 10 = 0 then '   ' when c.c_custkey % 10 = 1 then null
                    else ' ' || c.c_name || ' ' end as "SYMBOL",
          c.c_mktsegment || '  ' as "NAME OF COMPANY",
          ' IN' || cast(o.o_orderkey as string) as " ISIN NUMBER",
          o.o_orderpriority as " SERIES",
          case when o.o_orderkey % 5 = 0 then 'not listed'
               when o.o_orderkey % 5 = 1 then cast(cast(o.o_orderdate as date) as string)
               else cast(day(o.o_orderdate) as string) || '-' ||
                 case month(o.o_orderdate)
                   when 1 then 'Jan' when 2 then 'FEB' when 3 then 'mar' when 4 then 'Apr'
                   when 5 then 'May' when 6 then 'Jun' when 7 then 'JUL' when 8 then 'Aug'
                   when 9 then 'Sep' when 10 then 'oct' when 11 then 'Nov' else 'Dec' end
                 || '-' || cast(year(o.o_orderdate) as string) end as " DATE OF LISTING"
        from {orders} o join {customer} c on o.o_custkey = c.c_custkey""",
    "download_results": f"""
        select event_id as id, cast(user_id as string) as symbol,
          {_class_of('user_id')} as asset_type, ts as download_time,
          case when event_type = 'signup' then event_id else 0 end as rows_added,
          case when event_type = 'error' then
                 case when event_id % 4 = 0 then 'HTTP 429'
                      when event_id % 4 = 1 then 'Connection RESET by peer'
                      when event_id % 4 = 2 then 'invalid ticker symbol'
                      else 'No Data Found for ' || cast(user_id as string) end
               end as error,
          event_type = 'view' as skipped
        from {{events}}""",
    "validation_log": """
        select event_id as id, cast(user_id as string) as symbol, event_type as check_name,
          case when value > 100 then 'FAILED' else 'PASSED' end as status, props as details,
          ts as validated_at
        from {events}""",
    "supplier_assets": f"""
        select cast(s_suppkey as string) as symbol, s_name as name, '' as isin,
          {_exchange_of('s_suppkey')} as exchange, '' as sector, '' as industry,
          cast(null as date) as listing_date, {_class_of('s_suppkey')} as asset_type,
          cast(s_suppkey as string) || '.X' as yfinance_ticker,
          timestamp '2024-01-01 00:00:00' as created_at,
          timestamp '2024-01-01 00:00:00' as updated_at
        from {{supplier}}""",
    # Every customer listed once per order of theirs: keep-last has to choose.
    "order_assets": f"""
        select cast(o_custkey as string) as symbol, o_orderpriority as name,
          cast(o_orderkey as string) as isin, {_exchange_of('o_custkey')} as exchange,
          o_orderstatus as sector, '' as industry, cast(o_orderdate as date) as listing_date,
          {_class_of('o_custkey')} as asset_type, '' as yfinance_ticker, o_orderkey as listed
        from {{orders}}""",
    "class_sizes": f"""
        select {_class_of('c_custkey')} as asset_type,
          cast(floor(c_acctbal * 1000) as bigint) + 5000000 as size_bytes
        from {{customer}}""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view over the Parquet tables in sf_dir."""
    tables = {t: f"parquet.`{sf_dir}/{t}.parquet`" for t in
              ("events", "lineitem", "customer", "supplier", "part", "orders")}
    # Quoted names are double-quoted in the shared text, back-quoted in Spark.
    return spark.sql(VIEWS[name].format(**tables).replace('"', "`"))


def ctes(*names: str) -> str:
    """`with name as (...)` over the tables under their own names."""
    tables = {t: t for t in ("events", "lineitem", "customer", "supplier", "part", "orders")}
    return "with " + ",\n".join(f"{n} as ({VIEWS[n].format(**tables)})" for n in names)
