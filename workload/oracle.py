"""DuckDB SQL for the registered queries, written from the operators' rules."""

from __future__ import annotations

from workload.views import CLASS_OF, ctes

BAR = "date, open, high, low, close, adj_close, volume, dividends, stock_splits, symbol, seq"
KEY = "asset_type, storage_key"
ALL = f"{BAR}, {KEY}"

VIOLATION = """coalesce(high < low, false) or coalesce(open > high, false)
  or coalesce(open < low, false) or coalesce(close > high, false) or coalesce(close < low, false)"""

# The arriving and stored parts of raw_bars, and their keep-last merge.
OLD_NEW = ctes("raw_bars") + """,
old_bars as (select * from raw_bars
  where (date < date '2024-01-20' and asset_type <> 'ETF') or asset_type = 'COMMODITY'),
new_bars as (select * replace (open * 2 as open) from raw_bars
  where (date >= date '2024-01-15' and asset_type <> 'COMMODITY') or asset_type = 'ETF'),
both_bars as (select *, 0 as batch from old_bars union all select *, 1 as batch from new_bars),
sides as (select *,
    max(1 - batch) over (partition by asset_type, storage_key) as has_old,
    max(batch) over (partition by asset_type, storage_key) as has_new,
    row_number() over (partition by asset_type, storage_key, date
                       order by batch desc, seq desc) as rank
  from both_bars)
"""
UPSERT = OLD_NEW + f"select {ALL} from sides where rank = 1 or has_old = 0 or has_new = 0"
UPSERT_DEDUPED = OLD_NEW + f"select {ALL} from sides where rank = 1 or has_new = 0"

# What two batch runs take: of assets in the universe, bars after the last one that the first took.
INGESTED = OLD_NEW.split("both_bars as")[0] + f"""universe as (select cast(c_custkey as varchar) as storage_key,
    {CLASS_OF.replace('{k}', 'c_custkey')} as asset_type from customer),
first_run as (select * from old_bars semi join universe using ({KEY})
  where date >= date '1990-01-01' and date < date '2024-01-31'),
last_days as (select {KEY}, max(date) as last_day from first_run group by {KEY}),
second_run as (select n.* from new_bars n semi join universe using ({KEY})
    left join last_days using ({KEY})
  where date >= date '1990-01-01' and date < date '2024-01-31'
    and coalesce(n.date > last_day, true)),
both_runs as (select *, 0 as batch from first_run union all select *, 1 as batch from second_run),
sides as (select *,
    max(1 - batch) over (partition by {KEY}) as has_old, max(batch) over (partition by {KEY}) as has_new,
    row_number() over (partition by {KEY}, date order by batch desc, seq desc) as rank
  from both_runs)
"""

# Bars as a snapshot has them and as a site has them later.
YEARS_OF_BARS = ctes("history_bars") + f""",
years_of_bars as (select *, cast(null as double) as adj_close, cast(0 as double) as dividends,
    cast(0 as double) as stock_splits, volume as seq, year(date) as bar_year from history_bars),
before as (select * from years_of_bars where not (asset_type = 'FOREX' and bar_year = 1998)),
after as (select * replace (
      case when asset_type = 'INDEX' and bar_year = 1995 then close * 2 else close end as close)
  from years_of_bars where not (asset_type = 'ETF' and bar_year = 1990)),
both_sides as (select *, 0 as side from before union all select *, 1 as side from after)
"""

REPAIR = ctes("raw_bars") + f""",
marked as (select *, max(case when {VIOLATION} then 1 else 0 end)
    over (partition by {KEY}) as flagged from raw_bars),
repaired as (select * replace (
    case when flagged = 1 then greatest(open, high, low, close) else high end as high,
    case when flagged = 1 then least(open, high, low, close) else low end as low) from marked),
ranked as (select *, row_number() over (partition by {KEY}, date order by seq desc) as rank
  from repaired)
"""

PLAN = ctes("raw_bars", "universe") + """,
old_bars as (select * from raw_bars
  where (date < date '2024-01-20' and asset_type <> 'ETF') or asset_type = 'COMMODITY'),
old_last as (select asset_type, storage_key, max(date) as last_date from old_bars group by all),
plan as (select u.symbol, u.asset_type, u.storage_key,
    coalesce(cast(last_date + interval 1 day as date), date '1990-01-01') as start_date,
    date '2024-01-31' as end_date,
    coalesce(cast(last_date + interval 1 day as date) >= date '2024-01-31', false) as skipped
  from universe u left join old_last using (asset_type, storage_key)),
missing as (select b.* from raw_bars b join plan p using (asset_type, storage_key)
  where not p.skipped and b.date >= p.start_date and b.date < p.end_date)
"""

STATUS = """case when rows_added > 0 and error is null then 'success'
  when skipped then 'skipped' else 'error' end"""

TICKER = """case when coalesce(yfinance_ticker, '') <> '' then yfinance_ticker
  when asset_type = 'INDEX' then case upper(symbol)
    when 'NIFTY 50' then '^NSEI' when 'NIFTY NEXT 50' then '^NSMIDCP50'
    when 'NIFTY BANK' then '^NSEBANK' when 'NIFTY IT' then '^CNXIT'
    when 'NIFTY MIDCAP 50' then '^NSMIDCP50' when 'NIFTY MIDCAP 100' then '^NSEMDCP100'
    when 'INDIA VIX' then '^INDIAVIX' when 'SENSEX' then '^BSESN' else '^' || symbol end
  when asset_type = 'COMMODITY' then case upper(symbol)
    when 'GOLD' then 'GC=F' when 'SILVER' then 'SI=F' when 'CRUDE OIL' then 'CL=F'
    when 'NATURAL GAS' then 'NG=F' else symbol end
  when asset_type = 'FOREX' then case upper(symbol)
    when 'USDINR' then 'USDINR=X' when 'EURINR' then 'EURINR=X' when 'GBPINR' then 'GBPINR=X'
    when 'JPYINR' then 'JPYINR=X' else symbol || '=X' end
  else symbol || case when exchange = 'NSE' then '.NS' else '.BO' end end"""

SAFE = "replace(replace(replace(replace(symbol, ' ', '_'), '/', '_'), '^', ''), '=', '_')"

CLASS_DIR = """case asset_type when 'EQUITY' then 'stocks' when 'INDEX' then 'indices'
  when 'ETF' then 'etfs' when 'COMMODITY' then 'commodities' when 'FOREX' then 'forex'
  else 'other' end"""

UNIVERSE_COLUMNS = (
    "symbol, name, isin, exchange, sector, industry, listing_date, asset_type, yfinance_ticker"
)

PARSED = """parsed as (select trim(coalesce("SYMBOL", '')) as symbol,
    trim(coalesce("NAME OF COMPANY", '')) as name, trim(coalesce(" ISIN NUMBER", '')) as isin,
    'NSE' as exchange, '' as sector, '' as industry,
    cast(try_strptime(trim(" DATE OF LISTING"), '%d-%b-%Y') as date) as listing_date,
    'EQUITY' as asset_type, '' as yfinance_ticker
  from listing_text where trim(coalesce("SYMBOL", '')) <> '')"""

DOWNLOAD_LOG = f"""download_log as (select id, symbol, download_time,
    rows_added as rows_downloaded, {STATUS} as status, coalesce(error, '') as error_message
  from download_results)"""


def counted(bars: str, as_of: str, max_gap: int = 5) -> str:
    """CTEs `per_asset` (row counters) and `per_dates` (date counters) over `bars`."""
    return f""",
per_asset as (select {KEY}, count(*) as total_rows,
    count(*) filter (where high < low) as hl,
    count(*) filter (where open > high or open < low) as oo,
    count(*) filter (where close > high or close < low) as co,
    count(*) filter (where volume < 0) as neg,
    count(*) filter (where date is null) as null_date,
    count(*) filter (where open is null) as null_open,
    count(*) filter (where high is null) as null_high,
    count(*) filter (where low is null) as null_low,
    count(*) filter (where close is null) as null_close,
    count(*) filter (where volume is null) as null_volume,
    count(*) filter (where date > date '{as_of}') as future,
    count(*) filter (where date < date '1990-01-01') as old
  from {bars} group by {KEY}),
dates as (select {KEY}, date, count(*) as n from {bars} group by {KEY}, date),
steps as (select *, date - lag(date) over (partition by {KEY} order by date nulls first) as gap
  from dates),
per_dates as (select {KEY}, cast(sum(case when n > 1 then n else 0 end) as bigint) as dup,
    count(*) filter (where gap > {max_gap}) as large, max(gap) as widest
  from steps group by {KEY}),
counted as (select *, hl + oo + co as bad,
    null_date + null_open + null_high + null_low + null_close + null_volume as nulls
  from per_asset join per_dates using ({KEY}))"""


def verdict(check: str, max_gap: int = 5) -> str:
    """check_name, status, message and rows_affected of one check, over `counted`."""
    none = "cast(0 as bigint)"
    rules = {
        "duplicates": (
            "dup > 0", "'FAILED'", "'Found ' || dup || ' duplicate rows by date'", "dup",
            "No duplicate dates found"),
        "missing_trading_days": (
            "large > 0", "'WARNING'",
            f"'Found ' || large || ' gaps > {max_gap} days' || "
            "case when widest > 15 then ' (max gap: ' || widest || ' days)' else '' end",
            "large", f"No gaps larger than {max_gap} days"),
        "ohlc_consistency": (
            "bad > 0", "'FAILED'", "'Found ' || bad || ' OHLC consistency violations'", "bad",
            "All OHLC values are consistent"),
        "negative_volume": (
            "neg > 0", "'FAILED'", "'Found ' || neg || ' rows with negative volume'", "neg",
            "No negative volume values"),
        "null_values": (
            "nulls > 0", "'WARNING'",
            "'Found ' || nulls || ' null values across critical columns'", "nulls",
            "No null values in critical columns"),
        "data_range": (
            "future > 0 or old > 0", "case when future > 0 then 'FAILED' else 'WARNING' end",
            "case when future > 0 then 'Found ' || future || ' rows with future dates' "
            "else 'Found ' || old || ' rows before 1990' end",
            "case when future > 0 then future else old end", "All dates within expected range"),
    }
    condition, status, message, rows, fine = rules[check]
    return f"""'{check}' as check_name, case when {condition} then {status} else 'PASSED' end as status,
  case when {condition} then {message} else '{fine}' end as message,
  case when {condition} then {rows} else {none} end as rows_affected"""


CHECK_NAMES = ["duplicates", "missing_trading_days", "ohlc_consistency", "negative_volume",
               "null_values", "data_range"]


UNIVERSE_KEYS = f"""universe as (select cast(c_custkey as varchar) as symbol,
    {CLASS_OF.replace('{k}', 'c_custkey')} as asset_type, cast(c_custkey as varchar) as storage_key
  from customer)"""


def report(
    bars: str, as_of: str, *views: str, before: str = "", assets: str = "universe", base: str = "",
) -> str:
    """CTEs up to `report`: the validation report of `assets` over `bars`, a view unless `base` has
    CTEs for it and the universe."""
    each = "\nunion all\n".join(
        f"select symbol, {KEY}, total_rows, {verdict(c)} "
        f"from counted join {assets} using ({KEY})" for c in CHECK_NAMES
    )
    base = base or ctes(bars, "universe", *views)
    return base + before + counted(bars, as_of) + f""",
report as ({each}
union all
select symbol, {KEY}, cast(0 as bigint) as total_rows, 'data_exists' as check_name,
  'SKIPPED' as status, 'No data available for validation' as message,
  cast(0 as bigint) as rows_affected
from {assets} anti join per_asset using ({KEY}))
"""


# A universe in which some assets are listed twice, and its assets.
LISTED_TWICE = f""",
listed as (select symbol, {KEY} from universe union all
  select symbol, asset_type, {SAFE} as storage_key from supplier_assets),
listed_assets as (select distinct * from listed)"""
TWICE = report("raw_bars", "2024-01-25", "supplier_assets", before=LISTED_TWICE, assets="listed_assets")


def one_check(bars: str, as_of: str, check: str, details: str = "", max_gap: int = 5) -> str:
    more = f", {details}" if details else ""
    return (
        ctes(bars) + counted(bars, as_of, max_gap)
        + f" select {KEY}, {verdict(check, max_gap)}{more} from counted"
    )


def non_zero(**columns: str) -> str:
    return ", ".join(f"nullif({c}, 0) as detail_{name}" for name, c in columns.items())


GAP_DETAILS = (
    "case when large > 0 and widest > 15 then widest end as detail_max_gap_days, "
    + non_zero(gap_count="large")
)
SUMMARY = f"""summary as (select symbol, {KEY}, max(total_rows) as total_rows,
    count(*) filter (where status = 'PASSED') as passed,
    count(*) filter (where status = 'WARNING') as warned,
    count(*) filter (where status = 'FAILED') as failed
  from report group by symbol, {KEY})"""

NUMERAL = r"^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|inf|infinity|nan)\s*$"


def numeral(column: str) -> str:
    """The text as a double; NULL if it is no numeral or NaN."""
    value = f"try_cast(trim({column}) as double)"
    return (f"case when regexp_matches({column}, '{NUMERAL}', 'i') and not isnan({value}) "
            f"then {value} end")


ORACLE: dict[str, str] = {
    "scan_bars": ctes("raw_bars") + f" select {ALL} from raw_bars",
    "scan_date_range": ctes("raw_bars") + f""" select {ALL} from raw_bars
        where date >= date '2024-01-10' and date <= date '2024-01-20'""",
    "scan_universe": ctes("universe") + f""",
        typed as (select symbol, name, '' as isin, 'NSE' as exchange, '' as sector,
          '' as industry, cast(null as date) as listing_date, asset_type, '' as yfinance_ticker
          from universe)
        select * replace ({TICKER} as yfinance_ticker) from typed""",
    "parse_listing": ctes("listing_text") + f""", {PARSED}
        select * replace (symbol || '.NS' as yfinance_ticker) from parsed""",
    "listing_from_file": ctes("listing_text") + f""", {PARSED}
        select * replace (symbol || '.NS' as yfinance_ticker) from parsed""",
    "universe_roundtrip": ctes("universe") + f"""
        select * replace ({TICKER} as yfinance_ticker) from universe""",
    "report_file": report("raw_bars", "2024-01-25") + """
        select symbol, total_rows, check_name, status, message, rows_affected,
          '2024-01-30T12:00:00' as validated_at from report""",
    "seed_index_exchange": ctes("odd_symbols") + """ select id, name,
        case when name like '%NSE%' then 'NSE' else 'BSE' end as exchange from odd_symbols""",
    "snapshot_subset": ctes("raw_bars") + f""" select {ALL} from raw_bars
        where asset_type in ('INDEX', 'FOREX')""",
    "upsert_keep_last": UPSERT,
    "upsert_dedupe_first_load": UPSERT_DEDUPED,
    "store_upsert": UPSERT,
    "store_delete": ctes("raw_bars", "supplier_assets") + f""" select {ALL} from raw_bars
        where (asset_type, symbol) not in (select asset_type, symbol from supplier_assets)""",
    "store_clean": REPAIR + f"select {ALL} from ranked where flagged = 0 or rank = 1",
    "stream_ingest": UPSERT,
    "ingest_new_files": INGESTED
    + f"select {ALL} from sides where rank = 1 or has_old = 0 or has_new = 0",
    "stream_validation": report(
        "both_bars", "2024-01-25", base=f"{OLD_NEW}, {UNIVERSE_KEYS}") + "select * from report",
    "stream_absent_columns": ctes("raw_bars") + f" select {ALL} from raw_bars",
    "store_compact": UPSERT,
    "snapshot_scoped_sync": OLD_NEW + f""",
        scoped as (select *, 0 as batch from raw_bars where asset_type = 'EQUITY'
          union all select *, 1 as batch from new_bars where asset_type = 'EQUITY'),
        scoped_sides as (select *, max(batch) over (partition by {KEY}) as has_new,
          row_number() over (partition by {KEY}, date order by batch desc, seq desc) as rank
          from scoped)
        select {ALL} from scoped_sides where rank = 1 or has_new = 0
        union all select {ALL} from raw_bars where asset_type <> 'EQUITY'""",
    "landed_csv": ctes("vendor_bars") + """ select "Date" as date, "Open" as open,
        "High" as high, "Low" as low, "Close" as close, "Adj Close" as adj_close,
        "Volume" as volume, cast(0 as double) as dividends, "Stock Splits" as stock_splits,
        "Symbol" as symbol from vendor_bars""",
    "coerce_types": ctes("text_bars") + f""" select seq, symbol, date, {numeral('open')} as open,
        coalesce(cast(trunc({numeral('volume')}) as bigint), 0) as volume from text_bars""",
    "delete_assets": ctes("raw_bars", "supplier_assets") + f""" select {ALL} from raw_bars
        where (asset_type, symbol) not in (select asset_type, symbol from supplier_assets)""",
    "deletion_outcome": ctes("raw_bars", "universe") + f""" select distinct {KEY},
        ({KEY}) in (select ({KEY}) from raw_bars) as existed from universe""",
    "upsert_assets": ctes("supplier_assets", "order_assets") + f""",
        latest as (select * from order_assets
          qualify row_number() over (partition by symbol order by listed desc) = 1)
        select l.symbol, l.name, l.isin, l.exchange, l.sector, l.industry, l.listing_date,
          l.asset_type, l.yfinance_ticker,
          coalesce(s.created_at, timestamp '2024-01-30 12:00:00') as created_at,
          timestamp '2024-01-30 12:00:00' as updated_at
        from latest l left join supplier_assets s on l.symbol = s.symbol
        union all
        select {UNIVERSE_COLUMNS}, created_at, updated_at from supplier_assets
        where symbol not in (select symbol from order_assets)""",
    "validation_log_rows": report("raw_bars", "2024-01-25") + """
        select symbol, check_name, status, message as details from report
        where check_name <> 'data_exists'""",
    "runs_replay": report("raw_bars", "2024-01-25") + f""",
        hits as (select {KEY}, count(*) as n from raw_bars where {VIOLATION} group by {KEY})
        select 'first' as run_id, symbol, check_name, status, message as details from report
        where check_name <> 'data_exists'
        union all
        select 'first/clean', symbol, 'ohlc_consistency', 'PASSED',
          'Repaired ' || n || ' OHLC consistency violations'
        from universe join hits using ({KEY})""",
    "repair_log_rows": ctes("raw_bars", "universe") + f""",
        hits as (select {KEY}, count(*) as n from raw_bars where {VIOLATION} group by {KEY})
        select symbol, 'ohlc_consistency' as check_name, 'PASSED' as status,
          'Repaired ' || n || ' OHLC consistency violations' as details
        from universe join hits using ({KEY})""",
    "normalize_bars": ctes("vendor_bars") + """ select "Date" as date, "Open" as open,
        "High" as high, "Low" as low, "Close" as close, "Adj Close" as adj_close,
        "Volume" as volume, cast(0 as double) as dividends, "Stock Splits" as stock_splits,
        "Symbol" as symbol from vendor_bars""",
    "filter_symbols": ctes("odd_symbols") + """ select * from odd_symbols
        where upper(symbol) in ('NIFTY 50', 'GOLD', 'USD/INR', '^SMALL RING=F', 'NOTHING')""",
    "filter_asset_type": ctes("raw_bars") + " select * from raw_bars where asset_type = 'FOREX'",
    "download_status": ctes("download_results")
        + f" select id, {STATUS} as status from download_results",
    "download_log_rows": ctes("download_results") + f""" select symbol,
        rows_added as rows_downloaded, {STATUS} as status,
        case when {STATUS} = 'success' then {CLASS_DIR} || '/' || symbol else '' end as file_path,
        coalesce(error, '') as error_message from download_results""",
    "throttle_errors": ctes("download_results") + """ select id, error as error_message,
        coalesce(lower(error) like '%429%' or lower(error) like '%too many requests%'
          or lower(error) like '%rate limit%' or lower(error) like '%connection reset%'
          or lower(error) like '%connection aborted%' or lower(error) like '%read timed out%'
          or lower(error) like '%no data found%', false) as throttle from download_results""",
    "storage_key": ctes("odd_symbols") + f""" select id, {SAFE} as storage_key,
        {CLASS_DIR} as class, {CLASS_DIR} || '/' || {SAFE} as path, 'other' as unknown_class
        from odd_symbols""",
    "derive_ticker": ctes("odd_symbols")
        + f" select id, symbol, asset_type, {TICKER} as ticker from odd_symbols",
    "assets_with_data": ctes("raw_bars", "universe") + f""" select * from universe
        where ({KEY}) in (select ({KEY}) from raw_bars)""",
    "resume_plan": ctes("raw_bars", "universe") + f""",
        latest as (select {KEY}, max(date) as last_date from raw_bars group by {KEY})
        select symbol, asset_type, last_date,
          coalesce(cast(last_date + interval 1 day as date), date '1990-01-01') as start_date,
          date '2024-01-31' as end_date,
          coalesce(last_date + interval 1 day >= date '2024-01-31', false) as skipped
        from universe left join latest using ({KEY})""",
    "resume_plan_from": ctes("universe") + """ select symbol, asset_type,
        date '2024-01-03' as start_date, date '2024-01-31' as end_date, false as skipped
        from universe""",
    "select_missing": PLAN + f"select {ALL} from missing",
    "ingest_results": PLAN + f"""select p.symbol, p.asset_type, p.storage_key,
        coalesce(n, 0) as rows_added, p.skipped
        from plan p left join (select {KEY}, count(*) as n from missing group by {KEY})
        using ({KEY})""",
    "orphan_log_rows": ctes("validation_log", "supplier_assets") + """ select *
        from validation_log where symbol not in (select symbol from supplier_assets)""",
    "last_dates": ctes("raw_bars")
        + f" select {KEY}, max(date) as last_date from raw_bars group by {KEY}",
    "row_counts": ctes("raw_bars", "universe") + f""" select u.symbol, u.asset_type,
        count(b.seq) as row_count from universe u left join raw_bars b
        on u.asset_type = b.asset_type and u.storage_key = b.storage_key
        group by u.symbol, u.asset_type""",
    "store_last_dates": OLD_NEW
        + f"select {KEY}, max(date) as last_date from both_bars group by {KEY}",
    "store_row_counts": OLD_NEW + f""",
        kept as (select * from sides where rank = 1 or has_old = 0 or has_new = 0),
        {ctes("universe").strip().removeprefix("with ")}
        select u.symbol, u.asset_type, count(k.seq) as row_count from universe u left join kept k
        on u.asset_type = k.asset_type and u.storage_key = k.storage_key
        group by u.symbol, u.asset_type""",
    "class_counts": ctes("raw_bars") + """ select asset_type, count(*) as row_count,
        count(distinct storage_key) as asset_count from raw_bars group by asset_type""",
    "class_stats": ctes("class_sizes") + f""",
        named as (select {CLASS_DIR} as class, size_bytes from class_sizes)
        select class, count(*) as files, cast(sum(size_bytes) as bigint) as size_bytes
        from named group by rollup (class)""",
    "coverage_table": ctes("class_sizes") + f""",
        named as (select {CLASS_DIR} as class, size_bytes from class_sizes)
        select upper(class[1]) || class[2:] as class, count(*) as files,
          printf('%.1f MB', sum(size_bytes) / 1048576.0e0) as size
        from named group by class""",
    "sync_document": ctes("class_sizes") + f""",
        named as (select {CLASS_DIR} as class, size_bytes from class_sizes),
        stats as (select class, count(*) as files, cast(sum(size_bytes) as bigint) as size_bytes
          from named group by class)
        select '{{"last_sync_utc":"2024-01-30T12:00:00","repo_id":"someone/bars","stats":'
          || '{{"total_files":' || cast(sum(files) as bigint) || ',"total_size_bytes":'
          || cast(sum(size_bytes) as bigint) || ',"asset_types":{{'
          || string_agg('"' || class || '":{{"files":' || files || ',"size_bytes":' || size_bytes
               || '}}', ',' order by class) || '}}}}}}' as document from stats""",
    "scan_asset_range": ctes("raw_bars") + f""" select {ALL} from raw_bars
        where asset_type = 'EQUITY' and storage_key in ('8', '15')
          and date between date '2024-01-08' and date '2024-01-21'""",
    "snapshot_delta": YEARS_OF_BARS + f"""
        select asset_type, cast(bar_year as integer) as bar_year,
          case when n_before = 0 then 'new' when n_after = 0 then 'gone' else 'changed' end as change
        from (select asset_type, bar_year, sum(side) as n_after, sum(1 - side) as n_before
              from both_sides group by asset_type, bar_year)
        semi join (select asset_type, bar_year from (
            (select * exclude (side) from both_sides where side = 0
             except all select * exclude (side) from both_sides where side = 1)
            union all
            (select * exclude (side) from both_sides where side = 1
             except all select * exclude (side) from both_sides where side = 0))) as differing
          using (asset_type, bar_year)""",
    "snapshot_delta_import": YEARS_OF_BARS + f"select {ALL} from after",
    "all_assets_ranked": ctes("universe") + """
        select *, row_number() over (order by symbol) as position from universe""",
    "stored_assets_ranked": ctes("raw_bars") + f"""
        select {KEY}, row_number() over (order by storage_key, asset_type) as position
        from (select distinct {KEY} from raw_bars)""",
    "download_history_ranked": ctes("download_results") + f""", {DOWNLOAD_LOG}
        select *, row_number() over (order by symbol, download_time desc, id) as position
        from download_log""",
    "log_replay": ctes("universe", "download_results") + f""", {DOWNLOAD_LOG},
        logged as (select symbol, cast(sum(rows_downloaded) as bigint) as rows_downloaded,
            max(status) as status
          from download_log semi join universe using (symbol) group by symbol)
        select run_id, symbol, rows_downloaded, status
        from logged cross join (values ('first'), ('second')) as runs(run_id)""",
    "check_price_outliers": ctes("history_bars") + f""",
        odd as (select {KEY}, case
              when cast(symbol as int) % 5 = 0 and day(date) = 1 then close * 200
              when cast(symbol as int) % 5 in (0, 1) and day(date) = 2 then close / 1000
              else close end as close
          from history_bars),
        extremes as (select {KEY}, max(close) > 50 * avg(close) as high,
            min(close) * 50 < avg(close) as low from odd group by {KEY})
        select {KEY}, 'price_outliers' as check_name,
          case when high or low then 'WARNING' else 'PASSED' end as status,
          case when high and low then 'Closes far above and below the mean'
               when high then 'Highest close far above the mean'
               when low then 'Lowest close far below the mean'
               else 'All closes near the mean' end as message,
          cast(high as bigint) + cast(low as bigint) as rows_affected
        from extremes""",
    "check_stale_prices": ctes("history_bars") + f""",
        flat as (select {KEY}, count(*) as n, count(distinct case
              when cast(symbol as int) % 3 = 0 then 100 + month(date) % 2 else close end) as n_closes
          from history_bars where close is not null group by {KEY}),
        stale as (select *, n >= 10 and n_closes <= 2 as is_stale from flat)
        select {KEY}, 'stale_prices' as check_name,
          case when is_stale then 'WARNING' else 'PASSED' end as status,
          case when is_stale then 'Found ' || n_closes || ' distinct closes'
               else 'Closes change' end as message,
          case when is_stale then n else 0 end as rows_affected,
          case when is_stale then n_closes end as detail_distinct_closes
        from stale""",
    "asset_type_counts": ctes("universe") + """ select coalesce(asset_type, 'TOTAL') as asset_type,
        count(*) as asset_count from universe group by rollup (asset_type)""",
    "count_assets": "select count(*) as total_assets from customer",
    "status_summary": ctes("universe", "download_results") + f""", {DOWNLOAD_LOG}
        select (select count(*) from universe) as total_assets,
          (select count(*) from universe where asset_type = 'EQUITY') as n_equity,
          (select count(*) from universe where asset_type = 'INDEX') as n_index,
          (select count(*) from universe where asset_type = 'ETF') as n_etf,
          (select count(*) from universe where asset_type = 'COMMODITY') as n_commodity,
          (select count(*) from universe where asset_type = 'FOREX') as n_forex,
          (select count(*) from download_log
           where download_time > timestamp '2024-01-29 12:00:00') as recent_downloads_24h,
          (select count(*) from download_log where status = 'error') as total_failed_downloads""",
    "status_by_hour": ctes("download_results") + f""", {DOWNLOAD_LOG},
        landed as (select *, download_time < timestamp '2024-01-20 00:00:00' and id % 10 <> 0 as is_first,
            date_trunc('hour', download_time) as hour from download_log),
        known_until as (select max(download_time) - interval 3 days as until from landed where is_first),
        taken as (select landed.* from landed, known_until
          where is_first or until is null or hour + interval 1 hour > until)
        select hour + to_hours(cast(k as integer)) as window_end, count(*) as downloads,
          count(*) filter (where status = 'error') as failed
        from taken cross join range(1, 25) as hours(k) group by 1""",
    "class_row_counts": ctes("raw_bars") + """
        select asset_type, count(*) as row_count from raw_bars group by asset_type""",
    "class_last_dates": ctes("raw_bars") + """
        select asset_type, max(date) as last_date from raw_bars group by asset_type""",
    "validation_report": report("raw_bars", "2024-01-25") + "select * from report",
    "validation_report_incremental": report("history_bars", "2001-01-01") + "select * from report",
    "validation_report_history": report("history_bars", "2001-01-01") + "select * from report",
    "report_summary": report("raw_bars", "2024-01-25") + f""", {SUMMARY}
        select *, case when failed = 0 then 'PASS' else 'FAIL' end as verdict,
          symbol || ': ' || passed || ' passed, ' || warned || ' warnings, ' || failed
            || ' failed' as summary
        from summary""",
    "batch_summary": report("raw_bars", "2024-01-25") + f""", {SUMMARY}
        select count(*) as total_assets, count(*) filter (where failed = 0) as passed_assets
        from summary""",
    "report_summary_listed_twice": TWICE + f""", {SUMMARY}
        select summary.*, case when failed = 0 then 'PASS' else 'FAIL' end as verdict,
          symbol || ': ' || passed || ' passed, ' || warned || ' warnings, ' || failed
            || ' failed' as summary
        from listed join summary using (symbol, {KEY})""",
    "batch_summary_listed_twice": TWICE + f""", {SUMMARY}
        select count(*) as total_assets, count(*) filter (where failed = 0) as passed_assets
        from listed join summary using (symbol, {KEY})""",
    "repair_log_listed_twice": ctes("raw_bars", "universe", "supplier_assets") + LISTED_TWICE + f""",
        hits as (select {KEY}, count(*) as n from raw_bars where {VIOLATION} group by {KEY})
        select symbol, 'ohlc_consistency' as check_name, 'PASSED' as status,
          'Repaired ' || n || ' OHLC consistency violations' as details
        from listed_assets join hits using ({KEY})""",
    "validation_report_scoped": report("raw_bars", "2024-01-25") + """ select * from report
        where symbol in ('1', '2', '3', '5', '8', '13', '21', '34')""",
    "file_sizes": ctes("raw_bars") + f""",
        named as (select {CLASS_DIR} as class, seq from raw_bars where asset_type <> 'ETF'
          union all select unnest(['stocks', 'indices', 'etfs', 'commodities', 'forex']), null)
        select class, count(seq) > 0 as has_files, count(seq) > 0 as has_bytes
        from named group by rollup (class)""",
    "ingest_log_sizes": ctes("raw_bars", "universe") + f"""
        select asset_type, count(distinct storage_key) as assets,
          count(*) as rows_downloaded, true as sizes_add_up
        from raw_bars semi join universe using ({KEY})
        where date < date '2024-01-31' group by asset_type""",
    "asset_lookup": ctes("universe") + " select * from universe where symbol = '7'",
    "download_history_of": ctes("download_results") + f""", {DOWNLOAD_LOG}
        select * from download_log where symbol = '7'""",
    "ingest_summary": ctes("download_results") + f""" select
        count(*) filter (where {STATUS} = 'success') as succeeded,
        count(*) filter (where skipped) as skipped,
        count(*) filter (where coalesce(error, '') <> '') as failed,
        cast(sum(rows_added) as bigint) as total_rows from download_results""",
    "repair_summary": ctes("raw_bars") + f""" select count(*) as repaired_rows,
        count(distinct ({KEY})) as repaired_assets from raw_bars where {VIOLATION}""",
    "repaired_counts": ctes("raw_bars") + f""" select {KEY}, count(*) as repaired_rows
        from raw_bars where {VIOLATION} group by {KEY}""",
    "dedupe_keep_last": ctes("raw_bars") + f""" select {ALL} from raw_bars
        qualify row_number() over (partition by {KEY}, date order by seq desc) = 1""",
    "duplicate_rows": ctes("raw_bars") + f""" select {KEY}, date, count(*) as date_rows
        from raw_bars group by {KEY}, date having count(*) > 1""",
    "date_gaps": ctes("history_bars") + counted("history_bars", "2001-01-01")
        + f" select {KEY}, date, gap as gap_days from steps where gap is not null",
    "all_assets": ctes("universe") + " select * from universe",
    "download_history": ctes("download_results") + f""", {DOWNLOAD_LOG}
        select * from download_log""",
    "validation_history": ctes("validation_log") + " select * from validation_log",
    "stored_assets": ctes("raw_bars") + f" select distinct {KEY} from raw_bars",
    "build_universe": ctes("listing_text", "universe", "supplier_assets", "odd_symbols") + f""",
        {PARSED},
        united as (select {UNIVERSE_COLUMNS} from parsed
          union all select {UNIVERSE_COLUMNS} from universe
          union all select {UNIVERSE_COLUMNS} from supplier_assets
          union all select symbol, name, '' as isin, exchange, '' as sector, '' as industry,
            cast(null as date) as listing_date, asset_type, yfinance_ticker from odd_symbols)
        select * replace ({TICKER} as yfinance_ticker) from united""",
    "check_duplicates": one_check("raw_bars", "2024-01-25", "duplicates"),
    "check_gaps": one_check("history_bars", "2024-01-25", "missing_trading_days", GAP_DETAILS),
    "check_gaps_wide": one_check(
        "history_bars", "2024-01-25", "missing_trading_days", GAP_DETAILS, max_gap=12),
    "check_ohlc": one_check(
        "raw_bars", "2024-01-25", "ohlc_consistency",
        non_zero(high_lt_low="hl", open_out_of_range="oo", close_out_of_range="co")),
    "check_volume": one_check("raw_bars", "2024-01-25", "negative_volume"),
    "check_nulls": one_check(
        "raw_bars", "2024-01-25", "null_values",
        non_zero(date="null_date", open="null_open", high="null_high", low="null_low",
                 close="null_close", volume="null_volume")),
    "check_range": one_check("history_bars", "2001-01-01", "data_range"),
    "checks_without_columns": ctes("raw_bars") + f""",
        assets as (select {KEY}, count(*) filter (where open is null)
          + count(*) filter (where close is null) as nulls from raw_bars group by {KEY}),
        skipped as (select * from (values
          ('duplicates', 'No ''date'' column found'),
          ('missing_trading_days', 'Insufficient data'),
          ('ohlc_consistency', 'Missing required OHLC columns'),
          ('negative_volume', 'No ''volume'' column found'),
          ('data_range', 'Insufficient data')) as t (check_name, message))
        select {KEY}, check_name, 'SKIPPED' as status, message, cast(0 as bigint) as rows_affected
        from assets cross join skipped
        union all
        select {KEY}, 'null_values', case when nulls > 0 then 'WARNING' else 'PASSED' end,
          case when nulls > 0 then 'Found ' || nulls || ' null values across critical columns'
            else 'No null values in critical columns' end, nulls from assets""",
    "checks_without_bars": ctes("raw_bars", "universe") + counted("raw_bars", "2024-01-25") + f"""
        select {KEY}, {verdict('duplicates')} from counted
        union all
        select {KEY}, {verdict('ohlc_consistency')} from counted
        union all
        select {KEY}, 'duplicates', 'SKIPPED', 'Empty DataFrame', 0
        from universe anti join per_asset using ({KEY})
        union all
        select {KEY}, 'ohlc_consistency', 'SKIPPED', 'Missing required OHLC columns', 0
        from universe anti join per_asset using ({KEY})""",
    "repair_ohlc": REPAIR + f"select {ALL} from repaired",
    "repair_assets": REPAIR + f"select {ALL} from ranked where flagged = 0 or rank = 1",
    "param_query": ctes("universe", "download_results") + f""", {DOWNLOAD_LOG}
        select a.asset_type, l.status, count(*) as n,
          cast(sum(l.rows_downloaded) as bigint) as row_total
        from download_log l join universe a on l.symbol = a.symbol
        where l.rows_downloaded >= 0 and a.exchange <> 'BSE'
        group by a.asset_type, l.status""",
    "param_query_named": ctes("universe", "download_results") + f""", {DOWNLOAD_LOG}
        select a.asset_type, l.status, count(*) as n,
          cast(sum(l.rows_downloaded) as bigint) as row_total
        from download_log l join universe a on l.symbol = a.symbol
        where l.rows_downloaded >= 1 and a.exchange <> 'NSE'
        group by a.asset_type, l.status""",
}
