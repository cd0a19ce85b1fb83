"""Data-quality checks over all assets in one pass.

Every check contributes counters to two shared aggregations and a verdict over the results:

1. bars -> (asset, span of 16 days): row counters and the number of rows of each day, combined
   map-side. Neither an asset nor a day with a very large share of the rows is ever gathered in
   one task, and what is shuffled is one row per span instead of one per bar.
2. (asset, span) -> asset: date counters, which see a span's dates as bits, how many rows repeat
   a date, and the gap to the asset's previous span. The calendar bounds the spans of an asset,
   and so the window that finds the previous one, whatever the number of bars.

Checks that need no dates skip step 1 and aggregate bars straight to assets. Conditions are SQL
text over bar columns, which keeps added checks short. Beside counters, a check may ask for any
aggregate that merges (`Aggregate`): sums, extremes, sketches of quantiles or of distinct values.
They take the same way, bars -> span -> asset, in the same pass.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.coercion import nan_to_null
from barloom.schema import ASSET_KEY, FAILED, PASSED, PRICE_COLUMNS, SKIPPED, WARNING

# Fixed values of the rules.
DEFAULT_MAX_GAP_DAYS = 5
VERY_LARGE_GAP_DAYS = 15
EARLIEST_DATE = date(1990, 1, 1)
CRITICAL_COLUMNS = ["date"] + PRICE_COLUMNS + ["volume"]

# The three independent price rules, each as "this bar breaks it"; missing prices break none.
OHLC_RULES = {
    "high_lt_low": "coalesce(high < low, false)",
    "open_out_of_range": "coalesce(open > high, false) or coalesce(open < low, false)",
    "close_out_of_range": "coalesce(close > high, false) or coalesce(close < low, false)",
}

SPAN_BITS = 4
SPAN_DAYS = 1 << SPAN_BITS
# Rows on each day of a span.
DAY_ROWS = [f"day_{i}" for i in range(SPAN_DAYS)]


@dataclass(frozen=True)
class Settings:
    """What verdicts depend on besides the bars; `as_of` stands for "today"."""

    as_of: date
    max_gap_days: int = DEFAULT_MAX_GAP_DAYS

    def __post_init__(self) -> None:
        if self.max_gap_days < 0:
            raise ValueError("max_gap_days must not be negative")


@dataclass(frozen=True)
class Outcome:
    """What a check reports where `when` holds; SQL over the counters, except the status."""

    when: str
    status: str
    message: str
    rows: str
    details: str = "null"


@dataclass(frozen=True)
class Aggregate:
    """An aggregate of an asset's bars, as SQL in two steps.

    part: aggregate over bars, for a span or any other part of them.
    merge: aggregate that joins parts, with `{}` for the column that holds them. Parts are merged more
    than once where summaries are kept, so it has to give what `part` gives.
    """

    part: str
    merge: str

    def merged(self, name: str) -> str:
        return f"{self.merge.format(name)} as {name}"


def extreme(function: str, column: str) -> Aggregate:
    """The least or greatest value of a column (`min` or `max`)."""
    return Aggregate(f"{function}({column})", f"{function}({{}})")


def exact_sum(column: str) -> Aggregate:
    """A sum to six decimals that doesn't depend on the order of bars."""
    return Aggregate(
        f"cast(sum(cast({column} as decimal(24,6))) as decimal(38,6))",
        "cast(sum({}) as decimal(38,6))")


def distinct_sketch(column: str) -> Aggregate:
    """A HyperLogLog sketch; `hll_sketch_estimate(name)` is the number of distinct values."""
    return Aggregate(f"hll_sketch_agg({column})", "hll_union_agg({})")


@dataclass(frozen=True)
class Check:
    """One check. Counter names must be unique among the checks that run together.

    row_counters: name -> condition on a bar; the number of bars it holds for.
    aggregates: name -> Aggregate; what outcomes may use beside counters.
    date_counters: name -> aggregate over an asset's spans (columns as date_spans gives them).
    outcomes: the first that applies is reported, else PASSED with the message `fine`.
    """

    name: str
    outcomes: Callable[[Settings, Sequence[str]], list[Outcome]]
    fine: Callable[[Settings], str]
    row_counters: Callable[[Settings, Sequence[str]], dict[str, str]] = lambda s, c: {}
    aggregates: Callable[[Settings, Sequence[str]], dict[str, Aggregate]] = lambda s, c: {}
    date_counters: Callable[[Settings], dict[str, str]] = lambda s: {}
    needs: Sequence[str] = field(default_factory=tuple)
    needs_any: Sequence[str] = field(default_factory=tuple)
    on_missing: str = ""
    on_empty: str = ""

    def runs_on(self, columns: Sequence[str]) -> bool:
        some = not self.needs_any or bool(set(self.needs_any) & set(columns))
        return set(self.needs) <= set(columns) and some


def quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def result_sql(name: str, status: str, message: str, rows: str = "0", details: str = "null") -> str:
    """A result struct; `message`, `rows` and `details` are SQL."""
    return (
        f"named_struct('check_name', {quoted(name)}, 'status', {quoted(status)}, "
        f"'message', {message}, 'details', cast({details} as map<string,bigint>), "
        f"'rows_affected', cast({rows} as bigint))"
    )


def skipped_sql(name: str, message: str) -> str:
    return result_sql(name, SKIPPED, quoted(message))


def verdict_sql(check: Check, settings: Settings, columns: Sequence[str]) -> str:
    """The check's result struct from its counters; skipped where columns are missing."""
    if not check.runs_on(columns):
        return skipped_sql(check.name, check.on_missing)
    branches = " ".join(
        f"when {o.when} then {result_sql(check.name, o.status, o.message, o.rows, o.details)}"
        for o in check.outcomes(settings, columns)
    )
    fine = result_sql(check.name, PASSED, quoted(check.fine(settings)))
    return f"case {branches} else {fine} end"


def verdicts_sql(checks: Sequence[Check], settings: Settings, columns: Sequence[str]) -> str:
    """Result structs of all checks in order, as one array."""
    return f"array({', '.join(verdict_sql(c, settings, columns) for c in checks)})"


def non_zero(counters: dict[str, str]) -> str:
    """A map of label -> counter that leaves out the zero counters."""
    entries = ", ".join(f"{quoted(label)}, {counter}" for label, counter in counters.items())
    return f"map_filter(map({entries}), (k, n) -> n > 0)"


def found(counter: str, what: str) -> str:
    return f"concat('Found ', {counter}, {quoted(' ' + what)})"


def _gap_outcomes(settings: Settings, _: Sequence[str]) -> list[Outcome]:
    gaps = found("large_gaps", f"gaps > {settings.max_gap_days} days")
    return [
        Outcome(
            f"large_gaps > 0 and widest_gap > {VERY_LARGE_GAP_DAYS}", WARNING,
            f"concat({gaps}, ' (max gap: ', widest_gap, ' days)')", "large_gaps",
            "map('max_gap_days', cast(widest_gap as bigint), 'gap_count', large_gaps)",
        ),
        Outcome("large_gaps > 0", WARNING, gaps, "large_gaps", "map('gap_count', large_gaps)"),
    ]


def _null_counters(columns: Sequence[str]) -> dict[str, str]:
    return {c: f"null_{c}" for c in CRITICAL_COLUMNS if c in columns}


def _null_outcomes(_: Settings, columns: Sequence[str]) -> list[Outcome]:
    counters = _null_counters(columns)
    total = f"({' + '.join(counters.values())})"
    return [Outcome(
        f"{total} > 0", WARNING, found(total, "null values across critical columns"), total,
        non_zero(counters),
    )]


def gaps_inside(max_gap_days: int) -> str:
    """How many gaps inside a span are wider than the limit: SQL over its `days` bits.

    A day ends such a gap if none of the `max_gap_days` bits before it is set; that also holds for
    the span's first day, which ends the gap between spans instead.
    """
    reach = range(1, min(max_gap_days, SPAN_DAYS - 1) + 1)
    earlier = " | ".join(["0", *(f"shiftleft(days, {n})" for n in reach)])
    return f"greatest(bit_count(days & ~({earlier})) - 1, 0)"


def rows_on(comparison: str, day: date) -> str:
    """How many of a span's rows have dates that compare so with a day: SQL over its day counts."""
    number = (day - date(1970, 1, 1)).days
    return " + ".join(
        f"if(span_start + {i} {comparison} {number}, {n}, 0L)" for i, n in enumerate(DAY_ROWS))


_OHLC_TOTAL = f"({' + '.join(OHLC_RULES)})"

DUPLICATES = Check(
    name="duplicates",
    date_counters=lambda s: {"duplicate_rows": "sum(repeated_rows)"},
    outcomes=lambda s, c: [Outcome(
        "duplicate_rows > 0", FAILED, found("duplicate_rows", "duplicate rows by date"),
        "duplicate_rows",
    )],
    fine=lambda s: "No duplicate dates found",
    needs=["date"],
    on_missing="No 'date' column found",
    on_empty="Empty DataFrame",
)
MISSING_TRADING_DAYS = Check(
    name="missing_trading_days",
    date_counters=lambda s: {
        "large_gaps":
            f"sum(if(lead_gap > {s.max_gap_days}, 1L, 0L) + {gaps_inside(s.max_gap_days)})",
        # Wide enough to be named are only gaps between spans.
        "widest_gap": "max(lead_gap)",
    },
    outcomes=_gap_outcomes,
    fine=lambda s: f"No gaps larger than {s.max_gap_days} days",
    needs=["date"],
    on_missing="Insufficient data",
    on_empty="Insufficient data",
)
OHLC_CONSISTENCY = Check(
    name="ohlc_consistency",
    row_counters=lambda s, c: OHLC_RULES,
    outcomes=lambda s, c: [Outcome(
        f"{_OHLC_TOTAL} > 0", FAILED, found(_OHLC_TOTAL, "OHLC consistency violations"),
        _OHLC_TOTAL, non_zero({rule: rule for rule in OHLC_RULES}),
    )],
    fine=lambda s: "All OHLC values are consistent",
    needs=PRICE_COLUMNS,
    on_missing="Missing required OHLC columns",
    on_empty="Missing required OHLC columns",
)
NEGATIVE_VOLUME = Check(
    name="negative_volume",
    row_counters=lambda s, c: {"negative_volumes": "volume < 0"},
    outcomes=lambda s, c: [Outcome(
        "negative_volumes > 0", FAILED, found("negative_volumes", "rows with negative volume"),
        "negative_volumes",
    )],
    fine=lambda s: "No negative volume values",
    needs=["volume"],
    on_missing="No 'volume' column found",
    on_empty="No 'volume' column found",
)
NULL_VALUES = Check(
    name="null_values",
    row_counters=lambda s, columns: {
        counter: f"{c} is null" for c, counter in _null_counters(columns).items()
    },
    outcomes=_null_outcomes,
    fine=lambda s: "No null values in critical columns",
    needs_any=CRITICAL_COLUMNS,
    on_missing="No critical columns found",
    on_empty="Empty DataFrame",
)
DATA_RANGE = Check(
    name="data_range",
    date_counters=lambda s: {
        "future_dates": f"sum({rows_on('>', s.as_of)})",
        "old_dates": f"sum({rows_on('<', EARLIEST_DATE)})",
    },
    outcomes=lambda s, c: [
        Outcome("future_dates > 0", FAILED, found("future_dates", "rows with future dates"),
                "future_dates"),
        Outcome("old_dates > 0", WARNING, found("old_dates", "rows before 1990"), "old_dates"),
    ],
    fine=lambda s: "All dates within expected range",
    needs=["date"],
    on_missing="Insufficient data",
    on_empty="Insufficient data",
)


def price_outliers(factor: int = 4) -> Check:
    """An added check: closes above `factor` times the asset's mean close, or below it by as much."""
    mean = "(close_sum / valued_closes)"
    high, low = f"(highest_close > {factor} * {mean})", f"(lowest_close * {factor} < {mean})"
    return Check(
        name="price_outliers",
        row_counters=lambda s, c: {"valued_closes": "close is not null"},
        aggregates=lambda s, c: {
            "close_sum": exact_sum("close"), "highest_close": extreme("max", "close"),
            "lowest_close": extreme("min", "close"),
        },
        outcomes=lambda s, c: [
            Outcome(f"{high} and {low}", WARNING, quoted("Closes far above and below the mean"), "2L"),
            Outcome(high, WARNING, quoted("Highest close far above the mean"), "1L"),
            Outcome(low, WARNING, quoted("Lowest close far below the mean"), "1L"),
        ],
        fine=lambda s: "All closes near the mean",
        needs=["close"],
        on_missing="No 'close' column found",
        on_empty="No 'close' column found",
    )


def stale_prices(at_most: int = 2, min_rows: int = 10) -> Check:
    """An added check: `at_most` distinct closes in `min_rows` bars or more.

    Distinct closes are counted by a sketch, which is exact for the few that matter here.
    """
    distinct = "hll_sketch_estimate(close_sketch)"
    return Check(
        name="stale_prices",
        row_counters=lambda s, c: {"priced_rows": "close is not null"},
        aggregates=lambda s, c: {"close_sketch": distinct_sketch("cast(close as string)")},
        outcomes=lambda s, c: [Outcome(
            f"priced_rows >= {min_rows} and {distinct} <= {at_most}", WARNING,
            found(distinct, "distinct closes"), "priced_rows",
            f"map('distinct_closes', {distinct})",
        )],
        fine=lambda s: "Closes change",
        needs=["close"],
        on_missing="No 'close' column found",
        on_empty="No 'close' column found",
    )


# In report order.
ALL_CHECKS = (
    DUPLICATES, MISSING_TRADING_DAYS, OHLC_CONSISTENCY, NEGATIVE_VOLUME, NULL_VALUES, DATA_RANGE,
)


def span_counts(
    bars: DataFrame, counters: dict[str, str] | None = None, by: Sequence[str] = ASSET_KEY,
    aggregates: dict[str, Aggregate] | None = None,
) -> DataFrame:
    """One row per asset and span of 16 days that has bars: the mergeable part of `date_spans`.

    Columns: the key, span (null for bars without a date), span_rows, the counters, the aggregates
    and DAY_ROWS. All but key, span and aggregates are sums, so counts of parts of the bars add up to
    those of all of them, wherever the parts were cut; aggregates merge as they say.
    """
    return (
        bars.withColumn("_day", F.expr("unix_date(date)"))
        .withColumn("span", F.expr(f"shiftright(_day, {SPAN_BITS})"))
        .groupBy(*by, "span")
        .agg(*[F.expr(e) for e in (
            "count(1) as span_rows",
            *[f"count_if({condition}) as {name}" for name, condition in (counters or {}).items()],
            *[f"{a.part} as {name}" for name, a in (aggregates or {}).items()],
            *[f"count_if(_day & {SPAN_DAYS - 1} = {i}) as {n}" for i, n in enumerate(DAY_ROWS)],
        )])
    )


def merged_counts(
    counts: DataFrame, by: Sequence[str] = ASSET_KEY,
    aggregates: dict[str, Aggregate] | None = None,
) -> DataFrame:
    """Span counts of several parts, or of finer keys, as one row per key and span."""
    aggregates = aggregates or {}
    sums = [c for c in counts.columns if c.startswith("day_") or c == "span_rows"]
    sums += [c for c, kind in counts.dtypes if kind == "bigint" and c != "span"
             and c not in sums and c not in by and c not in aggregates]
    return counts.groupBy(*by, "span").agg(
        *(F.sum(c).alias(c) for c in sums),
        *(F.expr(a.merged(name)) for name, a in aggregates.items()))


#: Rows of a span on days that have more than one: SQL over its counts. Rows without a date repeat
#: each other.
REPEATED_ROWS = (
    "if(span is null, if(span_rows > 1, span_rows, 0L), "
    + " + ".join(f"if({n} > 1, {n}, 0L)" for n in DAY_ROWS) + ")"
)


def spans_of(counts: DataFrame, by: Sequence[str] = ASSET_KEY) -> DataFrame:
    """`date_spans` from span counts that have one row per key and span."""
    kept = [c for c in counts.columns if c != "span"]
    present = [f"if({n} > 0, span * {SPAN_DAYS} + {i}, null)" for i, n in enumerate(DAY_ROWS)]
    spans = counts.selectExpr(
        *kept, "span", f"span * {SPAN_DAYS} as span_start",
        " + ".join(f"if({n} > 0, {1 << i}, 0)" for i, n in enumerate(DAY_ROWS)) + " as days",
        f"{REPEATED_ROWS} as repeated_rows",
        f"coalesce({', '.join(present)}) as _first",
        f"coalesce({', '.join(reversed(present))}) as _last",
    )
    # The span without dates sorts first and has no last day.
    previous = F.lag("_last").over(Window.partitionBy(*by).orderBy("span"))
    return spans.withColumn("_previous", previous).selectExpr(
        *kept, "span_start", "days", "repeated_rows", "_first - _previous as lead_gap"
    )


def date_spans(
    bars: DataFrame, counters: dict[str, str] | None = None, by: Sequence[str] = ASSET_KEY
) -> DataFrame:
    """One row per asset and span of 16 days that has bars.

    Columns: the key, span_rows, the counters, DAY_ROWS, span_start (day number of the span's first
    day), `days` (bit i is set if day i of the span has rows), repeated_rows (rows on days with more
    than one) and lead_gap (days from the asset's previous date to the span's first one). Bars
    without a date are a span of their own that has no days, and repeat each other.
    """
    return spans_of(span_counts(bars, counters, by), by)


def date_gaps(bars: DataFrame, by: Sequence[str] = ASSET_KEY) -> DataFrame:
    """Gaps in calendar days between an asset's consecutive distinct dates."""
    steps = f"""transform(
        filter(sequence(0, {SPAN_DAYS - 1}), i -> getbit(days, i) = 1),
        (i, n) -> struct(span_start + i as day, n))"""
    spans = date_spans(bars, by=by).selectExpr(*by, "lead_gap", f"{steps} as _steps")
    gaps = """inline(transform(_steps, s -> named_struct(
        'date', date_from_unix_date(s.day),
        'gap_days', cast(if(s.n = 0, lead_gap, s.day - _steps[s.n - 1].day) as bigint))))"""
    return spans.selectExpr(*by, gaps).where("gap_days is not null")


def duplicate_rows(bars: DataFrame, by: Sequence[str] = ASSET_KEY) -> DataFrame:
    """Asset dates that occur more than once, with their number of rows."""
    return (
        bars.groupBy(*by, "date").agg(F.count(F.lit(1)).alias("date_rows"))
        .where(F.col("date_rows") > 1)
    )


def row_counters_of(
    checks: Sequence[Check], settings: Settings, columns: Sequence[str]
) -> dict[str, str]:
    """The row counters of the checks that the columns allow."""
    runnable = [c for c in checks if c.runs_on(columns)]
    return {n: x for c in runnable for n, x in c.row_counters(settings, columns).items()}


def aggregates_of(
    checks: Sequence[Check], settings: Settings, columns: Sequence[str]
) -> dict[str, Aggregate]:
    """The aggregates of the checks that the columns allow."""
    runnable = [c for c in checks if c.runs_on(columns)]
    return {n: a for c in runnable for n, a in c.aggregates(settings, columns).items()}


def count_by_asset(
    bars: DataFrame, settings: Settings, checks: Sequence[Check] = ALL_CHECKS,
    by: Sequence[str] = ASSET_KEY,
) -> DataFrame:
    """Per asset: total_rows, and the counters and aggregates of the checks the columns allow."""
    bars = nan_to_null(bars)
    row_counters = row_counters_of(checks, settings, bars.columns)
    extra = aggregates_of(checks, settings, bars.columns)
    if not any(c.date_counters(settings) for c in checks if c.runs_on(bars.columns)):
        aggregates = ["count(1) as total_rows"]
        aggregates += [f"count_if({condition}) as {n}" for n, condition in row_counters.items()]
        aggregates += [f"{a.part} as {n}" for n, a in extra.items()]
        return bars.groupBy(*by).agg(*[F.expr(a) for a in aggregates])
    counts = span_counts(bars, row_counters, by, extra)
    return count_by_asset_of(counts, settings, checks, bars.columns, by)


def count_by_asset_of(
    counts: DataFrame, settings: Settings, checks: Sequence[Check], columns: Sequence[str],
    by: Sequence[str] = ASSET_KEY,
) -> DataFrame:
    """`count_by_asset` from span counts of bars with the given columns, one row per key and span."""
    runnable = [c for c in checks if c.runs_on(columns)]
    date_counters = {n: x for c in runnable for n, x in c.date_counters(settings).items()}
    aggregates = ["sum(span_rows) as total_rows"]
    aggregates += [f"sum({n}) as {n}" for n in row_counters_of(checks, settings, columns)]
    aggregates += [a.merged(n) for n, a in aggregates_of(checks, settings, columns).items()]
    aggregates += [f"{aggregate} as {n}" for n, aggregate in date_counters.items()]
    return spans_of(counts, by).groupBy(*by).agg(*[F.expr(a) for a in aggregates])


def run_checks(
    bars: DataFrame, settings: Settings, checks: Sequence[Check] = ALL_CHECKS,
    by: Sequence[str] = ASSET_KEY, assets: DataFrame | None = None,
) -> DataFrame:
    """One row per asset and check: key, check_name, status, message, details, rows_affected.

    With `assets`, those without bars get the checks' "empty" outcomes as SKIPPED rows.
    """
    counted = count_by_asset(bars, settings, checks, by)
    outcomes = verdicts_sql(checks, settings, bars.columns)
    if assets is not None:
        counted = assets.select(*by).join(counted, list(by), "left")
        empty = ", ".join(skipped_sql(c.name, c.on_empty) for c in checks)
        outcomes = f"if(total_rows is null, array({empty}), {outcomes})"
    return counted.selectExpr(*by, f"inline({outcomes})")
