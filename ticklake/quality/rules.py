"""Row rules as column predicates, evaluated together in one pass.

``flag`` adds one array of the rules a row breaks.  Good rows, quarantined rows and violations are
all read off that array, so validating never shuffles.  Rules about more than one row (duplicates,
null counts) are map-side aggregates.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

CRITICAL, WARNING = "critical", "warning"
FLAGS = "_broken"
FLAG_TYPE = "array<struct<rule:string,severity:string,field:string,message:string>>"


@dataclass(frozen=True)
class Settings:
    """Thresholds; ``as_of`` stands for now, so a rerun gives the same verdict."""

    as_of: str
    max_price_change_pct: float = 20.0
    max_freshness_hours: int = 48
    turnover_tolerance_pct: float = 10.0
    first_date: str = "1990-01-01"


@dataclass(frozen=True)
class Check:
    """One predicate that is true for a bad row."""

    rule: str
    severity: str
    field: str
    bad: Column
    message: Column


# The names a column may have.
NAMES = {
    "volume": ("volume", "TtlTradgVol"), "turnover": ("turnover", "TtlTrfVal"), "close": ("close", "ClsPric"),
    "prev_close": ("prev_close", "PrvsClsgPric"), "trades": ("trades", "TtlNbOfTxsExctd"),
}
PRICE_WORDS = ("pric", "price", "open", "high", "low", "close")
VOLUME_WORDS = ("vol", "volume", "qty")
NUMERIC = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType)


def _say(*parts: object) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(str(p)) for p in parts])


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("null"))


class _Rules:
    """Builders of checks; each gives none when its columns are absent."""

    def __init__(self, schema: T.StructType, settings: Settings):
        self.schema = schema
        self.cols = schema.names
        self.s = settings

    def _pick(self, *names: str) -> list[Column] | None:
        found = []
        for n in names:
            hit = next((c for c in NAMES.get(n, (n,)) if c in self.cols), None)
            if hit is None:
                return None
            found.append(F.col(hit))
        return found

    def _millis(self, name: str) -> Column:
        """Epoch milliseconds of a timestamp column, or the column itself where it already holds them."""
        c = F.col(name)
        return c if isinstance(self.schema[name].dataType, T.LongType) else F.unix_millis(c.cast("timestamp"))

    def _date(self, name: str) -> Column:
        """A date column, or whole days since 1970 as one."""
        c = F.col(name)
        return F.date_from_unix_date(c.cast("int")) if isinstance(self.schema[name].dataType, (T.LongType, T.IntegerType)) else c

    def high_below_low(self):
        if cols := self._pick("high", "low"):
            h, lo = cols
            yield Check("high_below_low", CRITICAL, "high,low", h < lo, _say("high ", _text(h), " < low ", _text(lo)))

    def _outside(self, name: str):
        if cols := self._pick(name, "low", "high"):
            c, lo, h = cols
            yield Check(f"{name}_outside_range", CRITICAL, name, (c < lo) | (c > h), _say(name, " ", _text(c), " outside low-high"))

    def close_outside_range(self):
        yield from self._outside("close")

    def open_outside_range(self):
        yield from self._outside("open")

    def trades_without_volume(self):
        if cols := self._pick("volume", "trades"):
            v, t = cols
            yield Check("trades_without_volume", CRITICAL, "volume,trades", (v == 0) & (t > 0), _say("no volume with ", _text(t), " trades"))

    def turnover_deviates(self):
        if cols := self._pick("volume", "turnover", "close"):
            v, t, c = cols
            expected = v * c
            # try_divide: a zero close expects nothing and is judged by other rules
            deviation = F.try_divide(F.abs(t - expected), expected) * 100
            bad = (v > 0) & (t > 0) & (deviation > self.s.turnover_tolerance_pct)
            yield Check("turnover_deviates", WARNING, "turnover,volume", bad, _say("turnover off by ", _text(F.round(deviation, 1)), "%"))

    def price_jump(self):
        if cols := self._pick("close", "prev_close"):
            c, p = cols
            change = F.try_divide(F.abs(c - p), p) * 100
            bad = (p > 0) & (change > self.s.max_price_change_pct)
            yield Check("price_jump", WARNING, "close", bad, _say("price changed ", _text(F.round(change, 1)), "%"))

    def bad_adjustment_factor(self):
        if cols := self._pick("adjustment_factor", "adjustment_date"):
            f, d = cols
            yield Check("bad_adjustment_factor", CRITICAL, "adjustment_factor", d.isNotNull() & (f <= 0), _say("factor ", _text(f)))

    def stale(self):
        if self._pick("event_time", "ingest_time"):
            hours = (self._millis("ingest_time") - self._millis("event_time")) / 3_600_000
            yield Check("stale", WARNING, "ingest_time,event_time", hours > self.s.max_freshness_hours, _say("ingested after ", _text(F.round(hours, 1)), " h"))

    def impossible_time(self):
        limit = F.unix_millis(F.lit(self.s.as_of).cast("timestamp")) + 3_600_000
        for name in ("event_time", "ingest_time"):
            if name in self.cols:
                ms = self._millis(name)
                yield Check("impossible_time", CRITICAL, name, (ms < 0) | (ms > limit), _say(name, " ", _text(F.col(name))))

    def _negative(self, rule: str, words: tuple[str, ...]):
        for f in self.schema.fields:
            if isinstance(f.dataType, NUMERIC) and any(w in f.name.lower() for w in words):
                yield Check(rule, CRITICAL, f.name, F.col(f.name) < 0, _say(f.name, " ", _text(F.col(f.name))))

    def negative_price(self):
        yield from self._negative("negative_price", PRICE_WORDS)

    def negative_volume(self):
        yield from self._negative("negative_volume", VOLUME_WORDS)

    def date_out_of_range(self):
        if "trade_date" in self.cols:
            d = self._date("trade_date")
            last = F.date_add(F.lit(self.s.as_of).cast("date"), 1)
            bad = (d < F.lit(self.s.first_date).cast("date")) | (d > last)
            yield Check("date_out_of_range", CRITICAL, "trade_date", bad, _say("date ", _text(d)))

    def trading_day_without_volume(self):
        if cols := self._pick("is_trading_day", "volume"):
            t, v = cols
            yield Check("trading_day_without_volume", WARNING, "is_trading_day,volume", t & (v == 0), _say("trading day without volume"))


ROW_RULES = (
    "high_below_low", "close_outside_range", "open_outside_range", "trades_without_volume", "turnover_deviates",
    "price_jump", "bad_adjustment_factor", "stale", "impossible_time", "negative_price", "negative_volume",
    "date_out_of_range", "trading_day_without_volume",
)
#: rules that only make sense for price tables
PRICE_TABLE_RULES = ROW_RULES[:7] + ("trading_day_without_volume",)


def checks_for(df: DataFrame, settings: Settings, rules: Iterable[str] = ROW_RULES) -> list[Check]:
    built = _Rules(df.schema, settings)
    return [c for r in rules for c in getattr(built, r)()]


def rules_for_table(table: str, everything: bool = False) -> tuple[str, ...]:
    """Price tables get all rules, other tables the general ones."""
    if everything or "ohlc" in table:
        return ROW_RULES
    return tuple(r for r in ROW_RULES if r not in PRICE_TABLE_RULES)


def contract_checks(contract: dict[str, dict], columns: list[str]) -> list[Check]:
    """Checks of a row contract; a null fails only ``required``."""
    out = []
    for name, want in contract.items():
        if name not in columns:
            if want.get("required"):
                out.append(Check("contract", CRITICAL, name, F.lit(True), _say(name, " is absent")))
            continue
        c = F.col(name)
        if want.get("required"):
            out.append(Check("contract", CRITICAL, name, c.isNull(), _say(name, " is required")))
        if "minimum" in want:
            out.append(Check("contract", CRITICAL, name, c < want["minimum"], _say(name, " below ", want["minimum"])))
        if "above" in want:
            out.append(Check("contract", CRITICAL, name, c <= want["above"], _say(name, " not above ", want["above"])))
        if "min_length" in want:
            out.append(Check("contract", CRITICAL, name, F.length(c) < want["min_length"], _say(name, " too short")))
        if "one_of" in want:
            out.append(Check("contract", CRITICAL, name, ~c.isin(*want["one_of"]), _say(name, " not allowed: ", _text(c))))
        if "pattern" in want:
            out.append(Check("contract", CRITICAL, name, ~c.rlike(want["pattern"]), _say(name, " does not match")))
    return out


def contract_type_errors(contract: dict[str, dict], schema: T.StructType) -> list[tuple[str, str, str]]:
    """(field, agreed type, actual type); fields outside the contract count as 'absent'."""
    actual = {f.name: f.dataType.simpleString() for f in schema.fields}
    wrong = [(n, w["type"], actual[n]) for n, w in contract.items() if n in actual and actual[n] != w["type"]]
    return wrong + [(n, "absent", t) for n, t in actual.items() if n not in contract]


@dataclass
class Registry:
    """Extra rules: a predicate per row, or a function from the table to violation rows.

    A rule that cannot be planned on the table is logged and skipped.
    """

    predicates: dict[str, Callable[[DataFrame], Check]] = field(default_factory=dict)
    tables: dict[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)
    skipped: list[str] = field(default_factory=list)

    def checks(self, df: DataFrame) -> list[Check]:
        out = []
        for name, build in self.predicates.items():
            try:
                check = build(df)
                df.select(check.bad, check.message)
            except PySparkException as exc:
                log.warning("rule %s skipped: %s", name, exc)
                self.skipped.append(name)
                continue
            out.append(check)
        return out

    def table_violations(self, df: DataFrame) -> list[DataFrame]:
        out = []
        for name, build in self.tables.items():
            try:
                out.append(build(df))
            except PySparkException as exc:
                log.warning("rule %s skipped: %s", name, exc)
                self.skipped.append(name)
        return out


def breaks_any(checks: list[Check]) -> Column:
    """Whether a row breaks any rule, for steps that need no reasons; an unknown (null) verdict is not a violation."""
    return reduce(lambda a, b: a | b, [F.coalesce(c.bad, F.lit(False)) for c in checks], F.lit(False))


def flag(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Add the array of broken rules; an unknown (null) verdict is not a violation."""
    each = [
        F.when(c.bad, F.struct(F.lit(c.rule).alias("rule"), F.lit(c.severity).alias("severity"), F.lit(c.field).alias("field"), c.message.alias("message")))
        for c in checks
    ]
    broken = F.array_compact(F.array(*each)) if each else F.array()
    return df.withColumn(FLAGS, broken.cast(FLAG_TYPE))


def violations(df: DataFrame, checks: list[Check], key: str = "event_id") -> DataFrame:
    """One row per broken rule."""
    return flag(df, checks).select(key, F.inline(FLAGS))


def duplicate_violations(df: DataFrame, key: list[str], row_id: str = "event_id") -> DataFrame:
    """One violation per duplicated key, on its smallest row id; copies are counted, never collected."""
    return (
        df.groupBy(*key)
        .agg(F.min(row_id).alias(row_id), F.count("*").alias("_n"))
        .filter("_n > 1")
        .select(
            row_id, F.lit("duplicate_key").alias("rule"), F.lit(CRITICAL).alias("severity"), F.lit(",".join(key)).alias("field"),
            F.concat_ws(" ", F.lit("copies"), "_n").alias("message"),
        )
    )


def critical_fields(table: str) -> tuple[str, ...]:
    if "ohlc" not in table:
        return ()
    return ("open", "high", "low", "close", *(("volume", "turnover") if "normalized" in table else ()))


def null_violations(df: DataFrame, fields: Iterable[str], row_id: str = "event_id") -> DataFrame:
    """One violation per critical field that has nulls, with their number; one pass for all fields."""
    present = [f for f in fields if f in df.columns]
    row = df.agg(
        *[F.count_if(F.col(f).isNull()).alias(f"n_{f}") for f in present],
        *[F.min(F.when(F.col(f).isNull(), F.col(row_id))).alias(f"i_{f}") for f in present],
    )
    entries = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"n_{f}").alias("n"), F.col(f"i_{f}").alias(row_id)) for f in present])
    return (
        row.select(F.inline(entries))
        .filter("n > 0")
        .select(row_id, F.lit("null_field").alias("rule"), F.lit(CRITICAL).alias("severity"), "field", F.concat_ws(" ", "n", F.lit("nulls")).alias("message"))
    )


# States of an instrument, and the form of its international number.
INSTRUMENT_STATES = ("ACTIVE", "SUSPENDED", "DELISTED")
ISIN_PATTERN = "^[A-Z0-9]{12}$"


def _present(columns: Iterable[str], checks: Iterable[tuple[tuple[str, ...], Check]]) -> list[Check]:
    """The checks whose columns are all there."""
    have = set(columns)
    return [check for needed, check in checks if have.issuperset(needed)]


def _order_check(rule: str, field: str, later: str, earlier: str) -> tuple[tuple[str, ...], Check]:
    """``later`` must not lie before ``earlier``; nulls pass."""
    return (later, earlier), Check(rule, CRITICAL, field, F.col(later) < F.col(earlier), _say(later, " ", _text(F.col(later)), " before ", earlier, " ", _text(F.col(earlier))))


def master_checks(columns: Iterable[str], states: tuple[str, ...] = INSTRUMENT_STATES) -> list[Check]:
    """Symbol master: known state, ordered validity, form of the ISIN, positive lot.  Nulls pass."""
    return _present(
        columns,
        [
            (("status",), Check("status_unknown", CRITICAL, "status", ~F.col("status").isin(*states), _say("status ", _text(F.col("status"))))),
            (("valid_from", "valid_to"), Check("valid_range", CRITICAL, "valid_from", F.col("valid_from") > F.col("valid_to"), _say("valid from ", _text(F.col("valid_from"))))),
            (("isin",), Check("isin_format", WARNING, "isin", ~F.col("isin").rlike(ISIN_PATTERN), _say("isin ", _text(F.col("isin"))))),
            (("lot_size",), Check("lot_not_positive", CRITICAL, "lot_size", F.col("lot_size") <= 0, _say("lot ", _text(F.col("lot_size"))))),
        ],
    )


def action_checks(columns: Iterable[str]) -> list[Check]:
    """Corporate actions: order of their dates, positive factor (0 for dividends too), a purpose.  Null dates pass."""
    factor = F.col("adjustment_factor")
    return _present(
        columns,
        [
            _order_check("record_before_ex", "record_date", "record_date", "ex_date"),
            _order_check("ex_before_announcement", "ex_date", "ex_date", "announcement_date"),
            _order_check("closure_order", "book_closure_end_date", "book_closure_end_date", "book_closure_start_date"),
            (
                ("adjustment_factor", "action_type"),
                Check("factor_not_positive", CRITICAL, "adjustment_factor", (factor < 0) | ((factor == 0) & (F.col("action_type") != "DIVIDEND")), _say("factor ", _text(factor))),
            ),
            (("purpose",), Check("purpose_empty", CRITICAL, "purpose", F.trim(F.coalesce("purpose", F.lit(""))) == "", _say("no purpose"))),
        ],
    )


def calendar_checks(columns: Iterable[str]) -> list[Check]:
    """Trading calendar: an open segment on open days, sessions in order, clearing and settlement not too early."""
    none_open = ~F.exists("segments", lambda s: s["is_open"])
    times = ("pre_open_start", "pre_open_end", "normal_open", "normal_close")
    out_of_order = reduce(lambda a, b: a | b, [F.coalesce(F.col(x) >= F.col(y), F.lit(False)) for x, y in zip(times, times[1:], strict=False)])
    return _present(
        columns,
        [
            (("is_trading_day", "segments"), Check("open_day_without_segment", CRITICAL, "segments", F.col("is_trading_day") & none_open, _say("no open segment"))),
            (times, Check("session_order", CRITICAL, "pre_open_start", out_of_order, _say("session times out of order"))),
            _order_check("clearing_before_trade", "clearing_date", "clearing_date", "trade_date"),
            _order_check("settlement_before_clearing", "settlement_date", "settlement_date", "clearing_date"),
        ],
    )
