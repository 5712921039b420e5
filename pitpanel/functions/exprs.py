"""Column builders for cleaning, classifying and scoring; every one stays inside whole-stage codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def finite(x: Column | str) -> Column:
    """A double, with NaN and the infinities as null."""
    d = c(x).cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != F.lit(float("inf"))), d)


def number(text: Column | str) -> Column:
    """A number in text: blanks around it, thousands commas and one trailing % are dropped; not finite is null."""
    plain = F.regexp_replace(F.trim(c(text)), ",|%$", "")
    return finite(F.when(plain.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), plain).try_cast("double"))


def missing(x: Column | str, text: bool = True) -> Column:
    """Null, NaN, or (text) blank."""
    return c(x).isNull() | (F.trim(c(x)) == "") if text else c(x).isNull() | F.isnan(c(x))


def code6(x: Column | str) -> Column:
    """A six-digit code from 1, 1.0 or an exchange prefix and digits; else null."""
    digits = F.regexp_extract(F.lower(F.trim(c(x))), r"^(?:(?:sh|sz)\.)?(\d{1,6})(?:\.0)?$", 1)
    return F.when(digits != "", F.lpad(digits, 6, "0"))


def security_id(x: Column | str) -> Column:
    """Exchange letters and six digits in upper case, or null."""
    clean = F.upper(F.trim(c(x)))
    return F.when(clean.rlike("^(SH|SZ|BJ)[0-9]{6}$"), clean)


def first_present(columns: list[str], *aliases: str) -> Column:
    """The first alias that is a column at all, even if null in a row; a plan-time choice."""
    for a in aliases:
        if a in columns:
            return F.col(a)
    return F.lit(None)


def first_finite(*aliases: Column | str) -> Column:
    """The first alias with a finite number in the row."""
    return F.coalesce(*(finite(a) for a in aliases))


def business_instant(text: Column | str, zone: str = "Asia/Shanghai", end_of_day: bool = False) -> Column:
    """Text of a date or of a local time as an instant; a bare date is the start or the end of its day."""
    t = F.trim(c(text))
    day = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(t, F.lit(" 23:59:59" if end_of_day else " 00:00:00")))
    full = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}$"), F.regexp_replace(t, "T", " "))
    return F.to_utc_timestamp(F.coalesce(day, full).try_cast("timestamp"), zone)


def report_date(text: Column | str) -> Column:
    """A date from ``2024-01-31`` or the same followed by midnight; nothing else."""
    return F.regexp_extract(c(text), r"^(\d{4}-\d{2}-\d{2})(?: 00:00:00)?$", 1).try_cast("date")


def period_kind(day: Column | str) -> Column:
    """FY, H1, Q1, Q3 by the period's last day, else OTHER."""
    md = F.date_format(c(day), "MM-dd")
    return F.when(md == "12-31", "FY").when(md == "06-30", "H1").when(md == "03-31", "Q1").when(md == "09-30", "Q3").otherwise("OTHER")


def decimal_text(x: Column | str) -> Column:
    """A decimal as text without trailing zeros or a bare dot; minus zero is 0."""
    t = c(x).cast("string")
    short = F.when(t.contains("."), F.regexp_replace(t, r"\.?0+$", "")).otherwise(t)
    return F.when(short == "-0", "0").otherwise(short)


def grade(score: Column | str, bands: tuple = ((90, "A+"), (80, "A"), (70, "B"), (60, "C"), (50, "D")), rest: str = "E") -> Column:
    """The first band whose bound the unrounded score reaches; null stays null."""
    s = c(score)
    return F.when(s.isNull(), None).otherwise(reduce(lambda e, b: F.when(s >= b[0], b[1]).otherwise(e), reversed(bands), F.lit(rest)))


def compare(op: Column | str, left: Column | str, right: Column | str) -> Column:
    """lt, lte, gt, gte or eq, chosen by data; null for another operator or a null side."""
    o, x, y = c(op), c(left), c(right)
    return F.when(o == "lt", x < y).when(o == "lte", x <= y).when(o == "gt", x > y).when(o == "gte", x >= y).when(o == "eq", x == y)


def flag_state(flags: Column | str, flag: str) -> Column:
    """From an array of (flag_id, active): active, inactive, absent (not false) or duplicate."""
    own = F.filter(c(flags), lambda f: f["flag_id"] == flag)
    return F.when(F.size(own) > 1, "duplicate").when(F.size(own) < 1, "absent").when(F.try_element_at(own, F.lit(1))["active"], "active").otherwise("inactive")


def share(x: Column | str) -> Column:
    """0 to 1 as is, above 1 to 100 as per cent, else null."""
    v = finite(x)
    return F.when((v >= 0) & (v <= 1), v).when((v > 1) & (v <= 100), v / 100)


def violations(**rules: Column) -> Column:
    """The names of the rules that a row breaks, in the order given; a rule that is null is broken."""
    return F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())))


def symmetric_growth(now: Column | str, before: Column | str) -> Column:
    """200 (now - before) / (|now| + |before|); null where both are 0."""
    x, y = c(now), c(before)
    return F.try_divide(200 * (x - y), F.abs(x) + F.abs(y))


def positive_cagr(start: Column | str, end: Column | str, years: int) -> Column:
    """Yearly growth in per cent, only between positive ends."""
    s, e = c(start), c(end)
    return F.when((s > 0) & (e > 0), 100 * (F.pow(e / s, F.lit(1.0 / years)) - 1))


def rescaled(value: Column | str, current: Column | str, normal: Column | str) -> Column:
    """value * normal / current; null where current is 0."""
    return F.try_divide(c(value) * c(normal), c(current))


def row_hash(*columns: str) -> Column:
    """SHA-256 over the columns' text in the given order; null is told from the empty text."""
    return F.sha2(F.concat_ws("\x1f", *(F.coalesce(F.col(x).cast("string"), F.lit("\x00")) for x in columns)), 256)


def effective_at(precision: Column | str, instant: Column | str, next_close: Column | str) -> Column:
    """A timestamp counts as it stands, a bare date from the next session's close."""
    return F.when(c(precision) == "timestamp", c(instant)).when(c(precision) == "date_only", c(next_close))


def visible(cutoff: Column, *instants: str, optional: tuple[str, ...] = ()) -> Column:
    """All instants known and no later than the cutoff; optional ones may be null."""
    need = [F.coalesce(F.col(i) <= cutoff, F.lit(False)) for i in instants]
    return reduce(lambda a, b: a & b, need + [F.col(i).isNull() | (F.col(i) <= cutoff) for i in optional])


def session_date(instant: Column | str, cut: str = "15:30:00") -> Column:
    """The last completed weekday session at a local instant."""
    t = c(instant)
    day = F.when(F.date_format(t, "HH:mm:ss") >= cut, F.to_date(t)).otherwise(F.date_sub(F.to_date(t), 1))
    return F.date_sub(day, F.when(F.dayofweek(day) == 7, 1).when(F.dayofweek(day) == 1, 2).otherwise(0))


def conjunction(*parts: Column) -> Column:
    """Three-valued AND: one proven false settles it, else null if any is unknown."""
    return reduce(lambda a, b: a & b, parts)
