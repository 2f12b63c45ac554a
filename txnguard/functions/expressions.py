"""Column expressions. All are built-in Spark functions, so they stay inside
whole-stage code generation; no Python UDF is involved."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0  # fixed value of the original haversine helper


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_micros(ts, ntz: bool = True) -> Column:
    """Microseconds since 1970-01-01 00:00.

    ``ntz=True`` (TIMESTAMP_NTZ, wall-clock UTC): built from the date and clock
    fields, which do not depend on the session time zone. ``ntz=False``
    (TIMESTAMP, an instant): ``unix_micros``.
    """
    ts = _c(ts)
    if not ntz:
        return F.unix_micros(ts)
    seconds = F.extract(F.lit("SECOND"), ts)  # decimal(8,6): seconds with fraction
    return (F.unix_date(F.to_date(ts)).cast("long") * F.lit(86_400_000_000)
            + F.hour(ts).cast("long") * F.lit(3_600_000_000)
            + F.minute(ts).cast("long") * F.lit(60_000_000)
            + (seconds * F.lit(1_000_000)).cast("long"))


def zscore(amount="amount", avg="avg_amount", std="stddev_amount", mode: str = "zero") -> Column:
    """Amount z-score against a user baseline.

    mode="zero": (amount-avg)/std when std > 0, else 0.0 (also 0.0 without baseline),
                 as in the enrichment path of the original job.
    mode="unit": std == 0 is replaced by 1; null in -> null out (the pandas helper).
    """
    amount, avg, std = _c(amount), _c(avg), _c(std)
    if mode == "zero":
        return F.when(std > 0, (amount - avg) / std).otherwise(F.lit(0.0))
    if mode == "unit":
        return zscore_unit(amount, avg, std)
    raise ValueError(f"unknown zero_std mode {mode!r}")


def zscore_unit(amount="amount", avg="avg_amount", std="stddev_amount") -> Column:
    amount, avg, std = _c(amount), _c(avg), _c(std)
    return (amount - avg) / F.when(std == 0, F.lit(1.0)).otherwise(std)


def calendar_columns(ts="event_time", tz: str | None = None) -> dict[str, Column]:
    """hour_of_day, day_of_week (1 = Sunday .. 7 = Saturday) and is_weekend.

    ``tz`` shifts a UTC wall-clock value into another calendar zone first.
    """
    t = _c(ts).cast("timestamp_ntz")
    if tz:
        t = F.convert_timezone(F.lit("UTC"), F.lit(tz), t)
    dow = F.dayofweek(t)
    return {
        "hour_of_day": F.hour(t),
        "day_of_week": dow,
        "is_weekend": F.when(dow.isin(1, 7), F.lit(1)).otherwise(F.lit(0)),
    }


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km; any null input gives null.

    The asin argument is clamped with CASE (not ``least``, which skips nulls and
    would turn a missing previous point into a half-circumference distance).
    """
    lat1, lon1, lat2, lon2 = (_c(x) for x in (lat1, lon1, lat2, lon2))
    dphi = F.radians(lat2 - lat1)
    dlam = F.radians(lon2 - lon1)
    a = (F.pow(F.sin(dphi / 2), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlam / 2), 2))
    root = F.sqrt(a)
    root = F.when(root > 1.0, F.lit(1.0)).otherwise(root)
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(root)


def rounded(col, places: int = 6) -> Column:
    """Round a double for engine-independent comparison."""
    return F.round(_c(col), places)


EPOCH_NTZ = "1970-01-01 00:00:00"


def instant_to_utc_ntz(ts) -> Column:
    """TIMESTAMP (instant) -> TIMESTAMP_NTZ wall-clock in UTC, session-zone free."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(ts)),
                           F.lit(EPOCH_NTZ).cast("timestamp_ntz"))


def utc_ntz_to_instant(ts) -> Column:
    """TIMESTAMP_NTZ wall-clock UTC -> TIMESTAMP (instant), session-zone free."""
    return F.timestamp_micros(epoch_micros(_c(ts), ntz=True))


def ntz_literal(value) -> Column:
    """TIMESTAMP_NTZ literal from a naive datetime (or text), built from its text so
    neither the Python process zone nor the session zone can shift it."""
    text = value.strftime("%Y-%m-%d %H:%M:%S.%f") if hasattr(value, "strftime") else str(value)
    return F.lit(text).cast("timestamp_ntz")


def instant_literal(value) -> Column:
    """TIMESTAMP (instant) literal for a naive UTC datetime, zone-free."""
    return utc_ntz_to_instant(ntz_literal(value))
