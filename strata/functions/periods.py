"""Calendar period labels as plain Spark column expressions.

Every function here returns a ``Column`` built from JVM built-ins, so the
labels are computed inside whole-stage codegen next to the scan.  All label
arithmetic is done on ``TIMESTAMP_NTZ`` wall-clock values, which makes the
result independent of ``spark.sql.session.timeZone``:

* ``as_wall_clock`` turns any supported date-like column into UTC wall clock;
* ``period_label`` maps that wall clock to the label of a pandas-style
  frequency (``D``, ``W-SUN``, ``M``, ``QS``, ``2D``, ...).

Label conventions follow pandas' ``Grouper(freq=...)`` defaults: day and
sub-day frequencies are labelled by the period start, ``W``/``M``/``Q``/``A``/
``SM`` by the period end, ``MS``/``QS``/``AS``/``SMS`` by the start.  Quarters and
years take any month as anchor (``Q-OCT``, ``AS-APR``); ``BM``, ``BQ``, ``BA`` end on
the last business day and ``BMS``, ``BQS``, ``BAS`` begin on the first one, so the
weekend at the border belongs to the neighbouring period.
Multiples (``2D``, ``36H``, ``2W``, ``3MS``) are anchored on a fixed origin (the Unix
epoch unless ``anchor`` is given), never on the first row of a batch, so two
partial runs always produce labels that line up.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

# Column metadata key under which a store's period column names its frequency.
FREQ_KEY = "freq"

# Pandas weekday anchors, Monday first (Spark's weekday(): Monday = 0).
WEEKDAY_NAMES = ["MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN"]

# Pandas frequency aliases accepted, mapped to one canonical unit.
UNIT_ALIASES = {
    "D": "D",
    "H": "H", "h": "H",
    "T": "T", "min": "T",
    "S": "S", "s": "S",
    "L": "L", "ms": "L",
    "U": "U", "us": "U",
    "W": "W",
    "M": "M", "ME": "M",
    "MS": "MS",
    "Q": "Q", "QE": "Q",
    "QS": "QS",
    "A": "A", "Y": "A", "YE": "A",
    "AS": "AS", "YS": "AS",
    "B": "B",
    "SM": "SM", "SME": "SM",
    "SMS": "SMS",
    "BM": "BM", "BME": "BM",
    "BMS": "BMS",
    "BQ": "BQ", "BQE": "BQ",
    "BQS": "BQS",
    "BA": "BA", "BY": "BA", "BYE": "BA",
    "BAS": "BAS", "BYS": "BAS",
}

# Microseconds per fixed-length unit.
_UNIT_MICROS = {"D": 86_400_000_000, "H": 3_600_000_000, "T": 60_000_000, "S": 1_000_000, "L": 1_000, "U": 1}

# Month names as pandas anchors write them, January first.
MONTH_NAMES = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]

# Months of a calendar unit (without the B of business units and the S of starts).
_UNIT_MONTHS = {"M": 1, "Q": 3, "A": 12}

_FREQ_RE = re.compile(r"^\s*(\d*)\s*([A-Za-z]+)(?:-([A-Za-z]{3}))?\s*$")


@dataclass(frozen=True)
class Frequency:
    """A parsed pandas-style frequency string."""

    n: int
    unit: str
    weekday: int | None = None  # only for W: 0 = Monday ... 6 = Sunday
    month: int = 0  # anchor of Q and A units: 0 = January ... 11 = December

    @property
    def sub_day(self) -> bool:
        return self.unit in ("H", "T", "S", "L", "U")

    @property
    def months(self) -> int:
        """Months in one period of a calendar unit; 0 for other units."""
        return self.n * _UNIT_MONTHS.get(self.unit.removeprefix("B").removesuffix("S"), 0)

    @property
    def label_format(self) -> str:
        """Spark ``date_format`` pattern that prints a label losslessly."""
        fraction = {"L": ".SSS", "U": ".SSSSSS"}.get(self.unit, "")
        return "yyyy-MM-dd HH:mm:ss" + fraction if self.sub_day else "yyyy-MM-dd"

    def nests_in(self, coarse: Frequency) -> bool:
        """Whether each period of this frequency lies inside one period of
        ``coarse`` and its label too, so that a store can be rolled up
        (multi-unit bins on the default origin)."""
        if self == coarse:
            return True
        fixed = self.n * _UNIT_MICROS.get(self.unit, 0)
        if fixed:
            wide = coarse.n * _UNIT_MICROS.get(coarse.unit, 0)
            return (wide or _UNIT_MICROS["D"]) % fixed == 0
        if self.unit == "W":
            return coarse.unit == "W" and self.weekday == coarse.weekday and coarse.n % self.n == 0
        if self.unit == "SMS":
            return coarse.unit == "SMS" or coarse.months > 0 and not coarse.unit.startswith("B")
        if self.months == 0 or coarse.months == 0 or coarse.months % self.months:
            return False
        if self.unit.startswith("B") or coarse.unit.startswith("B"):
            ends = self.unit.endswith("S") == coarse.unit.endswith("S")
            same = self.unit.startswith("B") and coarse.unit.startswith("B")
            return same and ends and (self.border - coarse.border) % self.months == 0
        return (self.border - coarse.border) % self.months == 0

    @property
    def border(self) -> int:
        """Index (0 = January 1970) of a month that begins a period."""
        step = self.months // self.n
        if self.unit.endswith("S"):
            return self.month % step
        return self.month % step + 1


def parse_frequency(freq: str) -> Frequency:
    m = _FREQ_RE.match(freq or "")
    if not m:
        raise ValueError(f"unsupported frequency {freq!r}")
    n_txt, unit_txt, anchor = m.groups()
    n = int(n_txt) if n_txt else 1
    if n <= 0:
        raise ValueError(f"frequency multiple must be positive: {freq!r}")
    unit = UNIT_ALIASES.get(unit_txt)
    if unit is None:
        raise ValueError(f"unsupported frequency unit in {freq!r}")
    weekday = None
    if unit == "W":
        name = (anchor or "SUN").upper()
        if name not in WEEKDAY_NAMES:
            raise ValueError(f"unsupported weekly anchor in {freq!r}")
        weekday = WEEKDAY_NAMES.index(name)
    month = 0
    if unit.removeprefix("B").removesuffix("S") in ("Q", "A"):
        name = (anchor or ("JAN" if unit.endswith("S") else "DEC")).upper()
        if name not in MONTH_NAMES:
            raise ValueError(f"unsupported anchor in {freq!r}")
        month = MONTH_NAMES.index(name)
    elif anchor is not None and unit != "W":
        raise ValueError(f"unsupported anchor in {freq!r}")
    if n > 1 and unit in ("B", "SM", "SMS"):
        raise ValueError(f"multiples of B, SM and SMS are not supported: {freq!r}")
    return Frequency(n=n, unit=unit, weekday=weekday, month=month)


# --------------------------------------------------------------------------
# Normalisation to UTC wall clock
# --------------------------------------------------------------------------

_EPOCH_UNITS = {"s": ("SECOND", 1), "ms": ("MILLISECOND", 1), "us": ("MICROSECOND", 1),
                "ns": ("MICROSECOND", 1000)}


def from_epoch(col: Column, unit: str = "s") -> Column:
    """Integral epoch offset (``s``/``ms``/``us``/``ns``) -> TIMESTAMP_NTZ in UTC."""
    if unit not in _EPOCH_UNITS:
        raise ValueError(f"unit must be one of {sorted(_EPOCH_UNITS)}, got {unit!r}")
    spark_unit, div = _EPOCH_UNITS[unit]
    amount = col.cast("bigint") if div == 1 else F.floor(col.cast("bigint") / F.lit(div))
    return F.timestamp_add(spark_unit, amount, F.expr(EPOCH_NTZ))


def epoch_micros(col: Column, dtype: T.DataType) -> Column:
    """Microseconds since the Unix epoch of a date/timestamp column (UTC)."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), col)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(dtype, T.DateType):
        return F.unix_date(col).cast("bigint") * F.lit(86_400_000_000)
    raise TypeError(f"not a date/timestamp type: {dtype.simpleString()}")


def parse_timestamp(col: Column, fmt: str | None = None, errors: str = "raise") -> Column:
    """Text -> TIMESTAMP_NTZ (UTC wall clock).

    Accepts ISO text with or without a zone suffix (``Z``, ``+02:00``, `` UTC``,
    a region id).  Text with a zone is converted to UTC; text without one is
    taken as already being UTC wall clock.  ``errors='raise'`` fails on bad
    text (like pandas), ``'coerce'`` yields NULL.
    """
    if errors not in ("raise", "coerce"):
        raise ValueError("errors must be 'raise' or 'coerce'")
    text = F.trim(col)
    has_zone = text.rlike(r"(?i)(Z|[+-]\d{2}(:?\d{2})?|\s+[A-Za-z][A-Za-z0-9_/+-]*)$")
    if fmt is not None:
        zoned = F.to_timestamp(text, fmt) if errors == "raise" else F.try_to_timestamp(text, F.lit(fmt))
        plain = F.to_timestamp_ntz(text, F.lit(fmt)) if errors == "raise" else _try_ntz(text, fmt)
    else:
        zoned = text.cast("timestamp") if errors == "raise" else text.try_cast("timestamp")
        plain = text.cast("timestamp_ntz") if errors == "raise" else text.try_cast("timestamp_ntz")
    return F.when(col.isNull(), F.lit(None).cast("timestamp_ntz")).when(
        has_zone, ltz_to_utc_ntz(zoned)).otherwise(plain)


def _try_ntz(text: Column, fmt: str) -> Column:
    return ltz_to_utc_ntz(F.try_to_timestamp(F.concat(text, F.lit(" +00:00")), F.lit(fmt + " XXX")))


def ltz_to_utc_ntz(col: Column) -> Column:
    """TIMESTAMP (instant) -> TIMESTAMP_NTZ holding its UTC wall clock."""
    return from_epoch(F.unix_micros(col), "us")


def as_wall_clock(col: Column, dtype: T.DataType, unit: str | None = None,
                  errors: str = "raise") -> Column:
    """Any date-like column -> TIMESTAMP_NTZ in UTC wall clock.

    Integral columns need an explicit ``unit``: without it pandas would read
    epoch seconds as nanoseconds and put every row in 1970-01-01.  Text is
    parsed with ``errors='raise'`` (fail on bad text) or ``'coerce'`` (NULL).
    """
    if isinstance(dtype, T.TimestampNTZType):
        return col
    if isinstance(dtype, T.TimestampType):
        return ltz_to_utc_ntz(col)
    if isinstance(dtype, T.DateType):
        return col.cast("timestamp_ntz")
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        if unit is None:
            raise ValueError("integral date column needs unit='s'|'ms'|'us'|'ns'")
        return from_epoch(col, unit)
    if isinstance(dtype, T.StringType):
        return parse_timestamp(col, errors=errors)
    raise TypeError(f"cannot use a {dtype.simpleString()} column as a date")


# --------------------------------------------------------------------------
# Labels
# --------------------------------------------------------------------------

def _micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), ts)


def _floor_fixed(ts: Column, width_micros: int, anchor_micros: int) -> Column:
    """Start of the fixed-width bin holding ``ts``; bins start at ``anchor``."""
    rel = _micros(ts) - F.lit(anchor_micros)
    # exact integer floor (pmod is never negative), no double rounding
    start = rel - F.pmod(rel, F.lit(width_micros)) + F.lit(anchor_micros)
    return F.timestamp_add("MICROSECOND", start, F.expr(EPOCH_NTZ))


def _week_end(d: Column, weekday: int) -> Column:
    """Same-or-next ``weekday`` (0 = Monday) on or after date ``d``."""
    return F.date_add(d, F.pmod(F.lit(weekday) - F.weekday(d), F.lit(7)).cast("int"))


def _calendar_label(d: Column, f: Frequency) -> Column:
    """Label of a period of whole months: months are counted from January 1970
    and the period's last (or first) month is the next (or latest) one that
    agrees with the first anchor since then, modulo the period's length."""
    step, starts, business = f.months, f.unit.endswith("S"), f.unit.startswith("B")
    first = f.month % (step // f.n)
    m = (F.year(d) - 1970) * 12 + F.month(d) - 1
    origin = F.lit("1970-01-01").cast("date")

    def label(k: Column) -> Column:
        day = F.add_months(origin, k.cast("int"))
        if starts:
            off = F.when(F.weekday(day) >= 5, 7 - F.weekday(day)).otherwise(0)
            return F.date_add(day, off) if business else day
        day = F.last_day(day)
        return F.date_sub(day, F.greatest(F.weekday(day) - 4, F.lit(0))) if business else day

    if starts:
        at = m - F.pmod(m - F.lit(first), F.lit(step))
        beyond = label(at) > d
    else:
        at = m + F.pmod(F.lit(first) - m, F.lit(step))
        beyond = label(at) < d
    if not business:
        return label(at)
    return F.when(beyond, label(at - step if starts else at + step)).otherwise(label(at))


def period_label(ts: Column, freq: str | Frequency, anchor: str | None = None) -> Column:
    """Label of the period holding wall-clock ``ts`` (TIMESTAMP_NTZ).

    Returns DATE for day and longer frequencies and TIMESTAMP_NTZ for
    sub-day ones.  ``anchor`` (``'YYYY-MM-DD[ HH:MM:SS]'``) sets the origin of
    multi-unit bins; the default origin is the Unix epoch.
    """
    f = parse_frequency(freq) if isinstance(freq, str) else freq
    anchor_micros = 0
    if anchor is not None:
        import datetime as _dt
        a = _dt.datetime.fromisoformat(anchor)
        anchor_micros = int((a - _dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000)
    d = F.to_date(ts)
    u = f.unit
    if u in _UNIT_MICROS:
        if u == "D" and f.n == 1 and anchor_micros % _UNIT_MICROS["D"] == 0:
            return d
        start = _floor_fixed(ts, f.n * _UNIT_MICROS[u], anchor_micros)
        return F.to_date(start) if u == "D" else start
    if u == "W":
        end = _week_end(d, f.weekday)
        if f.n == 1:
            return end
        # n-week bins ending on the anchor weekday, aligned on the first such
        # weekday on or after the origin.
        origin = F.date_add(F.lit("1970-01-01").cast("date"), anchor_micros // _UNIT_MICROS["D"])
        first_end = _week_end(origin, f.weekday)
        k = F.datediff(end, first_end) / F.lit(7)
        j = -F.floor(-k / F.lit(f.n))  # ceil(k / n) for negative k too
        return F.date_add(first_end, (j * F.lit(7 * f.n)).cast("int"))
    if f.months:
        return _calendar_label(d, f)
    if u == "B":
        back = F.when(F.weekday(d) == 5, 1).when(F.weekday(d) == 6, 2).otherwise(0)
        return F.date_sub(d, back)
    if u == "SM":
        month_start = F.trunc(d, "month")
        return (F.when(d == F.last_day(d), F.last_day(d))
                .when(F.dayofmonth(d) >= 15, F.date_add(month_start, 14))
                .otherwise(F.date_sub(month_start, 1)))
    if u == "SMS":
        month_start = F.trunc(d, "month")
        return F.when(F.dayofmonth(d) >= 15, F.date_add(month_start, 14)).otherwise(month_start)
    raise ValueError(f"unsupported frequency {freq!r}")


def label_text(label: Column, freq: str | Frequency) -> Column:
    """Printable label: ``yyyy-MM-dd`` or ``yyyy-MM-dd HH:mm:ss``."""
    f = parse_frequency(freq) if isinstance(freq, str) else freq
    return F.date_format(label, f.label_format)


def day_start_epoch(epoch_seconds: Column) -> Column:
    """Epoch seconds of the UTC day start of an epoch-seconds value; NULL -> 0.

    The reference job keys rows this way (and maps a missing time to 0);
    unlike it, the day is taken in UTC rather than the worker's local zone.
    """
    s = F.coalesce(epoch_seconds.cast("bigint"), F.lit(0))
    return s - F.pmod(s, F.lit(86_400))


def epoch_seconds(ts: Column, dtype: T.DataType) -> Column:
    """Whole epoch seconds of a date/timestamp column (UTC)."""
    return F.floor(epoch_micros(ts, dtype) / F.lit(1_000_000)).cast("bigint")
