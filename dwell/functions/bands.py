"""Time-of-day bands on a local clock of epoch milliseconds, as column arithmetic."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86_400_000
MINUTE = 60_000
#: The two bands that the command lines know.
DEFAULT_BANDS = {"lunch": ("11:30", "14:00"), "dinner": ("17:00", "21:00")}
ROUNDING = {"floor": 0, "round": 30_000, "ceil": 59_999}


def clock_ms(text: str) -> int:
    hours, minutes = text.split(":")
    return (int(hours) * 60 + int(minutes)) * MINUTE


@dataclass(frozen=True)
class TimeBand:
    """[start, end) within a day, in milliseconds; a band whose end is not after its start goes over midnight."""

    name: str
    start: int
    end: int

    @classmethod
    def of(cls, name: str, start: str, end: str) -> TimeBand:
        return cls(name, clock_ms(start), clock_ms(end))

    @property
    def parts(self) -> tuple[tuple[int, int], ...]:
        return ((self.start, self.end),) if self.start < self.end else ((self.start, DAY), (0, self.end))

    @property
    def length(self) -> int:
        return sum(b - a for a, b in self.parts)

    def within_day(self, start: Column, end: Column) -> Column:
        """Milliseconds of [start, end), both within one day, that fall into the band."""
        total = None
        for a, b in self.parts:
            own = F.greatest(F.lit(0).cast("long"), F.least(end, F.lit(b).cast("long")) - F.greatest(start, F.lit(a).cast("long")))
            total = own if total is None else total + own
        return total

    def contains(self, moment: Column) -> Column:
        """Whether a time of day lies in the band."""
        inside = F.lit(False)
        for a, b in self.parts:
            inside = inside | ((moment >= a) & (moment < b))
        return inside


def bands(names: list[str] | str) -> list[TimeBand]:
    """Bands by name, in any case; others than the known ones are an error."""
    out = []
    for raw in names.split(",") if isinstance(names, str) else names:
        name = raw.strip().lower()
        if not name:
            continue
        if name not in DEFAULT_BANDS:
            raise ValueError(f"unknown window: {raw}")
        out.append(TimeBand.of(name, *DEFAULT_BANDS[name]))
    if not out:
        raise ValueError("no window given")
    return out


def floor_div(a: Column, b: int) -> Column:
    """a // b as a long, rounded down for negative a too; exact, unlike a quotient of doubles."""
    rest = F.pmod(a, F.lit(b).cast("long"))
    return F.call_function("div", a - rest, F.lit(b).cast("long"))


def rounded_minutes(ms: Column, rounding: str) -> Column:
    return floor_div(ms + F.lit(ROUNDING[rounding]).cast("long"), MINUTE)


def record_minutes(start: Column, end: Column, band: TimeBand, rounding: str = "floor") -> Column:
    """Minutes of a whole record in a band, over any number of days, rounded once. Zero for records without duration.

    The days between the first and the last count in closed form; an end at midnight belongs to the day before.
    """
    first, last = floor_div(start, DAY), floor_div(end - 1, DAY)
    begin, stop = start - first * DAY, end - last * DAY
    one = band.within_day(begin, stop)
    more = band.within_day(begin, F.lit(DAY).cast("long")) + band.within_day(F.lit(0).cast("long"), stop) + (last - first - 1) * band.length
    total = F.when(first == last, one).otherwise(more)
    return F.when((start >= 0) & (end > start), rounded_minutes(total, rounding)).otherwise(F.lit(0).cast("long"))


def crosses_midnight(start: Column, end: Column) -> Column:
    return floor_div(start, DAY) != floor_div(end - 1, DAY)


def day_of(ms: Column) -> Column:
    return floor_div(ms, DAY)


def day_pieces(start: Column, end: Column) -> Column:
    """An array of (day, begin, stop) for records on one day or two; records over more days give none."""
    first, last = day_of(start), day_of(end - 1)
    piece = lambda d, a, b: F.struct(d.alias("day"), a.alias("begin"), b.alias("stop"))
    begin, stop, whole, zero = start - first * DAY, end - last * DAY, F.lit(DAY).cast("long"), F.lit(0).cast("long")
    none = F.array().cast("array<struct<day:long,begin:long,stop:long>>")
    return F.when(last == first, F.array(piece(first, begin, stop))).when(last == first + 1, F.array(piece(first, begin, whole), piece(last, zero, stop))).otherwise(none)


def is_weekend(day: Column) -> Column:
    """From days since 1970-01-01, a Thursday."""
    return F.pmod(day + 3, F.lit(7)) >= 5
