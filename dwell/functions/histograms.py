"""Fixed-width histograms as arrays, and the text forms in which they go out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def counts(value: Column, bins: range) -> Column:
    """An aggregate: how often value equals each bin. Null and values outside count nowhere."""
    return F.array(*[F.count_if(value == F.lit(b)) for b in bins])


def json_counts(hist: Column, first: int) -> Column:
    """{"8": 2, "9": 1}: bins above zero in ascending order."""
    pairs = F.transform(hist, lambda n, i: F.struct((i + first).alias("bin"), n.alias("n")))
    texts = F.transform(F.filter(pairs, lambda p: p["n"] > 0), lambda p: F.concat(F.lit('"'), p["bin"].cast("string"), F.lit('": '), p["n"].cast("string")))
    return F.concat(F.lit("{"), F.array_join(texts, ", "), F.lit("}"))


def top_bins(hist: Column, first: int, k: int = 3) -> Column:
    """The k fullest bins, empty ones included, ties to the lower bin."""
    order = F.array_sort(F.transform(hist, lambda n, i: F.struct((-n).alias("n"), (i + first).alias("bin"))))
    return F.transform(F.slice(order, 1, k), lambda p: p["bin"])


def json_list(values: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(values.cast("array<string>"), ", "), F.lit("]"))


def total(hist: Column, bins: list[int] | None = None, first: int = 0) -> Column:
    """The sum over all bins, or over those given (a bin named twice counts twice)."""
    zero = F.lit(0).cast("long")
    if bins is None:
        return F.aggregate(hist, zero, lambda a, b: a + b)
    out = zero
    for b in bins:
        out = out + F.element_at(hist, b - first + 1)
    return out


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def float_text(value: Column, places: int = 6) -> Column:
    """A non-negative number rounded half to even, written as Python writes floats: 0.5, 1.0, 5e-06, 2.5e-05."""
    unit = 10**places
    micro = F.bround(F.bround(value, places) * unit, 0).cast("long")
    whole, part = F.floor(micro / unit).cast("string"), F.lpad(F.pmod(micro, F.lit(unit)).cast("string"), places, "0")
    plain = F.concat(whole, F.lit("."), F.when(F.pmod(micro, F.lit(unit)) == 0, F.lit("0")).otherwise(F.regexp_replace(part, "0+$", "")))
    if places != 6:
        return plain
    tens, ones = F.floor(micro / 10).cast("string"), F.pmod(micro, F.lit(10)).cast("string")
    small = F.when(micro < 10, F.concat(micro.cast("string"), F.lit("e-06"))).when(F.pmod(micro, F.lit(10)) == 0, F.concat(tens, F.lit("e-05"))).otherwise(F.concat(tens, F.lit("."), ones, F.lit("e-05")))
    return F.when((micro > 0) & (micro < 100), small).otherwise(plain)
