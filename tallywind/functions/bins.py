"""Level codes, flags and ratios built from ``when`` chains."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Binning:
    """Closed bins of equal width, and the level-2 code of their numbers."""

    start: float
    step: float
    count: int
    sentinel: float
    low: tuple[int, int]
    middle: tuple[int, int]


# The binnings of the shop scores (on the 0-5 scale) and of the review rate.
DELIVERY = Binning(4.1, 0.1, 20, -5.0, (2, 4), (5, 7))
REVIEW = Binning(0.714, 0.02, 30, -1.0, (2, 12), (13, 15))
SERVICE = Binning(3.93, 0.1, 20, -1.0, (2, 7), (8, 9))
DESCRIPTION = Binning(3.93, 0.1, 30, -1.0, (2, 8), (9, 10))

# Flag sets in force by default, and the sets that were meant.
FLAG_SETS = {"gender0": [-1], "age0": [1007], "occupation0": [], "star0": [], "context_page0": [4007]}
INTENDED_FLAG_SETS = {
    "gender0": [-1],
    "age0": [1004, 1005, 1006, 1007],
    "occupation0": [-1, 2003],
    "star0": [-1, 3000, 3001],
    "context_page0": [4001, 4002, 4003, 4004, 4007],
}
FLAG_COLUMNS = {
    "gender0": "user_gender_id",
    "age0": "user_age_level",
    "occupation0": "user_occupation_id",
    "star0": "user_star_level",
    "context_page0": "context_page_id",
}


def bin_uniform(col: str, bins: Binning) -> Column:
    """Bin i (1..count-1) gets code i+1, the lower bin owns a shared edge, the sentinel gets 1, all else null.

    The bin number is computed and then checked, with its neighbours, against the exact edges
    ``start + step * i``.
    """
    x = F.col(col)
    start, step = F.lit(bins.start), F.lit(bins.step)
    guess = F.ceil((x - start) / step)

    def code(i: Column) -> Column:
        inside = (x >= start + step * (i - 1)) & (x <= start + step * i)
        return F.when(i.between(1, bins.count - 1) & inside, (i + 1).cast("int"))

    return F.coalesce(code(guess - 1), code(guess), code(guess + 1), F.when(x == F.lit(bins.sentinel), 1))


def bin_level2(code: Column | str, bins: Binning) -> Column:
    """1 for low bins, 2 for middle bins, 3 for all else, null included."""
    c = F.col(code) if isinstance(code, str) else code
    return F.when(c.between(*bins.low), 1).when(c.between(*bins.middle), 2).otherwise(3)


def membership_flag(col: str, values: Iterable, yes: int = 1, no: int = 2) -> Column:
    members = list(values)
    return F.when(F.col(col).isin(members), yes).otherwise(no) if members else F.lit(no)


def range_flag(col: str, lo: float, hi: float, inside: int = 0, outside: int = 1) -> Column:
    return F.when(F.col(col).between(lo, hi), inside).otherwise(outside)


def all_equal_flag(expected: Mapping[str, object]) -> Column:
    """1 where every column has its expected value."""
    return F.when(reduce(lambda a, b: a & b, [F.col(c) == v for c, v in expected.items()]), 1).otherwise(0)


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as double; null where the denominator is 0 or null."""
    a = F.col(numerator) if isinstance(numerator, str) else numerator
    b = F.col(denominator) if isinstance(denominator, str) else denominator
    return F.try_divide(a.cast("double"), b.cast("double"))


def float_ratio(a: Column, b: Column) -> Column:
    """Quotient with float rules for a zero denominator: +/-inf, and null for 0/0."""
    inf = F.lit(float("inf"))
    quotient = F.when(b != 0, F.try_divide(a.cast("double"), b.cast("double"))).when(a > 0, inf).when(a < 0, -inf)
    return quotient + F.lit(0.0)


def concat_cross(a: str, b: str) -> Column:
    """Two level codes written one after the other, read as one number."""
    return F.concat(F.col(a).cast("string"), F.col(b).cast("string")).try_cast("bigint")


def log_loss_terms(label: str, score: str, eps: float | None = None) -> Column:
    """y ln p + (1-y) ln(1-p) with 0 ln 0 = 0 and ln 0 = -inf; null where the label is null, an error where the score is."""
    y, p = F.col(label), F.col(score).cast("double")
    # Clipping would turn a null score into eps, so nulls are met first.
    known = F.when(p.isNull() & y.isNotNull(), F.raise_error(F.lit(f"{score} is null")).cast("double")).otherwise(p)
    if eps is not None:
        known = F.greatest(F.least(known, F.lit(1.0 - eps)), F.lit(eps))

    def part(weight: Column, chance: Column) -> Column:
        return F.when(weight == 0, F.lit(0.0)).when(chance <= 0, F.lit(float("-inf"))).otherwise(weight * F.log(chance))

    return F.when(y.isNotNull(), part(y, known) + part(1 - y, 1 - known))
