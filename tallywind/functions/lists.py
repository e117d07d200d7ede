"""Reading of ``;``-separated list columns and of ``category:properties;...`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def list_length(col: str, sep: str = ";") -> Column:
    return F.size(F.split(F.col(col), sep))


def list_item(col: str, i: int, default: str | None = "", sep: str = ";") -> Column:
    """The i-th piece (from 0), ``default`` past the end."""
    item = F.get(F.split(F.col(col), sep), F.lit(i))
    return item if default is None else F.coalesce(item, F.lit(default))


def list_number(col: str, i: int, sep: str = ";") -> Column:
    """The i-th piece as a number; a missing or non-numeric piece is an error."""
    return F.element_at(F.split(F.col(col), sep), F.lit(i + 1)).cast("bigint")


def predicted_category(col: str, i: int, missing: int = -1, strict: bool = True) -> Column:
    """The category before ``:`` of the i-th piece, ``missing`` past the end; other text is an error, or ``missing`` if not ``strict``."""
    piece = F.get(F.split(F.col(col), ";"), F.lit(i))
    category = F.split_part(piece, F.lit(":"), F.lit(1))
    category = category.cast("bigint") if strict else category.try_cast("bigint")
    return F.coalesce(category, F.lit(missing))


def category_match_flags(category_cols: list[str], predicted_cols: list[str]) -> dict[str, Column]:
    """1 where an item category equals a predicted category, for every pair of columns."""
    return {f"{c}_{p}": (F.col(c) == F.col(p)).cast("int") for c in category_cols for p in predicted_cols}
