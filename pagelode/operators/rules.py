"""Decision lists as data: the first rule that holds gives the value."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def decision_list(rules: Sequence[tuple[Column, Column]], otherwise: Column) -> Column:
    """Value of the first rule whose condition is true; a null condition is not. One CASE expression, so later rules are not evaluated."""
    if not rules:
        return otherwise
    first, *rest = rules
    return reduce(lambda c, r: c.when(r[0], r[1]), rest, F.when(*first)).otherwise(otherwise)


def at_least(signals: Sequence[Column], n: int) -> Column:
    """Whether at least n of the signals hold; nulls do not."""
    return reduce(lambda a, b: a + b, [F.coalesce(s, F.lit(False)).cast("int") for s in signals], F.lit(0)) >= n


def split_by(df: DataFrame, column: str, kept: Sequence[str], parked: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose column is one of kept, and those whose column is one of parked; all others are in neither."""
    return df.filter(F.col(column).isin(*kept)), df.filter(F.col(column).isin(*parked))
