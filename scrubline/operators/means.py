"""Sums and means that do not depend on the order of the rows.

Adding doubles rounds at every step, so an ordinary sum changes with the partitioning.
Here a finite number is split exactly into a whole number below 2**55 and a power of two.
The whole numbers of one power are added up as decimals, which is exact in any order;
there are at most some 2,100 powers, so a task sends a few rows.  The driver adds the
powers' totals as whole numbers and rounds once.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.functions.missing import named

# A power of two is looked up in two parts, as computing it need not be exact.
PART, PARTS = 46, 13
SHIFT = 53
TOTAL = "decimal(38,0)"


@dataclass(frozen=True)
class ExactSum:
    """``whole / 2**shift``, over ``n`` numbers, and the infinite ones apart."""

    whole: int
    shift: int
    n: int
    up: int = 0
    down: int = 0

    def _special(self) -> float | None:
        if self.up and self.down:
            return float("nan")
        return float("inf") if self.up else float("-inf") if self.down else None

    def _divided(self, n: int) -> float:
        """Division of whole numbers rounds correctly; beyond the range it is infinite."""
        try:
            return self.whole / ((1 << self.shift) * n)
        except OverflowError:
            return float("inf") if self.whole > 0 else float("-inf")

    def total(self) -> float | None:
        """The sum, rounded once; None without numbers."""
        if not self.n:
            return None
        special = self._special()
        return self._divided(1) if special is None else special

    def mean(self) -> float | None:
        """The mean, rounded once; None without numbers."""
        if not self.n:
            return None
        special = self._special()
        return self._divided(self.n) if special is None else special


def _power(exponent: Column) -> Column:
    """Two to the power of ``exponent``, which is between ``-PART * PARTS`` and ``PART * PARTS``."""
    high = F.floor(exponent / PART).cast("int")
    coarse = F.array(*(F.lit(2.0 ** (PART * i)) for i in range(-PARTS, PARTS + 1)))
    fine = F.array(*(F.lit(2.0**i) for i in range(PART)))
    return F.get(coarse, high + PARTS) * F.get(fine, exponent - high * PART)


def exact_sums(df: DataFrame, columns: Iterable[str]) -> dict[str, ExactSum]:
    """An :class:`ExactSum` of each column; NULL, NaN and text that is no number are skipped.

    One pass for all columns, and one shuffle of a row for each column and power.
    """
    names = list(dict.fromkeys(columns))
    if not names:
        return {}
    cells = [x for i, c in enumerate(names) for x in (F.lit(i), named(c).try_cast("double"))]
    numbers = df.select(F.stack(F.lit(len(names)), *cells).alias("which", "x")).where("x is not null and not isnan(x)")
    size = F.abs("x")
    finite = (size > 0) & (size < float("inf"))
    # may be one too small or too large, for which SHIFT leaves room
    power = F.when(finite, F.floor(F.log2(F.when(finite, size))).cast("int"))
    sign = F.when(size == float("inf"), F.signum("x").cast("int"))
    split = numbers.select("which", "x", power.alias("power"), sign.alias("sign"))
    # in two steps, each within the range of a double
    steps = SHIFT - F.col("power")
    half = F.floor(steps / 2).cast("int")
    scaled = F.col("x") * _power(half) * _power(steps - half)
    whole = F.coalesce(scaled.cast("bigint"), F.lit(0).cast("bigint"))
    totals = (
        split.select("which", "power", "sign", F.when(F.col("sign").isNull(), whole).cast("decimal(20,0)").alias("whole"))
        .groupBy("which", "power", "sign")
        .agg(F.count("*").alias("n"), F.sum("whole").cast(TOTAL).alias("whole"))
        .collect()
    )
    found = {}
    for i, name in enumerate(names):
        own = [r for r in totals if r["which"] == i]
        shift = max((SHIFT - r["power"] for r in own if r["power"] is not None), default=0)
        shift = max(shift, 0)
        found[name] = ExactSum(
            sum(int(r["whole"]) << (shift - SHIFT + r["power"]) for r in own if r["power"] is not None),
            shift,
            sum(r["n"] for r in own),
            sum(r["n"] for r in own if r["sign"] == 1),
            sum(r["n"] for r in own if r["sign"] == -1),
        )
    return found


def exact_mean(df: DataFrame, column: str) -> float | None:
    """The mean of ``column``, rounded once, whatever the partitioning."""
    return exact_sums(df, [column])[column].mean()
