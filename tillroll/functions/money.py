"""Exact sums and means of currency columns held as doubles.

Adding doubles gives a result that depends on the order of the rows, and past about
1e13 a double no longer holds whole cents. Here every amount is taken apart into whole
minor units (cents for two digits), which are added as integers. The unit count is kept
as two bigint halves, so that a sum over any number of rows neither overflows nor leaves
whole-stage codegen; a decimal(14,2) cast gives the same digits but is slower.

What an amount has beyond whole minor units, a fraction of a cent, is added as a double on
its own, so it keeps its digits beside any sum. NaN, infinities and amounts beyond 9e15
units go to that sum whole, where they behave as in a plain ``sum``.

Amounts, counts and factors are SQL text: one parsed expression costs one call into the
JVM, where the same expression put together from columns costs one per operator.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

LOW_BITS = 16
LOW_SIZE = 1 << LOW_BITS
EXACT_UNITS = "9e15d"
# A double that stands for whole units, or the sum of two such, is off by two units in the
# last place at most once it is scaled. Anything further away is a fraction of a unit.
SLACK = "4.5e-16d"


@dataclass(frozen=True)
class ExactSum:
    """One sum, held in the columns ``<name>_high``, ``<name>_low`` and ``<name>_rest``.

    Rows are split first and summed then: ``frame.select(key, *s.split("price"))``,
    ``.groupBy(key).agg(*s.sums())``, and ``s.total()`` or ``s.mean(...)`` of the result.
    """

    name: str
    digits: int = 2

    @property
    def columns(self) -> list[str]:
        return [f"{self.name}_high", f"{self.name}_low", f"{self.name}_rest"]

    def split(self, amount: str) -> list[Column]:
        """``<name>_units`` and ``<name>_loose`` of each row, to select ahead of the sums."""
        scaled = f"(cast({amount} AS double) * {self._scale})"
        gap = f"({scaled} - rint({scaled}))"
        near = f"abs({scaled}) < {EXACT_UNITS}"
        loose = f"if(abs{gap} <= abs({scaled}) * {SLACK}, null, {gap} / {self._scale})"
        return [
            F.expr(f"if({near}, cast(rint({scaled}) AS bigint), null) AS {self.name}_units"),
            F.expr(f"if({near}, {loose}, cast({amount} AS double)) AS {self.name}_loose"),
        ]

    def sums(self) -> list[Column]:
        """Aggregate expressions that build the sum of the split amounts."""
        high, low, rest = self.columns
        return [
            F.expr(f"sum(shiftright({self.name}_units, {LOW_BITS})) AS {high}"),
            F.expr(f"sum({self.name}_units & {LOW_SIZE - 1}) AS {low}"),
            F.expr(f"sum({self.name}_loose) AS {rest}"),
        ]

    def again(self, times: str | None = None) -> list[Column]:
        """Aggregate expressions that add up sums built before, each counted ``times``."""
        parts = zip(self._parts(times), self.columns)
        return [F.expr(f"sum({part}) AS {name}") for part, name in parts]

    def total(self, times: str | None = None) -> Column:
        """The sum as a double; null if no amount was present."""
        return F.expr(self._total(times))

    def rounded(self) -> Column:
        """The sum rounded to ``digits``."""
        # Whole minor units need no rounding, which is slow on doubles.
        return F.expr(
            f"CASE WHEN {self.columns[2]} IS NULL THEN {self._exact(None)}"
            f" ELSE round({self._total(None)}, {self.digits}) END"
        )

    def mean(self, count: str) -> Column:
        """The mean over ``count`` amounts, rounded half away from zero to ``digits``."""
        high, low, rest = self._parts(None)
        units = (
            f"CASE WHEN {_small(high, low)}"
            f" THEN {_rounded_ratio(f'({high} * {LOW_SIZE} + {low})', count)}"
            f" ELSE {_rounded_ratio(_wide(high, low), f'cast({count} AS decimal(20,0))')} END"
        )
        return F.expr(
            f"CASE WHEN {rest} IS NOT NULL THEN round({self._total(None)} / {count}, {self.digits})"
            f" WHEN {count} > 0 THEN cast({units} AS double) / {self._scale} END"
        )

    @property
    def _scale(self) -> str:
        return f"{10**self.digits}d"

    def _parts(self, times: str | None) -> list[str]:
        return [name if times is None else f"({name} * ({times}))" for name in self.columns]

    def _exact(self, times: str | None) -> str:
        high, low, _ = self._parts(times)
        return (
            f"CASE WHEN {_small(high, low)}"
            f" THEN cast({high} * {LOW_SIZE} + {low} AS double) / {self._scale}"
            f" ELSE cast({_wide(high, low)} / cast({10**self.digits} AS decimal(9,0)) AS double)"
            " END"
        )

    def _total(self, times: str | None) -> str:
        rest = self._parts(times)[2]
        return f"coalesce({self._exact(times)} + coalesce({rest}, 0d), {rest})"


def _small(high: str, low: str) -> str:
    """True where the unit count lies below 2**53 and so fits both bigint and double."""
    return f"(abs({high}) < {1 << 36} AND {low} < {1 << 52})"


def _wide(high: str, low: str) -> str:
    return (
        f"(cast({high} AS decimal(20,0)) * cast({LOW_SIZE} AS decimal(6,0))"
        f" + cast({low} AS decimal(20,0)))"
    )


def _rounded_ratio(units: str, count: str) -> str:
    return f"(2 * {units} + if({units} < 0, -{count}, {count})) div (2 * {count})"
