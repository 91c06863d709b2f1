"""Sums and means that do not depend on the order of the rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

MILLION = 1_000_000
SPACING = 2.0**-52


@dataclass(frozen=True)
class ExactMeasure:
    """Sum and mean of a double column, rounded half up from an exact total.

    Every value is cut into millions, units, millionths and millionths of those, and each part is added up by itself. So
    partial sums may be combined in any order (map side, pane by pane, batch by batch) with one result, and all buffers
    are fixed-width primitives that the hash aggregate updates in place. A part is below 1e6, so its bigint holds more
    than 1e12 rows of a group; the millions are a double, exact for totals up to 9e21, an ordinary sum of doubles beyond.

    Twelve decimals are kept. A value that lies within its own double's spacing of a number of six decimals is taken
    for that number, as its shortest digits show it, so ties are ties. NaN counts as missing; infinity gives infinity.
    """

    name: str

    @property
    def millions(self) -> str:
        return f"{self.name}_millions"

    @property
    def units(self) -> str:
        return f"{self.name}_units"

    @property
    def micros(self) -> str:
        return f"{self.name}_micros"

    @property
    def picos(self) -> str:
        return f"{self.name}_picos"

    @property
    def known(self) -> str:
        return f"{self.name}_known"

    @property
    def parts(self) -> tuple[str, str, str, str, str]:
        return self.millions, self.units, self.micros, self.picos, self.known

    def inputs(self) -> list[Column]:
        """The four parts of each value, all of its sign; NULL for a missing one."""
        number = F.col(self.name)
        value = F.when(~F.isnan(number), number)
        small = F.nanvl(value % float(MILLION), F.lit(0.0))
        units = small.cast("bigint")
        fraction = small - units
        micros = F.rint(fraction * float(MILLION))
        left = fraction - micros / float(MILLION)
        picos = F.when(F.abs(left) > F.abs(value) * SPACING, F.rint(left * float(MILLION**2)).cast("bigint"))
        return [
            ((value - small) / float(MILLION)).alias(self.millions),
            units.alias(self.units),
            micros.cast("bigint").alias(self.micros),
            picos.alias(self.picos),
        ]

    def partial(self) -> list[Column]:
        """Aggregates over rows that carry ``inputs()``."""
        sums = [F.sum(part).alias(part) for part in self.parts[:3]]
        return [*sums, F.coalesce(F.sum(self.picos), F.lit(0)).alias(self.picos), F.count(self.units).alias(self.known)]

    def merge(self) -> list[Column]:
        """Aggregates over rows that carry the result of ``partial()``."""
        return [F.sum(part).alias(part) for part in self.parts]

    def carried(self) -> list[Column]:
        """The parts of a finished group with 0 to 999,999 in all but the millions, which take the sign."""

        def over(part: str) -> str:
            return f"(({part} - pmod({part}, {MILLION}L)) div {MILLION}L)"

        micros = f"({self.micros} + {over(self.picos)})"
        units = f"({self.units} + {over(micros)})"
        return [
            F.expr(f"{self.millions} + {over(units)}").alias(self.millions),
            F.expr(f"pmod({units}, {MILLION}L)").alias(self.units),
            F.expr(f"pmod({micros}, {MILLION}L)").alias(self.micros),
            F.expr(f"pmod({self.picos}, {MILLION}L)").alias(self.picos),
            F.col(self.known),
        ]

    def _rounded(self, whole: str, units: str, picos: str, rest: str, dp: int) -> Column:
        """Half up, away from zero: what was cut off is compared with half a step, exactly."""
        step = 10 ** (12 - dp)
        cut = f"2 * ({picos} % {step}L)"
        up = f"cast({cut} > {step}L or ({cut} = {step}L and ({rest} > 0 or {self.millions} >= 0)) as bigint)"
        steps = f"({units} * {10**dp}L + {picos} div {step}L + {up})"
        scale = float(10**dp)
        # In steps the number is whole, so the quotient is its nearest double; past 2**53 steps the fraction is added instead.
        near = f"({whole} * {MILLION * scale!r}D + {steps}) / {scale!r}D"
        far = f"{whole} * {float(MILLION)!r}D + {steps} / {scale!r}D"
        return F.expr(f"if(abs({whole}) < {2.0**53 / (MILLION * scale)!r}D, {near}, {far})")

    def total(self, dp: int) -> Column:
        """From ``carried()`` parts. NULL when every value was NULL."""
        picos = f"({self.micros} * {MILLION}L + {self.picos})"
        return self._rounded(self.millions, self.units, picos, "0L", dp)

    def mean(self, dp: int) -> Column:
        """From ``carried()`` parts, by long division. NULL when every value was NULL."""
        count = f"nullif({self.known}, 0L)"
        left = f"cast(nanvl(pmod({self.millions}, cast({count} as double)), 0D) as bigint)"
        whole = f"(({self.millions} - {left}) / {count})"
        units = f"({left} * {MILLION}L + {self.units})"
        micros = f"({units} % {count} * {MILLION}L + {self.micros})"
        picos = f"({micros} % {count} * {MILLION}L + {self.picos})"
        small = f"({micros} div {count} * {MILLION}L + {picos} div {count})"
        return self._rounded(whole, f"({units} div {count})", small, f"({picos} % {count})", dp)
