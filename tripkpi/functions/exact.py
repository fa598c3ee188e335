"""Sums and means that come out the same in every run, whatever the values and the layout.

A sum of doubles depends on the order in which tasks finish, and a mean near x.xx5 then rounds either
way. Here a value becomes whole numbers that bigint sums add exactly, which takes much less time than
decimals: its whole part, split at 2**20, and its fraction in billionths, split at 2**10. The small
parts leave room for 8e12 rows in a group, and the large part for sums of 9e24. The few result rows
are put together as decimals and rounded once, half away from zero, by whole-number division. None of
this depends on ANSI mode.

A value's fraction is that of the double, to the nearest billionth. Values that are not finite have no
whole part; they are summed apart as doubles, where order does not matter, and decide the result. What
no bigint can take, 9.2e18 and more, is summed apart as well, and the exact sum of all other values is
added to it once, at the end. Doubles of that size are whole thousands apart, so only they can make
such a sum depend on their order, in its last digits.
"""

from __future__ import annotations

from dataclasses import dataclass

_LARGEST = "9.2e18D"
_HALF_BITS, _NANO_BITS = 20, 10
_NANOS = 1_000_000_000


def _decimal(whole: str) -> str:
    return f"CAST({whole} AS DECIMAL(38, 0))"


def _rounded(numerator: str, denominator: str, digits: str) -> str:
    """numerator / denominator in hundredths, halves away from zero, as a double.

    ``digits`` is the factor that makes the numerator count hundredths.
    """
    doubled = f"(abs({numerator}) * {2 * int(digits)} + {denominator})"
    hundredths = f"(({doubled} - ({doubled} % (2 * {denominator}))) / (2 * {denominator}))"
    return f"(sign({numerator}) * CAST({hundredths} AS DOUBLE) / 100)"


@dataclass(frozen=True)
class Measure:
    """A summed quantity: where it comes from and how many units make one.

    ``whole`` quantities have no fraction once they are counted in units.
    """

    name: str
    column: str
    per_one: int = 1
    whole: bool = False

    @property
    def columns(self) -> tuple[str, ...]:
        parts = ("high", "low") if self.whole else ("high", "low", "milli", "nano")
        return tuple(f"{self.name}_{p}" for p in (*parts, "seen", "rest"))

    @property
    def seen(self) -> str:
        return f"{self.name}_seen"

    @property
    def rest(self) -> str:
        return f"{self.name}_rest"

    def parts(self) -> list[str]:
        """Per row: the parts, 1 if there is a value at all, and a value that has no parts."""
        value = f"CAST({self.column} AS DOUBLE)"
        if self.per_one != 1:
            value = f"({value} * {self.per_one}D)"
        if self.whole:
            value = f"rint({value})"
        countable = f"abs({value}) < {_LARGEST}"
        part = f"CASE WHEN {countable} THEN {value} ELSE 0D END"
        floor = f"floor({part})"
        parts = [
            f"shiftright({floor}, {_HALF_BITS}) AS {self.name}_high",
            f"{floor} & {2**_HALF_BITS - 1}L AS {self.name}_low",
        ]
        if not self.whole:
            nanos = f"CAST(rint(({part} - {floor}) * {_NANOS}D) AS BIGINT)"
            parts += [
                f"shiftright({nanos}, {_NANO_BITS}) AS {self.name}_milli",
                f"{nanos} & {2**_NANO_BITS - 1}L AS {self.name}_nano",
            ]
        return [
            *parts,
            f"CAST({self.column} IS NOT NULL AS BIGINT) AS {self.seen}",
            f"CASE WHEN NOT ({countable}) THEN {value} END AS {self.rest}",
        ]

    def sums(self) -> list[str]:
        return [f"sum({c}) AS {c}" for c in self.columns]

    def exact(self) -> str:
        """The sum in units, or in billionths of them."""
        n = self.name
        units = f"({_decimal(f'{n}_high')} * {2**_HALF_BITS} + {n}_low)"
        if self.whole:
            return _decimal(units)
        nanos = f"({_decimal(f'{n}_milli')} * {2**_NANO_BITS} + {n}_nano)"
        return _decimal(f"{_decimal(units)} * {_NANOS} + {nanos}")

    @property
    def scale(self) -> int:
        """What one is counted as in ``exact``."""
        return self.per_one * (1 if self.whole else _NANOS)

    def total(self) -> str:
        """Sum rounded to two places; null where no row has a value."""
        return self._pick(_rounded(self.exact(), _decimal(str(self.scale)), "100"), self.loose())

    def mean(self) -> str:
        """Mean of the values that are there, rounded to two places."""
        count = _decimal(f"{_decimal(self.seen)} * {self.scale}")
        return self._pick(_rounded(self.exact(), count, "100"), f"{self.loose()} / {self.seen}")

    def loose(self) -> str:
        """The sum as a double, with the values that have no parts; null if there are none of those."""
        return f"((CAST({self.exact()} AS DOUBLE) / {self.scale} + {self.rest} / {self.per_one}))"

    def _pick(self, exact: str, loose: str) -> str:
        return (
            f"CASE WHEN {self.seen} > 0 THEN "
            f"CASE WHEN {self.rest} IS NULL THEN {exact} ELSE round({loose}, 2) END END"
        )


def percent_of(part: Measure, whole: Measure) -> str:
    """100 x sum of ``part`` / sum of ``whole``, two places; 0 unless the whole is positive.

    Both have to be counted in the same units.
    """
    exact = _rounded(part.exact(), whole.exact(), "10000")
    sums = [
        f"coalesce({m.loose()}, CAST({m.exact()} AS DOUBLE) / {m.scale})" for m in (part, whole)
    ]
    loose = f"100 * {sums[0]} / {sums[1]}"
    positive = f"coalesce({whole.loose()} > 0, {whole.exact()} > 0)"
    return (
        f"CASE WHEN {positive} THEN CASE "
        f"WHEN {part.seen} = 0 THEN NULL "
        f"WHEN {part.rest} IS NULL AND {whole.rest} IS NULL THEN {exact} "
        f"ELSE round({loose}, 2) END ELSE 0D END"
    )
