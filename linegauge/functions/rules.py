"""Segment rules and range rules as CASE expressions over the line."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from linegauge.functions.numbers import num
from linegauge.sources import fixed_values as fixed


def _case(tests: Sequence[str], values: Sequence, otherwise=None) -> Column:
    literal = lambda v: str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    whens = " ".join(f"WHEN {t} THEN {literal(v)}" for t, v in zip(tests, values))
    rest = "" if otherwise is None else f" ELSE {literal(otherwise)}"
    return F.expr(f"CASE {whens}{rest} END")


@dataclass(frozen=True)
class SegmentRule:
    """First match wins; the last step has no upper end, so NULL and NaN lines fall there too."""

    steps: tuple[tuple[float | None, bool, str, str], ...]

    def _choose(self, line: str, values: Sequence) -> Column:
        tests = [f"{line} {'<=' if closed else '<'} {num(upper)}" for upper, closed, _, _ in self.steps[:-1]]
        return _case(tests, values, values[-1])

    def code(self, line: str) -> Column:
        return self._choose(line, [s[2] for s in self.steps])

    def label(self, line: str) -> Column:
        return self._choose(line, [s[3] for s in self.steps])

    def order(self, line: str) -> Column:
        return self._choose(line, list(range(1, len(self.steps) + 1)))


@dataclass(frozen=True)
class RangeRule:
    """Ranges low < line <= high that do not overlap; a line outside every range gives NULL."""

    ranges: tuple[tuple[str, float, float], ...]

    def _choose(self, line: str, values: Sequence) -> Column:
        return _case([f"{line} > {num(low)} AND {line} <= {num(high)}" for _, low, high in self.ranges], values)

    def name(self, line: str) -> Column:
        return self._choose(line, [r[0] for r in self.ranges])

    def order(self, line: str) -> Column:
        return self._choose(line, list(range(1, len(self.ranges) + 1)))


GAMES = SegmentRule(tuple(fixed.GAMES_SEGMENTS))
FANTASY = SegmentRule(tuple(fixed.FANTASY_SEGMENTS))
FORMAT = SegmentRule(tuple(fixed.FORMAT_SEGMENTS))
GAMES_RANGES = RangeRule(tuple(fixed.GAMES_RANGES))
FANTASY_RANGES = RangeRule(tuple(fixed.FANTASY_RANGES))
