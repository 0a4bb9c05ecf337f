"""Weighted composite scores over wide rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from daybook import config
from daybook.functions.dates import date_lit
from daybook.functions.numeric import all_of, count_known


@dataclass(frozen=True)
class ScoreTerm:
    """A column's part in a score: ``weight * x ** power``, or ``weight * transform(x)``."""

    column: str
    low: float
    high: float
    weight: float = 1.0
    power: float = 1.0
    transform: Callable[[Column], Column] | None = None

    def apply(self, x: Column) -> Column:
        if self.transform is not None:
            shaped = self.transform(x)
        else:
            shaped = x if self.power == 1 else F.pow(x, F.lit(float(self.power)))
        return shaped * F.lit(float(self.weight))

    @property
    def value(self) -> Column:
        return self.apply(F.col(f"`{self.column}`"))

    def extreme(self, least: bool) -> Column:
        """Least or greatest contribution inside the column's range."""
        at = self.low if least == (self.weight > 0) else self.high
        return self.apply(F.lit(float(at)))


@dataclass(frozen=True)
class ScoreSpec:
    terms: tuple[ScoreTerm, ...]
    rescale: bool = True


def score_specs(table: Mapping = config.SCORES) -> dict[str, ScoreSpec]:
    return {
        name: ScoreSpec(tuple(ScoreTerm(c, *args) for c, args in terms.items()), rescale)
        for name, (rescale, terms) in table.items()
    }


def _total(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols)


def composite_score(spec: ScoreSpec, cutoff: float = config.FULL_CUTOFF,
                    zero_baseline: Sequence[str] = config.ZERO_BASELINE,
                    exclude_ranges: Sequence[tuple[str, str]] = (), date: str = "date") -> Column:
    """Sum of terms (missing ones count 0), optionally rescaled to -100..100.

    NULL when the share of known terms is below ``cutoff``, when every column is at its
    resting value, or (optionally) on excluded dates.
    """
    terms = spec.terms
    raw = [F.col(f"`{t.column}`") for t in terms]
    total = _total([F.coalesce(t.value, F.lit(0.0)) for t in terms])
    resting = all_of([
        c == (0 if t.column in zero_baseline else 1) for t, c in zip(terms, raw)
    ])
    valid = (count_known(raw) / F.lit(len(terms)) >= cutoff) & ~resting
    for lo, hi in exclude_ranges:
        valid = valid & ~F.col(date).between(date_lit(lo), date_lit(hi))
    score = total
    if spec.rescale:
        low = _total([t.extreme(True) for t in terms])
        high = _total([t.extreme(False) for t in terms])
        score = (total - low) / (high - low) * 200 - 100
    return F.when(valid, score)


def score_metrics(df: DataFrame, specs: Mapping[str, ScoreSpec] | None = None,
                  suffix: str = "_partial", **options) -> DataFrame:
    """Every score at the full and the partial cutoff, in one projection."""
    specs = score_specs() if specs is None else specs
    return df.select(
        "*",
        *[composite_score(s, config.FULL_CUTOFF, **options).alias(n) for n, s in specs.items()],
        *[composite_score(s, config.PARTIAL_CUTOFF, **options).alias(n + suffix)
          for n, s in specs.items()],
    )
