"""Exact quantiles by repeated narrowing.

``percentile`` and ``median`` keep a count per distinct value in one reducer, which a continuous column
of a large table overflows. Here every pass is an aggregate of bounded size over all columns at once:

1. a sketch proposes, for each wanted rank, two values that should enclose it;
2. the next pass counts the rows below and at these two values, which proves where the rank lies, and
   sketches the rows strictly between them;
3. a rank that falls on a counted value is found; one that lies between is read from the sketch when the
   sketch held all the rows (few are left), otherwise the two values move closer and the pass repeats.

Each pass leaves about one row in a thousand, so a table of 10^6 rows needs two passes and one of 10^12
needs four. Nothing is shuffled but one row of state per task. A value that fills a third of the table is
found by its count, never collected.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.numeric import nan_to_null
from tablewright.operators.columns import q

ACCURACY = 20000
GRID = 2000
_MAX_PASSES = 40


@dataclass
class _Search:
    """Search for the value at a 0-based ``rank``; it is known to lie in [low, high]."""

    column: str
    rank: int
    low: float
    high: float
    outer_low: float
    outer_high: float
    value: float | None = None


def _grid_neighbours(grid, position: float, slack: float):
    """Two sketch values around a relative position in 0..1."""
    lo = max(0, math.floor((position - slack) * GRID) - 1)
    hi = min(GRID, math.ceil((position + slack) * GRID) + 1)
    return grid[lo], grid[hi]


def _advance(s: _Search, counts, grid) -> None:
    """Use one pass over the data to find the value or to move the bounds."""
    below, to_low, below_high, to_high = counts
    if s.rank < below:
        s.low, s.high, s.outer_high = s.outer_low, s.low, s.low
    elif s.rank < to_low:
        s.value = s.low
    elif s.rank < below_high:
        inside, position = below_high - to_low, s.rank - to_low
        s.outer_low, s.outer_high = s.low, s.high
        if inside <= GRID // 4:
            # All rows in between were in the sketch: fraction (i + 1/2) / n is the value at index i.
            s.value = grid[round((position + 0.5) / inside * GRID)]
        else:
            s.low, s.high = _grid_neighbours(grid, (position + 0.5) / inside, 2.5 / ACCURACY)
    elif s.rank < to_high:
        s.value = s.high
    else:
        s.low, s.high, s.outer_low = s.high, s.outer_high, s.high


def _order_statistics(df: DataFrame, ranks_of, probs: Mapping[str, Sequence[float]]):
    names = list(probs)
    first = []
    for i, name in enumerate(names):
        c = F.col(name)
        # Fractions on either side of each wanted one, wider than the error of the sketch.
        around = [min(1.0, max(0.0, p + d)) for p in probs[name] for d in (-2.5 / ACCURACY, 2.5 / ACCURACY)]
        first += [F.count(c).alias(f"n{i}"), F.min(c).alias(f"min{i}"), F.max(c).alias(f"max{i}"),
                  F.percentile_approx(c, around, ACCURACY).alias(f"q{i}")]
    seen = df.agg(*first).first()

    searches: dict[tuple[str, int], _Search] = {}
    for i, name in enumerate(names):
        n = seen[f"n{i}"]
        for j, p in enumerate(probs[name]):
            for rank in ranks_of(n, p):
                lo, hi = seen[f"q{i}"][2 * j], seen[f"q{i}"][2 * j + 1]
                searches.setdefault((name, rank), _Search(
                    name, rank, lo, hi, seen[f"min{i}"], seen[f"max{i}"]))

    # One text literal instead of thousands of numeric ones keeps the plan small.
    fractions = F.split(F.lit(" ".join(str(i / GRID) for i in range(GRID + 1))), " ").cast("array<double>")
    for _ in range(_MAX_PASSES):
        open_searches = [s for s in searches.values() if s.value is None]
        if not open_searches:
            break
        spans = {(s.column, s.low, s.high): None for s in open_searches}
        aggregates = []
        for i, (name, lo, hi) in enumerate(spans):
            c = F.col(name)
            aggregates += [
                F.struct(F.count_if(c < lo), F.count_if(c <= lo), F.count_if(c < hi), F.count_if(c <= hi))
                .alias(f"c{i}"),
                F.percentile_approx(F.when((c > lo) & (c < hi), c), fractions, ACCURACY).alias(f"g{i}"),
            ]
        row = df.agg(*aggregates).first()
        found = {span: (row[f"c{i}"], row[f"g{i}"]) for i, span in enumerate(spans)}
        for s in open_searches:
            _advance(s, *found[(s.column, s.low, s.high)])
    else:
        raise RuntimeError("quantile search did not settle; is the input deterministic?")
    return {name: seen[f"n{i}"] for i, name in enumerate(names)}, {k: s.value for k, s in searches.items()}


def _linear_ranks(n: int, p: float) -> tuple[int, ...]:
    if n == 0:
        return ()
    position = p * (n - 1)
    return (math.floor(position), min(n - 1, math.floor(position) + 1))


def exact_quantiles(df: DataFrame, probs: Mapping[str, Sequence[float]],
                    exprs: Mapping[str, Column] | None = None) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation; missing values are skipped, an empty column gives None.

    ``probs`` maps a name to its probabilities. ``exprs`` may give the expression behind a name;
    otherwise it is the column of that name.
    """
    probs = {c: list(ps) for c, ps in probs.items() if len(ps)}
    if not probs:
        return {}
    exprs = exprs or {}
    plain = {name: f"v{i}" for i, name in enumerate(probs)}
    values = df.select(*[nan_to_null(exprs.get(name, q(name)).cast("double")).alias(alias)
                         for name, alias in plain.items()])
    counts, stats = _order_statistics(values, _linear_ranks, {plain[c]: ps for c, ps in probs.items()})
    out: dict[str, list[float | None]] = {}
    for name, ps in probs.items():
        n = counts[plain[name]]
        row: list[float | None] = []
        for p in ps:
            if n == 0:
                row.append(None)
                continue
            lower, upper = (stats[(plain[name], r)] for r in _linear_ranks(n, p))
            row.append(lower + (upper - lower) * (p * (n - 1) - math.floor(p * (n - 1))))
        out[name] = row
    return out


def exact_medians(df: DataFrame, names: Sequence[str], exprs=None) -> dict[str, float | None]:
    return {c: v[0] for c, v in exact_quantiles(df, {c: [0.5] for c in names}, exprs).items()}
