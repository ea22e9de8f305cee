"""Exact order statistics without ordering the whole table."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

SKETCH_ACCURACY = 10_000
#: A bracket with more rows than this is narrowed again before its values are ordered.
BRACKET_ROWS = 1_000_000
NARROWINGS = 6


@dataclass(frozen=True)
class Request:
    """A place in the order of a column's non-null values: its share, and its rank among n."""

    column: str
    share: float
    rank: Callable[[int], int]


@dataclass
class _Bracket:
    """Values between ``low`` and ``high`` hold the rank; ``below`` rows lie under them."""

    rank: int
    low: object
    high: object
    below: int
    inside: int

    @property
    def wide(self) -> bool:
        return self.low != self.high and self.inside > BRACKET_ROWS

    @property
    def missed(self) -> bool:
        return not self.below < self.rank <= self.below + self.inside


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _sketched(value: Column, share: float, slack: float) -> Column:
    return F.percentile_approx(value, [max(0.0, share - slack), min(1.0, share + slack)],
                               SKETCH_ACCURACY)


def _counted(df: DataFrame, brackets: Sequence[tuple[Column, _Bracket]]) -> None:
    """Count what lies below and inside each bracket, all in one pass."""
    tests = [F.count_if(test) for value, b in brackets for test in (
        value < F.lit(b.low), value.between(F.lit(b.low), F.lit(b.high)))]
    if tests:
        found = df.agg(*tests).first()
        for i, (_, bracket) in enumerate(brackets):
            bracket.below, bracket.inside = found[2 * i], found[2 * i + 1]


def values_at(df: DataFrame, requests: Sequence[Request]) -> list[object]:
    """The exact values at the requested places; null for a column without values.

    Three passes serve all columns and ranks together: one takes each column's
    count, ends and sketched brackets, one counts what lies below and inside the brackets,
    one orders the distinct values inside them.  A bracket the sketch put beside its rank is
    widened to the end of the column, and one with more than ``BRACKET_ROWS`` rows is sketched
    again, in two further passes for all such brackets.  Call it on a frame that is
    cheap to read a few times.
    """
    if not requests:
        return []
    names = list(dict.fromkeys(r.column for r in requests))
    value = {name: F.col(_quoted(name)) for name in names}
    slack = 2.0 / SKETCH_ACCURACY
    first = df.agg(*[a for name in names for a in (
        F.count(value[name]), F.min(value[name]), F.max(value[name]))],
        *[_sketched(value[r.column], r.share, slack) for r in requests]).first()
    ends = {name: first[3 * i:3 * i + 3] for i, name in enumerate(names)}
    brackets: list[_Bracket | None] = []
    for request, sketch in zip(requests, first[3 * len(names):]):
        n, least, most = ends[request.column]
        brackets.append(_Bracket(
            request.rank(n), sketch[0] if request.share > slack else least,
            sketch[1] if request.share + slack < 1 else most, 0, n) if n else None)
    held = [(value[r.column], b) for r, b in zip(requests, brackets) if b]
    _counted(df, held)
    missed = [(r, b) for r, b in zip(requests, brackets) if b and b.missed]
    for request, bracket in missed:
        _, bracket.low, bracket.high = ends[request.column]
    _counted(df, [(value[r.column], b) for r, b in missed])

    for _ in range(NARROWINGS):
        wide = [(v, b) for v, b in held if b.wide]
        if not wide:
            break
        plans = [((b.rank - b.below) / b.inside, slack + 2.0 / b.inside) for _, b in wide]
        found = df.agg(*[_sketched(F.when(v.between(F.lit(b.low), F.lit(b.high)), v), *plan)
                         for (v, b), plan in zip(wide, plans)]).first()
        before = [(b.low, b.high, b.below, b.inside) for _, b in wide]
        for (_, b), (share, spare), (low, high) in zip(wide, plans, found):
            b.low, b.high = low if share > spare else b.low, high if share + spare < 1 else b.high
        _counted(df, wide)
        for (_, b), old in zip(wide, before):
            if b.missed:
                b.low, b.high, b.below, b.inside = old

    result = [b.low if b and b.low == b.high else None for b in brackets]
    open_ = [i for i, b in enumerate(brackets) if b and b.low != b.high]
    if not open_:
        return result
    # One field per type, so that columns of several types share a pass.
    types = {name: df.select(value[name]).schema[0].dataType for name in names}
    kinds = list(dict.fromkeys(types[requests[i].column].simpleString() for i in open_))

    def entry(i: int) -> Column:
        name, b = requests[i].column, brackets[i]
        fields = [(value[name] if kind == types[name].simpleString() else F.lit(None).cast(kind))
                  .alias(f"v{k}") for k, kind in enumerate(kinds)]
        return F.when(value[name].between(F.lit(b.low), F.lit(b.high)), F.struct(
            F.lit(i).alias("i"), F.lit(b.rank - b.below).alias("place"),
            F.struct(*fields).alias("value")))

    running = Window.partitionBy("i").orderBy("value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    found = (df.select(F.explode(F.array_compact(F.array(*[entry(i) for i in open_]))).alias("s"))
             .groupBy("s.i", "s.place", "s.value").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("seen", F.sum("n").over(running))
             .where(F.col("seen") >= F.col("place"))
             .groupBy("i").agg(F.min("value").alias("value")).collect())
    for row in found:
        result[row.i] = row.value[kinds.index(types[requests[row.i].column].simpleString())]
    if len(found) != len(open_):
        raise RuntimeError(f"{len(open_) - len(found)} ranks were not located")
    return result


def values_at_ranks(df: DataFrame, column: str, ranks: Iterable[int], n: int) -> dict[int, object]:
    """The values at 1-based ranks of a column with ``n`` values."""
    wanted = sorted(set(ranks))
    return dict(zip(wanted, values_at(
        df, [Request(column, r / n, lambda _, r=r: r) for r in wanted])))


def lower_quantiles_of(df: DataFrame, shares: Mapping[str, Sequence[float]]
                       ) -> dict[str, list[object]]:
    """By column, the least values that at least each share of its non-null values do not exceed.

    Nulls for a column without values; all columns are served by the same passes.
    """
    found = iter(values_at(df, [
        Request(name, share, lambda n, share=share: max(1, math.ceil(share * n)))
        for name, wanted in shares.items() for share in wanted]))
    return {name: [next(found) for _ in wanted] for name, wanted in shares.items()}


def lower_quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> list[object]:
    """The lower quantiles of one column."""
    return lower_quantiles_of(df, {column: shares})[column]


def _interpolation(start: int, rows: int, share: float) -> tuple[int, int, float]:
    """Neighbouring 1-based ranks and weight of a quantile of rows ``start + 1 …``."""
    position = (rows - 1) * share
    lower = math.floor(position)
    return start + lower + 1, start + math.ceil(position) + 1, position - lower


def interpolated_quantiles(df: DataFrame, column: str,
                           requests: Sequence[tuple[int, int, float]], n: int) -> list[float]:
    """Quantiles of stretches of the ordered column: ``(rows before, rows, share)`` each."""
    spots = [_interpolation(*request) for request in requests]
    values = values_at_ranks(df, column, [r for lo, hi, _ in spots for r in (lo, hi)], n)
    return [float(values[lo]) + (float(values[hi]) - float(values[lo])) * weight
            for lo, hi, weight in spots]


def median(df: DataFrame, column: str) -> float | None:
    """Interpolated median over non-null values."""
    low, high = values_at(df, [Request(column, 0.5, lambda n: (n + 1) // 2),
                               Request(column, 0.5, lambda n: n // 2 + 1)])
    return None if low is None else float(low) + (float(high) - float(low)) * 0.5


def first_by_rank(df: DataFrame, value: str, key: str, ranks: Sequence[int],
                  n: int) -> list[Column]:
    """For each rank, a condition that holds for that many first rows by value, then key.

    Rows tied at a boundary value are told apart by the key at the boundary,
    itself found as an order statistic, so rows are never numbered.
    """
    cuts = values_at_ranks(df, value, [rank for rank in ranks if rank > 0], n)
    counts = {}
    if cuts:
        found = df.agg(*[F.count_if(test).alias(f"{name}_{rank}")
                         for rank, cut in cuts.items()
                         for name, test in (("below", F.col(value) < F.lit(cut)),
                                            ("tied", F.col(value) == F.lit(cut)))]).first()
        counts = {rank: (found[f"below_{rank}"], found[f"tied_{rank}"]) for rank in cuts}

    def condition(rank: int) -> Column:
        if rank <= 0:
            return F.lit(False)
        (below, tied), at_cut = counts[rank], F.col(value) == F.lit(cuts[rank])
        place = rank - below
        if place == tied:
            return F.col(value) <= F.lit(cuts[rank])
        last_key = values_at_ranks(df.where(at_cut), key, [place], tied)[place]
        return (F.col(value) < F.lit(cuts[rank])) | (at_cut & (F.col(key) <= F.lit(last_key)))

    return [condition(rank) for rank in ranks]
