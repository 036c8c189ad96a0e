"""Exact order statistics without a global sort.

A rank is located by narrowing: a mergeable quantile sketch proposes two values around it, an exact count says how
many rows lie below, on and between them, and the search continues in the open interval that holds the rank. Every
round shrinks that interval by about 1/1000 of its rows, so a trillion rows need four scans, each with a tiny
shuffle. Only when an interval is proven to hold at most ``SORT_LIMIT`` rows is it sorted in one task; all intervals
sorted together hold at most ``SORT_BUDGET`` rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SORT_LIMIT = 200_000
SORT_BUDGET = 1_000_000
SKETCH_ACCURACY = 10_000
# Half-width of the proposed bracket, in units of rank share: five times the sketch's error bound.
BRACKET = 5.0 / SKETCH_ACCURACY
# Groups are enumerated on the driver, so their number has to be small by meaning (classes, types).
MAX_GROUPS = 1000


@dataclass
class RankTarget:
    """The row of 0-based ``rank`` in ascending order of ``column`` among the rows where ``where`` holds."""

    where: Column
    column: str
    rank: int
    size: int
    low: float | int | None = None
    high: float | int | None = None
    below: int = 0  # rows of ``where`` at or under ``low``
    inside: int = 0  # rows of the open interval (low, high)
    value: float | int | None = None
    less: int = 0  # rows strictly below ``value``
    equal: int = 0  # rows equal to ``value``

    def condition(self) -> Column:
        c = F.col(self.column)
        test = self.where & c.isNotNull()
        if self.low is not None:
            test = test & (c > F.lit(self.low))
        if self.high is not None:
            test = test & (c < F.lit(self.high))
        return test


def select_ranks(df: DataFrame, targets: list[RankTarget], sort_limit: int = SORT_LIMIT, runs: bool = True) -> list[RankTarget]:
    """Fill ``value`` of every target, and ``less`` and ``equal`` unless ``runs`` is off."""
    for t in targets:
        if not 0 <= t.rank < t.size:
            raise ValueError(f"rank {t.rank} outside 0..{t.size - 1}")
        t.inside = t.size
    while True:
        wide = [t for t in targets if t.value is None and t.inside > sort_limit]
        if not wide:
            break
        _narrow(df, wide)
    for part in _within_budget([t for t in targets if t.value is None]):
        _sort_small(df, part, runs)
    return targets


def _within_budget(targets: list[RankTarget]) -> list[list[RankTarget]]:
    """Targets cut into parts whose intervals hold at most ``SORT_BUDGET`` rows; those of one interval stay together."""
    parts, room, last = [], 0, None
    for t in sorted(targets, key=_interval):
        if _interval(t) != last:
            if not parts or room < t.inside:
                parts.append([])
                room = SORT_BUDGET
            room -= t.inside
            last = _interval(t)
        parts[-1].append(t)
    return parts


def _interval(t: RankTarget) -> tuple:
    return id(t.where), t.column, repr(t.low), repr(t.high)


def _brackets(targets: list[RankTarget]) -> list[list[RankTarget]]:
    """Targets that one pair of proposed values serves: neighbouring ranks of one interval, such as the two around a median."""
    found: list[list[RankTarget]] = []
    for t in sorted(targets, key=lambda t: (_interval(t), t.rank)):
        if found and _interval(found[-1][0]) == _interval(t) and t.rank - found[-1][0].rank <= 1:
            found[-1].append(t)
        else:
            found.append([t])
    return found


def _narrow(df: DataFrame, targets: list[RankTarget]) -> None:
    brackets = _brackets(targets)
    intervals: dict[tuple, list[int]] = {}
    for i, group in enumerate(brackets):
        intervals.setdefault(_interval(group[0]), []).append(i)
    sketches, place = [], {}
    for members in intervals.values():
        points = []
        for i in members:
            first, last = brackets[i][0], brackets[i][-1]
            shares = [(t.rank - t.below) / max(t.inside - 1, 1) for t in (first, last)]
            place[i] = len(sketches), len(points)
            points += [max(shares[0] - BRACKET, 0.0), min(shares[1] + BRACKET, 1.0)]
        # One sketch of an interval answers for all its ranks.
        value = F.when(first.condition(), F.col(first.column))
        sketches.append(F.percentile_approx(value, points, SKETCH_ACCURACY).alias(f"p{len(sketches)}"))
    sketched = df.agg(*sketches).first()
    bounds = [tuple(sketched[f"p{k}"][j : j + 2]) for k, j in (place[i] for i in range(len(brackets)))]
    counts = []
    for i, (group, (low, high)) in enumerate(zip(brackets, bounds)):
        c, inside = F.col(group[0].column), group[0].condition()
        tests = [c < F.lit(low), c == F.lit(low), (c > F.lit(low)) & (c < F.lit(high)), c == F.lit(high)]
        counts.append(F.array(*[F.count_if(inside & test) for test in tests]).alias(f"n{i}"))
    counted = df.agg(*counts).first()
    for i, (group, (low, high)) in enumerate(zip(brackets, bounds)):
        for t in group:
            _settle(t, low, high, counted[f"n{i}"])


def _settle(t: RankTarget, low: float | int, high: float | int, counted: list[int]) -> None:
    """The target's value, or the part of its interval that holds it."""
    under, on_low, between, on_high = counted
    if low == high:
        on_high = 0
    local = t.rank - t.below
    if local < under:
        t.high, t.inside = low, under
    elif local < under + on_low:
        t.value, t.less, t.equal = low, t.below + under, on_low
    elif local < under + on_low + between:
        t.low, t.high, t.below, t.inside = low, high, t.below + under + on_low, between
    elif local < under + on_low + between + on_high:
        t.value, t.less, t.equal = high, t.below + under + on_low + between, on_high
    else:
        skipped = under + on_low + between + on_high
        t.low, t.below, t.inside = high, t.below + skipped, t.inside - skipped


def _run_length(array: Column, value: Column) -> Column:
    return F.size(F.filter(array, lambda x: x == value))


def _sort_small(df: DataFrame, targets: list[RankTarget], runs: bool) -> None:
    """Sort intervals already proven to hold few rows, sharing one sort between targets of the same interval."""
    shared: dict[tuple, list[RankTarget]] = {}
    for t in targets:
        shared.setdefault(_interval(t), []).append(t)
    arrays = [
        F.array_sort(F.collect_list(F.when(group[0].condition(), F.col(group[0].column)))).alias(f"a{i}")
        for i, group in enumerate(shared.values())
    ]
    picks, flat = [], []
    for i, group in enumerate(shared.values()):
        for t in group:
            array = F.col(f"a{i}")
            value = F.element_at(array, t.rank - t.below + 1)
            fields = [value.alias("v")]
            if runs:
                fields += [F.array_position(array, value).alias("first"), _run_length(array, value).alias("run")]
            picks.append(F.struct(*fields).alias(f"r{len(flat)}"))
            flat.append(t)
    row = df.agg(*arrays).select(*picks).first()
    for i, t in enumerate(flat):
        found = row[f"r{i}"]
        t.value = found["v"]
        if runs:
            t.less, t.equal = t.below + found["first"] - 1, found["run"]


def group_values(df: DataFrame, by: str | None) -> list[tuple[object, Column]]:
    """(value, condition) of each group; one catch-all group when ``by`` is None."""
    if by is None:
        return [(None, F.lit(True))]
    rows = df.groupBy(by).count().orderBy(by).limit(MAX_GROUPS + 1).collect()
    if len(rows) > MAX_GROUPS:
        raise ValueError(f"{by} has more than {MAX_GROUPS} values; group statistics expect a class-like column")
    return [(r[0], F.col(by).eqNullSafe(F.lit(r[0]))) for r in rows]


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    by: str | None = None,
    sort_limit: int = SORT_LIMIT,
) -> dict[object, dict[str, list[float | None]]]:
    """Linearly interpolated quantiles per group and column: ``{group: {column: [q, ...]}}``.

    Only non-null values count. The result is a handful of numbers per column.
    """
    clean = df.select(*([by] if by else []), *[F.col(c) for c in dict.fromkeys(columns) if c != by])
    groups = group_values(clean, by)
    sizes = clean.agg(
        *[F.count(F.when(cond, F.col(c))).alias(f"n{g}_{i}") for g, (_, cond) in enumerate(groups) for i, c in enumerate(columns)]
    ).first()
    targets: dict[tuple, RankTarget] = {}
    for g, (_, cond) in enumerate(groups):
        for i, c in enumerate(columns):
            n = sizes[f"n{g}_{i}"]
            for p in probabilities:
                if n:
                    place = p * (n - 1)
                    for rank in {math.floor(place), math.ceil(place)}:
                        targets.setdefault((g, i, rank), RankTarget(cond, c, rank, n))
    select_ranks(clean, list(targets.values()), sort_limit, runs=False)
    result: dict[object, dict[str, list[float | None]]] = {}
    for g, (value, _) in enumerate(groups):
        result[value] = {}
        for i, c in enumerate(columns):
            n, points = sizes[f"n{g}_{i}"], []
            for p in probabilities:
                if not n:
                    points.append(None)
                    continue
                place = p * (n - 1)
                low = float(targets[(g, i, math.floor(place))].value)
                high = float(targets[(g, i, math.ceil(place))].value)
                points.append(_between(low, high, place))
            result[value][c] = points
    return result


def _between(low: float, high: float, place: float) -> float:
    """Linear interpolation; an infinite neighbour counts only where the place lies off the other one."""
    if low == high or place == math.floor(place):
        return low
    return (math.ceil(place) - place) * low + (place - math.floor(place)) * high


def exact_medians(df: DataFrame, columns: list[str], **kw) -> dict[str, float | None]:
    return {c: q[0] for c, q in exact_quantiles(df, columns, [0.5], **kw)[None].items()}


def left_out_medians(df: DataFrame, columns: list[str], by: str, sort_limit: int = SORT_LIMIT) -> dict[object, dict[str, float | None]]:
    """Exact medians of all rows (under None) and, for each value of ``by``, of the rows with another value: ``{value: {column: median}}``.

    One sketch of all rows proposes two values around every median; counts and the values between them are taken for each value of
    ``by``, and those of a part are the sums of the others. A part whose median lies elsewhere is searched alone.
    """
    clean = df.select(by, *columns)
    names = [value for value, _ in group_values(clean, by)]

    def by_group(entries: list[Column]) -> dict[object, list]:
        rows = clean.groupBy(by).agg(*[e.alias(f"c{i}") for i, e in enumerate(entries)]).collect()
        return {r[by]: [r[f"c{i}"] for i in range(len(entries))] for r in rows}

    sizes = by_group([F.count(c) for c in columns])
    parts = {None: names} | {g: [other for other in names if other != g] for g in names}
    least = max(1, min(sum(sizes[g][i] for g in kept) for kept in parts.values() for i in range(len(columns))))
    # The rank of a median moves by about the root of the rows when a random part of them is left out.
    half = BRACKET + 2.5 / math.sqrt(least)
    points = [max(0.5 - half, 0.0), min(0.5 + half, 1.0)]
    proposed = clean.agg(*[F.percentile_approx(c, points, SKETCH_ACCURACY).alias(f"p{i}") for i, c in enumerate(columns)]).first()
    bounds = [tuple(p) if p else (None, None) for p in proposed]
    between = [(F.col(c) > F.lit(low)) & (F.col(c) < F.lit(high)) for c, (low, high) in zip(columns, bounds)]
    tests = [(F.col(c) < F.lit(low), F.col(c) == F.lit(low), inside, F.col(c) == F.lit(high)) for c, (low, high), inside in zip(columns, bounds, between)]
    counts = by_group([F.array(*[F.count_if(t) for t in four]) for four in tests])
    few = [sum(counts[g][i][2] for g in names) <= sort_limit // max(len(columns), 1) for i in range(len(columns))]
    values = by_group([F.collect_list(F.when(inside, F.col(c)) if ok else F.lit(None).cast("double")) for c, inside, ok in zip(columns, between, few)])
    found: dict[object, dict[str, float | None]] = {}
    for g, kept in parts.items():
        medians = {}
        for i, c in enumerate(columns):
            low, high = bounds[i]
            n, under, on_low, inside, on_high = (sum(v) for v in zip(*[(sizes[k][i], *counts[k][i]) for k in kept])) if kept else [0] * 5
            ordered = sorted(v for k in kept for v in values[k][i]) if few[i] else []
            place = (n - 1) / 2
            ranks = [r - under for r in (math.floor(place), math.ceil(place))]
            reached = on_low + inside + (on_high if low != high else 0)
            if not n:
                medians[c] = None
            elif 0 <= ranks[0] and ranks[1] < reached and (few[i] or ranks[1] < on_low or ranks[0] >= on_low + inside):
                ends = [low if r < on_low else ordered[r - on_low] if r < on_low + inside else high for r in ranks]
                medians[c] = _between(float(ends[0]), float(ends[1]), place)
        missed = [c for c in columns if c not in medians]
        if missed:
            medians |= exact_medians(clean if g is None else clean.filter(~F.col(by).eqNullSafe(F.lit(g))), missed)
        found[g] = medians
    return found


@dataclass(frozen=True)
class Cutoff:
    """The last row of an ordered prefix: every row up to and including (key, tie) belongs to it.

    ``tie`` is None when the prefix ends with the last row of its key. Rows without key come last, ordered by tie; ``key`` is
    None when the prefix ends among them.
    """

    key: object
    tie: object

    def covers(self, key: str, tie: str) -> Column:
        if self.key is None:
            return F.col(key).isNotNull() if self.tie is None else F.col(key).isNotNull() | (F.col(tie) <= F.lit(self.tie))
        k = F.lit(self.key)
        inside = F.col(key) <= k if self.tie is None else (F.col(key) < k) | ((F.col(key) == k) & (F.col(tie) <= F.lit(self.tie)))
        return F.coalesce(inside, F.lit(False))


def prefix_cutoffs(
    df: DataFrame,
    key: str,
    tie: str,
    wanted: list[tuple[Column, int, int]],
    sort_limit: int = SORT_LIMIT,
    nulls: bool = False,
) -> list[Cutoff | None]:
    """Cutoffs of the first ``length`` rows by (key, tie) among the rows of ``where``.

    ``wanted`` holds (where, size of where, length); a length of 0 gives None. ``tie`` must be unique within a key.
    Rows can then be told apart by comparing with literals, so splitting and sampling need no sort of the data.
    With ``nulls`` rows may lack the key; they come last.
    """
    keyed = [size for _, size, _ in wanted]
    if nulls and wanted:
        counts = df.agg(*[F.count_if(w & F.col(key).isNotNull()).alias(f"n{i}") for i, (w, _, _) in enumerate(wanted)]).first()
        keyed = list(counts)
    targets, last = [], {}
    for i, ((w, size, length), n) in enumerate(zip(wanted, keyed)):
        length = min(length, size)
        targets.append(RankTarget(w, key, length - 1, n) if 0 < length <= n else None)
        if length > n:
            last[i] = RankTarget(w & F.col(key).isNull(), tie, length - n - 1, size - n)
    select_ranks(df, list(last.values()), sort_limit, runs=False)
    first = [t for t in targets if t]
    select_ranks(df, first, sort_limit)
    # A prefix that ends inside a run of equal keys also needs the tie value of its last row.
    inside = [t for t in first if t.rank < t.less + t.equal - 1]
    second = [RankTarget(t.where & (F.col(key) == F.lit(t.value)), tie, t.rank - t.less, t.equal) for t in inside]
    if second:
        select_ranks(df, second, sort_limit)
    ties = {id(t): s.value for t, s in zip(inside, second)}
    found = [Cutoff(t.value, ties.get(id(t))) if t else None for t in targets]
    for i, t in last.items():
        found[i] = Cutoff(None, t.value)
    return found
