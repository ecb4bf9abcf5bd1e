"""Exact quantiles (linear interpolation) without a single-reducer step.

Spark's ``percentile`` is exact but builds one value->count map per group in
one task: fine for a capped integer, not for a continuous metric over a
billion customers. Here the order statistics are selected by brackets:

1. One pass of mergeable sketches (``percentile_approx`` on an even grid, one
   sketch a task and metric) gives two cut points around every wanted rank.
2. The next pass counts the rows at each cut point and between neighbouring
   ones, exactly. A rank on a cut point is found; one between two of them has
   its bracket. A bracket that may hold more than ``SMALL`` rows is sketched in
   the same pass and cut again, to about 3/1,000 of its rows; cut points are
   taken out of the brackets, so a value held by a third of all rows does not
   come back.
3. The last pass counts all regions once more and the values inside the
   brackets, at most about ``SMALL`` for a wanted rank.

Two passes up to some million rows, three up to some billion. Nothing is range
partitioned, sorted or written; shuffles carry sketches and counts only. The
counts are exact whatever the sketch says, so it decides the number of passes
and never a result.

``partitions`` asks for the former plan instead: distinct values are range
partitioned and written, and only partitions with a wanted rank are sorted.

The driver only ever sees sketches, counts of regions and the few values in
the brackets. Interpolation: ``rn = (n-1)*q``, ``d = rn - floor(rn)``,
``lo*(1-d) + hi*d`` (numpy's ``linear`` method up to an ulp).
"""

from __future__ import annotations

import bisect
import math
from collections import defaultdict
from fractions import Fraction
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


#: Rows that a bracket may hold when its values are counted one by one.
SMALL = 4096
#: Steps of the sketches' grid, and their accuracy (rank error n / ACCURACY).
GRID = 1024
ACCURACY = 10_000
MAX_PASSES = 30


def _stack(df: DataFrame, cols: list[str], offset: int = 0) -> DataFrame:
    pairs = ", ".join(f"{offset + i}, CAST(`{c}` AS DOUBLE)" for i, c in enumerate(cols))
    return df.selectExpr(f"stack({len(cols)}, {pairs}) AS (m, v)").where(F.col("v").isNotNull())


def _stack_many(sources: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    out, offset = None, 0
    for df, cols in sources:
        part = _stack(df, cols, offset)
        out = part if out is None else out.unionByName(part)
        offset += len(cols)
    return out


def _interp(lo: float, hi: float, d: float) -> float:
    """``lo*(1-d) + hi*d`` with one rounding of the sum; another engine's last
    bit may differ, a tolerance of one unit in the last place."""
    return float(Fraction(lo) * Fraction(1.0 - d) + Fraction(hi * d))


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                    partitions: int | None = None) -> dict[str, list[float | None]]:
    """Exact linear-interpolated quantiles of each column in ``cols``:
    ``{col: [value per prob]}`` (None for a column with no non-null value)."""
    return exact_quantiles_many([(df, cols)], probs, partitions)[0]


def exact_quantiles_many(sources: list[tuple[DataFrame, list[str]]], probs: list[float],
                         partitions: int | None = None) -> list[dict[str, list[float | None]]]:
    """``exact_quantiles`` for several (frame, columns) sources in one job:
    the sources are stacked into one (metric, value) frame, so e.g. two
    binners fitted on related tables share a single shuffle and sort."""
    flat = [f"{i}:{c}" for i, (_, cols) in enumerate(sources) for c in cols]
    if partitions:
        res = _exact_ranged(_stack_many(sources), flat, probs, partitions)
    else:
        res = _exact_bracketed(sources, flat, probs)
    return [{c: res[f"{i}:{c}"] for c in cols} for i, (_, cols) in enumerate(sources)]


def _region(v: Column, cuts: list[float]) -> Column:
    """Number of a value's region: 2 i + 1 at the i-th cut point (from 0), even
    numbers between them."""
    out = F.lit(0)
    for c in cuts:
        out = out + F.when(v > F.lit(c), 2).when(v == F.lit(c), 1).otherwise(0)
    return out


def _regions(sources: list[tuple[DataFrame, list[str]]], cuts: dict[int, list[float]]) -> DataFrame:
    """(m, g, v): metric, region and value of all sources."""
    out, m = None, 0
    for df, cols in sources:
        parts = []
        for c in cols:
            v = F.col(c).cast("double")
            parts.append(F.struct(F.lit(m).alias("m"), _region(v, cuts.get(m, [])).alias("g"), v.alias("v")))
            m += 1
        part = df.select(F.explode(F.array(*parts)).alias("x")).select("x.m", "x.g", "x.v").where("v is not null")
        out = part if out is None else out.unionByName(part)
    return out


def _chosen(wanted: set[tuple[int, int]]) -> Column:
    """Whether a row's metric and region are among ``wanted``."""
    out = F.lit(False)
    for m in sorted({m for m, _ in wanted}):
        out = out | ((F.col("m") == m) & F.col("g").isin(sorted(g for k, g in wanted if k == m)))
    return out


def _between(cuts: list[float], low: float, high: float) -> list[int]:
    """The regions strictly between two cut points that hold no cut point."""
    return list(range(2 * bisect.bisect_left(cuts, low) + 2, 2 * bisect.bisect_left(cuts, high) + 1, 2))


def _exact_bracketed(sources: list[tuple[DataFrame, list[str]]], cols: list[str], probs: list[float]) -> dict[str, list[float | None]]:
    cuts: dict[int, list[float]] = {m: [] for m in range(len(cols))}
    ranks: dict[int, list[tuple[int, int, float]]] = {}
    small: set[tuple[int, float, float]] = set()  # brackets (metric, low, high) with few rows
    wanted = {(m, 0) for m in cuts}  # regions to be sketched in the next pass
    grid = [k / GRID for k in range(GRID + 1)]
    for _ in range(MAX_PASSES):
        if not wanted:
            return _counted(sources, cols, probs, cuts, ranks, {(m, g) for m, a, b in small for g in _between(cuts[m], a, b)})
        sketch = F.percentile_approx(F.when(_chosen(wanted), F.col("v")), grid, ACCURACY)
        seen = _regions(sources, cuts).groupBy("m", "g").agg(F.count(F.lit(1)).alias("n"), sketch.alias("s")).collect()
        large = set()
        for m, found in _by_metric(seen).items():
            ends = list(accumulate(r["n"] for r in found))
            rn = [(ends[-1] - 1) * q for q in probs]
            ranks[m] = [(math.floor(x), math.ceil(x), x - math.floor(x)) for x in rn]
            fresh = set(cuts[m])
            for t in {t for lo, hi, _ in ranks[m] for t in (lo, hi)}:
                at = bisect.bisect_right(ends, t)
                r = found[at]
                if not r["s"]:
                    continue  # on a cut point, or in a small bracket
                p = (t - ends[at] + r["n"] + 0.5) / r["n"] * GRID
                low, high = max(0, math.floor(p - 0.5)), min(GRID, math.ceil(p + 0.5))
                fresh |= {r["s"][k] for k in (0, low, high, GRID)}
                rows = ((high - low) / GRID + 2 / ACCURACY) * r["n"]  # at most, between the two
                (large if rows > SMALL else small).add((m, r["s"][low], r["s"][high]))
            cuts[m] = sorted(fresh)
        wanted = {(m, g) for m, a, b in large for g in _between(cuts[m], a, b)}
    raise RuntimeError("brackets did not settle")


def _by_metric(rows: list) -> dict[int, list]:
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["m"], r["g"])):
        out[r["m"]].append(r)
    return out


def _counted(sources: list[tuple[DataFrame, list[str]]], cols: list[str], probs: list[float], cuts: dict[int, list[float]],
             ranks: dict[int, list[tuple[int, int, float]]], small: set[tuple[int, int]]) -> dict[str, list[float | None]]:
    """The last pass: counts of regions, and of each value in the brackets. A
    rank outside its bracket (a sketch beyond its error) costs another pass."""
    regions = _regions(sources, cuts)
    one_by_one = F.when(_chosen(small), F.col("v"))
    got = regions.groupBy("m", "g", one_by_one.alias("v")).agg(F.count(F.lit(1)).alias("n")).collect()
    place: dict[tuple[int, int], tuple[int, int]] = {}  # (metric, rank) -> (region, rank in it)
    values: dict[tuple[int, int], list[tuple[float, int]]] = defaultdict(list)
    for m, rows in _by_metric(got).items():
        sizes: dict[int, int] = defaultdict(int)
        for r in rows:
            sizes[r["g"]] += r["n"]
            if r["v"] is not None:
                values[m, r["g"]].append((r["v"], r["n"]))
        ends = list(accumulate(sizes.values()))
        for t in {t for lo, hi, _ in ranks[m] for t in (lo, hi)}:
            at = bisect.bisect_right(ends, t)
            g = list(sizes)[at]
            place[m, t] = (g, t - ends[at] + sizes[g])
    missed = {(m, g) for (m, _), (g, _) in place.items() if g % 2 == 0 and (m, g) not in values}
    if missed:
        for r in regions.where(_chosen(missed)).groupBy("m", "g", "v").agg(F.count(F.lit(1)).alias("n")).collect():
            values[r["m"], r["g"]].append((r["v"], r["n"]))
    for found in values.values():
        found.sort()

    def value_at(m: int, t: int) -> float:
        g, left = place[m, t]
        if g % 2:
            return cuts[m][g // 2]
        for v, n in values[m, g]:
            if left < n:
                return v
            left -= n
        raise RuntimeError(f"rank {t} not found for metric {m}")

    out: dict[str, list[float | None]] = {}
    for m, c in enumerate(cols):
        out[c] = [None] * len(probs) if m not in ranks else [
            value_at(m, lo) if lo == hi else _interp(value_at(m, lo), value_at(m, hi), d) for lo, hi, d in ranks[m]]
    return out


def _exact_ranged(stacked: DataFrame, cols: list[str], probs: list[float],
                  partitions: int | None = None) -> dict[str, list[float | None]]:
    spark = stacked.sparkSession
    nparts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = stacked.groupBy("m", "v").agg(F.count(F.lit(1)).alias("c"))
    ranged = materialize(
        counts.repartitionByRange(nparts, "m", "v").withColumn("p", F.spark_partition_id()),
        "quantile_ranges")

    totals = ranged.groupBy("m", "p").agg(F.sum("c").alias("pc")).collect()
    per_metric: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for r in totals:
        per_metric[r["m"]].append((r["p"], r["pc"]))

    # target rank -> (m, p, local rank)
    wanted: dict[tuple[int, int], set[int]] = defaultdict(set)
    plan: dict[int, list[tuple[int, int, float]]] = {}
    for m in range(len(cols)):
        parts = sorted(per_metric.get(m, []))
        n = sum(pc for _, pc in parts)
        if n == 0:
            continue
        starts, acc = [], 0
        for p, pc in parts:
            starts.append((acc, acc + pc, p))
            acc += pc
        rows = []
        for q in probs:
            rn = (n - 1) * q
            lo, hi = math.floor(rn), math.ceil(rn)
            rows.append((lo, hi, rn - lo))
            for r in (lo, hi):
                for a, b, p in starts:
                    if a <= r < b:
                        wanted[(m, p)].add(r - a)
                        break
        plan[m] = (rows, {p: a for a, _, p in starts})

    if not wanted:
        return {c: [None] * len(probs) for c in cols}

    sel = None
    for (m, p), locs in wanted.items():
        cond = (F.col("m") == m) & (F.col("p") == p)
        sel = cond if sel is None else (sel | cond)
    w = Window.partitionBy("m", "p").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    cand = ranged.where(sel).withColumn("cum", F.sum("c").over(w))
    hit = None
    for (m, p), locs in wanted.items():
        for t in locs:
            cond = ((F.col("m") == m) & (F.col("p") == p)
                    & (F.col("cum") - F.col("c") <= t) & (F.col("cum") > t))
            hit = cond if hit is None else (hit | cond)
    picked = cand.where(hit).select("m", "p", "v", "c", "cum").collect()

    def value_at(m: int, rank: int) -> float:
        starts = plan[m][1]
        for r in picked:
            if r["m"] != m:
                continue
            a = starts[r["p"]]
            if a + r["cum"] - r["c"] <= rank < a + r["cum"]:
                return r["v"]
        raise RuntimeError(f"rank {rank} not found for metric {m}")

    out: dict[str, list[float | None]] = {}
    for m, c in enumerate(cols):
        if m not in plan:
            out[c] = [None] * len(probs)
            continue
        vals = []
        for lo, hi, d in plan[m][0]:
            x_lo = value_at(m, lo)
            vals.append(x_lo if lo == hi else _interp(x_lo, value_at(m, hi), d))
        out[c] = vals
    return out


def approx_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                     accuracy: int = 10000) -> dict[str, list[float | None]]:
    """Bounded-memory sketch (``percentile_approx``); ranks within n/accuracy,
    no interpolation. One partial sketch per task, merged per metric."""
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), list(probs), accuracy).alias(c)
                   for c in cols]).first()
    return {c: (list(row[c]) if row[c] is not None else [None] * len(probs)) for c in cols}
