"""Quantiles and the IQR outlier rule.

Two modes:

* ``approx`` (default, what the original pipeline does): one
  ``percentile_approx`` aggregation with relative error ``rel_error``
  (accuracy = 1 / rel_error). Partial sketches are merged, so memory per task
  is bounded whatever the row count.
* ``exact``: interpolated quantiles (same definition as SQL
  ``percentile`` / DuckDB ``quantile_cont``) found by distributed selection. One
  sketch aggregation brackets every wanted rank between two values; a second
  aggregation counts the rows below each bracket and, inside it only, rows per
  equal-width bucket (map-side combined, so a hot value costs one row per task;
  what is shuffled follows the bracket's share of the rows, not tasks times buckets).
  A rank whose bucket holds several values is narrowed to it and looked at again. The
  driver sees one row per rank and round; no task ever holds the values of a group.

NULL, NaN and the infinities are no values: both modes leave them out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from joulebox.functions.numeric import finite_or_null

DEFAULT_BUCKETS = 1 << 12
#: Accuracy of the sketch that brackets the ranks: off by at most 1 / ACCURACY of the rows.
ACCURACY = 2_000


def _interpolate(lo: float, hi: float, frac: float) -> float:
    return lo + (hi - lo) * frac


def _bucket(x: Column, lo: float, hi: float, buckets: int) -> Column:
    """Monotone bucket in [0, buckets] of x in [lo, hi]; hi alone is bucket ``buckets``.

    The fraction is formed before scaling up, and both ends are halved when
    hi - lo overflows, so no intermediate leaves the double range (SQL
    ``width_bucket`` multiplies first and breaks on such ranges).
    """
    scale = 0.5 if math.isinf(hi - lo) else 1.0
    frac = (x * scale - F.lit(lo * scale)) / F.lit(hi * scale - lo * scale)
    return F.least(F.floor(frac * buckets), F.lit(buckets)).cast("long")


def _select_round(narrow: DataFrame, open_: dict, buckets: int) -> dict:
    """One refinement round: for each open target, the bucket holding its rank.

    Histograms are built and searched inside Spark: per probe (column, range)
    counts per bucket, a running count over the probe's buckets (at most
    ``buckets + 2`` rows per probe), and a join with the open targets. Only one
    row per target returns to the driver.
    """
    spark = narrow.sparkSession
    probes = sorted({(c, lo, hi) for (c, _), (lo, hi, _) in open_.items()}, key=repr)
    probe_id = {p: i for i, p in enumerate(probes)}
    entries = []
    for i, (c, lo, hi) in enumerate(probes):
        x = F.col(c)
        b = _bucket(x, lo, hi, buckets)
        entries.append(F.when(x.between(lo, hi), F.struct(F.lit(i).alias("p"), b.alias("b"), x.alias("v"))))
    hist = (
        narrow.select(F.explode(F.array_compact(F.array(*entries))).alias("e"))
        .groupBy(F.col("e.p").alias("p"), F.col("e.b").alias("b"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("e.v").alias("mn"), F.max("e.v").alias("mx"))
    )
    before = Window.partitionBy("p").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    hist = hist.withColumn("below", F.coalesce(F.sum("n").over(before), F.lit(0)))
    keys = list(open_)
    wanted = spark.createDataFrame(
        [(t, probe_id[(c, lo, hi)], int(rank - offset)) for t, ((c, rank), (lo, hi, offset)) in enumerate(zip(keys, open_.values()))],
        "t int, p int, r long",
    )
    # bounded: one row per open target
    found = (
        hist.join(F.broadcast(wanted), "p")
        .filter((F.col("below") <= F.col("r")) & (F.col("r") < F.col("below") + F.col("n")))
        .select("t", "below", "mn", "mx")
        .collect()
    )
    return {keys[row["t"]]: row for row in found}


def _brackets(narrow: DataFrame, targets: dict[str, set[int]], sizes: dict[str, int]) -> dict:
    """(column, rank) -> (low, high): values of the sketch at least one error below and above the rank."""
    wanted = {c: sorted(r) for c, r in targets.items()}
    exprs = []
    for c, ranks in wanted.items():
        ends = [min(1.0, max(0.0, r / sizes[c] + side * 2 / ACCURACY)) for r in ranks for side in (-1, 1)]
        exprs.append(F.percentile_approx(c, F.array(*[F.lit(p) for p in ends]), ACCURACY).alias(c))
    row = narrow.agg(*exprs).first()
    return {(c, r): (row[c][2 * i], row[c][2 * i + 1]) for c, ranks in wanted.items() for i, r in enumerate(ranks)}


def exact_order_statistics(
    narrow: DataFrame, targets: dict[str, set[int]], extremes: dict[str, tuple], sizes: dict[str, int], buckets: int = DEFAULT_BUCKETS
) -> dict[tuple[str, int], float]:
    """Values at 0-based ranks among the non-null values of each column (finite ones only).

    ``targets`` maps a column to the ranks wanted (each < the column's
    non-null count, ``sizes``); ``extremes`` gives each column's (min, max).
    """
    done: dict[tuple[str, int], float] = {}
    open_: dict[tuple[str, int], list] = {}  # (col, rank) -> [lo, hi, rows below lo]
    asked = {c: r for c, r in targets.items() if extremes[c][0] != extremes[c][1]}
    done.update({(c, r): extremes[c][0] for c, ranks in targets.items() if c not in asked for r in ranks})
    if not asked:
        return done
    brackets = _brackets(narrow, asked, sizes)
    below = narrow.agg(
        *[F.count_if(F.col(c) < lo).alias(f"lo{i}") for i, ((c, _), (lo, _)) in enumerate(brackets.items())],
        *[F.count_if(F.col(c) <= hi).alias(f"hi{i}") for i, ((c, _), (_, hi)) in enumerate(brackets.items())],
    ).first()
    for i, ((c, r), (lo, hi)) in enumerate(brackets.items()):
        inside = below[f"lo{i}"] <= r < below[f"hi{i}"]
        open_[(c, r)] = [lo, hi, below[f"lo{i}"]] if inside else [*extremes[c], 0]
        if inside and lo == hi:
            done[(c, r)] = lo
            del open_[(c, r)]
    # every round divides a range by the number of buckets, down to one value: it ends for any doubles
    while open_:
        found = _select_round(narrow, open_, buckets)
        for key, (_, _, offset) in list(open_.items()):
            row = found.get(key)
            if row is None:
                raise RuntimeError(f"rank {key[1]} not found for column {key[0]}")
            if row["mn"] == row["mx"]:
                done[key] = row["mn"]
                del open_[key]
            else:
                open_[key] = [row["mn"], row["mx"], offset + row["below"]]
    return done


def extreme_metrics(cols: list[str], where: Column | None = None) -> dict:
    """Aggregates giving ``exact_quantiles`` its (count, min, max) per column, for
    ``DataFrame.observe`` on a write of the same rows (``where`` selects them)."""
    out = {}
    for c in cols:
        x = finite_or_null(F.col(c).cast("double"))
        x = x if where is None else F.when(where, x)
        out.update({f"{c}__n": F.count(x), f"{c}__min": F.min(x), f"{c}__max": F.max(x)})
    return out


def exact_quantiles(
    df: DataFrame, cols: list[str], probs: list[float], buckets: int = DEFAULT_BUCKETS, extremes: dict | None = None
) -> dict:
    """{(col, p): value or None}; linear interpolation between order statistics.

    The input is read a few times (only the wanted columns of it), so hand in a stored table.
    ``extremes`` (the values of ``extreme_metrics``, e.g. observed while the
    rows were written) saves the first pass over the data.
    """
    narrow = df.select(*[finite_or_null(F.col(c).cast("double")).alias(c) for c in cols])
    if extremes is not None:
        first = {c: (extremes[f"{c}__n"], extremes[f"{c}__min"], extremes[f"{c}__max"]) for c in cols}
    else:
        first = narrow.agg(*[F.struct(F.count(c), F.min(c), F.max(c)).alias(c) for c in cols]).first()
    targets: dict[str, set[int]] = {}
    plan = {}
    for c in cols:
        n = first[c][0]
        for p in probs:
            if n == 0:
                plan[(c, p)] = None
                continue
            h = (n - 1) * p
            lo_r, hi_r = math.floor(h), math.ceil(h)
            targets.setdefault(c, set()).update((lo_r, hi_r))
            plan[(c, p)] = (lo_r, hi_r, h - lo_r)
    ranges = {c: (first[c][1], first[c][2]) for c in cols}
    stats = exact_order_statistics(narrow, targets, ranges, {c: first[c][0] for c in cols}, buckets) if targets else {}
    out = {}
    for key, spec in plan.items():
        if spec is None:
            out[key] = None
            continue
        lo_r, hi_r, frac = spec
        c = key[0]
        lo_v, hi_v = stats[(c, lo_r)], stats[(c, hi_r)]
        out[key] = lo_v if lo_r == hi_r else _interpolate(lo_v, hi_v, frac)
    return out


def approx_quantile_row(df: DataFrame, cols: list[str], probs: list[float], rel_error: float = 0.01) -> DataFrame:
    """One row, one array column per input column (NULL when the column has no values)."""
    accuracy = max(1, int(round(1.0 / rel_error)))
    return df.agg(
        *[F.percentile_approx(finite_or_null(F.col(c).cast("double")), F.array(*[F.lit(p) for p in probs]), accuracy).alias(c) for c in cols]
    )


def quantile_table(
    df: DataFrame, cols: list[str], probs: list[float], mode: str = "approx", rel_error: float = 0.01
) -> DataFrame:
    """Long table (column, probability, value)."""
    spark = df.sparkSession
    if mode == "exact":
        q = exact_quantiles(df, cols, probs)
    else:
        row = approx_quantile_row(df, cols, probs, rel_error).first()
        q = {(c, p): (row[c][i] if row[c] else None) for c in cols for i, p in enumerate(probs)}
    rows = [(c, float(p), q[(c, p)]) for c in cols for p in probs]
    return spark.createDataFrame(rows, "column string, probability double, value double")


def iqr_bounds(
    df: DataFrame,
    cols: list[str],
    factor: float = 3.0,
    mode: str = "approx",
    rel_error: float = 0.01,
    extremes: dict | None = None,
) -> dict[str, tuple[Column, Column] | None]:
    """Per column (lower, upper) = (Q1 - factor*IQR, Q3 + factor*IQR) as literals.

    All bounds come from the same input. A column without quantiles maps to
    None (its rule is skipped). The quartiles come back to the driver as one
    row of 2 x len(cols) doubles and enter the plan as literals, so the range
    tests push down like any constant predicate (a scalar subquery would be
    re-planned once per reference).
    """
    if mode == "exact":
        q = exact_quantiles(df, cols, [0.25, 0.75], extremes=extremes)
        quart = {c: (q[(c, 0.25)], q[(c, 0.75)]) for c in cols}
    else:
        row = approx_quantile_row(df, cols, [0.25, 0.75], rel_error).first()
        quart = {c: ((row[c][0], row[c][1]) if row[c] else (None, None)) for c in cols}
    out: dict[str, tuple[Column, Column] | None] = {}
    for c in cols:
        q1, q3 = quart[c]
        if q1 is None or q3 is None:
            out[c] = None
        else:
            iqr = q3 - q1
            out[c] = (F.lit(q1 - factor * iqr), F.lit(q3 + factor * iqr))
    return out


def iqr_condition(bounds: dict[str, tuple[Column, Column] | None]) -> Column | None:
    """AND of per-column inclusive range tests; a NULL bound skips that column."""
    cond = None
    for c, b in bounds.items():
        if b is None:
            continue
        lo, hi = b
        test = F.when(lo.isNull() | hi.isNull(), F.lit(True)).otherwise((F.col(c) >= lo) & (F.col(c) <= hi))
        cond = test if cond is None else (cond & test)
    return cond


def iqr_filter(
    df: DataFrame, cols: list[str], factor: float = 3.0, mode: str = "approx", rel_error: float = 0.01
) -> DataFrame:
    """Keep rows inside [Q1 - factor*IQR, Q3 + factor*IQR] for every column."""
    cond = iqr_condition(iqr_bounds(df, cols, factor, mode, rel_error))
    return df if cond is None else df.filter(cond)
