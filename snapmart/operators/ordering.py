"""Exact order statistics and running sums that never put one group into one task.

Both operators work on nested value ranges (see ``order_key``). Ranges are counted first;
sorting only ever happens between the members of one range.
"""

from collections import defaultdict
from collections.abc import Callable
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapmart.functions.numbers import null_nan, order_key
from snapmart.operators.lookup import staged_lookup

#: Leading bits of the nested ranges of running sums.
LEVELS = (9, 24, 39)
COARSE_BITS, FINE_BITS = 10, 20


def running_sums(df: DataFrame, groups: list, value: str, sums: dict[str, Column],
                 key: Callable[[Column, int], Column] = order_key) -> DataFrame:
    """One row per group and distinct value with sums, sums of all smaller values and totals.

    For every entry ``name`` of ``sums`` the result has ``name`` (sum at the value),
    ``name_before`` (sum over smaller values of the group) and ``name_total``. Rows of equal
    values are combined map-side. Ranges of values are nested to a fixed depth (``LEVELS``): a running sum is the sum over the ranges before
    at each level, inside the range of the level above, plus that over smaller values inside the last range. So no task holds more than the
    ranges of one range, 32,768 at most below the first level, or the 8,192 different values of the last, however close together
    the values are. Rows with a NULL value take no part.
    """
    names = list(sums)
    cells = [f"_r{bits}" for bits in LEVELS]
    leaf = df.filter(F.col(value).isNotNull()).groupBy(*groups, value).agg(*[e.alias(n) for n, e in sums.items()])
    leaf = leaf.withColumns({c: F.coalesce(key(F.col(value), bits), F.lit(0).cast("bigint")) for c, bits in zip(cells, LEVELS, strict=True)})

    def before(n, part, order):
        w = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(n).over(w), F.lit(0))

    def inside(frame, part, order):
        """Sums before each row among those of its range."""
        return frame.withColumns({f"{n}_before": before(n, part, order) for n in names})

    def placed(frame, offsets, part):
        """``frame`` with the sums before its range added; null-safe, so that a group whose key is NULL keeps its rows."""
        renamed = offsets.select(*[F.col(c).alias(f"_of_{c}") for c in part], *[F.col(f"{n}_before").alias(f"_of_{n}") for n in names], *[f"{n}_total" for n in names])
        same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in part]
        # never broadcast: sorted sums compress so well in the shuffle that what looks small there would fill the driver
        found = frame.join(renamed.hint("merge"), same)
        return found.withColumns({f"{n}_before": F.col(f"_of_{n}") + F.col(f"{n}_before") for n in names}).drop(*[f"_of_{c}" for c in [*part, *names]])

    # Sums of the ranges of every level, the finest first.
    levels = [leaf]
    for depth in range(len(cells), 0, -1):
        levels.insert(0, levels[0].groupBy(*groups, *cells[:depth]).agg(*[F.sum(n).alias(n) for n in names]))
    totals = {f"{n}_total": F.sum(n).over(Window.partitionBy(*groups)) for n in names}
    offsets = inside(levels[0], groups, cells[0]).withColumns(totals)
    for depth in range(1, len(cells)):
        part = [*groups, *cells[:depth]]
        offsets = placed(inside(levels[depth], part, cells[depth]), offsets, part)
    part = [*groups, *cells]
    out = placed(inside(leaf, part, value), offsets, part)
    return out.select(*groups, value, *names, *[f"{n}_before" for n in names], *[f"{n}_total" for n in names])


def long_values(df: DataFrame, columns: dict[str, Column], names="column", values="value") -> DataFrame:
    """Unpivot expressions to (column, value) rows without NULLs; one scan for all of them."""
    pairs = F.array(*[F.struct(F.lit(n).alias(names), e.alias(values)) for n, e in columns.items()])
    return df.select(F.inline(pairs)).filter(F.col(values).isNotNull())


def exact_quantiles(df: DataFrame, columns: dict[str, Column], probs: dict[str, float]) -> dict:
    """Fit exact quantiles with linear interpolation: ``{column: {prob name: value}}``.

    The columns are read once: equal values are combined map-side and written with their counts. Rank selection then takes
    three narrowing passes over the counts: of coarse ranges, of the fine ranges inside the hit coarse ones, and of the
    values inside the hit ranges. Only counts are
    shuffled, and no task sees more than the members of one range, whereas the built-in exact
    percentile keeps all distinct values of a column in one task. The driver gets at most two
    rows per column and probability and pass. NULL and NaN take no part; a column without
    values is absent.
    """
    return quantiles_of_counts(long_values(df, {n: null_nan(e) for n, e in columns.items()}).withColumn("_n", F.lit(1)), probs)


def quantiles_of_counts(counted: DataFrame, probs: dict[str, float]) -> dict:
    """``exact_quantiles`` of (column, value, _n) rows that stand for ``_n`` equal values each; a NULL value takes no part."""
    data = staged_lookup(counted.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.sum("_n").alias("_n")))
    data = data.select("column", "value", "_n", *[
        order_key(F.col("value"), bits).alias(f"_r{bits}") for bits in (COARSE_BITS, FINE_BITS)])

    coarse, fine = f"_r{COARSE_BITS}", f"_r{FINE_BITS}"
    top = _cumulated(data, ["column"], coarse).withColumn(
        "_total", F.sum("_n").over(Window.partitionBy("column")))
    positions = [(F.col("_total") - 1) * F.lit(float(q)) for q in dict.fromkeys(probs.values())]
    hits = (top.withColumn("_rank", F.explode(F.array(*[f(p) for p in positions for f in (F.floor, F.ceil)])))
            .filter((F.col("_rank") >= F.col("_lo")) & (F.col("_rank") < F.col("_hi")))
            .select("column", F.col(coarse).alias("range"), "_n", "_total", F.col("_rank").alias("at"),
                    (F.col("_rank") - F.col("_lo")).alias("inner")).collect())
    if not hits:
        return {}
    totals = {h["column"]: h["_total"] for h in hits}
    targets = sorted({(h["column"], h["range"], h["at"], h["inner"]) for h in hits})
    found = _at_ranks(_cumulated(_in_ranges(data, coarse, targets), ["column", coarse], fine), coarse, targets)
    targets = [(r["column"], r[fine], r["at"], r["left"]) for r in found.select("column", fine, "at", "left").collect()]
    found = _at_ranks(_cumulated(_in_ranges(data, fine, targets), ["column", fine], "value"), fine, targets)
    at = {(r["column"], r["at"]): r["value"] for r in found.select("column", "at", "value").collect()}

    out = defaultdict(dict)
    for c, n in totals.items():
        for name, q in probs.items():
            p = (n - 1) * q
            low, high = at[c, floor(p)], at[c, ceil(p)]
            out[c][name] = low if low == high else low + (high - low) * (p - floor(p))
    return dict(out)


def _cumulated(frame: DataFrame, group: list, child: str) -> DataFrame:
    """Counts per child with the ranks ``_lo`` (first) and ``_hi`` (one past the last) in its group."""
    counts = frame.groupBy(*group, child).agg(F.sum("_n").alias("_n"))
    w = Window.partitionBy(*group).orderBy(child).rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("_hi", F.sum("_n").over(w)).withColumn("_lo", F.col("_hi") - F.col("_n"))


def _in_ranges(data: DataFrame, key: str, targets: list) -> DataFrame:
    """Rows inside the target ranges, by literal predicates."""
    wanted = defaultdict(set)
    for column, range_, _, _ in targets:
        wanted[column].add(range_)
    keep = F.lit(False)
    for column, ranges in wanted.items():
        keep = keep | ((F.col("column") == column) & F.col(key).isin(*ranges))
    return data.filter(keep)


def _at_ranks(cumulated: DataFrame, key: str, targets: list) -> DataFrame:
    """The children that hold the target ranks, with the rank left inside each child."""
    wanted = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(r).cast("bigint").alias("range"),
                 F.lit(at).cast("bigint").alias("at"), F.lit(inner).cast("bigint").alias("inner"))
        for c, r, at, inner in targets])
    here = F.filter(wanted, lambda t: (t["column"] == F.col("column")) & (t["range"] == F.col(key))
                    & (t["inner"] >= F.col("_lo")) & (t["inner"] < F.col("_hi")))
    return (cumulated.withColumn("_t", F.explode(here))
            .withColumns({"at": F.col("_t.at"), "left": F.col("_t.inner") - F.col("_lo")}))


def exact_medians(df: DataFrame, columns) -> dict:
    """``{column: median}``, NULL where a column has no values."""
    found = exact_quantiles(df, {c: F.col(c) for c in columns}, {"median": 0.5})
    return {c: found.get(c, {}).get("median") for c in columns}


def modes(df: DataFrame, columns) -> dict:
    """``{column: most frequent value}``, the smallest of tied ones; NULL without values.

    Values are counted map-side first, so neither a hot value nor a column is held in a task.
    """
    columns = list(columns)
    counts = (long_values(df, {c: F.col(c).cast("string") for c in columns})
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    best = F.min_by("value", F.struct((-F.col("n")).alias("k"), F.col("value")))
    found = {r["column"]: r["value"] for r in counts.groupBy("column").agg(best.alias("value")).collect()}
    return {c: found.get(c) for c in columns}
