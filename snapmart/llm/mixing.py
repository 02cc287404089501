"""Mixing sources to target weights by entropy balancing."""

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from snapmart.llm.common import whole, word_count, written
from snapmart.session import stage

#: Resolution of the first pass that looks for the rounding threshold of a source.
BUCKETS = 65_536
ITERATIONS = 100
TOLERANCE = 1e-10


def source_key(source: Column) -> Column:
    """A source as a text that is never null and keeps a null source apart from every other."""
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source.cast("string")))


def source_targets(sizes: DataFrame, weights=(5, 2, 1), share=1.5, cap=2.0) -> DataFrame:
    """Targets of sources: ``_key, _source, source_size`` gain ``target``.

    Sources by code point, null last, take ``weights`` in turn and share ``share`` times the sum of
    all sizes. A target stops at ``cap`` times its source's size. With sources in the order of the level at which
    they fill up, the common level is the first that leaves the next source unfilled, which is what
    resharing the excess again and again comes to. The windows run over sources, not documents.
    """
    everything = Window.orderBy(F.col("_source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(everything) - 1) % len(weights) + 1)
    by_fill = Window.orderBy("_fills_at", "_key")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    from_here = by_fill.rowsBetween(0, Window.unboundedFollowing)
    total = Window.partitionBy()
    ranked = sizes.withColumn("_w", weight).withColumn("_most", cap * F.col("source_size")).withColumn("_fills_at", F.col("_most") / F.col("_w"))
    levels = (ranked.withColumn("_full", F.coalesce(F.sum("_most").over(before), F.lit(0.0)))
              .withColumn("_level", (share * F.sum("source_size").over(total) - F.col("_full")) / F.sum("_w").over(from_here)))
    level = F.min_by(F.when(F.col("_level") <= F.col("_fills_at"), F.col("_level")),
                     F.when(F.col("_level") <= F.col("_fills_at"), F.struct("_fills_at", "_key"))).over(total)
    target = F.least(F.col("_most"), F.coalesce(level * F.col("_w"), F.col("_most")))
    return levels.withColumn("target", target).select("_key", "_source", "source_size", "target")


def tilts(cells: DataFrame, targets: DataFrame, cap: float) -> DataFrame:
    """The dual of each source's token constraint: ``targets`` gain ``_scale`` and ``_tilt``.

    Wanted are the document rates r with the least divergence from one copy each, sum of r ln r - r, such that a
    source's documents come to its target and no rate exceeds ``cap``. They are r = min(cap, exp(tilt * size /
    scale)), and the tilt is the root of the dual's gradient, which grows with the tilt. Newton steps look for it in
    all sources at once; a step that leaves the bracket known so far is halved into it. Each iteration is one
    aggregate over the cells (source, size, documents). A target of ``cap`` times the size needs no tilt.
    """
    top = math.log(cap)
    scale = F.greatest(F.col("source_size") / F.greatest(F.col("_documents"), F.lit(1)), F.lit(1e-9))
    state = (targets.join(cells.groupBy("_key").agg(F.sum(F.when(F.col("size") > 0, F.col("_n")).otherwise(0)).alias("_documents")), "_key")
             .withColumn("_scale", scale).withColumn("_wanted", F.col("target") / F.col("_scale"))
             .withColumn("_open", F.col("target") < F.col("source_size") * cap * (1 - 1e-12))
             .withColumn("_tilt", F.when(F.col("_open"), F.lit(0.0)).otherwise(F.lit(float("inf"))))
             .withColumn("_low", F.lit(float("-inf"))).withColumn("_high", F.lit(float("inf"))))
    state = stage(state)
    for _ in range(ITERATIONS):
        x = F.col("size") / F.col("_scale")
        rate = F.exp(F.least(F.lit(top), F.col("_tilt") * x))
        sums = (cells.where("size > 0").join(state.where("_open"), "_key").groupBy("_key")
                .agg(F.sum(F.col("_n") * x * rate).alias("_got"),
                     F.sum(F.when(F.col("_tilt") * x < top, F.col("_n") * x * x * rate).otherwise(0.0)).alias("_slope")))
        over = F.col("_got") - F.col("_wanted")
        low = F.when(over < 0, F.col("_tilt")).otherwise(F.col("_low"))
        high = F.when(over >= 0, F.col("_tilt")).otherwise(F.col("_high"))
        newton = F.try_divide(over, F.col("_slope"))
        step = F.col("_tilt") - newton
        inside = newton.isNotNull() & (step > F.col("_low2")) & (step < F.col("_high2"))
        middle = (F.when(F.col("_low2") == float("-inf"), 2 * F.col("_high2") - 1)
                  .when(F.col("_high2") == float("inf"), 2 * F.col("_low2") + 1).otherwise((F.col("_low2") + F.col("_high2")) / 2))
        done = F.abs(over) <= TOLERANCE * F.col("_wanted")
        state = stage(state.join(sums, "_key", "left").withColumn("_low2", low).withColumn("_high2", high)
                      .withColumn("_next", F.when(inside, step).otherwise(middle))
                      .withColumn("_still", F.coalesce(F.col("_open") & ~done & (F.col("_next") != F.col("_tilt")), F.lit(False)))
                      .select("_key", "_source", "source_size", "target", "_documents", "_scale", "_wanted",
                              F.col("_still").alias("_open"), F.when(F.col("_still"), F.col("_next")).otherwise(F.col("_tilt")).alias("_tilt"),
                              F.coalesce("_low2", "_low").alias("_low"), F.coalesce("_high2", "_high").alias("_high")))
        if state.where("_open").isEmpty():
            break
    return state.select("_key", "_source", "source_size", "target", "_scale", "_tilt")


def rounding_thresholds(parts: DataFrame) -> DataFrame:
    """Where to stop giving documents one more copy: ``_key, _last``, from rows with ``_key, _size, _part, _turn``.

    Documents get the copy in the order of ``_turn`` (a hash over the fractional rate, so that larger fractions come
    first) until their words come to the sum of size times fraction. Sums of narrow turns find the
    one in which that happens; only its documents are ordered one by one.
    """
    bucket = F.floor(F.col("_turn") / (1 + F.col("_turn")) * BUCKETS).cast("int")
    rows = parts.where("_part > 0").select("_key", "_size", "_turn", (F.col("_size") * F.col("_part")).alias("_due"), bucket.alias("_bucket"))
    sums = rows.groupBy("_key", "_bucket").agg(F.sum("_size").alias("_words"), F.sum("_due").alias("_due"))
    running = Window.partitionBy("_key").orderBy("_bucket")
    source = Window.partitionBy("_key")
    crossing = (sums.withColumn("_after", F.sum("_words").over(running)).withColumn("_due", F.sum("_due").over(source))
                .where(F.col("_after") >= F.col("_due"))
                .groupBy("_key").agg(F.min(F.struct("_bucket", (F.col("_after") - F.col("_words")).alias("_before"), "_due")).alias("_at"))
                .select("_key", "_at.*"))
    ordered = Window.partitionBy("_key").orderBy("_turn")
    fits = F.col("_before") + F.sum("_size").over(ordered) - F.col("_size") / 2 <= F.col("_due")
    inside = rows.drop("_due").join(crossing, ["_key", "_bucket"]).withColumn("_fits", fits)
    return (inside.groupBy("_key").agg(F.max(F.when(F.col("_fits"), F.col("_turn"))).alias("_turn"), F.first("_bucket").alias("_bucket"))
            .select("_key", F.coalesce("_turn", F.col("_bucket") / (BUCKETS - F.col("_bucket")) * (1 - 1e-12)).alias("_last")))


def mix(docs: DataFrame, id_column="doc_id", text_column="text", source_column="source", weights=(5, 2, 1), share=1.5, cap=2.0) -> DataFrame:
    """``docs`` with ``size, source_size, target, rate, copies, taken``; columns of those names are replaced.

    Entropy balancing: the rates of a source's documents are an exponential tilt of one copy each (``tilts``) whose
    words meet the source's target (``source_targets``). A rate becomes its whole part of copies, and one more by
    sequential Poisson sampling of its fraction, stopped where the source's words come nearest to the target
    (``rounding_thresholds``); the hash depends on the row alone, so reruns agree.

    Null texts have size 0, take 0 words and keep one copy; documents without a source are a source of their own, last
    in order; an empty table gives an empty result. Of n rows with equal id, source and text the whole part of n times the fraction
    take one more copy, and what is left of it is drawn like one row's; which of them do is open, as they are the same.
    """
    made = ["size", "source_size", "target", "rate", "copies", "taken"]
    keep = [c for c in docs.columns if c not in made]
    sized = docs.select(*keep, word_count(whole(text_column)).alias("size"), source_key(F.col(source_column)).alias("_key"), F.xxhash64(whole(text_column)).alias("_hash"))
    narrow = written(sized.select(F.col(id_column).alias("_id"), F.col(source_column).alias("_source"), "_key", "size", "_hash"), "mix-sizes")
    cells = written(narrow.groupBy("_key", "_source", "size").agg(F.count(F.lit(1)).alias("_n")), "mix-cells")
    totals = cells.groupBy("_key", "_source").agg(F.sum(F.col("size") * F.col("_n")).alias("source_size"))
    state = tilts(cells, source_targets(totals, weights, share, cap), cap).drop("_source")

    rate = (F.when(F.col("size") == 0, F.lit(1.0)).when(F.col("_tilt") == float("inf"), F.lit(float(cap)))
            .otherwise(F.exp(F.least(F.lit(math.log(cap)), F.col("_tilt") * F.col("size") / F.col("_scale")))))

    def rated(df, key):
        """Rates, and for ``_rows`` equal rows together: copies that they take for certain, and the fraction and turn of one more."""
        uniform = (F.shiftrightunsigned(F.xxhash64(key, F.col("size"), F.lit(8)), 11) + F.lit(0.5)) / F.lit(float(2**53))
        due = F.when(F.col("size") > 0, (F.col("rate") - F.floor("rate")) * F.col("_rows")).otherwise(F.lit(0.0))
        return (df.join(state, "_key").withColumn("rate", rate).withColumn("_sure", F.floor(due)).withColumn("_part", due - F.floor(due))
                .withColumn("_turn", F.when(F.col("_part") > 0, uniform / F.col("_part"))))

    units = written(narrow.groupBy("_id", "_key", "size", "_hash").agg(F.count(F.lit(1)).alias("_rows")), "mix-units")
    last = stage(rounding_thresholds(rated(units, F.col("_id")).withColumn("_size", F.col("size"))))
    extra = F.col("_sure") + F.when(F.col("_turn") <= F.col("_last"), 1).otherwise(0)

    def taking(df, more):
        copies = (F.floor("rate") + more).cast("long")
        return df.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size")).select(*keep, *made)

    repeated = units.where("_rows > 1").withColumnsRenamed({"_id": "_unit", "_key": "_unit_key", "size": "_unit_size", "_hash": "_unit_hash"})
    if repeated.isEmpty():
        return taking(rated(sized.withColumn("_rows", F.lit(1)), F.col(id_column)).join(last, "_key", "left"), extra)
    same = (F.col(id_column).eqNullSafe(F.col("_unit")) & (F.col("_key") == F.col("_unit_key")) & (F.col("size") == F.col("_unit_size")) & (F.col("_hash") == F.col("_unit_hash")))
    single = rated(sized.join(repeated, same, "left_anti").withColumn("_rows", F.lit(1)), F.col(id_column)).join(last, "_key", "left")
    several = numbered(written(sized.join(repeated, same).withColumn("_row", F.monotonically_increasing_id()), "mix-repeated"))
    several = rated(several, F.col(id_column)).join(last, "_key", "left")
    return taking(single, extra).unionByName(taking(several, F.when(F.col("_number") <= extra, 1).otherwise(0)))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_number``, from 1 among the rows of a unit. Rows are numbered within the part of the table they were written in, then
    parts follow each other, so no unit meets in one task. ``rows`` have to be a written table."""
    unit = ["_unit", "_unit_key", "_unit_size", "_unit_hash"]
    placed = rows.withColumn("_place", F.shiftright("_row", 33))
    inside = placed.withColumn("_inside", F.row_number().over(Window.partitionBy(*unit, "_place").orderBy("_row")))
    parts = placed.groupBy(*unit, "_place").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*unit).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumnsRenamed({c: f"{c}_of" for c in [*unit, "_place"]})
    there = [F.col(c).eqNullSafe(F.col(f"{c}_of")) for c in [*unit, "_place"]]
    return inside.join(parts, there).withColumn("_number", F.col("_before") + F.col("_inside"))
