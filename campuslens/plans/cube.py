"""Dashboard measures under slicers from one aggregate, without the facts.

``measure_cube`` is one ``GROUPING SETS`` aggregate over (state, school type,
selectivity band): a row per combination of values of each subset of the
three, with partial values that merge (counts, sums, minima, maxima). Every
card and chart under any choice of slicers is then a filter and a sum over
cells of the coarsest set that holds the sliced columns and the chart's axis;
without a slicer that is the finished row. The cube has at most (states + 1)
x (types + 1) x (bands + 1) rows, whatever the facts.

``distinct_cube`` does the same for the distinct cards. Distinct counts do
not add, bitmaps do: ids are split into a bucket and a bit, a cell holds one
bitmap a bucket, and the union of cells is a bitwise or. It is exact also
where an id occurs in several cells (loads of several runs, schools that
changed type). Ids should be dense, as dimension and surrogate ids are: a
bitmap takes 4 KB however few of its 32,768 ids occur.

Both aggregates are partial per partition; a label that holds a third of all
facts costs one row a partition (and grouping set) in the shuffle.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campuslens.functions.measures import rounded, zero_as_null
from campuslens.plans.dashboard import with_band

DIMENSIONS = ["state", "school_type", "selectivity"]
SETS = [list(c) for n in range(len(DIMENSIONS) + 1) for c in combinations(DIMENSIONS, n)]
LEVEL = "level"
# Measures of which the cube holds the sum and count of the values other than 0 ...
AVERAGED = {"in_state_tuition": "in_state_tuition", "out_of_state_tuition": "out_of_state_tuition",
            "graduation": "graduation_rate", "retention": "retention_rate", "sat": "average_sat_score",
            "rate": "reported_rate"}
# ... and of which the smallest and the largest as well.
RANGED = ["sat", "rate"]


def level(columns) -> int:
    """The grouping id of the set that holds exactly ``columns``: a bit for every absent one."""
    return sum(1 << (len(DIMENSIONS) - 1 - i) for i, c in enumerate(DIMENSIONS) if c not in columns)


def measure_cube(fact: DataFrame) -> DataFrame:
    """Cells of every subset of the dimensions; ``level`` tells which (an absent dimension is null, so is a null label)."""
    values = {name: zero_as_null(F.col(column)) if column != "reported_rate" else F.col(column)
              for name, column in AVERAGED.items()}
    partial = [F.count(F.lit(1)).alias("schools")]
    for name, value in values.items():
        partial += [F.sum(value).alias(f"{name}_sum"), F.count(value).alias(f"{name}_n")]
    for name in RANGED:
        partial += [F.min(values[name]).alias(f"{name}_min"), F.max(values[name]).alias(f"{name}_max")]
    partial += [F.grouping_id().alias(LEVEL)]
    banded = with_band(fact)
    return banded.groupingSets([[F.col(c) for c in s] for s in SETS], *DIMENSIONS).agg(*partial)


def chosen(cube: DataFrame, by: list[str], **slicers: list | None) -> DataFrame:
    """The cells that a chart over ``by`` under the slicers merges (a missing or empty choice means all)."""
    slicers = {c: list(v) for c, v in slicers.items() if v}
    unknown = set(slicers) - set(DIMENSIONS)
    if unknown:
        raise ValueError(f"no slicer over {sorted(unknown)}")
    cells = cube.where(F.col(LEVEL) == level({*by, *slicers}))
    for column, values in slicers.items():
        cells = cells.where(F.col(column).isin(values))
    return cells


def merged(cube: DataFrame, by: list[str], **slicers: list | None) -> DataFrame:
    """One row a value of ``by`` with the merged partial values."""
    sums = [F.coalesce(F.sum("schools"), F.lit(0)).alias("schools")]
    for name in AVERAGED:
        sums += [F.sum(f"{name}_sum").alias(f"{name}_sum"), F.sum(f"{name}_n").alias(f"{name}_n")]
    for name in RANGED:
        sums += [F.min(f"{name}_min").alias(f"{name}_min"), F.max(f"{name}_max").alias(f"{name}_max")]
    return chosen(cube, by, **slicers).groupBy(*by).agg(*sums)


def _average(name: str) -> Column:
    return rounded(F.col(f"{name}_sum") / F.nullif(F.col(f"{name}_n"), F.lit(0)))


def cards(cube: DataFrame, **slicers) -> DataFrame:
    """Schools and average tuition (cards of the overview page)."""
    return merged(cube, [], **slicers).select(
        "schools", _average("in_state_tuition").alias("avg_in_state_tuition"),
        _average("out_of_state_tuition").alias("avg_out_of_state_tuition"))


def graduation_by_type(cube: DataFrame, **slicers) -> DataFrame:
    return merged(cube, ["school_type"], **slicers).select(
        "school_type", _average("graduation").alias("avg_graduation_rate"),
        F.col("graduation_n").alias("reported"), "schools")


def retention_vs_selectivity(cube: DataFrame, **slicers) -> DataFrame:
    return merged(cube, ["selectivity"], **slicers).select(
        "selectivity", _average("retention").alias("avg_retention_rate"),
        _average("rate").alias("avg_admission_rate"), "schools")


def selectivity_distribution(cube: DataFrame, **slicers) -> DataFrame:
    # the share's window runs over the handful of bands
    total = F.sum("schools").over(Window.partitionBy())
    return merged(cube, ["selectivity"], **slicers).select(
        "selectivity", "schools", rounded(F.col("schools").cast("double") / total).alias("share"))


def admission_summary(cube: DataFrame, **slicers) -> DataFrame:
    return merged(cube, ["selectivity"], **slicers).select(
        "selectivity", "schools", _average("sat").alias("avg_sat"), F.col("sat_min").alias("min_sat"),
        F.col("sat_max").alias("max_sat"), _average("rate").alias("avg_admission_rate"),
        F.col("rate_min").alias("min_admission_rate"), F.col("rate_max").alias("max_admission_rate"))


# ------------------------------------------------------------ distinct cards
CARDS = {"total_universities": "school_id", "total_programs": "program_id", "total_program_types": "program_type_id"}


def distinct_cube(fact: DataFrame, dimensions: list[str] | None = None) -> DataFrame:
    """(dimensions, card, bucket, bits): the ids of every cell as bitmaps. Null ids count nowhere."""
    dimensions = DIMENSIONS if dimensions is None else dimensions
    ids = F.explode(F.array(*[F.struct(F.lit(card).alias("card"), F.col(column).cast("long").alias("id"))
                              for card, column in CARDS.items()])).alias("of")
    rows = (with_band(fact).select(*dimensions, ids).select(*dimensions, "of.card", "of.id")
            .where(F.col("id").isNotNull()))
    # bits of negative ids count from below: give them buckets of their own
    sign, size = F.col("id") < 0, F.when(F.col("id") < 0, -(F.col("id") + 1)).otherwise(F.col("id")) + 1
    rows = rows.select(*dimensions, "card", F.bitmap_bucket_number(size).alias("bucket"), sign.alias("negative"),
                       F.bitmap_bit_position(size).alias("bit"))
    return rows.groupBy(*dimensions, "card", "negative", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def distinct_cards(cube: DataFrame, by: list[str] | None = None, **slicers: list | None) -> DataFrame:
    """The distinct cards under the slicers, a row a value of ``by``: bitmaps are or-ed, then counted."""
    by = by or []
    cells = cube
    for column, values in slicers.items():
        if values:
            cells = cells.where(F.col(column).isin(list(values)))
    united = cells.groupBy(*by, "card", "negative", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return united.groupBy(*by).agg(*[
        F.coalesce(F.sum(F.when(F.col("card") == card, F.bitmap_count("bits"))), F.lit(0)).alias(card)
        for card in CARDS])
