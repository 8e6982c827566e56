"""Mixing sources to target weights by capped water-filling, all in SQL functions.

Sizes are words. The sources share the total in proportion to their
weights, but no target exceeds ``epochs`` times its source's size: what a
capped source cannot take is shared by the others, by weight, until none is
above its cap. With the sources in ascending order of cap over weight the
capped ones come first, so running sums of caps and weights give the level
directly; there is one row a source in that step.

A target is then taken as whole repetitions of the source and a fractional
one. The fractional repetition takes the source's documents in the order of
a seeded hash until its words are used up; the document at the end of it
gives the words that are left. The place of a document in that order comes
from the sums of 4096 hash ranges per source and the running sum inside its
own range, so a source that holds most rows is still spread over 4096 keys.

Defined cases: a null or empty text has size 0 and takes 0; a null source
is a source of its own, last in order; a null doc_id hashes as ""; repeated
rows are taken one after the other; a total of 0 gives targets 0; an empty
table gives none; other columns pass through ``mix`` (its own columns
replace clashing ones).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from campuslens.llm.columns import set_aside
from campuslens.session import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
EPOCHS = 3
SEED = "mix"
RANGE_DIGITS = 3
OWN = ("size", "source_size", "target", "taken")


def with_sizes(docs: DataFrame, seed: str) -> DataFrame:
    """``docs`` with size, the seeded draw and its hash range."""
    draw = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return (docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))
            .withColumn("_draw", draw).withColumn("_range", F.substring("_draw", 1, RANGE_DIGITS)))


def targets(sizes: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, weight, target) from one row (source, source_size) a source.

    Weights repeat over the sources in code point order, null last.
    """
    number = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), F.pmod(number - 1, F.lit(len(weights))) + 1)
    rows = (sizes.withColumn("weight", weight.cast("long"))
            .withColumn("cap", F.lit(epochs) * F.col("source_size")))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    capped = F.col("cap") * F.col("w_left") < (F.col("total") - F.col("cap_before")) * F.col("weight")
    rows = (rows.withColumn("total", F.sum("source_size").over(every))
            .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
            .withColumn("w_left", F.sum("weight").over(onward))
            .withColumn("capped", capped)
            .withColumn("rest", F.col("total") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(every))
            .withColumn("w_rest", F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(every)))
    share = (F.col("rest") * F.col("weight")).cast("double") / F.col("w_rest")
    return rows.select("source", "source_size", "weight",
                       F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share).alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """``docs`` with size, source_size, target and taken (words, repeats counted)."""
    docs = docs.select(*["`" + c.replace("`", "``") + "`" for c in docs.columns if c not in OWN])
    docs, names = set_aside(docs, ("doc_id", "source", "text"))[0], docs.columns
    rows = with_sizes(docs, seed)
    ranges = stage(rows.groupBy("source", "_range").agg(F.sum("size").alias("_words")), "mix-ranges")
    goal = targets(ranges.groupBy("source").agg(F.sum("_words").alias("source_size")), weights, epochs)
    taken = F.floor(F.col("target") + F.lit(0.5)).cast("long")
    whole = F.when(F.col("source_size") > 0, F.expr("_goal div source_size")).otherwise(F.lit(0)).cast("long")
    before = (Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    ranges = (ranges.withColumn("_ahead", F.coalesce(F.sum("_words").over(before), F.lit(0)))
              .join(goal.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
              .withColumn("_goal", F.least(taken, F.lit(epochs) * F.col("source_size")))
              .withColumn("_whole", whole)
              .select(F.col("source").alias("_source"), F.col("_range").alias("_own"), "source_size", "target",
                      "_whole", (F.col("_goal") - F.col("_whole") * F.col("source_size") - F.col("_ahead")).alias("_left")))
    inside = (Window.partitionBy("source", "_range").orderBy("_draw", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    part = F.greatest(F.lit(0).cast("long"), F.least("size", F.col("_left") - F.col("_inside")))
    return (rows.join(ranges, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_range") == F.col("_own")))
            .withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .withColumn("taken", F.col("_whole") * F.col("size") + part)
            .select(*docs.columns, *OWN).toDF(*names, *OWN))


def repeat(mixed: DataFrame) -> DataFrame:
    """The mixed documents themselves: ``mix``'s rows repeated as taken.

    A last, partial repetition holds the document's first words, and
    ``n_chars`` follows it.
    """
    mixed, back = set_aside(mixed, ("size", "taken", "text", "n_chars"))
    whole = F.when(F.col("size") > 0, F.expr("taken div size")).otherwise(F.lit(0))
    part = F.when(F.col("size") > 0, F.expr("taken % size")).otherwise(F.lit(0))
    piece = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    cut = F.array_join(F.slice(piece, F.lit(1), F.col("_part").cast("int")), "")
    copies = F.concat(F.when(F.col("_whole") > 0, F.sequence(F.lit(1), F.col("_whole").cast("int")))
                      .otherwise(F.array().cast("array<int>")),
                      F.when(F.col("_part") > 0, F.array(F.lit(0))).otherwise(F.array().cast("array<int>")))
    rows = (mixed.withColumn("_whole", whole).withColumn("_part", part)
            .withColumn("_copy", F.explode(copies))
            .withColumn("text", F.when(F.col("_copy") == 0, cut).otherwise(F.col("text"))))
    if "n_chars" in mixed.columns:
        rows = rows.withColumn("n_chars", F.when(F.col("_copy") == 0, F.length("text").cast(mixed.schema["n_chars"].dataType))
                               .otherwise(F.col("n_chars")))
    return back(rows)
