"""The corpus pipeline: stages over ``documents``, each one an operator of llm.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps, with
the columns of ``documents``; the last returns the encoded corpus. Every
result is written as Parquet in the shared folder and read again.

Defined cases: documents of null or empty text pass the filters (they are
not toxic, and link with nothing) and end as rows without tokens only if the
mix takes them, which it does not (size 0). Rows with a null doc_id pass the
pair stages untouched. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campuslens.llm import jaccard_join, mixing, passages, sentencepiece_codec, toxicity
from campuslens.llm.columns import set_aside
from campuslens.llm.queries import read, tokenizer_file
from campuslens.llm.ship import ship
from campuslens.session import scratch_path, stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    ship(spark)
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), ~toxicity.held_out())
    inner, back = set_aside(docs, ("text",))
    return back(toxicity.score(inner, model).where("predicted = 0"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates: the one of the smallest doc_id.

    A document is a row, known by a hash of all its columns, so of rows that
    share a doc_id each is kept or dropped by its own text. Of rows equal in
    doc_id and text one stays.
    """
    ship(spark)
    inner, back = set_aside(docs, ("doc_id", "text"))
    others = [F.to_json(F.col(f.name)) if isinstance(f.dataType, (T.MapType, T.VariantType)) else F.col(f.name)
              for f in inner.schema.fields]
    rows = inner.withColumn("row", F.xxhash64(*others))
    known = rows.where(F.col("doc_id").isNotNull())
    classes = (jaccard_join.similarity_classes(known.select(F.col("row").alias("doc_id"), "text"))
               .select(F.col("doc_id").alias("row"), F.col("component_id").alias("component")).distinct())
    # a text without words links with nothing, but its repeats are one document all the same
    blank = F.when(~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]"), F.xxhash64("doc_id", "text"))
    first = (known.select("row", "doc_id", blank.alias("blank")).distinct().join(classes, "row")
             .groupBy(F.coalesce("blank", "component").alias("group"), F.col("blank").isNull().alias("linked"))
             .agg(F.min(F.struct("doc_id", "row")).alias("first")).select("first.row"))
    kept = known.join(stage(first, "near-copies"), "row", "left_semi").dropDuplicates(["row"])
    return back(kept.select(*inner.columns).union(inner.where(F.col("doc_id").isNull())))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that repeat an earlier document's."""
    ship(spark)
    return passages.remove_passages(docs, stage(passages.repeated_passages(docs), "passages"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as the mix of the sources takes them, each time whole.

    A document of which the mix takes a part is taken once more if that is
    half of it or more, so a source is off its target by half a document at most.
    """
    times = F.expr("(2 * taken + size) div (2 * size)")
    inner, back = set_aside(docs, ("doc_id", "source", "text", "n_chars"))
    mixed = mixing.mix(inner).withColumn("taken", F.when(F.col("size") > 0, times * F.col("size")).otherwise(F.lit(0)))
    return back(mixing.repeat(mixed))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, with what decoding them gives."""
    ship(spark)
    return sentencepiece_codec.encode_decode(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES = [("toxicity", drop_toxic), ("jaccard_join", drop_near_copies), ("passages", drop_repeated_passages),
          ("mixing", mix_sources), ("sentencepiece", encode)]
#: Not one of learned scores, compact windows and piece ids can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
