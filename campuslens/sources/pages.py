"""Landed API pages: one JSON line per page response.

Each line is ``{"page": N, "results": [record, ...]}``: the response body
plus the page number it was requested with. Many pages share a file, which
keeps the file count proportional to data volume rather than to page count
(a file per 100-record page would be millions of tiny objects at scale).

Reading: an explicit schema (only the listed API keys are parsed, the rest
of each record is skipped), ``FAILFAST`` so a corrupt page stops the job
instead of silently truncating it, and ``posexplode`` of ``results``. The
explode is not outer, so a page with an empty or missing ``results`` array
contributes no rows. The scan is split-parallel: pages are read
concurrently, not one after another.

Landing (used to materialise test inputs) groups records by page. A page
holds at most the API's page size (100 records), so collecting one
page's records into an array is bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campuslens.operators.decode import flatten_record
from campuslens.schemas import API_FIELDS, page_schema

def to_api_record(raw: DataFrame) -> DataFrame:
    """Plain-named raw records -> one struct column with the dotted API keys."""
    record = F.struct(*[F.col(plain).alias(key) for key, plain, _ in API_FIELDS])
    return raw.select("page", "pos", record.alias("record"))


def land_pages(raw: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Write raw records (with ``page``/``pos``) as page files under ``path``."""
    pages = (to_api_record(raw)
             .groupBy("page")
             .agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "record"))),
                              lambda e: e["record"]).alias("results")))
    pages.write.mode(mode).json(path)
    return path


def land_empty_pages(spark: SparkSession, path: str, after_page: DataFrame) -> None:
    """Land two pages past the last one: an empty ``results`` array and none at all.

    ``after_page`` is a one-row frame holding the last page number; the
    empty pages are derived from it, not from a constant.
    """
    empty = page_schema()["results"].dataType
    last = after_page.select(F.col("page").cast("long").alias("page"))
    blanks = (last.select((F.col("page") + 1).alias("page"),
                          F.array().cast(empty).alias("results"))
              .unionByName(last.select((F.col("page") + 2).alias("page"),
                                       F.lit(None).cast(empty).alias("results"))))
    blanks.write.mode("append").json(path)


def unnest_pages(pages: DataFrame) -> DataFrame:
    """One row per record of page rows (``page``, ``results``, partition levels).

    ``start``, where present, is the place of the first record on its page
    (a stream may resume within one).
    """
    levels = [c for c in pages.columns if c not in ("results", "page", "start")]
    start = F.col("start") if "start" in pages.columns else F.lit(0)
    return (pages.select(*levels, F.col("page").cast("long").alias("page"), start.cast("long").alias("_start"),
                         F.posexplode("results").alias("pos", "record"))
            .select(*levels, "page", (F.col("_start") + F.col("pos")).alias("pos"), "record.*"))


def read_pages(spark: SparkSession, path: str, fields: list[str] | None = None) -> DataFrame:
    """Unnested page records: ``page``, ``pos`` and the requested dotted keys.

    ``path`` is a landing root. Partition levels (for instance ``run=...``,
    when several loads land under one root) are kept as leading columns, so
    many landings are one split-parallel scan.
    """
    return unnest_pages(spark.read.schema(page_schema(fields, with_page=True))
                        .option("mode", "FAILFAST").json(path))


def extract(spark: SparkSession, path: str, fields: list[str] | None = None) -> DataFrame:
    """Scan landed pages and rename the dotted keys: the raw school records."""
    return flatten_record(read_pages(spark, path, fields))
