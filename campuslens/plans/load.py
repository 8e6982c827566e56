"""The transform and load flows composed from the operators.

``transform``: decoded records -> nine-key top-k -> rank -> fill.
``load``:      top-k -> dimension upsert -> ids by name from the *stored*
               dimensions -> fact rows -> upsert into the stored fact.

Also a *full load* (every school, no cut): the same steps without the
limit. Dimension ids then follow first occurrence in rank order computed by
a partial aggregate over a rank-key struct, never by a global sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from campuslens.functions import codes
from campuslens.functions.joins import attach_id
from campuslens.operators import dims as D
from campuslens.operators.decode import decode, project_fact
from campuslens.operators.fill import fill_missing, flag_reported
from campuslens.operators.rank import TOP_K, rank_key, ranked_top_k
from campuslens.operators.upsert import assert_source_unique, upsert
from campuslens.session import session_key, stage  # noqa: F401  (callers use L.stage)
from campuslens.sources.standin import EARLIER_RUN, LATER_RUN, school_raw

PROGRAM = ("program_name", "program_id", codes.label_bound(codes.PROGRAM_NAME))
PROGRAM_TYPE = ("program_type", "program_type_id", codes.label_bound(codes.PROGRAM_TYPE))


def run_window(run: str | None) -> dict:
    if run is None:
        return {}
    since, until = {"earlier": EARLIER_RUN, "later": LATER_RUN}[run]
    return {"since": since, "until": until, "reported_only": True, "old_codes": run == "earlier"}


_DECODED: dict = {}


def school(spark: SparkSession, sf_dir: str, run: str | None = None) -> DataFrame:
    """Decoded 24-column records of every school (of one run's window).

    Like ``school_raw``, the lazy plan is built once per session and run.
    """
    key = (session_key(spark), sf_dir.rstrip("/"), run)
    if key not in _DECODED:
        _DECODED[key] = decode(school_raw(spark, sf_dir, **run_window(run)))
    return _DECODED[key]


def transform(records: DataFrame, k: int = TOP_K, flag: bool = False) -> DataFrame:
    """Top-k in rank order with rank numbers, then the fills (after the cut).

    ``flag`` keeps whether the admission rate was reported, for the measures.
    """
    ranked = ranked_top_k(records, k)
    return fill_missing(flag_reported(ranked) if flag else ranked)


def top(spark: SparkSession, sf_dir: str, run: str | None = None, k: int = TOP_K) -> DataFrame:
    return transform(school(spark, sf_dir, run), k)


def frame_dims(df: DataFrame, order_col: str = "rank") -> tuple[DataFrame, DataFrame]:
    """Frame-local dimensions (ids 1..n by first occurrence)."""
    return (D.build_dim(df, PROGRAM[0], PROGRAM[1], order_col),
            D.build_dim(df, PROGRAM_TYPE[0], PROGRAM_TYPE[1], order_col))


def with_ids(df: DataFrame, dim_program: DataFrame, dim_program_type: DataFrame,
             proven: bool = True) -> DataFrame:
    """Attach both ids by name.

    Dimensions built from decoded labels (``proven``) are bounded by the code
    tables and broadcast; stored ones are counted first.
    """
    out = attach_id(df, dim_program, PROGRAM[0], PROGRAM[1], PROGRAM[2] if proven else None)
    return attach_id(out, dim_program_type, PROGRAM_TYPE[0], PROGRAM_TYPE[1],
                     PROGRAM_TYPE[2] if proven else None)


def fact(top_df: DataFrame) -> DataFrame:
    """Staged fact rows of one run with frame-local ids."""
    dp, dt = frame_dims(top_df)
    return project_fact(with_ids(top_df, dp, dt))


def filled_schools(spark: SparkSession, sf_dir: str, run: str | None = None) -> DataFrame:
    """Every school of a run, filled, with the reported flag and without ids.

    Lazy, so a measure reads from the source only the columns it needs.
    """
    return fill_missing(flag_reported(school(spark, sf_dir, run)))


def full_load_tables(spark: SparkSession, sf_dir: str, run: str | None = None,
                     columns: list[str] | None = None):
    """``university`` rows for every school of a run (no cut) and its dimensions.

    ``columns`` restricts the fact to those and the ids; only they are staged.
    """
    rows = school(spark, sf_dir, run).withColumn("_rank_key", rank_key())
    # Staged once: the dimensions and the fact rows both read it.
    if columns is None:
        filled = fill_missing(flag_reported(stage(rows)))
    else:
        filled = stage(fill_missing(flag_reported(rows)).select(*columns, PROGRAM[0], PROGRAM_TYPE[0], "_rank_key"))
    dp, dt = frame_dims(filled, "_rank_key")
    rows = with_ids(filled, dp, dt)
    return (project_fact(rows) if columns is None else rows.select(*columns, PROGRAM[1], PROGRAM_TYPE[1])), dp, dt


def full_load(spark: SparkSession, sf_dir: str, run: str | None = None) -> DataFrame:
    """``university`` rows for every school of a run, no cut."""
    return full_load_tables(spark, sf_dir, run)[0]


def upsert_dims(stored_program: DataFrame, stored_type: DataFrame,
                top_df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (D.upsert_dim(stored_program, top_df, PROGRAM[0], PROGRAM[1]),
            D.upsert_dim(stored_type, top_df, PROGRAM_TYPE[0], PROGRAM_TYPE[1]))


def refresh_ids(staged: DataFrame, dim_program: DataFrame, dim_program_type: DataFrame) -> DataFrame:
    """Replace frame-local ids by the stored dimension ids, looked up by name."""
    names = staged.drop(PROGRAM[1], PROGRAM_TYPE[1])
    return with_ids(names, dim_program, dim_program_type, proven=False)


def stage_load(stored_program: DataFrame, stored_type: DataFrame, top_df: DataFrame,
               persist=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fact rows of one load with their stored ids, and the upserted dimensions.

    ``persist(df, name)`` stores an upserted dimension and returns it read
    back, so the fact takes its ids from the stored copy (the incremental
    job writes its folders this way; the default stages it).
    """
    dp, dt = upsert_dims(stored_program, stored_type, top_df)
    persist = persist or stage
    dp, dt = persist(dp, "dim_program"), persist(dt, "dim_program_type")
    return project_fact(with_ids(top_df, dp, dt, proven=False)), dp, dt


def load(stored_fact: DataFrame, stored_program: DataFrame, stored_type: DataFrame,
         top_df: DataFrame, persist=None, k: int = TOP_K) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One load: upsert the dimensions, then upsert the fact with their ids.

    ``top_df`` must hold each school once; a repeat would duplicate its fact.
    """
    assert_source_unique(top_df, "school_id")
    staged, dp, dt = stage_load(stored_program, stored_type, top_df, persist)
    # The staged rows come from a top-k: at most k rows, a proven bound, so
    # the stored fact is filtered by a broadcast anti join, not shuffled.
    return upsert(stored_fact, staged, "school_id", source_rows_bound=k), dp, dt


def two_run_state(spark: SparkSession, sf_dir: str, k: int = TOP_K):
    """Stored state after the earlier run, and the later run's top-k."""
    first = stage(top(spark, sf_dir, "earlier", k), "top")
    dp, dt = (stage(d, "dim") for d in frame_dims(first))
    stored = project_fact(with_ids(first, dp, dt))
    return stored, dp, dt, stage(top(spark, sf_dir, "later", k), "top")


def load_university(spark: SparkSession, sf_dir: str, k: int = TOP_K) -> DataFrame:
    """The later run loaded into the state the earlier run left."""
    stored, dp, dt, later = two_run_state(spark, sf_dir, k)
    result, _, _ = load(stored, dp, dt, later, k=k)
    return result

