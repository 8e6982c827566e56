"""ANSI SQL text of the reference computations, for the DuckDB oracle.

Each query of the catalog has an independent SQL formulation here. The SQL
starts from the driver's tables (``customer``, ``orders``, ...), builds the
same stand-in records, and computes the result with plain SQL (window
functions, joins, grouping). Only constants are shared with the Spark side:
code tables, the ranking rule, fill values and band bounds.
"""

from __future__ import annotations

from campuslens.functions import codes
from campuslens.operators.fill import ZERO_FILL_COLUMNS
from campuslens.operators.rank import RANK_KEYS, TOP_K
from campuslens.schemas import FACT_COLUMNS, RECORD_COLUMNS


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def case_lookup(col: str, table: dict, default) -> str:
    arms = " ".join(f"WHEN {k} THEN {_quote(v) if isinstance(v, str) else v}"
                    for k, v in table.items())
    dflt = _quote(default) if isinstance(default, str) else default
    return f"CASE {col} {arms} ELSE {dflt} END"


def school_raw_sql(since: str | None = None, until: str | None = None,
                   reported_only: bool = False, old_codes: bool = False) -> str:
    """SELECT of the raw school records (codes) over the driver tables."""
    where = []
    if since:
        where.append(f"o_orderdate >= TIMESTAMP '{since} 00:00:00'")
    if until:
        where.append(f"o_orderdate < TIMESTAMP '{until} 00:00:00'")
    where_sql = ("WHERE " + " AND ".join(where)) if where else ""
    join = "JOIN" if reported_only else "LEFT JOIN"
    # the older classifications end at 17 and 6
    basic = "CASE WHEN c.c_custkey % 37 - 2 <= 17 THEN c.c_custkey % 37 - 2 END" if old_codes else "c.c_custkey % 37 - 2"
    undergrad = "CASE WHEN c.c_custkey % 18 - 1 <= 6 THEN c.c_custkey % 18 - 1 END" if old_codes else "c.c_custkey % 18 - 1"
    return f"""
SELECT c.c_custkey AS school_id,
       c.c_name AS name,
       n.n_name AS city,
       r.r_name AS state,
       CASE WHEN c.c_custkey % 11 = 0 THEN NULL ELSE CAST(c.c_custkey % 5 AS INTEGER) END AS ownership,
       'http://school.example/' || CAST(c.c_custkey AS VARCHAR) AS school_url,
       CASE WHEN c.c_custkey % 4 = 0 THEN NULL
            ELSE 'http://calc.example/' || CAST(c.c_custkey AS VARCHAR) END AS price_calculator,
       CAST({basic} AS INTEGER) AS carnegie_basic,
       CAST({undergrad} AS INTEGER) AS carnegie_undergrad,
       CAST(c.c_custkey % 4 AS INTEGER) AS level,
       CASE WHEN c.c_custkey % 9 = 0 THEN CAST(0.1 AS DOUBLE)
            WHEN c.c_custkey % 9 = 1 THEN CAST(0.05 AS DOUBLE)
            WHEN c.c_custkey % 9 = 2 THEN CAST(1.0 AS DOUBLE)
            ELSE CAST(nullif(least(floor(CAST(o.n_f AS DOUBLE) / o.n * 4), 3), 0) AS DOUBLE) / 4
       END AS admission_rate,
       CASE WHEN c.c_custkey % 3 = 0 THEN NULL
            ELSE CAST(400 + (c.c_custkey * 37) % 1201 AS DOUBLE) END AS average_sat_score,
       o.price_min AS in_state_tuition,
       o.price_max AS out_of_state_tuition,
       CAST(floor(o.urgent_max / 250000) AS DOUBLE) * 250000 AS earnings_after_10yrs,
       CAST(nullif(floor(CAST(o.n_o AS DOUBLE) / o.n * 4), 0) AS DOUBLE) / 4 AS graduation_rate,
       CASE WHEN c.c_custkey % 7 = 0 THEN NULL ELSE CAST(c.c_custkey % 3 AS DOUBLE) END AS faculty_quality,
       CASE WHEN c.c_nationkey % 4 = 0 THEN NULL
            ELSE CAST(c.c_nationkey % 4 AS DOUBLE) / 4 END AS international_outlook,
       CAST(o.n_urgent AS DOUBLE) / o.n AS retention_rate,
       CASE WHEN c.c_custkey % 13 = 0 THEN NULL
            ELSE CAST(floor(c.c_acctbal / 4000) AS DOUBLE) * 4000 END AS revenue_per_student,
       CAST(floor(o.pending_max / 250000) AS DOUBLE) * 250000 AS spending_per_student,
       CASE WHEN c.c_custkey % 5 = 0 THEN NULL ELSE o.finished_min END AS endowment,
       CAST(o.n_low AS DOUBLE) / o.n AS financial_aid_percent,
       CAST(floor(c.c_custkey / 100) AS BIGINT) AS page,
       c.c_custkey % 100 AS pos
FROM customer c
{join} (
    SELECT o_custkey,
           count(*) AS n,
           nullif(count(*) FILTER (WHERE o_orderstatus = 'F'), 0) AS n_f,
           nullif(count(*) FILTER (WHERE o_orderstatus = 'O'), 0) AS n_o,
           nullif(count(*) FILTER (WHERE o_orderpriority = '1-URGENT'), 0) AS n_urgent,
           nullif(count(*) FILTER (WHERE o_orderpriority = '5-LOW'), 0) AS n_low,
           min(o_totalprice) AS price_min,
           max(o_totalprice) AS price_max,
           max(o_totalprice) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent_max,
           max(o_totalprice) FILTER (WHERE o_orderstatus = 'P') AS pending_max,
           min(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS finished_min
    FROM orders {where_sql}
    GROUP BY o_custkey
) o ON c.c_custkey = o.o_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""


def school_sql(raw: str = "school_raw") -> str:
    """SELECT of the decoded 24-column record from a raw-record relation."""
    exprs = {
        "school_type": case_lookup("ownership", codes.OWNERSHIP, codes.UNKNOWN),
        "program_name": case_lookup("carnegie_basic", codes.PROGRAM_NAME, codes.UNKNOWN),
        "duration": case_lookup("level", codes.DURATION, codes.UNKNOWN),
        "program_type": case_lookup("carnegie_undergrad", codes.PROGRAM_TYPE, codes.UNKNOWN),
        "research_output": f"CAST({case_lookup('carnegie_basic', codes.RESEARCH_TIER, codes.DEFAULT_TIER)} AS INTEGER)",
    }
    cols = [f"{exprs[c]} AS {c}" if c in exprs else c for c in RECORD_COLUMNS]
    return f"SELECT {', '.join(cols)} FROM {raw}"


def order_by_sql(prefix: str = "") -> str:
    parts = [f"{prefix}{n} {d.upper()} NULLS LAST" for n, d in RANK_KEYS]
    parts.append(f"{prefix}school_id ASC")
    return ", ".join(parts)


def fill_sql(rel: str, extra: list[str] | None = None) -> str:
    """SELECT applying the post-cut fills to a record relation."""
    cols = []
    for c in RECORD_COLUMNS:
        if c == "price_calculator":
            cols.append("coalesce(price_calculator, '0') AS price_calculator")
        elif c in ZERO_FILL_COLUMNS:
            cols.append(f"coalesce({c}, CAST(0 AS DOUBLE)) AS {c}")
        elif c == "admission_rate":
            cols.append("coalesce(admission_rate, CAST(1 AS DOUBLE)) AS admission_rate")
        else:
            cols.append(c)
    cols.extend(extra or [])
    return f"SELECT {', '.join(cols)} FROM {rel}"


def base_ctes(since=None, until=None, reported_only=False, old_codes=False, k: int = TOP_K, prefix: str = "",
              school_where: str | None = None) -> str:
    """CTEs: raw records, decoded records, ranked top-k, filled top-k.

    Names: {prefix}school_raw, {prefix}school, {prefix}ranked, {prefix}top.
    ``school_where`` filters the decoded records (a slicer) before ranking.
    """
    p = prefix
    school = school_sql(p + "school_raw")
    if school_where:
        school = f"SELECT * FROM ({school}) WHERE {school_where}"
    return f"""
{p}school_raw AS ({school_raw_sql(since, until, reported_only, old_codes)}),
{p}school AS ({school}),
{p}ranked AS (
    SELECT * FROM (
        SELECT *, CAST(row_number() OVER (ORDER BY {order_by_sql()}) AS INTEGER) AS rank
        FROM {p}school) WHERE rank <= {k}),
{p}top AS ({fill_sql(p + 'ranked', ['rank'])})"""


def dim_ctes(src: str = "top", prefix: str = "") -> str:
    """Dimension CTEs numbered by first occurrence in rank order."""
    p = prefix
    return f"""
{p}dim_program AS (
    SELECT CAST(row_number() OVER (ORDER BY min(rank)) AS INTEGER) AS program_id, program_name
    FROM {src} WHERE program_name IS NOT NULL GROUP BY program_name),
{p}dim_program_type AS (
    SELECT CAST(row_number() OVER (ORDER BY min(rank)) AS INTEGER) AS program_type_id, program_type
    FROM {src} WHERE program_type IS NOT NULL GROUP BY program_type)"""


def fact_cte(src: str = "top", prefix: str = "", name: str = "fact") -> str:
    p = prefix
    cols = ", ".join(
        f"d.program_id" if c == "program_id" else
        f"dt.program_type_id" if c == "program_type_id" else f"t.{c}"
        for c in FACT_COLUMNS)
    return f"""
{p}{name} AS (
    SELECT {cols}
    FROM {src} t
    LEFT JOIN {p}dim_program d ON t.program_name = d.program_name
    LEFT JOIN {p}dim_program_type dt ON t.program_type = dt.program_type)"""


def full_load_ctes(since=None, until=None, reported_only=False, old_codes=False, prefix: str = "") -> str:
    """Fact over every school (no cut): decode, rank position, fill, dims, ids."""
    p = prefix
    return f"""
{p}school_raw AS ({school_raw_sql(since, until, reported_only, old_codes)}),
{p}school AS ({school_sql(p + 'school_raw')}),
{p}positioned AS (
    SELECT *, row_number() OVER (ORDER BY {order_by_sql()}) AS rank FROM {p}school),
{p}filled AS ({fill_sql(p + 'positioned', ['rank', 'nullif(admission_rate, 0) AS reported_rate'])}),
{dim_ctes(p + 'filled', p)},
{fact_cte(p + 'filled', p, 'university')},
{p}rates AS (
    SELECT school_id, admission_rate, retention_rate, average_sat_score, reported_rate,
           CASE WHEN reported_rate IS NULL THEN 'Not Reported' WHEN reported_rate <= 0.1 THEN 'Highly Selective'
                WHEN reported_rate <= 0.25 THEN 'Very Selective' WHEN reported_rate <= 0.5 THEN 'Selective'
                WHEN reported_rate <= 0.75 THEN 'Less Selective' ELSE 'Open' END AS selectivity
    FROM {p}filled)"""
