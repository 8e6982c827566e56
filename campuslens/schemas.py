"""Fixed schemas: landed API page, school record, fact and dimension tables.

Types are fixed here rather than inferred: an absent key reads as null,
and every metric is a double.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# API keys of a school record and the plain column each lands
# in. The keys are flat names that contain dots, not nested objects.
# ---------------------------------------------------------------------------
API_FIELDS = [
    ("id", "school_id", T.LongType()),
    ("school.name", "name", T.StringType()),
    ("school.city", "city", T.StringType()),
    ("school.state", "state", T.StringType()),
    ("school.ownership", "ownership", T.IntegerType()),
    ("school.school_url", "school_url", T.StringType()),
    ("school.price_calculator_url", "price_calculator", T.StringType()),
    ("latest.admissions.admission_rate.overall", "admission_rate", T.DoubleType()),
    ("latest.cost.tuition.in_state", "in_state_tuition", T.DoubleType()),
    ("latest.cost.tuition.out_of_state", "out_of_state_tuition", T.DoubleType()),
    ("latest.admissions.sat_scores.average.overall", "average_sat_score", T.DoubleType()),
    ("latest.earnings.10_yrs_after_entry.median", "earnings_after_10yrs", T.DoubleType()),
    ("latest.completion.completion_rate_4yr_150nt", "graduation_rate", T.DoubleType()),
    ("latest.student.demographics.student_faculty_ratio", "faculty_quality", T.DoubleType()),
    ("latest.student.demographics.race_ethnicity.non_resident_alien", "international_outlook", T.DoubleType()),
    ("latest.school.tuition_revenue_per_fte", "revenue_per_student", T.DoubleType()),
    ("latest.school.instructional_expenditure_per_fte", "spending_per_student", T.DoubleType()),
    ("latest.school.endowment.end", "endowment", T.DoubleType()),
    ("latest.student.retention_rate.four_year.full_time_pooled", "retention_rate", T.DoubleType()),
    ("latest.aid.pell_grant_rate", "financial_aid_percent", T.DoubleType()),
    ("school.carnegie_basic", "carnegie_basic", T.IntegerType()),
    ("school.institutional_characteristics.level", "level", T.IntegerType()),
    ("school.carnegie_undergrad", "carnegie_undergrad", T.IntegerType()),
]

# Columns of the decoded school record, in output order.
RECORD_COLUMNS = [
    "school_id", "name", "city", "state", "school_type", "school_url",
    "price_calculator", "admission_rate", "in_state_tuition",
    "out_of_state_tuition", "average_sat_score", "earnings_after_10yrs",
    "graduation_rate", "faculty_quality", "international_outlook",
    "revenue_per_student", "spending_per_student", "endowment",
    "retention_rate", "financial_aid_percent", "program_name", "duration",
    "program_type", "research_output",
]

# Columns of the ``university`` fact table, in insert order.
FACT_COLUMNS = [
    "school_id", "name", "city", "state", "school_url", "price_calculator",
    "admission_rate", "in_state_tuition", "out_of_state_tuition",
    "average_sat_score", "earnings_after_10yrs", "graduation_rate",
    "retention_rate", "financial_aid_percent", "program_id",
    "program_type_id", "school_type",
]
# ---------------------------------------------------------------------------

RAW_COLUMNS = [plain for _, plain, _ in API_FIELDS]
# Internal flag beside the fact: whether the admission rate was reported (a
# missing one is stored as 1, which is also a true value).
REPORTED = "admission_reported"

RECORD_SCHEMA = T.StructType([T.StructField(key, dtype, True) for key, _, dtype in API_FIELDS])
PAGE_SCHEMA = T.StructType([T.StructField("results", T.ArrayType(RECORD_SCHEMA), True)])
PAGE_NUMBER = T.StructField("page", T.LongType(), True)

_FACT_TYPES = {"school_id": T.LongType(), "program_id": T.IntegerType(),
               "program_type_id": T.IntegerType()}
_STRING_FACT = {"name", "city", "state", "school_url", "price_calculator", "school_type"}
FACT_SCHEMA = T.StructType([
    T.StructField(c, _FACT_TYPES.get(c, T.StringType() if c in _STRING_FACT else T.DoubleType()), True)
    for c in FACT_COLUMNS])

STORED_FACT_SCHEMA = T.StructType([*FACT_SCHEMA.fields, T.StructField(REPORTED, T.BooleanType(), True)])

DIM_PROGRAM_SCHEMA = T.StructType([
    T.StructField("program_id", T.IntegerType(), False),
    T.StructField("program_name", T.StringType(), False),
])
DIM_PROGRAM_TYPE_SCHEMA = T.StructType([
    T.StructField("program_type_id", T.IntegerType(), False),
    T.StructField("program_type", T.StringType(), False),
])


def page_schema(fields: list[str] | None = None, with_page: bool = False) -> T.StructType:
    """Page schema restricted to the requested API keys (source-side projection).

    ``with_page`` adds the page number a landed line carries next to the body.
    """
    if fields is None:
        results = PAGE_SCHEMA["results"]
    else:
        wanted = set(fields)
        unknown = wanted - {key for key, _, _ in API_FIELDS}
        if unknown:
            raise ValueError(f"unknown API fields: {sorted(unknown)}")
        record = T.StructType([T.StructField(k, t, True) for k, _, t in API_FIELDS if k in wanted])
        results = T.StructField("results", T.ArrayType(record), True)
    return T.StructType(([PAGE_NUMBER] if with_page else []) + [results])
