"""The five code tables and the column expressions that decode them.

A lookup is a literal map, so Catalyst treats it as a constant expression
inside whole-stage codegen: no join, no UDF, no broadcast. A missing code
and a null code both read as null from the map and fall back to the default.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the source system's code tables exactly,
# including the shared label of codes 1 and 5 in PROGRAM_TYPE, the space
# before the comma of code 9 in PROGRAM_TYPE, and the absence of code 2 in
# PROGRAM_NAME.
# ---------------------------------------------------------------------------
OWNERSHIP = {
    1: "Public",
    2: "Private Nonprofit",
    3: "Private For-Profit",
}

RESEARCH_TIER = {15: 1, 16: 2, 27: 3, 17: 4, 18: 5, 19: 6, 20: 7}

PROGRAM_TYPE = {
    0: "Exclusively Graduate",
    1: "higher part-time",
    2: "mixed part/full-time",
    3: "medium full-time",
    4: "higher full-time",
    5: "higher part-time",
    6: "medium full-time, inclusive, lower transfer-in",
    7: "medium full-time, inclusive, higher transfer-in",
    8: "medium full-time, selective, lower transfer-in",
    9: "medium full-time , selective, higher transfer-in",
    10: "full-time, inclusive, lower transfer-in",
    11: "full-time, inclusive, higher transfer-in",
    12: "full-time, selective, lower transfer-in",
    13: "full-time, selective, higher transfer-in",
    14: "full-time, more selective, lower transfer-in",
    15: "full-time, more selective, higher transfer-in",
}

DURATION = {
    1: "4-year",
    2: "2-year",
    3: "less_than_2_years",
}

PROGRAM_NAME = {
    0: "Not classified",
    1: "Associates Colleges: High Transfer-High Traditional",
    3: "Associates Colleges: High Transfer-High Nontraditional",
    4: "Associates Colleges: Mixed Transfer/Career & Technical-High Traditional",
    5: "Associates Colleges: Mixed Transfer/Career & Technical-Mixed Traditional/Nontraditional",
    6: "Associates Colleges: Mixed Transfer/Career & Technical-High Nontraditional",
    7: "Associates Colleges: High Career & Technical-High Traditional",
    8: "Associates Colleges: High Career & Technical-Mixed Traditional/Nontraditional",
    9: "Associates Colleges: High Career & Technical-High Nontraditional",
    10: "Health Professions",
    11: "Technical Professions",
    12: "Arts & Design",
    13: "Other Fields",
    14: "Baccalaureate/Associates Colleges: Associates Dominant",
    15: "Doctoral Universities: Very High Research Activity",
    16: "Doctoral Universities: High Research Activity",
    17: "Doctoral/Professional Universities",
    18: "Masters Colleges & Universities: Larger Programs",
    19: "Masters Colleges & Universities: Medium Programs",
    20: "Masters Colleges & Universities: Small Programs",
    21: "Baccalaureate Colleges: Arts & Sciences Focus",
    22: "Baccalaureate Colleges: Diverse Fields",
    23: "Baccalaureate/Associates Colleges: Mixed Baccalaureate/Associates",
    24: "Faith-Related Institutions",
    25: "Medical Schools & Centers",
    26: "Other Health Professions Schools",
    27: "Research Institution",
    28: "Engineering and Other Technology-Related Schools",
    29: "Business & Management Schools",
    30: "Arts, Music & Design Schools",
    31: "Law Schools",
    32: "Other Special Focus Institutions",
    33: "Tribal Colleges",
}

UNKNOWN = "Unknown"
DEFAULT_TIER = 8
# ---------------------------------------------------------------------------


def _literal_map(table: dict) -> Column:
    pairs = []
    for code, value in table.items():
        pairs.extend([F.lit(code), F.lit(value)])
    return F.create_map(*pairs)


def lookup(code: Column, table: dict, default) -> Column:
    """``table.get(code, default)`` as a column expression."""
    return F.coalesce(_literal_map(table)[code], F.lit(default))


def decode_ownership(code: Column) -> Column:
    return lookup(code, OWNERSHIP, UNKNOWN)


def decode_program_name(code: Column) -> Column:
    return lookup(code, PROGRAM_NAME, UNKNOWN)


def decode_program_type(code: Column) -> Column:
    return lookup(code, PROGRAM_TYPE, UNKNOWN)


def decode_duration(code: Column) -> Column:
    return lookup(code, DURATION, UNKNOWN)


def research_tier(code: Column) -> Column:
    return lookup(code, RESEARCH_TIER, DEFAULT_TIER).cast("int")


def label_bound(table: dict) -> int:
    """Upper bound on distinct decoded labels: the table's labels plus the default."""
    return len(set(table.values())) + 1
