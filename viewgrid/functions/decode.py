"""Household-demographic decodes: count columns -> categorical attributes.

Every rule is "first match wins" over columns tested with
``coalesce(count, 0) >= 1``; ``first_match`` turns a table of
(columns, value) rows into one CASE expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _present(col: str) -> str:
    return f"coalesce({col}, 0) >= 1"


def present(col: str) -> Column:
    return F.expr(_present(col))


def _any_present(cols) -> str:
    return "(" + " OR ".join(_present(c) for c in cols) + ")"


def any_present(cols) -> Column:
    return F.expr(_any_present(cols))


def _row_total(cols) -> str:
    return "(" + " + ".join(f"coalesce({c}, 0)" for c in cols) + ")"


def row_total(cols) -> Column:
    """Horizontal sum with NULL as 0."""
    return F.expr(_row_total(cols))


def _lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def first_match(rules, otherwise=None) -> Column:
    """rules: [(condition SQL text, value)]; first true condition wins.

    Built as one CASE expression (one JVM call per output column).
    """
    whens = " ".join(f"WHEN {cond} THEN {_lit(v)}" for cond, v in rules)
    tail = f" ELSE {_lit(otherwise)}" if otherwise is not None else ""
    return F.expr(f"CASE {whens}{tail} END")


# Age bands (column suffix, lower bound, bucket code).
AGE_BANDS = [("18_24", 18, 1), ("25_34", 25, 2), ("35_44", 35, 3),
             ("45_54", 45, 4), ("55_64", 55, 5), ("65_999", 65, 6)]
AGE_BUCKET_UNKNOWN = 7

# Income brackets (column, lower bound in $K, bucket code).
INCOME_BRACKETS = [("income_0_35_hh", 0, 1), ("income_35_45_hh", 35, 2), ("income_45_55_hh", 45, 3),
                   ("income_55_70_hh", 55, 4), ("income_70_85_hh", 70, 5), ("income_85_100_hh", 85, 6),
                   ("income_100_125_hh", 100, 7), ("income_125_150_hh", 125, 8),
                   ("income_150_200_hh", 150, 9), ("income_200_plus_hh", 200, 10)]
INCOME_BUCKET_UNKNOWN = 11

# Education levels, highest first.
EDUCATION = [("edu_graduate", "Graduate"), ("edu_college", "College"),
             ("edu_some_college", "Some College"), ("edu_high_school", "High School")]

# Ethnicity labels in priority order.
ETHNICITY = [("ethnicity_african_american", "African American"), ("ethnicity_asian", "Asian"),
             ("ethnicity_white_non_hispanic", "White Non-Hispanic"), ("ethnicity_hispanic", "Hispanic"),
             ("ethnicity_middle_eastern", "Middle Eastern"), ("ethnicity_native_american", "Native American"),
             ("ethnicity_other", "Other"), ("ethnicity_unknown", "Unknown")]

MARITAL = [("marital_status_married", "Married"), ("marital_status_single", "Single")]

# Y/N presence flags (output column, source column).
YN_FLAGS = [("SPANISH_LANGUAGE", "language_spanish"), ("HAS_BABIES_0_3", "babies_0_3_hh"),
            ("HAS_CHILDREN_0_18", "children_0_18_hh"), ("MOVE_LIKELY", "move_likely_hh"),
            ("MOVE_RECENT", "move_recent_hh"), ("LOW_QUALITY_FLAG", "low_quality"),
            ("DEMO_INCOMPLETE_FLAG", "demo_incomplete")]

MALE = [f"demo_male_{b}" for b, _, _ in AGE_BANDS]
FEMALE = [f"demo_female_{b}" for b, _, _ in AGE_BANDS]


def gender() -> Column:
    return first_match([(f"{_row_total(MALE)} > 0", "M"), (f"{_row_total(FEMALE)} > 0", "F")])


def _age_present(band: str) -> str:
    return _any_present([f"demo_male_{band}", f"demo_female_{band}"])


def age() -> Column:
    return first_match([(_age_present(b), lo) for b, lo, _ in AGE_BANDS])


def age_bucket() -> Column:
    return first_match([(_age_present(b), code) for b, _, code in AGE_BANDS], AGE_BUCKET_UNKNOWN)


def education() -> Column:
    return first_match([(_present(c), v) for c, v in EDUCATION])


def ethnicity() -> Column:
    return first_match([(_present(c), v) for c, v in ETHNICITY])


def marital_status() -> Column:
    return first_match([(_present(c), v) for c, v in MARITAL])


def home_ownership() -> Column:
    return first_match([(_present("home_owner_hh"), 1), (_present("home_renter_hh"), 0)])


def income_k() -> Column:
    return first_match([(_present(c), lo) for c, lo, _ in INCOME_BRACKETS])


def income_bucket() -> Column:
    return first_match([(_present(c), code) for c, _, code in INCOME_BRACKETS], INCOME_BUCKET_UNKNOWN)


def yn(col: str) -> Column:
    return first_match([(_present(col), "Y")], "N")


def hh_size() -> Column:
    return F.coalesce(F.col("adult_hh_size"), F.lit(0))


def children_flag(col: str = "HAS_CHILDREN_0_18") -> Column:
    return F.when(F.col(col) == "Y", F.lit(1)).otherwise(F.lit(0))


def decoded_columns() -> list[Column]:
    """All decoded attribute columns, in the attributes-table order."""
    cols = [gender().alias("GENDER"), age().alias("AGE"), age_bucket().alias("AGE_BUCKET"),
            education().alias("EDUCATION_LEVEL"), ethnicity().alias("ETHNICITY"),
            yn("language_spanish").alias("SPANISH_LANGUAGE"), marital_status().alias("MARITAL_STATUS"),
            home_ownership().alias("HOME_OWNERSHIP"), income_k().alias("HOUSEHOLD_INCOME_K"),
            income_bucket().alias("INCOME_BUCKET")]
    cols += [yn(src).alias(out) for out, src in YN_FLAGS if out != "SPANISH_LANGUAGE"]
    cols.append(hh_size().alias("ADULT_HOUSEHOLD_SIZE"))
    return cols
