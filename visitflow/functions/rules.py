"""Silver rules as built-in column expressions (no UDFs).

Each function returns a ``Column``; they compose into one projection, so the
whole rule set runs inside a single whole-stage-codegen span.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and thresholds of the silver rules.
GENDER_CODES = {"M": "MALE", "F": "FEMALE"}
GENDER_OTHER = "UNKNOWN"
UPPERCASE_COLUMNS = ("first_name", "last_name", "doctor_name", "severity")
ALLERGY_NONE_TEXT = "None"
ALLERGY_NONE_LABEL = "NO ALLERGY"
# (exclusive upper bound, label); ages at or above the last bound are ELDERLY.
AGE_BANDS = ((30, "YOUNG_ADULT"), (50, "MIDDLE_AGED"), (70, "SENIOR"))
AGE_TOP_BAND = "ELDERLY"
WBC_LOW, WBC_HIGH = 4.0, 10.0
HGB_LOW, HGB_HIGH = 12.0, 15.0
SEVERITY_SCORES = {"MILD": 1, "MODERATE": 2, "SEVERE": 3}
SEVERITY_OTHER_SCORE = 0
QUALITY_LABEL = "CLEAN"
UNKNOWN = "UNKNOWN"
DEFAULTED_COLUMNS = ("allergy", "severity", "age_group", "wbc_status", "hgb_status")
# Valid ranges, both bounds exclusive.
AGE_RANGE = (0, 120)
WBC_RANGE = (0, 30)
HGB_RANGE = (5, 25)
# Midpoint age of each band, used by the KPI "average age".
AGE_BAND_MIDPOINTS = {"YOUNG_ADULT": 25, "MIDDLE_AGED": 45, "SENIOR": 65, "ELDERLY": 80}
SEVERE_SCORE_THRESHOLD = 2


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def gender_label(c: str | Column = "gender") -> Column:
    """M -> MALE, F -> FEMALE, anything else (null too) -> UNKNOWN. Case-sensitive."""
    c = _col(c)
    expr = None
    for code, label in GENDER_CODES.items():
        expr = F.when(c == code, label) if expr is None else expr.when(c == code, label)
    return expr.otherwise(GENDER_OTHER)


def allergy_label(c: str | Column = "allergy") -> Column:
    """The exact text 'None' means no allergy; everything else is upper-cased."""
    c = _col(c)
    return F.when(c == ALLERGY_NONE_TEXT, ALLERGY_NONE_LABEL).otherwise(F.upper(c))


def age_band(c: str | Column = "age") -> Column:
    """Age band; a null age falls through to the top band, as a when-chain does."""
    c = _col(c)
    expr = None
    for bound, label in AGE_BANDS:
        expr = F.when(c < bound, label) if expr is None else expr.when(c < bound, label)
    return expr.otherwise(AGE_TOP_BAND)


def _three_way(c: Column, low: float, high: float) -> Column:
    return F.when(c < low, "LOW").when(c > high, "HIGH").otherwise("NORMAL")


def wbc_class(c: str | Column = "wbc") -> Column:
    """White-cell status; the bounds themselves are NORMAL."""
    return _three_way(_col(c), WBC_LOW, WBC_HIGH)


def hgb_class(c: str | Column = "hgb") -> Column:
    """Haemoglobin status; the bounds themselves are NORMAL."""
    return _three_way(_col(c), HGB_LOW, HGB_HIGH)


def severity_score(c: str | Column = "severity") -> Column:
    """Score of an (already upper-cased) severity label; unknown or null -> 0."""
    c = _col(c)
    expr = None
    for label, score in SEVERITY_SCORES.items():
        expr = F.when(c == label, score) if expr is None else expr.when(c == label, score)
    return expr.otherwise(SEVERITY_OTHER_SCORE).cast("int")


def present(name: str) -> Column:
    """The text is neither null nor empty."""
    c = F.col(name)
    return c.isNotNull() & (c != "")


def _in_range(name: str, bounds: tuple[float, float]) -> Column:
    c = F.col(name)
    return c.isNotNull() & (c > bounds[0]) & (c < bounds[1])


def quality_checks() -> dict[str, Column]:
    """The row-level checks by the column they look at; each is true or false, never null."""
    return {
        "age": _in_range("age", AGE_RANGE),
        "wbc": _in_range("wbc", WBC_RANGE),
        "hgb": _in_range("hgb", HGB_RANGE),
        "id": present("id"),
        "first_name": present("first_name"),
    }


def quality_predicate() -> Column:
    """Row-level validity: lab values and age in range, id and first name present."""
    return reduce(lambda a, b: a & b, quality_checks().values())


def reject_reasons() -> Column:
    """Names of the checks a row fails, in the order of ``quality_checks``; empty for a valid row."""
    return F.array_compact(F.array(*[F.when(~check, name) for name, check in quality_checks().items()]))


def visit_date(c: str | Column = "timestamp") -> Column:
    """Calendar date of the record's own timestamp text; unparsable text -> null.

    ``try_to_date`` reads only the leading date part, as the non-ANSI ``to_date``
    of older Spark did, and gives null instead of failing the query on bad text.
    """
    return F.try_to_date(_col(c))


def visit_time(c: str | Column = "timestamp") -> Column:
    """Event time of the record's own timestamp text; unparsable text -> null."""
    return _col(c).try_cast("timestamp")


def event_time(c: str | Column = "timestamp") -> Column:
    """Event time, or the start of the visit date where only the date can be read; else null."""
    return F.coalesce(visit_time(c), visit_date(c).cast("timestamp"))
