"""Bands, dates, maps and digests as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BANDS = [(85, "high_trust"), (70, "moderate_trust"), (50, "low_trust")]
LOWEST = "critical_or_unreliable"
LABELS = [label for _, label in BANDS] + [LOWEST]


def ladder(rules: list[tuple[Column, object]], otherwise: object) -> Column:
    """First rule that holds wins; a null condition doesn't hold."""
    out = F.lit(otherwise) if not isinstance(otherwise, Column) else otherwise
    for condition, value in reversed(rules):
        out = F.when(F.coalesce(condition, F.lit(False)), value if isinstance(value, Column) else F.lit(value)).otherwise(out)
    return out


def band_label(score: Column, bands=BANDS, lowest: str = LOWEST) -> Column:
    return ladder([(score >= limit, label) for limit, label in bands], lowest)


#: What a claim's type is called on a page.
CLASS_LABELS = {"empirical": "Cited fact", "comparative": "Cited fact", "causal": "Cited fact", "methodological": "Method note", "definition": "Method note", "review_synthesis": "Inference", "speculation": "Inference", "limitation": "Limitation"}


def class_label(claim_type: Column) -> Column:
    return F.coalesce(lookup(CLASS_LABELS, F.lower(claim_type)), F.lit("Claim"))


def band_text(score: Column) -> Column:
    """Label for display; no score is pending."""
    return F.when(score.isNull() | F.isnan(score.cast("double")), "pending").otherwise(band_label(score))


def multiple_of(x: Column, step: int) -> Column:
    return F.pmod(x, F.lit(step)) == 0


def chosen_in_order(found: Column, order: list[str]) -> Column:
    """Members of ``found`` in the fixed order of a list."""
    return F.filter(F.array(*[F.lit(x) for x in order]), lambda x: F.array_contains(found, x))


def moment(x: Column) -> Column:
    return F.try_to_timestamp(x)


RFC3339 = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:\d{2})$"


def strict_moment(x: Column) -> Column:
    return F.when(x.rlike(RFC3339), F.try_to_timestamp(x))


def iso_utc(ts: Column) -> Column:
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def in_order(*moments: Column) -> Column:
    """Each moment isn't later than the next; a missing one breaks the order."""
    pairs = [F.coalesce(a <= b, F.lit(False)) for a, b in zip(moments, moments[1:])]
    out = F.lit(True)
    for p in pairs:
        out = out & p
    return out


def elapsed_hours(first: Column, last: Column) -> Column:
    return (F.unix_timestamp(last) - F.unix_timestamp(first)) / 3600.0


def lookup(values: dict, key: Column) -> Column:
    pairs = [F.lit(v) for kv in values.items() for v in kv]
    return F.element_at(F.create_map(*pairs), key)


def threshold_of(rule: Column) -> tuple[Column, Column]:
    """Percent and window of a rule such as ``<2% new unique in last 100``."""
    return (F.regexp_extract(rule, r"<\s*([0-9.]+)\s*%", 1).cast("double") / 100, F.regexp_extract(rule, r"last\s+([0-9]+)", 1).cast("int"))


def or_default(x: Column, default: object) -> Column:
    """Null and the empty text both give way to the default."""
    return F.coalesce(F.when(x.cast("string") != "", x), default if isinstance(default, Column) else F.lit(default))
