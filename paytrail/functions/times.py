"""ISO-8601 times that must carry an offset."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE = r"\d{4}-\d{2}-\d{2}"
CLOCK = r"[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?"
OFFSET = r"(?:Z|[+-]\d{2}:?\d{2}(?::\d{2})?)"


def instant(text: Column) -> Column:
    """Timestamp of text with an offset; null if it isn't one."""
    shaped = text.rlike(rf"\A{DATE}{CLOCK}{OFFSET}\z")
    return F.when(shaped, F.try_to_timestamp(F.regexp_replace(F.translate(text, " ", "T"), r"([+-]\d{2})(\d{2})\z", "$1:$2")))


def time_reason(text: Column, field: str, at: Column | None = None) -> Column:
    """Why text is no time with an offset: invalid, or a time without one; null if it is.  at is its instant, if that is there already."""
    naive = text.rlike(rf"\A{DATE}(?:{CLOCK})?\z") & F.try_to_timestamp(F.regexp_replace(text, " ", "T")).isNotNull()
    return F.when(text.isNull(), f"invalid_{field}").when((instant(text) if at is None else at).isNotNull(), None).when(naive, f"timezone_required:{field}").otherwise(f"invalid_{field}")
