"""Row-local column expressions. All of them stay inside generated JVM code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for "no value" in raw files.
MISSING_MARKERS = ("", "na", "n/a", "nan", "none", "null", "?", "unknown", "error")

# Score thresholds, class names and outcome texts of the label rule.
POSITIVE_MIN = 4.0
NEGATIVE_MAX = 2.0
LABEL_POSITIVE = "positive"
LABEL_NEGATIVE = "negative"
CLASS_LABELS = (LABEL_NEGATIVE, LABEL_POSITIVE)
POS_LABEL = LABEL_NEGATIVE
OUTCOME_MISSING = "dropped: missing rating"
OUTCOME_NON_NUMERIC = "dropped: non-numeric rating"
OUTCOME_MIDDLE = "dropped: ambiguous middle rating"

# Fixed value: a rating written out in free text, such as "4/5" or "5 stars".
EXPLICIT_RATING = r"(?i)\b[1-5](?:\.5)?\s*(?:/\s*5|stars?)\b"

EXAMPLE_LENGTH = 60


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# A decimal number or an infinity; a cast alone would also take type suffixes such as ``5d`` or ``1F``.
NUMBER = r"(?i)^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf|infinity)\s*$"


def to_number(c: str | Column) -> Column:
    """Parse to double; text that is no number, and NaN, become NULL."""
    c = as_column(c)
    number = c.try_cast("double")
    return F.when(c.cast("string").rlike(NUMBER) & ~F.isnan(number), number)


def nan_to_null(c: str | Column) -> Column:
    return F.nanvl(as_column(c).cast("double"), F.lit(None).cast("double"))


def strip(c: str | Column) -> Column:
    """Remove white space of any kind at both ends (``trim`` removes blanks only)."""
    return F.regexp_replace(as_column(c).cast("string"), r"^\s+|\s+$", "")


def normalised_text(c: str | Column) -> Column:
    return F.lower(strip(c))


def word_count(c: str | Column) -> Column:
    return F.size(F.filter(F.split(as_column(c), r"\s+"), lambda w: w != ""))


def char_count(c: str | Column) -> Column:
    return F.char_length(as_column(c))


def integer_before(c: str | Column, word: str) -> Column:
    """The number written directly before ``word``; NULL where there is none."""
    return F.regexp_extract(as_column(c), rf"(\d+)\s*{word}", 1).try_cast("double")


def states_rating(c: str | Column) -> Column:
    return as_column(c).rlike(EXPLICIT_RATING)


def is_missing_marker(c: str | Column, markers: Sequence[str] = MISSING_MARKERS) -> Column:
    return normalised_text(c).isin(*markers)


def clip_example(c: str | Column, length: int = EXAMPLE_LENGTH) -> Column:
    c = as_column(c)
    return F.when(F.char_length(c) > length, F.concat(F.left(c, F.lit(length - 3)), F.lit("..."))).otherwise(c)


def yes_no_flag(c: str | Column, yes: str = "Yes") -> Column:
    return (as_column(c) == yes).cast("int")


def zscore(c: str | Column, mean: Column | float, std: Column | float) -> Column:
    return (as_column(c) - mean) / std


def outside(c: str | Column, low: Column | float, high: Column | float) -> Column:
    c = as_column(c)
    return (c < low) | (c > high)


def is_whole(c: str | Column) -> Column:
    c = as_column(c)
    return c == F.round(c)


def agreement(a: Column, b: Column) -> Column:
    """Share of rows on which two expressions agree; NULL agrees with NULL."""
    return F.avg(a.eqNullSafe(b).cast("int"))


def masked(c: str | Column, text: str = "<hidden>") -> Column:
    return F.when(as_column(c).isNotNull(), F.lit(text))


def label_from_score(c: str | Column, positive_min: float = POSITIVE_MIN, negative_max: float = NEGATIVE_MAX) -> Column:
    """Two classes from a score; the middle, the missing and the unreadable stay NULL."""
    score = to_number(c)
    return F.when(score >= positive_min, F.lit(LABEL_POSITIVE)).when(score <= negative_max, F.lit(LABEL_NEGATIVE))


def label_outcome(c: str | Column, positive_min: float = POSITIVE_MIN, negative_max: float = NEGATIVE_MAX) -> Column:
    """What happens to each raw score, in words."""
    raw = as_column(c)
    return (
        F.when(raw.isNull(), OUTCOME_MISSING)
        .when(to_number(raw).isNull(), OUTCOME_NON_NUMERIC)
        .otherwise(F.coalesce(label_from_score(raw, positive_min, negative_max), F.lit(OUTCOME_MIDDLE)))
    )


def content_key(c: str | Column, is_text: bool) -> Column:
    """A short stand-in for comparing long text: its digest once it exceeds 32 characters.

    Shuffles then carry 64 bytes instead of whole documents. Short text stands for
    itself and can never equal a 64-character digest.
    """
    c = as_column(c)
    if not is_text:
        return c
    return F.when(F.char_length(c) > 32, F.sha2(c, 256)).otherwise(c)


def order_hash(key: str | Column, seed: int = 42) -> Column:
    """A seeded order that depends on the row id alone, never on partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}|"), as_column(key).cast("string")))
