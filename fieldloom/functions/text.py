"""Tokens, n-grams and per-text term counts, all inside one row."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from fieldloom.functions.scalars import as_column

# Fixed value: a token is two or more letters, digits or underscores.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


@F.udf(returnType=StringType(), useArrow=False)
def _folded(text):
    if text is None:
        return None
    return "".join([ch for ch in unicodedata.normalize("NFKD", text) if not unicodedata.combining(ch)])


def fold_accents(text: str | Column) -> Column:
    """Compatibility-decompose and drop combining marks; Spark has no such function.

    Texts of ASCII alone stay in Spark. The others go to Python a hundred rows at a time and not as Arrow batches, whose ten
    thousand whole texts would be held there at once.
    """
    text = as_column(text)
    return F.coalesce(_folded(F.when(F.octet_length(text) != F.char_length(text), text)), text)


def tokens(c: str | Column, fold: bool = False) -> Column:
    c = F.lower(as_column(c))
    return F.regexp_extract_all(fold_accents(c) if fold else c, F.lit(TOKEN_PATTERN), F.lit(0))


def with_bigrams(words: str | Column) -> Column:
    """The words followed by every pair of neighbours."""
    words = as_column(words)
    pairs = F.zip_with(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
        F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return F.concat(words, pairs)


def term_counts(sorted_terms: str | Column) -> Column:
    """``array<struct<term, tf>>`` from a *sorted* term array, without leaving the row.

    Run starts are found in the sorted array and each run length is the gap to the
    next start, so a text of n terms costs O(n) here and no shuffle.
    """
    terms = as_column(sorted_terms)
    starts = F.filter(
        F.transform(terms, lambda t, i: F.when((i == 0) | (F.get(terms, i - 1) != t), i)),
        lambda p: p.isNotNull(),
    )
    ends = F.concat(F.slice(starts, 2, F.size(terms) + 1), F.array(F.size(terms)))
    return F.when(
        F.size(terms) > 0,
        F.zip_with(
            starts,
            ends,
            lambda s, e: F.struct(F.get(terms, s).alias("term"), (e - s).cast("long").alias("tf")),
        ),
    )
