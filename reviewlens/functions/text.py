"""Text expressions over one row: cleaning, tokens, term counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Blanks as Python's str.split() sees them: the Unicode ones and four separators.
SPACES = r"\s\x1C-\x1F"
WORD_CHARS = r"\p{L}\p{N}_"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def clean(text: Column) -> Column:
    """Lower case without punctuation."""
    return F.regexp_replace(F.lower(text), f"(?U)[^{WORD_CHARS}{SPACES}]", "")


def words(text: Column) -> Column:
    """Pieces between runs of blanks."""
    return F.array_remove(F.split(text, f"(?U)[{SPACES}]+"), "")


def terms(text: Column) -> Column:
    """Lower-cased runs of two or more word characters, the tokens of all TF-IDF work."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"[{WORD_CHARS}]{{2,}}"), F.lit(0))


def term_counts(tokens: Column) -> Column:
    """``array<struct<term, tf>>`` of one row's tokens.

    Tokens are sorted and cut into runs inside the row, so a bag of words needs no shuffle.
    """

    def runs(a: Column) -> Column:
        heads = F.array_compact(
            F.transform(a, lambda x, i: F.when((i == 0) | (x != F.get(a, i - 1)), i))
        )

        def spans(h: Column) -> Column:
            ends = F.slice(F.concat(h, F.array(F.size(a))), F.lit(2), F.size(h))
            return F.zip_with(
                h, ends, lambda b, e: F.struct(F.get(a, b).alias("term"), (e - b).alias("tf"))
            )

        return bind(heads, spans)

    return bind(F.sort_array(tokens), runs)
