"""Text checks, classification into given labels, and masking expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F, types as T

# Fixed value: the accepted form of an e-mail address.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def is_email(value: Column) -> Column:
    """TRUE for a well-formed address; a NULL is simply not one.

    The ``d`` flag makes ``$`` accept a final newline but no other line end, as Python does.
    """
    return F.coalesce(value.rlike(f"(?d){EMAIL_PATTERN}"), F.lit(False))


@F.udf(T.BooleanType(), useArrow=True)
def is_email_udf(value):
    """The same check as a user-defined function, for callers that must stay in Python."""
    import re

    return value is not None and re.search(EMAIL_PATTERN, value) is not None


def clean_code(value: Column) -> Column:
    return F.upper(F.trim(value))


def classify_keywords(
    text: Column, labels: Mapping[str, Sequence[str]], default: str
) -> Column:
    """The label with most matching patterns over the whole text; the first one wins a tie."""
    scores = {
        label: sum(
            (F.coalesce(text.rlike(pattern), F.lit(False)).cast("int") for pattern in patterns),
            F.lit(0),
        )
        for label, patterns in labels.items()
    }
    best = F.greatest(*scores.values(), F.lit(0)) if len(scores) > 1 else next(iter(scores.values()))
    choice = F.when(best == 0, F.lit(default))
    for label, score in scores.items():
        choice = choice.when(score == best, F.lit(label))
    return choice.otherwise(F.lit(default))


def keep_last(value: Column, shown: int, prefix: str) -> Column:
    """Replace all but the last ``shown`` characters by a fixed prefix."""
    return F.concat(F.lit(prefix), F.right(value, F.lit(shown)))
