"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ABSTRACT_CLIP = 500
WHITESPACE = r"[\s\p{Z}\x0b\x1c-\x1f\x85]+"


def collapse_whitespace(text: Column) -> Column:
    """Runs of white space become one blank, none at either end.

    White space is what Python's ``str.split`` takes for it: NBSP, the information separators and the
    next-line mark count too.
    """
    return F.trim(F.regexp_replace(text, WHITESPACE, " "))


def clip(text: Column, length: int = ABSTRACT_CLIP) -> Column:
    return F.substring(text, 1, length)


def is_blank(text: Column) -> Column:
    return text.isNull() | (text == "")


def page_line(title: Column, abstract: Column) -> Column:
    """``title`` alone, or ``title: abstract`` when there is one."""
    return F.concat(
        F.coalesce(title, F.lit("")),
        F.when(~is_blank(abstract), F.concat(F.lit(": "), abstract)).otherwise(F.lit("")),
    )


def page_text(title: Column, abstract: Column) -> Column:
    """What gets embedded; a missing abstract adds nothing."""
    return F.concat_ws("\n", title, abstract)
