"""Cleaning of text cells."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cells that mean "no value" when a landing file is loaded. 'N/A' is not one of them;
# it stays text until a tolerant cast turns it into null.
NULL_TOKENS = ("", "NA", "Not Available")

# The characters (with any white space) after which the warehouse dialect starts a new word.
TITLE_DELIMITERS = "!?@\"^#$&~_,.:;+-*%/|\\[](){}<>"


def null_tokens(cell: Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """Null where the whole cell is one of ``tokens``, else the cell unchanged."""
    return F.when(cell.isin(*tokens), F.lit(None)).otherwise(cell)


def title_case(text: Column, delimiters: str = TITLE_DELIMITERS) -> Column:
    """Upper-case the first character of every word and lower-case the rest.

    Spark's ``initcap`` starts words at blanks only; here a word also starts after punctuation and other white space,
    so ``A&B`` and ``WEST/EAST`` come out right, while an apostrophe does not start one. The text is cut only where
    ``initcap`` would miss a word, and each piece is left to it.
    """
    marks = re.escape(delimiters)
    missed_start = f"(?<=[\\t\\n\\x0B\\f\\r{marks}])(?=[^\\s{marks}])"
    return F.array_join(F.transform(F.split(text, missed_start), lambda piece: F.initcap(piece)), "")
