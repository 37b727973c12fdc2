"""Cutting lines into fields, and the text rules of single fields."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# A token is a "quoted text" (quotes kept) or a run without blanks that does
# not begin with a quote. A quote that is never closed runs to the end of the
# line, so it can only be the last token.
TOKEN_PATTERN = r'"[^"]*"?|[^ \t\r\n"][^ \t\r\n]*'


def split_fields(line: Column, separator: str = ",") -> Column:
    """All fields, empty ones included; there is no way to escape a separator."""
    return F.split(line, re.escape(separator), -1)


def tokenize_quoted(line: Column) -> Column:
    """Blank-separated tokens; blanks inside double quotes do not separate."""
    return F.regexp_extract_all(line, F.lit(TOKEN_PATTERN), F.lit(0))


def has_open_quote(tokens: Column) -> Column:
    """True when the last of `tokenize_quoted`'s tokens misses its closing quote."""
    last = F.try_element_at(tokens, F.lit(-1))
    open_quote = last.startswith('"') & (~last.endswith('"') | (F.length(last) == 1))
    return F.coalesce(open_quote, F.lit(False))


def unless_placeholder(text: Column) -> Column:
    """Text of at most one character (`-`, a bare `/`) counts as absent."""
    return F.when(F.length(text) > 1, text).otherwise(F.lit(""))


def full_uri(host: Column, path: Column, query: Column) -> Column:
    return F.concat(host, unless_placeholder(path), unless_placeholder(query))
