"""Text expressions used by the word-count job (JVM regular expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokeniser rules of the word-count job.
# Unicode punctuation or symbol characters become a space, tokens are split on
# runs of ASCII whitespace, and each token is trimmed of every character at or
# below U+0020 (the JVM's String.trim), then lower-cased.
PUNCTUATION_OR_SYMBOL = r"\p{P}|\p{S}"
WHITESPACE_RUN = r"\s+"
CONTROL_EDGES = r"^[\x00-\x20]+|[\x00-\x20]+$"


def jvm_trim(c: Column) -> Column:
    """Strip every character <= U+0020 from both ends (``F.trim`` strips only spaces)."""
    return F.regexp_replace(c, CONTROL_EDGES, "")


def raw_tokens(c: Column) -> Column:
    """array<string> of whitespace-separated pieces after punctuation removal."""
    return F.split(F.regexp_replace(c, PUNCTUATION_OR_SYMBOL, " "), WHITESPACE_RUN)


def normalise_token(c: Column) -> Column:
    return F.lower(jvm_trim(c))


def replace_newlines(c: Column) -> Column:
    """Replace ``\\n`` (and only ``\\n``) by a space."""
    return F.replace(c, F.lit("\n"), F.lit(" "))
