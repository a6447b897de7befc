"""Words, sentences and padding of a text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\r\x0b\x0c"
NOT_LETTERS = r"[^\p{L}]+"
SENTENCE = r"[^.!?\n]+[.!?]*"


def trimmed(text: Column) -> Column:
    """The text without blanks of any kind at its ends."""
    return F.btrim(text, F.lit(BLANKS))


def words(text: Column) -> Column:
    """Lower-case words in text order."""
    return F.array_remove(F.split(F.lower(text), NOT_LETTERS), "")


def cased_words(text: Column) -> Column:
    """Words in text order as they are written."""
    return F.array_remove(F.split(text, NOT_LETTERS), "")


def sentences(text: Column) -> Column:
    """Sentences in text order, without padding; blank ones are kept so that positions stay stable."""
    return F.transform(F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0)), lambda s: F.trim(s))


def label_list(labels: Column) -> Column:
    """A list of labels; a missing list is empty."""
    return F.coalesce(labels, F.array().cast("array<string>"))


def label_as_list(label: Column) -> Column:
    """A single label as a list; a missing or empty label gives an empty list."""
    return F.when(label.isNull() | (label == ""), F.array().cast("array<string>")).otherwise(F.array(label))
