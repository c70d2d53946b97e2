"""Words and small text measures as Column functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: what separates words, as in ``[^\x20\x09-\x0D]+``.
BLANKS = " \t\n\x0b\x0c\r"


def text_of(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def replaced(text: Column, characters: str, by: str) -> Column:
    """Replace each character; a byte search per character, far faster than ``translate`` on long texts."""
    for character in characters:
        text = F.replace(text, F.lit(character), F.lit(by))
    return text


def words_of(text: Column) -> Column:
    """Words of a text, unchanged; none for a null or blank text."""
    return F.array_remove(F.split(replaced(text_of(text), BLANKS[1:], " "), " "), "")


def is_blank(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS)) == ""


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z only, so that the result does not depend on a locale."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def unused(name: str, taken: list[str]) -> str:
    """A column name that clashes with none of ``taken``, in any spelling Spark takes for equal."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name = "_" + name
    return name
