"""State UTF-8 in the text of HTML and XML documents."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .charset import META_DECLARED

# What a rewritten document states.
META_UTF8 = '<meta charset="UTF-8">'
XML_UTF8 = '<?xml version="1.0" encoding="UTF-8"?>'

_ONE_META = r'<meta\s+charset="UTF-8">\s*'
# Two passes instead of a repeated group: Java matches repeated groups by
# recursion, and a document with thousands of tags must not end the executor.
_THIRD_LAST_META = rf"(?is){_ONE_META}(?={_ONE_META}<meta\s+charset=\"UTF-8\">)"
_PAIR_OF_META = rf"(?is){_ONE_META}{_ONE_META}"


def rewrite_html(text: Column, keep_tail: bool = False) -> Column:
    """Replace every charset statement by UTF-8, or insert one.

    ``keep_tail`` leaves whatever follows the charset value inside the tag in
    the text, which is what the service being replaced does.
    """
    pattern = META_DECLARED if keep_tail else META_DECLARED + "(?:[^>]*>)?"
    stated = F.regexp_replace(text, pattern, META_UTF8)
    inserted = (
        F.when(
            text.rlike(r"(?is)<head[^>]*>"),
            F.regexp_replace(text, r"(?is)\A(.*?<head[^>]*>)", "$1\n" + META_UTF8),
        )
        .when(
            text.rlike(r"(?is)\A\s*<!doctype[^>]*>"),
            F.regexp_replace(text, r"(?is)\A(\s*<!doctype[^>]*>\s*)", "$1\n" + META_UTF8),
        )
        .otherwise(F.concat(F.lit(META_UTF8 + "\n"), text))
    )
    whole = F.when(text.rlike(META_DECLARED), stated).otherwise(inserted)
    return F.regexp_replace(F.regexp_replace(whole, _THIRD_LAST_META, ""), _PAIR_OF_META, META_UTF8)


def rewrite_xml(text: Column) -> Column:
    """Replace the leading XML declaration, or put one in front."""
    declared = r"\A<\?xml[^>]*\?>"
    return F.when(
        text.rlike(declared), F.regexp_replace(text, declared, XML_UTF8)
    ).otherwise(F.concat(F.lit(XML_UTF8 + "\n"), text))


def rewrite(text: Column, kind: Column, keep_tail: bool = False) -> Column:
    return (
        F.when(kind == "html", rewrite_html(text, keep_tail))
        .when(kind == "xml", rewrite_xml(text))
        .otherwise(text)
    )
