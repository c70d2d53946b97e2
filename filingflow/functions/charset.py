"""Find the character set of a document and decode it strictly."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import strip

# Aliases of charset names, after trimming, lower-casing and _ -> -.
ALIASES = {
    "ks-c-5601-1987": "cp949",
    "ks-c-5601": "cp949",
    "x-windows-949": "cp949",
    "windows-949": "cp949",
    "euckr": "euc-kr",
    "utf8": "utf-8",
}

# Accepted names and the Java charset that reads them. UTF-8 has its own path.
JAVA_CHARSETS = {
    "utf-8": "UTF-8",
    "utf-8-sig": "UTF-8",
    "u8": "UTF-8",
    "utf-16": "x-UTF-16LE-BOM",
    "utf-16le": "UTF-16LE",
    "utf-16-le": "UTF-16LE",
    "utf-16be": "UTF-16BE",
    "utf-16-be": "UTF-16BE",
    "cp949": "MS949",
    "949": "MS949",
    "ms949": "MS949",
    "uhc": "MS949",
    "euc-kr": "EUC-KR",
    "ksc5601": "EUC-KR",
    "ks-x-1001": "EUC-KR",
    "korean": "EUC-KR",
    "johab": "x-Johab",
    "iso-2022-kr": "ISO-2022-KR",
    "shift-jis": "Shift_JIS",
    "sjis": "Shift_JIS",
    "cp932": "windows-31j",
    "ms932": "windows-31j",
    "windows-31j": "windows-31j",
    "euc-jp": "EUC-JP",
    "iso-2022-jp": "ISO-2022-JP",
    "gb2312": "GB2312",
    "gbk": "GBK",
    "cp936": "GBK",
    "gb18030": "GB18030",
    "big5": "Big5",
    "big5-hkscs": "Big5-HKSCS",
    "ascii": "US-ASCII",
    "us-ascii": "US-ASCII",
    "latin-1": "ISO-8859-1",
    "latin1": "ISO-8859-1",
    "latin": "ISO-8859-1",
    "l1": "ISO-8859-1",
    "8859": "ISO-8859-1",
    "cp819": "ISO-8859-1",
    "koi8-r": "KOI8-R",
    "koi8-u": "KOI8-U",
    "tis-620": "TIS-620",
    "macintosh": "x-MacRoman",
    "cp858": "IBM00858",
}
JAVA_CHARSETS |= {f"{iso}-{n}": f"ISO-8859-{n}" for iso in ("iso-8859", "iso8859") for n in (*range(1, 10), 13, 15, 16)}
JAVA_CHARSETS |= {f"{maker}{n}": f"windows-{n}" for maker in ("windows-", "cp") for n in range(1250, 1259)}
JAVA_CHARSETS |= {f"cp{n}": f"IBM{n}" for n in (437, 850, 852, 855, 857, *range(860, 867), 869)}

# Where a document states its charset.
XML_DECLARED = r"(?is)<\?xml[^>]+encoding\s*=\s*[\"']?([a-zA-Z0-9._-]+)"
META_DECLARED = r"(?is)<meta[^>]+charset\s*=\s*[\"']?([a-zA-Z0-9._-]+)"

_COMMENT = r"(?s)<!--.*?-->"
_META_TAG = r"(?is)<meta[\s/][^>]*>"
_QUOTED_CONTENT = r"(?is)\bcontent\s*=\s*(?:\"[^\"]*\"|'[^']*')"
_CHARSET_ATTRIBUTE = r"(?is)\scharset\s*=\s*[\"']?\s*([^\s\"'/>]+)"
_HTTP_EQUIV = r"(?is)http-equiv\s*=\s*[\"']?content-type"
_CHARSET_IN_CONTENT = r"(?is)charset=([^\s;\"'>]+)"

# U+FFFD marks malformed input; U+E000..U+E0BB are the 188 sequences that the
# Java table sends to the private area although they are not assigned.
MALFORMED = r"\uFFFD"
MALFORMED_KOREAN = r"[\uFFFD\uE000-\uE0BB]"
BYTE_ORDER_MARK = r"\A\uFEFF"


def _lookup(table: dict[str, str], key: Column) -> Column:
    pairs = ", ".join(f"'{name}', '{value}'" for name, value in table.items())
    return F.try_element_at(F.expr(f"map({pairs})"), key)


def _found(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def normalize_name(name: Column) -> Column:
    """Charset name in its canonical spelling."""
    plain = F.translate(F.lower(strip(name)), "_", "-")
    return F.coalesce(_lookup(ALIASES, plain), plain)


def java_charset(name: Column) -> Column:
    """Java charset for a canonical name, NULL when the name is unknown."""
    return _lookup(JAVA_CHARSETS, name)


def _declared_by_tag(head: Column) -> Column:
    """First ``<meta charset>`` tag, else the first content-type tag."""
    tags = F.regexp_extract_all(F.regexp_replace(head, _COMMENT, ""), F.lit(_META_TAG), F.lit(0))
    by_attribute = F.filter(
        F.transform(tags, lambda t: _found(F.regexp_replace(t, _QUOTED_CONTENT, " "), _CHARSET_ATTRIBUTE)),
        lambda name: name.isNotNull(),
    )
    equiv = F.filter(tags, lambda t: t.rlike(_HTTP_EQUIV))
    return F.coalesce(
        F.get(by_attribute, F.lit(0)),
        _found(F.get(equiv, F.lit(0)), _CHARSET_IN_CONTENT),
    )


def declared_charset(head: Column, kind: Column) -> Column:
    """Canonical charset name the document states, NULL when it states none.

    ``head`` is the document, or its start, as returned by ``byte_text``.
    """
    return normalize_name(
        F.coalesce(
            F.when(kind == "html", _declared_by_tag(head)),
            _found(head, XML_DECLARED),
            _found(head, META_DECLARED),
        )
    )


def valid_utf8(data: Column) -> Column:
    return F.is_valid_utf8(data.cast("string"))


def utf8_text(data: Column) -> Column:
    """UTF-8 text without its byte order mark, NULL when malformed."""
    return F.regexp_replace(F.try_validate_utf8(data.cast("string")), BYTE_ORDER_MARK, "")


def loose_text(data: Column, charset: Column) -> Column:
    """Decode with any Java charset; malformed input becomes U+FFFD."""
    return F.call_function("decode", data, charset)


def unknown_charset(declared: Column) -> Column:
    """Failure text for a declared name nothing can read, else NULL."""
    bad = declared.isNotNull() & java_charset(declared).isNull()
    return F.when(bad, F.concat(F.lit("unknown encoding: "), declared))
