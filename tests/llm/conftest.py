import pytest

ODD_TEXTS = [
    None, "", " ", "\n\t", "one", "one two three four", "A b C d E", "word " * 300, ("x y z " * 40).strip(),
    "é ü ñ ß " * 20, "tab\tand\nline\x0bfeed\x0c end\r\n", "  leading and  double  spaces ", "<|endoftext|> is text",
    "Released under the MIT License.", "long " + " ".join(f"w{i}" for i in range(30_000)), " no break   wide", "é İ Σς ǅ",
]


@pytest.fixture
def odd(spark):
    """Null and odd values, repeated rows, and columns whose names clash with results."""
    base = " ".join(f"word{i % 97}-{i}" for i in range(120))
    near = base.replace("word5-5 ", "other ")
    texts = [*ODD_TEXTS, base, near, base, "prefix words here " + base, base.upper()]
    rows = [(i, t, f"src{i % 3}" if i % 5 else None, "en", 7, 1) for i, t in enumerate(texts)]
    rows += [(None, base, None, None, None, None), (3, "\n\t", "src0", "en", 7, 1), (3, base, "src0", "en", 7, 1)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, source string, lang string, N_Words int, kept int"
    ).repartition(3)


@pytest.fixture
def empty(odd):
    return odd.limit(0)


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 3 == 0) for i in range(25)], "doc_id long, quality int, t boolean").selectExpr(
        "doc_id", "quality", "int(t) AS toxic"
    )
