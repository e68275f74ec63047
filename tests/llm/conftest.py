import os
import zlib

import pytest

SF = "/root/testdata/sf0.001"

needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

LONG = " ".join(f"word{k % 977} x{k}" for k in range(60_000))

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, h long, batch int, label int"


def doc_row(doc_id, text, lang="en"):
    return (doc_id, text, lang, None, None, None, 7, None, 3)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty, blank and very long texts, repeated rows, extra
    columns named like an operator's own."""
    rows = [doc_row(1, None, None), doc_row(2, ""), doc_row(3, " \t\n\n "), doc_row(4, LONG), doc_row(5, "one two"),
            doc_row(5, "one two"), doc_row(None, "A text without an id, four five six seven."),
            doc_row(6, "1234 !!! 5678"), doc_row(7, "the same line of text, long enough\nsecond"),
            doc_row(8, "The same line of text, long enough \nthird"), doc_row(9, "the same line of text, long enough\n"),
            doc_row(10, "naïve café déjà vu où ça\r\nГде   x", None)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def crc(ids):
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))
