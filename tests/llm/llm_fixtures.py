import zlib

import pytest

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

#: Awkward rows: nulls, empty and blank texts, ties and repeated rows, odd white space, a very long text.
ODD_TEXTS = [None, "", "   ", "\n", "a", "The cat's  hat.\n\n  Don't!! x y 　z\t\tq", "naïve – “quoted”… 12,5% a.b,c!?;:",
             "ünï ʼn ſ ß ﬁ ǅ \U0001f600 é", "<|endoftext|> tail", " lead and trail ", "same text here again and again",
             "same text here again and again", "word " * 40_000, "x" * 20_000, "a\x1cb \x85 c d", "12345 67.89 a1b2",
             "日本語のテキスト と 空白", "it''s ''t 're x've", "\r\n\r\n a \r\n b"]


def crc(i, m):
    return zlib.crc32(str(i).encode()) % m


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with clashing extra columns, unordered ids, a repeated row and a null id."""
    rows = [(i * 7 % 23 + 100, t, ["en", None][i % 2], [None, "b", "a"][i % 3], len(t or ""), "x", 1, "y", 2.0)
            for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[9], (None, "row without id", "en", "a", 14, "x", 1, "y", 2.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "part string, size int, _id string, _row double").repartition(3)
