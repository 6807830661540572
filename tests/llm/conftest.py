import pytest

#: Texts with every odd case: null, empty, blanks only, repeats, long words,
#: characters beyond ASCII, spans at the ends.
TEXTS = [
    None, "", " \t\n\x0b\x0c\r ", "one", "one two", "a b c", "A b c d", "x" * 4_000, "9" * 2_000, "1 " * 1_000,
    "same line\nsame line\n\nsame line\n \n", "a@b.co", "mail a@b.c.d@e.f and x@y.z.", "..a@b.c-d.e", "a@b.c_d@e.f",
    "1.2.3.4.5.6.7.8", "256.1.1.1 0255.0.0.000 1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1112 4111111111111111",
    "+1 (262) 555-3752", "+12", "+1 ........ 2 +123456789 +1234567890123456", "é 10.0.0.1 😀 a@b.co",
    "DE89 3704 0044 0532 0130 00", "my ssn is 123-45-6789", "ref 123-45-6789", "call 555-123-4567 now",
    "word " * 60, "The quick brown fox jumps over the lazy dog again and again today", "THE QUICK BROWN FOX " * 4,
    "the same passage of five words and the same passage of five words ends here now ok",
    "### *** $$$ %%% &&& ||| <<< >>> ### *** $$$ %%%", "é è ü ö ß ñ ó í á ê ç à", "end \U0001f600\U0001f600 of it",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with every odd text, repeated rows, null ids, and extra
    columns whose names the operators use themselves."""
    rows = [(i, t, "en", None if i % 5 == 0 else f"src{i % 4}", None if t is None else len(t)) for i, t in enumerate(TEXTS)]
    rows += [rows[20], rows[20], rows[28], (None, "no id " * 20, "en", "src1", 1), (None, None, None, None, None)]
    rows += [(200 + i, rows[28][1], "en", "src0", 1) for i in range(30)]  # a group of copies
    extra = ("body", "kept", "row", "carried", "class", "bucket", "rank", "slot", "fp", "spans", "words", "node", "n")
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in extra)
    return spark.createDataFrame([(*r, *extra) for r in rows], schema).repartition(3)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def no_docs(small_docs):
    return small_docs.limit(0)


def pairs(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]
