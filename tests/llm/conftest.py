import pytest

SF = "/root/testdata/sf0.001"

#: Documents with everything that may go wrong, and columns that operators use as names of their own.
EDGE_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, _row long, fp string, unit string, "
               "size string, draws string, digest string, place string, score string, `group` string")


def edge_rows():
    long_text = "very long text about nothing at all. " * 4000
    texts = [None, "", "   \n\t ", "one", "one two", "one two three four five six. seven eight nine ten eleven.",
             "one two three four five six. seven eight nine ten eleven.", "ONE two three four five six. other things here",
             long_text, "naïve ÉCOLE ß and 日本語 words here now!", "x" * 5000, "\n" * 300, "end. " * 50]
    rows = [(i, t, "en", None if i % 4 == 0 else f"s{i % 3}", None, 1, "f", "u", "s", "d", "g", "p", "c", "g")
            for i, t in enumerate(texts)]
    rows += [rows[5], rows[8]]  # repeated rows
    rows += [(None, "a text without an id at all, but words", None, None, None, None, None, None, None, None, None, None, None, None)] * 2
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), EDGE_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
