import pytest

#: Documents, and columns with the names of what operators add or use themselves.
DOCS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, size string, shard int, _n string, "
    "_id string, _tie int, _twin int, _copy int, _copies int, _doc int, _spans string, _n_words int, _items string, _contaminated int, "
    "held_out string, n_tokens string, fp string, id string, tie string, twin string, copies string, `row` string, level int, prefix string"
)
EXTRA = (0.5, "x", 3, "y", "i", 1, 2, 3, 4, 5, "s", 6, "t", 7, "h", "n", "f", "d", "e", "w", "c", "r", 8, "p")
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
PLAIN = "the cat sat on the mat and then it went to the house of the old man who was there in the sun all day long " * 2


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, source]) with columns whose names the operators use themselves."""

    def build(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None, *EXTRA) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return build


@pytest.fixture(scope="session")
def odd_docs(docs_of):
    """Nulls, empty and blank texts, a very long text, ties, repeated rows, a null id and a null source."""
    return docs_of(
        [
            (1, None), (2, ""), (3, " \n\t "), (4, LONG, None), (5, PLAIN, "b"), (5, PLAIN, "b"), (6, PLAIN, "a"), (None, PLAIN),
            (None, None, None), (7, "one"), (8, "one two"), (9, PLAIN.upper(), "b"), (10, PLAIN + "extra words here", "b"),
        ]
    )


@pytest.fixture(scope="session")
def no_docs(docs_of):
    return docs_of([])
