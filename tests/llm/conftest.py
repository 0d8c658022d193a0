import os

import pytest

SF = "/root/testdata/sf0.001"
# Names that operators use inside must not clash with columns of the input.
CLASHING = (
    "key comp rep a b n at rank score predicted secrets spans words seed seeds region base "
    "n_tokens bucket batch_id slot place block gram logp held_out component_id label own"
).split()
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"`{c}` string" for c in CLASHING
)


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("test tables are absent")
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a table of documents, with clashing columns, from ``(doc_id, text, lang)``."""

    def make(rows):
        full = [
            (i, t, lang, "src", None if t is None else len(t), *["x"] * len(CLASHING))
            for i, t, lang in rows
        ]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
ODD = [
    (1, "One plain text of a few words, nothing more to it.", "en"),
    (2, None, "en"),
    (3, "", None),
    (4, " \t\n ", "en"),
    (5, LONG, "en"),
    (6, "word", "en"),
    (7, "same text for two ids, same words in both of them", "en"),
    (8, "same text for two ids, same words in both of them", None),
    (9, "a row that comes twice, with the same id and text", "de"),
    (9, "a row that comes twice, with the same id and text", "de"),
    (10, "größe ñandú 漢字 😀 … ▁ K", "de"),
    (None, "a row without an id, but with a text of some words", "en"),
    (None, None, None),
]


@pytest.fixture(scope="session")
def odd(documents):
    return documents(ODD)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents([])


@pytest.fixture(scope="session")
def odd_rows():
    return ODD
