"""The engine's inputs, over tables of a test's own."""

import pyarrow as pa
import pytest
from engine_helpers import rows
from pyspark.sql import functions as F

from plumefeed.plans import tables


@pytest.fixture
def documents(spark, tmp_path):
    """A folder with a table of documents, written anew for each test."""

    def write(texts):
        data = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts, 1)]
        found = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
        found.write.parquet(f"{tmp_path}/documents.parquet")
        return str(tmp_path)

    return write


def test_lines_stay_where_their_texts_are(spark, documents):
    """A shuffle by value put equal lines, as all blank ones, into one file."""
    at = documents([f"word {i}" for i in range(600)])
    lines = spark.read.text(tables.raw_path(spark, at)).withColumn("file", F.input_file_name())
    blank = lines.where(F.trim("value") == "")
    assert blank.count() == 600 // 43
    assert blank.select("file").distinct().count() > 1
    assert lines.select("file").distinct().count() >= 8
    assert lines.where(F.trim("value") != "").count() == 600 + 600 // 13


def test_vocabulary_has_every_character(spark, documents):
    texts = ["aé b\t\u00a0c", None, "", "\U0001f600x\n\x0b\f\r\x1c", "a"]
    at = documents(texts)
    chars = set("".join(t or "" for t in texts)) - set(" \t\n\x0b\f\r")
    found = tables.vocab(spark, at).orderBy("token_id").collect()
    assert [r.token_id for r in found] == list(range(5 + 2 * len(chars)))
    assert sorted(r.token for r in found[5:]) == sorted([*chars, *(f"##{c}" for c in chars)])


def test_vocabulary_leaves_python_as_different_characters():
    batch = pa.RecordBatch.from_arrays([pa.array(["aab", None, "b c"])], names=["text"])
    assert [b.column("c").to_pylist() for b in tables._characters(iter([batch]))] == [["a", "b", "c"]]
