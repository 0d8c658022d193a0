"""Token counts against the library."""

import random

import pyarrow as pa
import pytest

from plumefeed.llm import token_counts as tc
from plumefeed.llm.textops import as_text

spm = pytest.importorskip("sentencepiece")
files = pytest.importorskip("public_tokenizers")
MODEL = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def library():
    return spm.SentencePieceProcessor(model_file=files.path(MODEL))


def test_random_strings(library):
    rng = random.Random(3)
    letters = " \n\t▁aethinoABé😀ñ漢字.,<s>0x "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(70))) for _ in range(3000)]
    texts += ["", " ", "  ", " " * 70, "a" * 5000, "<s> a </s><unk> <0x0A>", "▁", "the " * 500]
    vocabulary = tc.read_vocabulary(files.path(MODEL))
    got = tc._count(as_text(pa.array(texts)), vocabulary, {})
    assert got.tolist() == [len(x) for x in library.encode(texts)]


def test_documents(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = tc.count_tokens(docs, limit=500).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(library.encode(texts[r.doc_id]))
        assert tuple(r) == (r.doc_id, len(texts[r.doc_id].encode()), n, n > 500)


def test_odd_rows(odd, odd_rows, nothing, library):
    got = sorted(tuple(r)[:3] for r in tc.count_tokens(odd).where("doc_id is not null").collect())
    expected = [(i, len((t or "").encode()), len(library.encode(t or ""))) for i, t, _ in odd_rows if i]
    assert got == sorted(expected)
    assert tc.count_tokens(odd).count() == len(odd_rows)
    assert tc.count_tokens(nothing).collect() == []


def test_other_models_are_an_error(tmp_path):
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    model = proto.ModelProto()
    with open(files.path(MODEL), "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    path = tmp_path / "unigram.model"
    path.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        tc.read_vocabulary(str(path))
