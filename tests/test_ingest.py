import hashlib
import json
from types import SimpleNamespace

import pyarrow as pa
import pytest
from engine_helpers import rows
from pyspark.sql import functions as F

from plumefeed.constants import FEATURE_COLUMNS
from plumefeed.functions import text as t
from plumefeed.functions import wordpiece
from plumefeed.operators import ingest
from plumefeed.schemas import CSV_COLUMNS
from plumefeed.sources import files
from plumefeed.sources.rows import first_rows, with_file_position, with_row_index

NOW = 1706745600


def one(spark, expr, value):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(expr(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "value, expected",
    [
        (None, ""),
        ("  a b ", "a b"),
        ('" quoted "', "quoted"),
        ('""twice""', '"twice"'),
        ('"', '"'),
        ('""', ""),
        ("NULL", ""),
        ('"None"', ""),
        ("nan", ""),
        ("nano", "nano"),
        ("  x\n", "x"),
        ('say "hi"', 'say "hi"'),
        ("line\nbreak", "line\nbreak"),
    ],
)
def test_clean_field(spark, value, expected):
    assert one(spark, t.clean_field, value) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        (None, []),
        ('["Spark","##Vector","", null, " x "]', ["Spark", "Vector", "x"]),
        ('["#"]', [""]),
        ("a, #b,, c ", ["a", "b", "c"]),
        ("#", [""]),
        ('"one"', ["one"]),
        ('"#one"', ["one"]),
        ("[1, 2]", ["1", "2"]),
        ("[]", []),
        ("5", ["5"]),
        ('{"a":1}', ['{"a":1}']),
        ("[broken", ["[broken"]),
    ],
)
def test_parse_list(spark, value, expected):
    assert one(spark, t.parse_list, value) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ('"2024-05-29T06:30:33.000Z"', 1716964233),
        ("2024-05-29T06:30:33+03:00", 1716953433),
        ("2024-05-29T06:30:33+0300", 1716953433),
        ("2024-05-29 06:30:33.987654", 1716964233),
        ("2024-05-29T06:30", 1716964200),
        ("2024-05-29T06", 1716962400),
        ("2024-05-29", 1716940800),
        ("2024-05", NOW),
        ("2024", NOW),
        ("2024-13-01", NOW),
        ("soon", NOW),
        ("", NOW),
        (None, NOW),
    ],
)
def test_parse_timestamp(spark, value, expected):
    assert one(spark, lambda c: t.parse_timestamp(c, NOW), value) == expected


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, lambda c: t.parse_timestamp(c, NOW), "2024-05-29T06:30:33") == 1716964233
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "value, expected",
    [("1,234", 1234), ("1.9e3", 1900), ("-1.9", -1), ("1.2K", 0), ("12d", 0), ("inf", 0), ("", 0), (None, 0),
     ("1_000", 1000), (".5", 0), ("7.", 7), ("1e400", 0)],
)
def test_parse_int(spark, value, expected):
    assert one(spark, t.parse_int, value) == expected


def test_parse_bool(spark):
    assert [one(spark, t.parse_bool, v) for v in ["TRUE", "1", '"yes"', "no", None]] == [True] * 3 + [False] * 2


@pytest.mark.parametrize(
    "value, expected",
    [
        (None, False),
        ("null", False),
        ('{"description":null,"post_id":null}', False),
        ('{"a":"null"}', False),
        ('{"a":""}', False),
        ('{"a":{}}', False),
        ('{"a":[]}', False),
        ('{"a":{"b":1}}', True),
        ('{"a":0}', True),
        ('{"a":false}', True),
        ("[]", False),
        ("[null]", False),
        ('["x"]', True),
        ("false", True),
        ("0", True),
        ("some text", True),
    ],
)
def test_has_content(spark, value, expected):
    assert one(spark, t.has_content, value) is expected


def test_hash_is_the_head_of_sha256(spark):
    assert one(spark, t.hashed, "alice") == hashlib.sha256(b"alice").hexdigest()[:32]


COLUMNS = [
    "description", "id", "name", "user_posted", "date_posted", "followers", "following",
    "hashtags", "is_verified", "videos", "photos", "parent_post_details", "quoted_post",
]
HEADER = ",".join(COLUMNS) + "\n"


def export(*posts):
    """Rows of a CSV export; columns a post does not name are empty."""
    return "".join(",".join(p.get(c, "") for c in COLUMNS) + "\n" for p in posts)


def by_length(c):
    """Fake tokenizer: 100 + length of each word between two marks."""
    lengths = F.transform(F.split(c, " "), lambda w: F.length(w) + 100)
    return F.concat(F.array(F.lit(101)), lengths, F.array(F.lit(102)))


def frame(spark, *posts):
    schema = ", ".join(f"{c} string" for c in CSV_COLUMNS) + ", row_index long"
    return spark.createDataFrame(
        [tuple(p.get(c) for c in CSV_COLUMNS) + (i,) for i, p in enumerate(posts)], schema
    )


FULL = {
    "id": " 31-c ",
    "user_posted": "null",
    "name": "Mira K.",
    "description": "\tmoon over  snow\n",
    "date_posted": "2024-02-29 23:59:58.7+02:00",
    "hashtags": "tides, #dark sky,,",
    "followers": "12,045.9",
    "following": "-3",
    "is_verified": "YES",
    "external_url": '["https://example.com/a","",null]',
    "photos": "[]",
    "videos": '"clip.webm"',
    "quoted_post": '{"description":"","post_id":7}',
    "parent_post_details": '{"post_id":null}',
}


def test_full_row(spark):
    posts = ingest.adapt_posts(frame(spark, FULL), by_length, NOW)
    cols = posts.select(ingest.feature_line(posts)).first()[0].split("\t")
    assert dict(zip(FEATURE_COLUMNS, cols, strict=True)) == {
        "text_tokens": "\x01".join(["101", "104", "104", "100", "104", "102"]),
        "hashtags": "tides\x01dark sky",
        "tweet_id": "31-c",
        "present_media": "Video",
        "present_links": "https://example.com/a",
        "present_domains": "",
        "tweet_type": "Quote",
        "language": "und",
        "tweet_timestamp": "1709243998",
        "engaged_with_user_id": hashlib.sha256(b"Mira K.").hexdigest()[:32],
        "engaged_with_user_follower_count": "12045",
        "engaged_with_user_following_count": "-3",
        "engaged_with_user_is_verified": "true",
        "engaged_with_user_account_creation": "0",
        "engaging_user_id": "sample-reader",
        "engaging_user_follower_count": "0",
        "engaging_user_following_count": "0",
        "engaging_user_is_verified": "false",
        "engaging_user_account_creation": "0",
        "engagee_follows_engager": "false",
    }


def test_fallbacks(spark):
    posts = [
        {"description": " "},
        {"id": "null", "description": "hello you", "name": "Bob", "quoted_post": '{"description":null}'},
        {"id": "3", "description": "x", "parent_post_details": '{"post_id":"9"}', "quoted_post": "q"},
        {"id": "4", "description": "x", "quoted_post": "q"},
    ]
    got = ingest.adapt_posts(frame(spark, *posts), by_length, NOW).orderBy("row_index").collect()
    assert [r.row_index for r in got] == [1, 2, 3]
    assert got[0].tweet_id == hashlib.sha256(b"brightdata-row-1-hello you").hexdigest()[:32]
    assert got[0].engaged_with_user_id == hashlib.sha256(b"Bob").hexdigest()[:32]
    assert got[1].engaged_with_user_id == hashlib.sha256(b"unknown").hexdigest()[:32]
    assert [r.tweet_type for r in got] == ["TopLevel", "Reply", "Quote"]
    assert got[0].tweet_timestamp == NOW


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_offset_and_limit(spark, tmp_path):
    texts = ["first", " ", "third", "fourth"]
    body = export(*[{"id": str(i), "description": d} for i, d in enumerate(texts, 1)])
    path = write(tmp_path / "posts.csv", "\ufeff" + HEADER + body)
    run = lambda **k: [r[0] for r in rows(
        ingest.ingest_csv(files.read_posts_csv(spark, path), by_length, NOW, **k), "key")]
    assert run() == ["1", "3", "4"]
    # The blank second row is skipped and does not count against the limit.
    assert run(offset=1, limit=1) == ["3"]
    assert run(offset=3) == ["4"]
    assert run(limit=2) == ["1", "3"]


def test_csv_quoting(spark, tmp_path):
    post = {"description": '"two\nlines, ""quoted"""', "hashtags": '"[""a"",""b""]"', "id": "7"}
    row = files.read_posts_csv(spark, write(tmp_path / "q.csv", HEADER + export(post))).first()
    assert row.description == 'two\nlines, "quoted"'
    assert row.hashtags == '["a","b"]'
    assert (row.id, row.external_url) == ("7", None)


def test_files_with_their_own_headers(spark, tmp_path):
    write(tmp_path / "a.csv", "id,description\n1,one\n")
    write(tmp_path / "b.csv", "description,id\ntwo,2\n")
    write(tmp_path / "c.csv", "id,photos,description\n3,p,three\n4,,four\n")
    write(tmp_path / "d.csv", "")
    read = files.read_posts_csv(spark, str(tmp_path))
    expected = [("1", "one", None), ("2", "two", None), ("3", "three", "p"), ("4", "four", None)]
    assert rows(read, "id", "description", "photos") == expected
    numbered = with_row_index(read)
    assert rows(numbered, "row_index", "id") == [(0, "1"), (1, "2"), (2, "3"), (3, "4")]


def test_feature_lines(spark, tmp_path):
    good = lambda i: "\t".join(["5", "", f"id{i}"] + [""] * 17)
    path = write(tmp_path / "lines.tsv", "\n".join([good(0), "", "a\tb", good(1), good(2), ""]))
    assert [r[0] for r in rows(files.read_feature_lines(spark, path), "key")] == ["id0", "id1", "id2"]
    assert [r[0] for r in rows(files.read_feature_lines(spark, path, offset=1, limit=1), "key")] == ["id1"]


def test_row_numbers_over_many_files(spark, tmp_path):
    for f in range(5):
        write(tmp_path / f"part-{f}.txt", "".join(f"{f * 100 + i:04d}\n" for i in range(50 - f)))
    tagged = with_file_position(spark.read.text(str(tmp_path)))
    values = sorted(r.value for r in tagged.collect())
    assert rows(with_row_index(tagged), "row_index", "value") == sorted(enumerate(values), key=repr)
    for n in (1, 50, 77, 240, 999):
        assert [r.value for r in first_rows(tagged, n).orderBy("value").collect()] == values[:n]


def test_vocab_ids_are_line_numbers(spark, tmp_path):
    path = write(tmp_path / "vocab.txt", "[UNK]\nmoon\n##berg\n\n")
    assert rows(files.read_vocab(spark, path)) == [(0, "[UNK]"), (1, "moon"), (2, "##berg"), (3, "")]


def test_encode_is_greedy_and_cased(spark):
    tokens = "[PAD] [UNK] [CLS] [SEP] [MASK] un ##aff ##able ##a una , Hi".split()
    df = spark.createDataFrame([("unaffable, Hi",), ("una zzz",), ("",), (None,)], "t string")
    encode = wordpiece.encoder(spark, tokens)
    got = [r[0] for r in df.select(encode(F.col("t"))).collect()]
    # "una" is longer than "un"; what remains of "unaffable" has no piece, so all of it is unknown.
    assert got == [[2, 1, 10, 11, 3], [2, 9, 1, 3], [2, 3], None]
    longest = wordpiece.encoder(spark, "[PAD] [UNK] [CLS] [SEP] [MASK] un ##aff ##able".split())
    assert one(spark, longest, "unaffable") == [2, 5, 6, 7, 3]


def test_encode_truncates_with_both_marks(spark):
    encode = wordpiece.encoder(spark, "[PAD] [UNK] [CLS] [SEP] [MASK] a".split(), max_length=128)
    ids = one(spark, encode, "a " * 500)
    assert len(ids) == 128 and ids[0] == 2 and ids[-1] == 3


class Recorder:
    """Encodes a text to its letters' codes, and notes how much it gets at a time."""

    def __init__(self):
        self.calls = []

    def encode_batch(self, texts, add_special_tokens):
        self.calls.append(sum(len(t.encode()) for t in texts))
        return [SimpleNamespace(ids=[ord(c) for c in t]) for t in texts]


def test_texts_and_ids_are_handled_in_bounded_steps(monkeypatch):
    monkeypatch.setattr(wordpiece, "STEP_BYTES", 10)
    monkeypatch.setattr(wordpiece, "STEP_IDS", 10)
    texts = ["abc", None, "", "x" * 25, "éé", "abcd", "ab", "abc"] * 20
    model = Recorder()
    parts = list(wordpiece._encode_all(model, pa.array(texts), True))
    ids = pa.chunked_array(parts).combine_chunks()
    assert ids.to_pylist() == [None if t is None else [ord(c) for c in t] for t in texts]
    # A long text goes alone; everything else in steps of ten bytes.
    assert {n for n in model.calls if n > 10} == {25} and len(model.calls) < len(texts)
    decode = wordpiece._Pieces([chr(i) for i in range(256)])
    steps = list(decode.decode_all(ids))
    assert [t for s in steps for t in s.to_pylist()] == decode.decode(ids).to_pylist()
    assert max(len(s) for s in steps) < len(texts) // 2 and sum(map(len, steps)) == len(texts)


@pytest.mark.parametrize("most", [None, 9, 40])
@pytest.mark.parametrize("special", [True, False])
def test_a_long_text_is_encoded_in_pieces(monkeypatch, most, special):
    tokens = "[PAD] [UNK] [CLS] [SEP] [MASK] moon snow ##berg ##s old , \u4e16 a ##a".split()
    model = wordpiece._tokenizer(tokens, most)
    texts = ["old moon, snowbergs  \u4e16\n snow" * 9, "a" * 150 + " moon", " " * 60, "moon", None, "x" * 60, "old\tmoon \x00" * 20]
    whole = [None if t is None else model.encode(t, add_special_tokens=special).ids for t in texts]
    monkeypatch.setattr(wordpiece, "STEP_BYTES", 20)
    calls = []
    pieces = wordpiece._pieces_of
    monkeypatch.setattr(wordpiece, "_pieces_of", lambda t: (calls.append(len(p)) or p for p in pieces(t)))
    got = pa.chunked_array(list(wordpiece._encode_all(model, pa.array(texts), special))).to_pylist()
    assert got == whole
    assert "".join(pieces(texts[0])) == texts[0] and calls.count(150) == 1 and sorted(calls)[-3] <= 20


def test_encode_then_decode(spark, toy_vocab):
    tokens = wordpiece.shared_vocab(toy_vocab)
    encode, decode = wordpiece.encoder(spark, tokens), wordpiece.decoder(spark, tokens)
    assert one(spark, lambda c: decode(encode(c)), "old moon over snowberges") == "old moon over snowberges"
    assert json.dumps(one(spark, encode, "snowberg moon")) == "[2, 7, 5, 8, 3]"


def test_web_files_are_copied_to_the_shared_folder(spark, tmp_path):
    path = write(tmp_path / "posts.csv", HEADER + export({"id": "1", "description": "first"}))
    copied = files.local_copy(spark, f"file://{path}")
    assert copied != path
    assert rows(files.read_posts_csv(spark, copied), "id", "description") == [("1", "first")]


def test_limit_adapts_no_more_rows_than_it_takes(spark, tmp_path):
    body = export(*[{"id": str(i), "description": " " if i % 5 else "x"} for i in range(100)])
    rows_ = files.read_posts_csv(spark, write(tmp_path / "posts.csv", HEADER + body))
    got = ingest.ingest_csv(rows_, by_length, NOW, offset=3, limit=4)
    assert [r[0] for r in rows(got, "key")] == ["10", "15", "20", "5"]
    assert ingest.ingest_csv(rows_, by_length, NOW, offset=3, limit=500).count() == 19
