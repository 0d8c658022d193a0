"""Secrets against every rule on every text."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa

from plumefeed.llm import secret_scan as ss
from plumefeed.llm.textops import as_text

# The base patterns as they are asked for; a match that fails its length is dropped.
BASE = {
    "assign": (
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda m: len(m[1]) >= 6,
    ),
    "access": ("AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    "hex": ("[0-9a-f]+", lambda m: len(m[0]) >= 24),
}


def base_spans(text):
    out = []
    for k, (kind, (pattern, good)) in enumerate(BASE.items()):
        out += [(m.start(), k, kind, m.end()) for m in re.finditer(pattern, text, re.ASCII) if good(m)]
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


def check(df, texts):
    rows = {r.doc_id: r for r in ss.digest(ss.find_secrets(df)).collect()}
    kinds = list(BASE)
    for i, text in texts.items():
        spans = base_spans(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        r = rows[i]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[0] == k for s in spans) for k in kinds]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s.split(":")[0] in kinds] == [s for s in joined.split(",") if s] or not (r.spans or joined)


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check(docs, {r.doc_id: r.text or "" for r in docs.collect()})


def test_awkward_texts(documents):
    hexes = "0123456789abcdef" * 3
    texts = [
        f"ñ😀 PASSWORD = '{hexes}' tail", "token=abc token=abcdef", "secret=token\"=abcdefgh",
        "AKIA" + "Z" * 15, "AKIA" + "Z" * 16, "xAKIAKIA" + "B" * 30, hexes[:23], hexes[:24] + "g" + hexes,
        "api_key:aaaaaa apikey : \"bbbbbb\" Api_Key=c.c.c.c", "toKen=abcdef", "ſecret=abcdef",
        "password\n=abcdef", "xoxb-1234567890-abcdef", "ghp_" + "a1B2" * 9, "AIza" + "x" * 35,
        "sk_live_" + "9" * 20, "-----BEGIN RSA PRIVATE KEY-----", "eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl",
        "secret=secret=secret=abc",
    ]
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    check(documents(rows), dict(enumerate(texts)))
    found = {r.doc_id: {s["kind"] for s in r.secrets} for r in ss.find_secrets(documents(rows)).collect()}
    assert found[12] == {"slack"} and found[13] == {"github"} and found[14] == {"google"}
    assert found[15] == {"stripe"} and found[16] == {"private_key"} and found[17] == {"jwt"}
    assert found[9] == found[10] == set()


def test_trigram_queries_lose_nothing():
    rng = random.Random(8)
    seeds = ["password=", "Api_Key: ", "AKIA" + "Q" * 17, "xoxp-", "ghp_", "eyJ", ".", "-----BEGIN ", "PRIVATE KEY-----"]
    texts = ["".join(rng.choice([*seeds, "abcdef123456", " ", "Z9"]) for _ in range(rng.randrange(12))) for _ in range(2000)]
    wanted = np.zeros(1 << 24, bool)
    queries = [ss.trigram_query(r) for r in ss.RULES]
    for q in queries:
        wanted[[ss._number(t) for t in ss._trigrams(q)]] = True
    index = ss.TrigramIndex(as_text(pa.array(texts)), wanted)
    for rule, query in zip(ss.RULES, queries):
        rows = set(index.rows(query).tolist())
        assert rows >= {i for i, t in enumerate(texts) if rule.compiled().search(t)}
    assert ss.trigram_query(ss.BASE[2]) is True
    assert ss.trigram_query(ss.BASE[1]) == ("and", (b"aki", b"kia"))


def test_odd_rows_and_redaction(odd, odd_rows, nothing, documents):
    assert ss.find_secrets(odd).count() == len(odd_rows)
    assert ss.find_secrets(nothing).collect() == ss.redact(nothing).collect() == []
    assert ss.redact(odd).columns == odd.columns
    same = sorted((str(tuple(r)) for r in odd.collect()))
    assert sorted(str(tuple(r)) for r in ss.redact(odd).collect()) == same
    secret = "é token=0123456789abcdef0123456789 and AKIA" + "A" * 16 + "."
    changed = ss.redact(documents([(1, secret, "en"), (2, "clean", "en")])).collect()
    texts = {r.doc_id: (r.text, r.n_chars) for r in changed}
    assert texts[1] == ("é [SECRET] and [SECRET].", 24) and texts[2] == ("clean", 5)
