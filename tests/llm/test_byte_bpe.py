import base64
import hashlib
import random
import time

import duckdb
import public_tokenizers
import pytest
import tiktoken

from quillsieve.llm import byte_bpe


@pytest.fixture(scope="module")
def tok():
    return byte_bpe.Tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def truth(tok):
    return tiktoken.Encoding("own", pat_str=tok.pattern, mergeable_ranks=tok.ranks, special_tokens={})


TEXTS = ["", " ", "hello  world", "aaaa" * 40, "-" * 300, "x" + " " * 200 + "y", "naïve façade 👩‍👩‍👧 中文字符", "\x00\x01", "it's we'll", "word " * 3000, "Donaudampfschifffahrtsgesellschaftskapitän" * 5, "<|endoftext|>"]


def test_same_ids_as_the_library(spark, tok, truth):
    rng = random.Random(7)
    texts = TEXTS + ["".join(rng.choice("abcdeABC é中-=. ") for _ in range(rng.randrange(400))) for _ in range(60)]
    texts += ["".join(rng.choice("abe") for _ in range(n)) for n in (65, 90, 400, 1500)] + ["ab" * 700, "=" * 2000, "hahaha" * 100]
    df = spark.createDataFrame([*enumerate(texts), (None, None)], "doc_id long, text string")
    rows = byte_bpe.decode(byte_bpe.encode(df, tok), tok).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        want = truth.encode_ordinary(r.text or "")
        assert r.ids == want and r.n_tokens == len(want), r.text[:50]
        assert bytes(r.decoded) == (r.text or "").encode()


def test_all_ways_give_the_same_ids(tok, truth):
    """Pieces on both sides of the bounds, of unlike letters and of tokens that start or end tokens of lower rank."""
    rng = random.Random(11)
    letters, parts = "abcdefghijklmnopqrstuvwxyz", ["the", " the", "th", "ing", "to", "of", "ation", "e"]
    session = tok.session()
    for n in (3, 30, 64, 65, 200, byte_bpe.WALK_BYTES, byte_bpe.WALK_BYTES + 1, 1700):
        pieces = ["".join(rng.choice(letters) for _ in range(n)), "".join(rng.choice(parts) for _ in range(n))[:n].replace(" ", "q"), "ha" * (n // 2), "สวัสดี" * n]
        for p in (x[:n] for x in pieces):
            raw = p.encode()
            want = b"".join(i.to_bytes(4, "little") for i in truth.encode_ordinary(p))
            if session.find(p) != [p]:
                continue
            assert session.walked(raw) == want
            assert raw in tok.ranks or session._contracted([raw, raw[:3]])[0] == want
            assert session.encode([p]) == [want]


def test_a_word_of_200_000_letters(tok, truth, tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)) for n in (200_000, *[400] * 300, *[60] * 3000)]
    began = time.monotonic()
    got = tok.session().encode([" ".join(words)])
    assert time.monotonic() - began < 120
    assert got == [b"".join(i.to_bytes(4, "little") for i in truth.encode_ordinary(" ".join(words)))]
    assert not [*tmp_path.iterdir()]  # nothing is spilled beside the process


def test_clashing_columns_and_empty_table(spark, tok):
    df = spark.createDataFrame([("a b", "old", 1), ("a b", "old", 1)], "text string, ids string, W int")
    out = byte_bpe.encode(df, tok, packed=True)
    assert out.columns == ["text", "W", "n_tokens", "ids"] and out.count() == 2
    assert byte_bpe.decode(byte_bpe.encode(df.limit(0), tok), tok).count() == 0


def test_query(spark, tok, truth):
    d = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = byte_bpe.op3_byte_bpe(spark, d).collect()
    assert len(rows) == len(text)
    for r in rows:
        ids = truth.encode_ordinary(text[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_rank_file_needs_all_bytes(tmp_path):
    (tmp_path / "r").write_bytes(base64.b64encode(b"a") + b" 0\n")
    with pytest.raises(ValueError):
        byte_bpe.Tokenizer(str(tmp_path / "r"), r"\w+")


def test_query_against_sql_and_on_odd_rows(spark, odd_documents, folder):
    made = [t for t in TEXTS if t] + ["a  b \n\n c", "\t\tx", "  ", "x\u00a0\u2003y  ", " 12  34 !? \n", "it's  'll 're", "th the  thee", "\x1c\x85 z"]
    docs = odd_documents.unionByName(spark.createDataFrame([(100 + i, t, "en", "s", 1) for i, t in enumerate(made)], odd_documents.schema))
    d = folder(documents=docs)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet/*.parquet'")
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))
    got = order(tuple(r[c] for c in names) for r in byte_bpe.op3_byte_bpe(spark, d).collect())
    assert got == order(con.execute(f"SELECT {', '.join(names)} FROM ({byte_bpe.op3_sql(public_tokenizers.path('byte_bpe_50k.tiktoken'))})").fetchall())
