import hashlib
import random
import re

import pytest

from quillsieve.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end(), "email") for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end(), "ip") for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end(), "card") for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, m.end(), "phone") for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(out)


def digest(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(spark)


TEXTS = [
    None, "", "a@b.c%d@e.f", "x@y.z@w.v a@b", "é😀 joe.bloggs+x@mail.example.com.", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0255", "4111 1111 1111 1111 and 4111111111111112", "+49 (0)30 1234-5678 +1 2", "+1.....2 +123456789012345678",
    "a" * 3000 + "@" + "b." * 500, "1 " * 3000, "+" + "-" * 3000, "0" * 5000, "9.9.9.9" * 50, "9.8.7.6 " * 8000, "5 - 5", "٣٣٣ 4-1-1-1 1111-1111-1111-1",
]


def test_base_spans_match_brute_force(spark, model):
    rng = random.Random(11)
    pieces = ["a", "b.c", "@", ".", "%", "12", "255", "3", " ", "-", "+", "(", ")", "4111111111111111", "é", "😀", "+4930123456", "x@y.z", "\n", "7.7.7.7"]
    texts = TEXTS + ["".join(rng.choice(pieces) for _ in range(rng.randrange(40))) for _ in range(400)]
    df = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    for r in pii.scan(df, model).collect():
        assert [(s["start"], s["rank"], s["end"], s["kind"]) for s in r.personal if s["rank"] < 4] == base(r.text or ""), r.text
        for s in r.personal:
            assert (r.text or "")[s["start"] : s["end"]] == s["token"]


def test_trees_add_spans_and_spare_others(spark, model):
    made = pii.snippets(1500, seed=99)
    df = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(made)], "i int, text string, label int")
    rows = pii.scan(df, model).collect()
    added = {1: 0, 0: 0}
    for r in rows:
        added[r.label] += any(s["rank"] == 4 for s in r.personal)
    assert added[1] > 0.8 * 750 and added[0] < 0.02 * 750, added


def test_clashing_columns_and_empty_table(spark, model):
    df = spark.createDataFrame([("mail joe@x.org", 1, 2), ("mail joe@x.org", 1, 2)], "text string, personal int, start int")
    rows = pii.scan(df, model).collect()
    assert [digest([(s["start"], 0, s["end"], s["kind"]) for s in r.personal]) for r in rows] == ["email:5:14"] * 2
    assert pii.scan(df.limit(0), model).count() == 0


def test_query(spark):
    d = "/root/testdata/sf0.01"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = pii.op6_pii(spark, d).collect()
    assert len(rows) == len(text)
    for r in rows:
        want = base(text[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in want) for k in range(4)]
        assert r.base_sha256 == hashlib.sha256(digest(want).encode()).hexdigest()
        assert all(x in r.spans.split(",") for x in digest(want).split(",") if x)


def test_ip_parts_may_be_zero(spark, model):
    rng = random.Random(12)
    parts = ["0", "00", "000", "0000", "00255", "0256", "10", "100", "255", "256", "1", "99"]
    texts = ["0.0.0.0", "10.0.0.1", "192.168.0.1", "255.255.255.0", "0.0.0.00", "000.0.0.256"] + [".".join(rng.choice(parts) for _ in range(rng.randrange(3, 9))) for _ in range(200)]
    df = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    for r in pii.scan(df, model).collect():
        assert [(s["start"], s["rank"], s["end"], s["kind"]) for s in r.personal if s["rank"] < 4] == base(r.text), r.text


def test_prefilters_pass_every_candidate(spark, model):
    rng = random.Random(13)
    pieces = ["jane", "ab", "x1", "@", " ", " at ", "(at)", "[AT]", ".", " dot ", "(dot)", "[Dot]", "com", "12", "3-4", "(555)", "DE44", "5001", "a1:", "B2:", "ff", "é"]
    texts = ["jane at example.com", "jane@example[dot]com", "jane at example[dot]com", "jane @ example . com"] + ["".join(rng.choice(pieces) for _ in range(rng.randrange(3, 30))) for _ in range(3000)]
    texts += ["".join(rng.choice(["a1:", "B2:", "f:", "0", " "]) for _ in range(12)) for _ in range(500)]
    df = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    for i, (kind, pattern, needed) in enumerate(pii.GENERATORS):
        matched = df.where(pii.F.col("text").rlike(pattern))
        assert matched.count() > 2 and matched.where(~pii.F.col("text").rlike(needed)).count() == 0, kind
        if kind == "email_like":
            made = df.where("doc_id < 4").select(pii.F.size(pii._made(pii.F.col("text"), i, pattern, needed)).alias("n")).collect()
            assert all(r.n == 1 for r in made), made
    found = pii.scan(df.where("doc_id IN (1, 2)"), model).collect()
    assert all([s["token"] for s in r.personal] == [r.text] for r in found), found


PERSONAL = [  # written otherwise than the snippets that the trees learn from
    lambda d: f"You can ring me on mobile 0{d(3)} {d(3)} {d(4)} any time", lambda d: f"Fax ({d(3)}) {d(3)} {d(4)}", lambda d: f"my social security number is {d(3)}-{d(2)}-{d(4)}, she said",
    lambda d: f"IBAN: GB{d(2)} {d(4)} {d(4)} {d(4)} {d(4)} {d(2)}", lambda d: f"pay into account FR{d(22)}", lambda d: f"reach Ann under ann{d(2)} at mailbox dot org", lambda d: f"or mail to bob.k{d(1)} [at] example [dot] net please",
    lambda d: f"device 00:1b:{d(2)}:{d(2)}:a{d(1)}:{d(2)} was seen", lambda d: f"passport no {d(9)} was lost", lambda d: f"call {d(3)}.{d(3)}.{d(4)} now",
]
OTHERS = [
    lambda d: f"order 4{d(8)} was sent", lambda d: f"on 20{d(2)}-0{rng_month(d)}-1{d(1)} it rained", lambda d: f"ISBN 978-{d(1)}-{d(3)}-{d(5)}-{d(1)}", lambda d: f"version {d(1)}.{d(2)}.{d(5)} is out", lambda d: f"it cost about {d(4)}.{d(5)}",
    lambda d: f"see pages {d(2)} {d(2)} {d(3)} {d(3)}", lambda d: f"ticket {d(10)} is open", lambda d: f"hash {d(4)}:{d(4)}:{d(4)}:{d(4)}:{d(4)}:{d(4)}",
]


def rng_month(d):
    return str(int(d(1)) % 9 + 1)


def test_planted_spans_in_documents(spark, model):
    """Precision and recall of the added spans over real documents, into each of which one phrase is planted."""
    rng = random.Random(21)
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) > 50").orderBy("doc_id").collect()]
    rows, kinds = [], {}
    for i, text in enumerate(docs):
        personal = i % 2
        phrase = rng.choice(PERSONAL if personal else OTHERS)(d)
        cut = text.find(" ", rng.randrange(len(text)))
        cut = len(text) if cut < 0 else cut
        rows.append((i, f"{text[:cut]} {phrase} {text[cut:]}"))
        kinds[i] = (personal, cut + 1, cut + 1 + len(phrase))
    hit = [0, 0]
    for r in pii.scan(spark.createDataFrame(rows, "doc_id long, text string"), model).collect():
        personal, a, b = kinds[r.doc_id]
        hit[personal] += any(s["rank"] == 4 and s["start"] < b and s["end"] > a for s in r.personal)
    total = [sum(p == k for p, _, _ in kinds.values()) for k in (0, 1)]
    recall, precision = hit[1] / total[1], hit[1] / (hit[0] + hit[1])
    print(f"planted in {len(docs)} documents: recall {recall:.3f}, precision {precision:.3f}")
    assert recall > 0.8 and precision > 0.9
