import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillsieve.llm import toxicity as X

from .conftest import DOCS


def test_lookup_finds_all_and_nothing_else():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**60, 50_000))
    values = rng.normal(size=len(keys)).astype(np.float32)
    table = X.Lookup(keys, values)
    got, missing = table.get(keys)
    assert (got == values).all() and not len(missing)
    other = np.setdiff1d(rng.integers(0, 2**60, 1000), keys)
    got, missing = table.get(other)
    assert len(missing) == len(other) and not got.any()


def packed(text):
    """The 6-gram of a word's prefix, as the model packs it."""
    codes = ([1] + [ord(c) for c in text])[-6:]
    return sum(c << (10 * i) for i, c in enumerate(reversed(codes)))


def test_grams_stop_at_word_starts():
    keys, sizes = X._grams(["ab cdefgh"])
    got = dict(zip(range(9), keys.tolist(), strict=True))
    assert sizes.tolist() == [9] and got[0] == packed("a") and got[1] == packed("ab") and got[3] == packed("c")
    assert got[8] == sum(ord(c) << (10 * i) for i, c in enumerate("hgfedc"))


def test_backoff_is_a_distribution():
    """Over the characters that follow a context, the shared probabilities and what is left for others make 1."""
    words = ["hello", "help", "held", "shell", "yell", "yes", "he"] * 3
    keys, _ = X._grams(words)
    types, times = np.unique(keys, return_counts=True)
    low_types, low = X._continuation(types, times.astype(float))
    assert (low > 0).all() and (low <= 1).all()
    context = low_types >> np.int64(10)
    for c in np.unique(context):
        assert low[context == c].sum() <= 1 + 1e-9


def test_log_ratios_favour_the_class_that_says_it():
    keys, _ = X._grams(["badword", "goodword"])
    types = np.unique(keys)
    bad = np.isin(types, X._grams(["badword"])[0]) * 5.0
    good = np.isin(types, X._grams(["goodword"])[0]) * 5.0
    model = X.kneser_ney(types, np.stack([bad, good]))
    f = model.features(["badword", "goodword", "other"])
    assert f[0, 0] > 0.1 and f[1, 0] < -0.1 and abs(f[2, 0]) < f[0, 0]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    syllables = ["ba", "ko", "ri", "tun", "mel", "sa", "vo", "lin"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    rows, labels = [], []
    for i in range(900):
        words = [word() for _ in range(rng.randrange(20, 80))]
        toxic = int(i % 5 == 0)
        for _ in range(toxic * 3):
            words[rng.randrange(len(words))] = "grumpf" + rng.choice(syllables)
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, toxic))
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_on_new_forms(spark, corpus, folder):
    docs, labels = corpus
    rows = X.op1_toxicity(spark, folder(documents=docs, labels=labels)).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out]
    wrong = sum(r.predicted != (r.doc_id % 5 == 0) for r in held)
    assert wrong <= 0.03 * len(held), (wrong, len(held))


def test_odd_rows(spark, corpus, odd_documents):
    docs, labels = corpus
    more = spark.createDataFrame([(None, 1, 1), (0, 1, None), (0, 1, 1), (99999, 1, 1)], "doc_id long, quality int, toxic int")
    model = X.fit(docs, labels.union(more), F.lit(True))
    out = X.score(odd_documents.withColumn("Score", F.lit("x")).withColumn("row", F.lit(1)), model)
    rows = out.collect()
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "row", "score", "predicted"]
    assert len(rows) == 9 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    same = [r.score for r in rows if r.doc_id in (4, 5)]
    assert len(set(same)) == 1 and len({r.score for r in rows if r.doc_id in (None, 1, 6)}) == 1
    assert X.score(odd_documents.limit(0), model).count() == 0


def test_one_class_or_no_labels(spark, corpus, odd_documents, folder):
    docs, labels = corpus
    only = X.fit(docs, labels.where("toxic = 0"), F.lit(True))
    assert only == 0.0 and X.fit(docs, labels.limit(0), F.lit(True)) == 0.0
    rows = X.op1_toxicity(spark, folder(documents=odd_documents, labels=labels.limit(0))).collect()
    assert len(rows) == 9 and all(r.score == 0 and r.predicted == 0 for r in rows)


def test_calibration_sees_every_held_row_at_its_own_share(spark, corpus, monkeypatch):
    """A cap on the rows of a class, which once was there, would change the classes' shares."""
    docs, labels = corpus
    seen = []
    monkeypatch.setattr(X, "SAMPLE", 100, raising=False)
    monkeypatch.setattr(X, "_calibrated", lambda model, features, label, f=X._calibrated: seen.append(label) or f(model, features, label))
    X.fit(docs, labels, F.lit(True))
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) // 3 % X.HELD == 0]
    assert len(seen[0]) == len(held) and seen[0].sum() == sum(i % 5 == 0 for i in held)


def test_rare_grams_stay_in_the_model(spark, corpus, monkeypatch):
    """A bound on the grams, which once was there, would drop those seen once first."""
    docs, labels = corpus
    monkeypatch.setattr(X, "MOST_GRAMS", 100, raising=False)
    model = X.fit(docs, labels, F.lit(True))
    keys = np.unique(X._grams([r.text for r in docs.collect()])[0])
    assert len(keys) > 1000 and not len(model.seen.get(keys)[1]) and not len(model.novel.get(np.unique(keys >> np.int64(10)))[1])


def test_every_window_counts():
    """The highest windows, by brute force, with the expression at every place of the text and at its end."""
    words = ["grumpfis", "balinko", "tunmela", "sako"]
    types = np.unique(X._grams(words)[0])
    bad = np.isin(types, X._grams(words[:1])[0]) * 5.0
    model = X.kneser_ney(types, np.stack([bad, 5.0 - bad]))
    texts = ["x" * i + " grumpfis" + " sako" * j for i in range(9, 20) for j in range(4)]
    for text, got in zip(texts, model.features(texts), strict=True):
        keys, _ = X._grams([text])
        ratio, missing = model.seen.get(keys)
        ratio[missing] = model.novel.get(keys[missing] >> np.int64(10))[0]
        windows = sorted(ratio[i : i + 16].sum() / 16 for i in range(len(text) - 15))
        assert abs(got[1] - windows[-1]) < 1e-5 and abs(got[2] - np.mean(windows[-8:])) < 1e-5, text


def test_model_against_plain_loops():
    """Counts, shared backoff, both class models, windows and features by dictionaries over tuples of codes."""
    rng = random.Random(4)
    parts = ["ba", "ko", "ri", "t", "e", " ", " ", "-", "é", "9"]
    made = lambda n: "".join(rng.choice(parts) for _ in range(n))
    classes = [[made(60) for _ in range(6)], [made(60) for _ in range(9)]]
    code = lambda ch: (ord(ch) if ch.isalnum() else 1)

    def grams(text):
        flat, out = [1] * 6 + [code(c) for c in text], []
        for i in range(6, len(flat)):
            gram = [flat[i]]
            while len(gram) < 6 and (len(gram) == 1 or gram[0] != 1):
                gram.insert(0, flat[i - len(gram)])
            out.append((0,) * (6 - len(gram)) + tuple(gram))
        return out

    def discounted(counts):
        once, twice = sum(v == 1 for v in counts.values()), sum(v == 2 for v in counts.values())
        return once / (once + 2 * twice) if once and twice else 0.5

    own = []
    for texts in classes:
        own.append({})
        for g in (g for t in texts for g in grams(t)):
            own[-1][g] = own[-1].get(g, 0) + 1
    both = {g: own[0].get(g, 0) + own[1].get(g, 0) for g in {*own[0], *own[1]}}
    below, upper = {}, both
    levels = []
    for n in range(5, 0, -1):
        occurs, before = {}, {}
        for g, v in upper.items():
            occurs[g[1:]] = occurs.get(g[1:], 0) + v
            before[g[1:]] = before.get(g[1:], 0) + 1
        levels.append({g: occurs[g] if g[0] <= 1 else before[g] for g in occurs})
        upper = occurs
    for level in reversed(levels):
        cut, total, kinds = discounted(level), {}, {}
        for g, v in level.items():
            total[g[:-1]], kinds[g[:-1]] = total.get(g[:-1], 0) + v, kinds.get(g[:-1], 0) + 1
        below = {g: (v - cut) / total[g[:-1]] + cut * kinds[g[:-1]] / total[g[:-1]] * (below[g[1:]] if below else 1 / 1024) for g, v in level.items()}

    def ratio(gram):
        logs = []
        for counts in own:
            cut, total = discounted(counts), sum(v for g, v in counts.items() if g[:-1] == gram[:-1])
            rest = cut * sum(g[:-1] == gram[:-1] for g in counts) / total if total else 1.0
            if gram in both:
                logs.append(np.log((max(counts.get(gram, 0) - cut, 0) / total if total else 0) + rest * below[gram[1:]]))
            else:
                logs.append(np.log(rest))
        return logs[0] - logs[1]

    pack = lambda g: sum(c << (10 * i) for i, c in enumerate(reversed(g)))
    keys = np.array(sorted(map(pack, both)))
    by_key = {pack(g): g for g in both}
    model = X.kneser_ney(keys, np.array([[c.get(by_key[k], 0) for k in keys.tolist()] for c in own], dtype=float))
    texts = [made(40), classes[0][0], classes[1][2], "ba", "qqq zzz", "", made(3)]
    got = model.features(texts)
    for text, row in zip(texts, got, strict=True):
        r = [ratio(g) for g in grams(text)]
        if not r:
            assert not row.any()
            continue
        width = min(16, len(r))
        windows = sorted((sum(r[i : i + width]) / 16 for i in range(len(r) - width + 1)), reverse=True)
        want = [np.mean(r), windows[0], np.mean(windows[:8]), np.log1p(len(r))]
        assert np.allclose(row, want, atol=1e-4), text


def test_calibration_is_at_its_optimum():
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(300, 4)), (rng.random(300) < 0.3).astype(float)
    model = X._calibrated(X.Model(X.Lookup(np.zeros(0, np.int64), np.zeros(0, np.float32)), X.Lookup(np.zeros(0, np.int64), np.zeros(0, np.float32))), x, y)
    z = np.concatenate([np.ones((300, 1)), (x - x.mean(axis=0)) / x.std(axis=0)], axis=1)
    ridge = np.diag([1e-6, 0.1, 0.1, 0.1, 0.1])
    assert np.abs(z.T @ (model.scores(x) - y) + ridge @ model.weights).max() < 1e-4
