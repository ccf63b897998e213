import zlib

import numpy as np
from pyspark.sql import functions as F

from quillsieve.llm import language as L


def test_kernel_is_the_mean_cosine_of_presence_sets():
    texts = ["Hello there", "hello here", "zzz"]
    x = L.scaled(L.presence(texts))
    grams = lambda t, n: {(" " * 4 + t.lower())[i - n + 1 : i + 1] for i in range(4, 4 + len(t))}
    for i in range(3):
        for j in range(3):
            want = np.mean([len(grams(texts[i], n) & grams(texts[j], n)) / np.sqrt(len(grams(texts[i], n)) * len(grams(texts[j], n))) for n in range(1, 5)])
            assert abs(float(x[i] @ x[j]) - want) < 0.02


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = L.op5_language_id(spark, d).collect()
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_odd_rows(spark, odd_documents, folder):
    rows = {r.doc_id: r for r in L.op5_language_id(spark, folder(documents=odd_documents)).collect()}
    assert [rows[i].lang_pred for i in (None, 1, 2, 6)] == ["und"] * 4 and rows[1].score == 0
    assert rows[3].lang_pred in {"en", "fr", "de"} and not rows[None].held_out == (zlib.crc32(b"") % 5 != 0)


def test_nothing_to_learn_from(spark, odd_documents):
    none = L.fit(odd_documents.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert {r.lang_pred for r in L.predict(odd_documents, none).collect()} == {"und"}
    clash = odd_documents.withColumn("Score", F.lit(1)).withColumn("text_of_row", F.lit(""))
    assert L.predict(clash, L.fit(clash, F.lit(True))).columns == ["doc_id", "text", "lang", "source", "n_chars", "text_of_row", "lang_pred", "score"]
    assert L.predict(odd_documents.limit(0), none).count() == 0


def test_every_language_is_learned(spark, monkeypatch):
    """A bound on the languages, which once was there, would leave out those with the fewest rows."""
    monkeypatch.setattr(L, "MOST_LANGUAGES", 3, raising=False)
    rows = [(i * 10 + j, f"{chr(97 + i) * 3}{chr(98 + i) * 2} word{chr(97 + i)}", f"l{i}") for i in range(6) for j in range(6 - i)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.fit(docs, F.lit(True))
    assert model[0] == [f"l{i}" for i in range(6)]
    assert all(r.lang_pred == r.lang for r in L.predict(docs, model).collect())


def test_repeated_and_null_ids_leave_no_language_out(spark):
    """Thousands of rows under one id, or under none, hash alike by their ids: the texts tell them apart."""
    rows = [(7, f"bonjour le monde {i}", "fr") for i in range(1500)] + [(i, f"hello the world {i}", "en") for i in range(1500)]
    rows += [(None, f"hallo die welt {i}", "de") for i in range(1500)] + [(9, "ciao", "it")] * 1500
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = L.fit(docs, F.lit(True))
    assert model[0] == ["de", "en", "fr", "it"]
    sample = L._labelled(docs, F.lit(True), "doc_id", "text", "lang", 1.0).groupBy("lang").count().collect()
    assert {r.lang: r["count"] for r in sample} == {"de": L.SAMPLE, "en": L.SAMPLE, "fr": L.SAMPLE, "it": 1}
    again = L.fit(docs.repartition(2, "text"), F.lit(True))
    assert again[0] == model[0] and np.allclose(again[1], model[1])


def test_a_bound_that_is_too_low_is_raised(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"word{i} {lang}", lang) for i in range(3000) for lang in ("aa", "bb")], "doc_id long, text string, lang string")
    want, labelled, tried = L.fit(docs, F.lit(True)), L._labelled, []
    monkeypatch.setattr(L, "_labelled", lambda *a: (tried.append(a[-1]), labelled(*a[:-1], a[-1] * 0.2))[1])
    got = L.fit(docs, F.lit(True))
    assert tried == [1.0, 4.0, 16.0][: len(tried)] and len(tried) > 1 and np.allclose(got[1], want[1])


def test_what_a_letter_is(spark):
    texts = ["½", "²³ ¼", "Ⅷ ⅻ", "12 _ ।", "٣", "ª", "ʰ", "語", "ǅ"]  # number signs, letter numbers, digits; then letters
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    model = L.fit(docs, F.lit(True))
    out = {r.doc_id: (r.lang_pred, r.score) for r in L.predict(docs, model).collect()}
    assert [out[i] for i in range(5)] == [("und", 0.0)] * 5
    assert [out[i][0] for i in range(5, 9)] == ["en"] * 4


def test_prediction_against_ridge_in_the_landmarks_kernel(spark, monkeypatch):
    """The same regression solved in its other form: least squares over landmark weights under the landmarks' kernel."""
    monkeypatch.setattr(L, "SAMPLE", 12)
    monkeypatch.setattr(L, "LANDMARKS", 5)
    words = {"en": "the cat sat on that mat with hats", "fr": "le chat dort sur une natte grise", "de": "die katze liegt auf der matte dort"}
    rows = [(i, " ".join(w.split()[j % 7 :]) + f" {w.split()[(i * 3 + j) % 7]}", lang) for lang, w in words.items() for j in range(7) for i in (j, j + 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = sorted((r.lang, r.place, r.text) for r in L._labelled(docs, F.lit(True), "doc_id", "text", "lang", 1.0).collect())
    langs, matrix = L.fit(docs, F.lit(True))
    cells = lambda t: [set(np.nonzero(r)[0]) for r in np.split(L.presence([t])[0], np.cumsum(L.CELLS)[:-1])]
    kernel = lambda a, b: np.mean([len(x & y) / np.sqrt(len(x) * len(y)) if x and y else 0 for x, y in zip(cells(a), cells(b), strict=True)])
    marks = [t for _, place, t in sample if place <= 5]
    big = np.array([[kernel(t, m) for m in marks] for _, _, t in sample])
    small = np.array([[kernel(a, m) for m in marks] for a in marks])
    y = np.array([[1.0 if lang == k else -1.0 for k in langs] for lang, _, _ in sample])
    w = np.array([len(sample) / len(langs) / sum(x[0] == lang for x in sample) for lang, _, _ in sample])[:, None]
    alpha = np.linalg.lstsq(big.T @ (w * big) + L.RIDGE * len(sample) / 100 * small, big.T @ (w * y), rcond=None)[0]
    for text in ["the mat", "une natte", "der hut 7", "zzz", sample[0][2]]:
        want = np.array([kernel(text, m) for m in marks]) @ alpha
        assert np.allclose(L.scaled(L.presence([text]))[0] @ matrix, want, atol=2e-3)
        got = L.predict(spark.createDataFrame([(text,)], "text string"), (langs, matrix)).first()
        e = np.exp(L.SHARPNESS * (want - want.max()))
        assert got.lang_pred == langs[int(want.argmax())] and abs(got.score - e.max() / e.sum()) < 0.02
