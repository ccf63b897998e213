"""Language identification with a string kernel: blended spectrum, Nystroem landmarks, kernel ridge regression.

The kernel of two texts is the mean, over n-grams of one to four characters, of the cosine of their n-gram presence
sets (hashed to a fixed number of cells). Landmarks are labelled texts. With K the landmarks' kernel matrix, a text's
feature map is its kernel row times K^(-1/2), and one-versus-rest ridge regression on that map gives a margin for each
language. As the kernel is an inner product, the kernel row times the fitted weights is the text's presence row times
one fixed matrix, which batches of texts are multiplied with.

Learning takes every language that labels a row, of each at most ``SAMPLE`` different labelled rows (id and text),
``LANDMARKS`` of them as landmarks, those that hash lowest; rows that repeat count once, and null or repeated ids leave
no language out. They are held on the driver, whose memory has to grow with the languages. All texts are scored whole.

Defined cases: a letter is a character of a Unicode category L (so no digit, number sign or letter number). A text that
is null or has no letter gets ``und`` and score 0, as does every text if no row has a label. Repeated rows score alike.
A very long text is one presence row, as long as any other, made from the whole text. Ties go to the language that sorts
first. An empty table gives an empty result. Columns of the input named like an output column are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsieve.llm import chars
from quillsieve.llm.common import crc_fold, free_name, lowest_hashes, scratch, table

#: Labelled rows of a language that learning takes at most, and the landmarks among them.
SAMPLE, LANDMARKS = 400, 48
#: Cells of the presence sets by n, ridge, and the scale of the margins in the softmax that gives the score.
CELLS, RIDGE, SHARPNESS = (256, 4096, 8192, 8192), 0.05, 8.0
#: Texts in a presence matrix.
ROWS = 128


def _letter(text: str) -> bool:
    return any(map(str.isalpha, text))  # the categories Lu, Ll, Lt, Lm and Lo


def presence(texts: list[str]) -> np.ndarray:
    """A row of 0 and 1 for each text: which cells of each n its n-grams fall in."""
    out = np.zeros((len(texts), sum(CELLS)), dtype=bool)
    if not texts:
        return out
    code, starts, sizes = chars.codes(texts, len(CELLS))
    doc = np.repeat(np.arange(len(texts)), sizes)
    at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(doc))
    first = 0
    for n, cells in enumerate(CELLS, 1):
        key = chars.grams(code, n)[at].view(np.uint64)
        with np.errstate(over="ignore"):
            cell = (key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - (cells - 1).bit_length())
        out[doc, first + cell.astype(np.int64)] = True
        first += cells
    return out


def scaled(x: np.ndarray) -> np.ndarray:
    """Presence rows whose inner products are the kernel."""
    out = x.astype(np.float32)
    first = 0
    for cells in CELLS:
        part = out[:, first : first + cells]
        part /= np.sqrt(np.maximum(part.sum(axis=1, keepdims=True), 1) * len(CELLS))
        first += cells
    return out


def _labelled(df: DataFrame, learn: Column, id_col: str, text_col: str, lang_col: str, spare: float) -> DataFrame:
    rows = df.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"))
    return lowest_hashes(rows, "lang", F.xxhash64("id", "text"), SAMPLE, spare)


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for a, b in chars.slices(texts):
            part = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("place"), part.column("whole"), pa.array([r.tobytes() for r in np.packbits(presence(texts[a:b]), axis=1)], pa.binary())], names=["lang", "place", "whole", "bits"])


def fit(df: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages, and the matrix that takes scaled presence rows to their margins."""
    spare = 1.0
    while True:
        with scratch(df.sparkSession):
            sample = sorted(_labelled(df, learn, id_col, text_col, lang_col, spare).mapInArrow(_bits, "lang string, place int, whole boolean, bits binary").collect())
        got = Counter(r["lang"] for r in sample)
        if all(r["whole"] or got[r["lang"]] == SAMPLE for r in sample):
            break
        spare *= 4  # the bound of a language was too low for its sample, which is very unlikely
    langs = sorted({r["lang"] for r in sample})
    if not langs:
        return [], np.zeros((sum(CELLS), 0), dtype=np.float32)
    unpack = lambda rows: scaled(np.unpackbits(np.stack([np.frombuffer(r["bits"], np.uint8) for r in rows]), axis=1, count=sum(CELLS)))
    marks = unpack([r for r in sample if r["place"] <= LANDMARKS]).astype(np.float64)
    values, vectors = np.linalg.eigh(marks @ marks.T)
    good = values > 1e-8 * values.max()
    half = vectors[:, good] / np.sqrt(values[good])  # the kernel row of a text times this is its feature map
    maps = np.concatenate([unpack(sample[i : i + 1000]).astype(np.float64) @ marks.T @ half for i in range(0, len(sample), 1000)])
    target = np.array([[1.0 if r["lang"] == k else -1.0 for k in langs] for r in sample])
    weight = np.array([len(sample) / len(langs) / max(1, sum(r["lang"] == k for r in sample)) for k in langs])
    w = np.array([weight[langs.index(r["lang"])] for r in sample])[:, None]
    fitted = np.linalg.solve(maps.T @ (w * maps) + RIDGE * len(sample) / 100 * np.eye(maps.shape[1]), maps.T @ (w * target))
    return langs, (marks.T @ (half @ fitted)).astype(np.float32)


def predict(df: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``df`` with the predicted language and its score, a softmax of the margins."""
    langs, matrix = model
    sent = df.sparkSession.sparkContext.broadcast(matrix)  # at most cells times languages floats
    new = {lang_pred.lower(), score.lower()}
    schema = T.StructType([f for f in df.schema if f.name.lower() not in new] + [T.StructField(lang_pred, T.StringType(), False), T.StructField(score, T.DoubleType(), False)])
    text, keep = free_name(df, "text_of_row"), [f.name for f in schema if f.name not in (lang_pred, score)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).to_pylist()
            for a, b in ((i, j) for s, e in chars.slices(texts) for i in range(s, e, ROWS) for j in (min(e, i + ROWS),)):
                part, out, sure = batch.slice(a, b - a), ["und"] * (b - a), np.zeros(b - a)
                at = [i for i, t in enumerate(texts[a:b]) if t and langs and _letter(t)]
                if at:
                    margins = SHARPNESS * (scaled(presence([texts[a + i] for i in at])) @ sent.value).astype(np.float64)
                    e = np.exp(margins - margins.max(axis=1, keepdims=True))
                    best = margins.argmax(axis=1)
                    sure[at] = e[np.arange(len(at)), best] / e.sum(axis=1)
                    for i, k in zip(at, best, strict=True):
                        out[i] = langs[k]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + [pa.array(out), pa.array(sure)], names=[*keep, lang_pred, score])

    given = df.withColumn(text, F.col(text_col))
    return given.mapInArrow(run, schema)


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    """The language of every text of ``documents``, learned from the rows of the other folds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs, crc_fold("doc_id", 5) != 0)
    ids = docs.select("doc_id", "text", (crc_fold("doc_id", 5) == 0).alias("held_out"))
    return predict(ids, model).select("doc_id", "held_out", "lang_pred", "score")
