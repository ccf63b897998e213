"""Toxicity by class-conditional Kneser-Ney models over characters.

Each class (toxic, ordinary) has its own counts of character 6-grams within words, with edges; what came before a word
is no context, so that the start of a word is judged as such. A class's probability of a character after up to five
others is its discounted count plus, weighted by what was discounted, a backoff probability that both classes share:
Kneser-Ney continuation counts of the 5-grams down to single characters, from the 6-grams of both classes together. So
rare expressions and new forms of known ones are smoothed by all text. A text's two log-likelihoods are compared per
character, over the whole text and over every window of 16 characters. A logistic calibration, fitted on labelled rows
that its counts have not seen, turns the whole text's mean, the highest window and the mean of the eight highest into
a score; then the counts take in those rows too.

Learning takes every labelled row, so the calibration sees the classes in their own shares and a score means the same at
every size. It keeps every 6-gram, however rare. The counts are summed in Spark; the smoothed tables are made on the driver
and sent to every task, so the distinct 6-grams have to fit there. All texts are scored whole.

The length-normalised comparison is the first feature, the mean; the windows say whether a part of a long text stands out
from it, and the length how much a mean is worth. The README has the figures of the mean alone beside those of the score.

Defined cases: a null text is an empty text, and an empty text has mean 0; a text shorter than a window is its own window,
and a very long one has all its windows. Labels that are null are no labels; an id with several labels is toxic if one
says so, and all rows of a labelled id are learned from. Ties of score and threshold count as toxic. If the labelled rows lack a class, every score is the toxic share of them
(0 without any). Repeated rows score alike. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsieve.llm import chars
from quillsieve.llm.common import crc_fold, free_name, scratch, table, written

ORDER, WINDOW, TOP = 6, 16, 8
#: Of the learning rows, every this many-th fits the calibration and not the counts.
HELD = 4
THRESHOLD = 0.7

_MASK = np.int64((1 << (chars.BITS * ORDER)) - 1)


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The packed 6-gram that ends at each character of each text, one text after the other, and the texts' lengths."""
    code, starts, sizes = chars.codes(texts, ORDER)
    at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    return (chars.word_grams(code, ORDER) & _MASK)[at], sizes


class Lookup:
    """Values by 64-bit key: open tables, each of which takes the keys that found their place taken in the one before."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.tables, odd = [], 0x9E3779B97F4A7C15
        while len(keys):
            bits = max(4, int(len(keys) * 2 - 1).bit_length())
            odd = (odd * 0xD1342543DE82EF95 + 2) % 2**64 | 1
            at = self._at(keys, odd, bits)
            first = np.unique(at, return_index=True)[1]
            own, value = np.full(1 << bits, -1, dtype=np.int64), np.zeros(1 << bits, dtype=np.float32)
            own[at[first]], value[at[first]] = keys[first], values[first]
            self.tables.append((odd, bits, own, value))
            rest = np.ones(len(keys), dtype=bool)
            rest[first] = False
            keys, values = keys[rest], values[rest]

    @staticmethod
    def _at(keys: np.ndarray, odd: int, bits: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.view(np.uint64) * np.uint64(odd)) >> np.uint64(64 - bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values, 0 for keys that are not there, and where those are."""
        out, todo = np.zeros(len(keys), dtype=np.float32), np.arange(len(keys))
        for odd, bits, own, value in self.tables:
            left = keys[todo] if len(todo) < len(keys) else keys
            at = self._at(left, odd, bits)
            hit = own[at] == left
            out[todo[hit]] = value[at[hit]]
            todo = todo[~hit]
        return out, todo


@dataclass
class Model:
    """Log ratios of 6-grams seen in learning, of contexts for 6-grams unseen, and the calibration."""

    seen: Lookup
    novel: Lookup
    mean: np.ndarray = field(default_factory=lambda: np.zeros(4))
    scale: np.ndarray = field(default_factory=lambda: np.ones(4))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(5))

    def features(self, texts: list[str]) -> np.ndarray:
        """Mean log ratio a character, highest window, mean of the eight highest windows, log of the length."""
        keys, sizes = _grams(texts)
        ratio, missing = self.seen.get(keys)
        ratio[missing] = self.novel.get(keys[missing] >> np.int64(chars.BITS))[0]
        total = np.concatenate([[0.0], np.cumsum(ratio, dtype=np.float64)])
        out = np.zeros((len(texts), 4))
        for i, (end, n) in enumerate(zip(np.cumsum(sizes).tolist(), sizes.tolist(), strict=True)):
            if n:
                own = total[end - n : end + 1]
                width = min(n, WINDOW)
                windows = (own[width:] - own[:-width]) / WINDOW
                top = windows if len(windows) <= TOP else np.partition(windows, len(windows) - TOP)[-TOP:]
                out[i] = (own[-1] - own[0]) / n, top.max(), top.mean(), np.log1p(n)
        return out

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + (features - self.mean) / self.scale @ self.weights[1:], -40, 40)))


def _continuation(types: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 5-grams that end the given 6-grams, and the probability of their last character by Kneser-Ney backoff.

    An n-gram counts as often as different characters come before it; one that starts at a word's edge has nothing
    before it and counts as often as it occurs.
    """
    levels = []
    for n in range(ORDER - 1, 0, -1):
        types, at = np.unique(types & np.int64((1 << (chars.BITS * n)) - 1), return_inverse=True)
        counts = np.bincount(at, weights=counts)
        first = types >> np.int64(chars.BITS * (n - 1))
        levels.append((types, np.where(first <= chars.EDGE, counts, np.bincount(at))))
    below: tuple[np.ndarray, np.ndarray] | None = None
    for n, (types, different) in enumerate(reversed(levels), 1):
        _, context = np.unique(types >> np.int64(chars.BITS), return_inverse=True)
        total, kinds = np.bincount(context, weights=different)[context], np.bincount(context)[context]
        discount = _discount(different)
        low = 1 / (1 << chars.BITS) if below is None else below[1][np.searchsorted(below[0], types & np.int64((1 << (chars.BITS * (n - 1))) - 1))]
        below = types, (different - discount) / total + discount * kinds / total * low
    assert below is not None
    return below


def _discount(counts: np.ndarray) -> float:
    once, twice = int((counts == 1).sum()), int((counts == 2).sum())
    return once / (once + 2 * twice) if once and twice else 0.5


def kneser_ney(keys: np.ndarray, counts: np.ndarray) -> Model:
    """Log ratios from sorted 6-grams and their counts (a row for each class, toxic first)."""
    low_types, low = _continuation(keys, counts.sum(axis=0))
    shared = low[np.searchsorted(low_types, keys & np.int64((1 << (chars.BITS * (ORDER - 1))) - 1))]
    contexts, context = np.unique(keys >> np.int64(chars.BITS), return_inverse=True)
    logs, rests = [], []
    for own in counts:
        discount, total = _discount(own), np.bincount(context, weights=own)
        rest = np.where(total > 0, discount * np.bincount(context, weights=own > 0) / np.maximum(total, 1), 1.0)
        logs.append(np.log(np.maximum(own - discount, 0) / np.maximum(total, 1)[context] + rest[context] * shared))
        rests.append(np.log(rest))
    return Model(Lookup(keys, (logs[0] - logs[1]).astype(np.float32)), Lookup(contexts, (rests[0] - rests[1]).astype(np.float32)))


_COUNTS = ["toxic", "ordinary", "toxic_held", "ordinary_held"]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        column = np.where(batch.column("toxic").to_numpy(zero_copy_only=False) == 1, 0, 1) + 2 * batch.column("held").to_numpy(zero_copy_only=False).astype(np.int64)
        for a, b in chars.slices(texts):
            keys, sizes = _grams([t or "" for t in texts[a:b]])
            kinds, at = np.unique(keys, return_inverse=True)
            counts = np.bincount(at * 4 + np.repeat(column[a:b], sizes), minlength=4 * len(kinds)).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([pa.array(kinds)] + [pa.array(np.ascontiguousarray(c)) for c in counts.T], names=["gram", *_COUNTS])


def _calibrated(model: Model, features: np.ndarray, label: np.ndarray) -> Model:
    """Logistic regression by Newton's method, with a little ridge."""
    model.mean, model.scale = features.mean(axis=0), features.std(axis=0) + 1e-9
    x = np.concatenate([np.ones((len(features), 1)), (features - model.mean) / model.scale], axis=1)
    w = np.zeros(x.shape[1])
    ridge = 0.1 * np.eye(len(w))
    ridge[0, 0] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - label) + ridge @ w)
    model.weights = w
    return model


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model | float:
    """The model, or the constant score where the labelled rows lack a class. ``learn`` selects rows of ``labels`` and ``docs`` by their ids."""
    with scratch(docs.sparkSession):
        named = labels.where(learn & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg((F.max(label_col) >= 1).cast("int").alias("toxic"))
        # the labelled ids grow with the input, so they are joined by shuffle at every size; rows not for learning stay out of it
        rows = written(docs.where(learn).select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(named.hint("shuffle_hash"), "id"), "labelled")
        fold = F.pmod(F.floor(F.crc32(F.col("id").cast("string").cast("binary")) / 3), F.lit(HELD))
        counted = rows.select("text", "toxic", (fold == 0).alias("held")).mapInArrow(_count, "gram long, " + ", ".join(f"{c} long" for c in _COUNTS))
        got = counted.groupBy("gram").agg(*[F.sum(c).alias(c) for c in _COUNTS]).toArrow()
        keys, counts = got["gram"].to_numpy(), np.stack([got[c].to_numpy() for c in _COUNTS])
        del got
        order = np.argsort(keys)
        keys, counts = keys[order], counts[:, order]
        if not counts[:2].any(axis=1).all():
            return float(named.agg(F.coalesce(F.avg("toxic"), F.lit(0.0)).alias("share")).first()["share"])
        first = counts[:2].any(axis=0)
        held = _applied(rows.where(fold == 0).select("text", "toxic"), kneser_ney(keys[first], counts[:2, first].astype(float)), "text", ["toxic"]).collect()
        label = np.array([r["toxic"] for r in held], dtype=float)
        model = kneser_ney(keys, (counts[:2] + counts[2:]).astype(float))
        if not len(held) or label.min() == label.max():
            return _calibrated(model, np.zeros((2, 4)) + [[-1], [1]], np.array([0.0, 1.0]))
        return _calibrated(model, np.array([[r["mean"], r["high"], r["highs"], r["length"]] for r in held]), label)


def _applied(df: DataFrame, model: Model, text: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with the features and the score of every text."""
    sent = df.sparkSession.sparkContext.broadcast(model)  # an entry of 12 bytes for each 6-gram and context, two to four times that in open tables
    names = ["mean", "high", "highs", "length", "score"]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(c, T.DoubleType(), False) for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(text).to_pylist()]
            for a, b in chars.slices(texts):
                features = sent.value.features(texts[a:b])
                columns = [*features.T, sent.value.scores(features)]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + [pa.array(np.ascontiguousarray(x)) for x in columns], names=[*keep, *names])

    return df.mapInArrow(run, schema)


def score(df: DataFrame, model: Model | float, text_col: str = "text", score_col: str = "score", predicted_col: str = "predicted") -> DataFrame:
    """``df`` with ``score_col`` (0 to 1, higher: likelier toxic) and ``predicted_col`` (1 from ``THRESHOLD`` up)."""
    keep = [c for c in df.columns if c.lower() not in (score_col.lower(), predicted_col.lower())]
    if isinstance(model, float):
        out = df.select(*keep, F.lit(model).alias(score_col))
    else:
        row, text = free_name(df, "row"), free_name(df, "text_of_row")
        packed = df.select(F.struct(*keep).alias(row), F.col(text_col).alias(text))
        out = _applied(packed, model, text, [row]).select(f"{row}.*", F.col("score").alias(score_col))
    return out.withColumn(predicted_col, (F.col(score_col) >= THRESHOLD).cast("int"))


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    """The toxicity of every text of ``documents``, learned from the labelled rows of the other folds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"), crc_fold("doc_id", 3) != 1)
    scored = score(docs, model) if isinstance(model, float) else _applied(docs, model, "text", ["doc_id"]).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    return scored.select("doc_id", (crc_fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")
