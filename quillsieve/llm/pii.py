"""Personal data: candidate spans from high-recall generators, scored by boosted trees. Built-in functions only.

Base kinds (``email``, ``ip``, ``card``, ``phone``) are fixed patterns with checks. Beside them four generators propose
overlapping candidates: digit sequences, written-out e-mail addresses, account numbers and hardware addresses. Each
candidate gets format and context features. Gradient-boosted trees, fitted here on generated snippets of which the
personal ones are known, score it; a threshold for each generator is calibrated on snippets that the trees have not
seen, for a precision of ``PRECISION``. Candidates from the threshold up are selected where no base span or
other such candidate that starts before them covers their start. The trees become one expression, so scoring stays in the engine.

Defined cases: a null text is an empty text and has no spans. Texts are scanned whole, however long, and so are runs of
any length (patterns do not back up over a run's characters). Base spans may overlap; spans that start together are in
the order of the kinds, and an added span that ties with a base span's start inside it goes. Rows are independent:
repeated rows give equal spans, and an empty table gives an empty result. Columns of the input named like an output column
are replaced.
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.functions.exprs import let
from quillsieve.llm.common import table
from quillsieve.llm.spans import SPAN, joined, kinded, prefixes, regex_spans

# Starts inside a run of the first class cannot match where the run's start does not, so only run starts are tried.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BYTE = r"(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)|0++)"
#: Generators: kind, pattern, and a cheaper pattern that every match of the first has in it.
GENERATORS = [
    ("number", r"(?<![0-9A-Za-z])\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,24}(?![0-9A-Za-z])", r"[0-9][\x20().-]{0,2}[0-9]"),
    ("email_like", r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{2,64}\x20?(?:@|[(\[]at[)\]]|\x20at\x20)\x20?[a-z0-9-]{2,63}(?:\x20?(?:\.|[(\[]dot[)\]]|\x20dot\x20)\x20?[a-z]{2,24}){1,4}", r"(?i)(?:@|[(\[]at[)\]]|\x20at\x20)\x20?[a-z0-9-]{2,63}\x20?(?:\.|[(\[]dot[)\]]|\x20dot\x20)\x20?[a-z]{2}"),
    ("account", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", r"[A-Z]{2}[0-9]{2}"),
    ("hardware", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){5,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])", r"[0-9A-Fa-f]:[0-9A-Fa-f]"),
]
#: Words beside a candidate that speak for a kind, or against all.
HINTS = {
    "phone": r"(?i)\b(tel|phone|call|mobile|fax|whatsapp|text me|cell)\b",
    "account": r"(?i)\b(iban|account|acct|card|visa|credit|bank|transfer)\b",
    "identity": r"(?i)\b(ssn|social security|passport|licen[cs]e|tax id|national id|born|dob)\b",
    "mail": r"(?i)\b(e-?mail|mail|contact|write to|reach)\b",
    "device": r"(?i)\b(mac|device|address|ipv6|host)\b",
    "against": r"(?i)(\b(order|invoice|version|release|isbn|price|total|sku|part no|page|build|ticket|ref|chapter|score|hash|checksum|ratio|id)\b|[$€£#])",
}
CONTEXT = 30
#: Snippets for learning, trees, their depth, learning rate, and the precision that thresholds are calibrated for.
SNIPPETS, TREES, DEPTH, RATE, PRECISION = 4000, 24, 3, 0.3, 0.99
FEATURES = ["generator", "digits", "length", "letters", "groups", "longest", "distinct", "dots", "spaces", "hyphens", "brackets", "luhn", "dated", "decimal", *HINTS]


def luhn(token: Column) -> Column:
    """Whether the digits of ``token`` pass the Luhn check."""
    digits = F.split(F.reverse(F.regexp_replace(token, "[^0-9]", "")), "")
    each = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d.try_cast("int")).otherwise(F.when(d.try_cast("int") > 4, d.try_cast("int") * 2 - 9).otherwise(d.try_cast("int") * 2)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _digits(token: Column) -> Column:
    return F.length(F.regexp_replace(token, "[^0-9]", ""))


def _if(needed: Column, spans: Column) -> Column:
    return F.when(needed, spans).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> list[Column]:
    """The spans of the four base kinds, checked."""
    email = _if(text.contains("@"), regex_spans(text, EMAIL))
    ip = F.filter(regex_spans(text, IP), lambda s: s["token"].rlike(rf"^{BYTE}\.{BYTE}\.{BYTE}\.{BYTE}\z"))
    card = F.filter(F.filter(regex_spans(text, CARD), lambda s: _digits(s["token"]).between(14, 19)), lambda s: luhn(s["token"]))
    phone = F.filter(_if(text.contains("+"), regex_spans(text, PHONE)), lambda s: _digits(s["token"]).between(10, 15))
    return [kinded(email, "email", 0), kinded(ip, "ip", 1), kinded(card, "card", 2), kinded(phone, "phone", 3)]


def _featured(span: Column, generator: int) -> Column:
    """A candidate with its features, all int."""
    t = span["token"]
    beside = F.concat_ws(" ", span["before"], span["after"])
    number = F.regexp_replace(t, "[^0-9]", "")
    groups = F.split(F.regexp_replace(t, "^[^0-9]+|[^0-9]+$", ""), "[^0-9]+")
    count = lambda pattern: F.length(t) - F.length(F.regexp_replace(t, pattern, ""))
    values = {
        "generator": F.lit(generator),
        "digits": F.length(number),
        "length": F.length(t),
        "letters": count("[A-Za-z]"),
        "groups": F.size(groups),
        "longest": F.array_max(F.transform(groups, lambda g: F.length(g))),
        "distinct": F.size(F.array_distinct(F.split(number, ""))),
        "dots": count("[.]"),
        "spaces": count(" "),
        "hyphens": count("-"),
        "brackets": count(r"[()\[\]]"),
        "luhn": luhn(t).cast("int"),
        "dated": t.rlike(r"^(19|20)[0-9]{2}[-. ](0?[1-9]|1[0-2])[-. ]|^[0-3]?[0-9][-. ][01]?[0-9][-. ](19|20)[0-9]{2}").cast("int"),
        "decimal": t.rlike(r"^[0-9]+[.][0-9]+$").cast("int"),
    } | {k: beside.rlike(p).cast("int") for k, p in HINTS.items()}
    return F.struct(span["start"].alias("start"), span["end"].alias("end"), t.alias("token"), F.lit(GENERATORS[generator][0]).alias("kind"), *[values[f].alias(f) for f in FEATURES])


def candidates(text: Column) -> Column:
    """Every generator's candidates with their features; they may overlap."""
    return F.concat(*[_made(text, i, pattern, needed) for i, (_, pattern, needed) in enumerate(GENERATORS)])


def _made(text: Column, i: int, pattern: str, needed: str) -> Column:
    return F.transform(_if(text.rlike(needed), regex_spans(text, pattern, CONTEXT)), lambda s: _featured(s, i))


@dataclass
class Node:
    """A split on ``feature`` <= ``cut``, or a leaf with ``value``."""

    feature: int = -1
    cut: int = 0
    low: Node | None = None
    high: Node | None = None
    value: float = 0.0

    def column(self, at: Column) -> Column:
        if self.low is None or self.high is None:
            return F.lit(self.value)
        return F.when(at[FEATURES[self.feature]] <= self.cut, self.low.column(at)).otherwise(self.high.column(at))

    def values(self, x: np.ndarray) -> np.ndarray:
        if self.low is None or self.high is None:
            return np.full(len(x), self.value)
        return np.where(x[:, self.feature] <= self.cut, self.low.values(x), self.high.values(x))


def _grown(x: np.ndarray, gradient: np.ndarray, weight: np.ndarray, depth: int) -> Node:
    """A regression tree by Newton gain over all cuts of all features."""
    g, h = gradient.sum(), weight.sum()
    best, gain = None, 1e-3
    if depth:
        for f in range(x.shape[1]):
            values, at = np.unique(x[:, f], return_inverse=True)
            gl, hl = np.cumsum(np.bincount(at, weights=gradient))[:-1], np.cumsum(np.bincount(at, weights=weight))[:-1]
            if len(gl):
                score = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
                if score.max() > gain:
                    gain, best = score.max(), (f, int(values[score.argmax()]))
    if best is None:
        return Node(value=float(RATE * g / (h + 1)))
    low = x[:, best[0]] <= best[1]
    return Node(best[0], best[1], _grown(x[low], gradient[low], weight[low], depth - 1), _grown(x[~low], gradient[~low], weight[~low], depth - 1))


@dataclass
class Model:
    trees: list[Node]
    thresholds: list[float]

    def margin(self, at: Column) -> Column:
        total = F.lit(0.0)
        for t in self.trees:
            total = total + t.column(at)
        return total

    def threshold(self, at: Column) -> Column:
        out = F.lit(math.inf)
        for i, t in enumerate(self.thresholds):
            out = F.when(at["generator"] == i, F.lit(t)).otherwise(out)
        return out


def snippets(n: int, seed: int = 6) -> list[tuple[str, int]]:
    """Generated sentences with one candidate each, and whether it is personal."""
    rng = random.Random(seed)
    d = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    word = lambda: "".join(rng.choice("aeioulnrstm") for _ in range(rng.randrange(2, 9)))
    hexes = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))
    personal = [
        lambda: (rng.choice(["tel ", "phone: ", "call ", "mobile ", "my cell "]), rng.choice([f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"0{d(3)} {d(7)}", f"{d(3)}.{d(3)}.{d(4)}", f"0{d(2)} {d(4)} {d(4)}"])),
        lambda: (rng.choice(["ssn ", "social security ", "ssn: "]), f"{d(3)}-{d(2)}-{d(4)}"),
        lambda: (rng.choice(["passport ", "national id ", "licence "]), d(rng.randrange(8, 12))),
        lambda: (rng.choice(["iban ", "account ", "bank transfer to ", "", ""]), rng.choice(["DE", "FR", "GB", "ES"]) + d(2) + "".join(rng.choice(["", " "]) + d(4) for _ in range(rng.randrange(3, 6)))),
        lambda: (rng.choice(["email ", "contact ", "write to ", "", ""]), f"{word()}{rng.choice([' at ', '(at)', ' [at] '])}{word()}{rng.choice([' dot ', '[dot]', '(dot)'])}{rng.choice(['com', 'org', 'net'])}"),
        lambda: (rng.choice(["mac ", "device ", "address ", ""]), ":".join(hexes(2) for _ in range(6))),
    ]
    other = [
        lambda: (rng.choice(["order ", "invoice ", "ticket ", "ref ", "id "]), d(rng.randrange(7, 13))),
        lambda: (rng.choice(["on ", "since ", "", "until "]), f"{rng.choice(['19', '20'])}{d(2)}-{rng.randrange(1, 13):02}-{rng.randrange(1, 29):02}"),
        lambda: (rng.choice(["version ", "release ", "build "]), f"{d(1)}.{d(2)}.{d(rng.randrange(4, 7))}"),
        lambda: (rng.choice(["price ", "total $", "about ", "ratio "]), f"{d(rng.randrange(3, 7))}.{d(rng.randrange(4, 9))}"),
        lambda: (rng.choice(["isbn ", "sku ", "part no "]), f"978-{d(1)}-{d(4)}-{d(4)}-{d(1)}"),
        lambda: (rng.choice(["pages ", "score ", "", "chapter "]), " ".join(d(rng.randrange(1, 4)) for _ in range(rng.randrange(4, 9)))),
        lambda: (f"{word()} ", d(rng.randrange(7, 26))),
        lambda: (rng.choice(["hash ", "checksum ", "ref "]), ":".join(hexes(4) for _ in range(6))),
        lambda: (f"{word()} ", f"{word()} at {word()} dot {word()}"),
        lambda: (rng.choice(["sku ", "part no ", "build "]), f"{rng.choice(['AB', 'XQ', 'ZZ'])}{d(2)} {hexes(4).upper()} {hexes(4).upper()}"),
    ]
    out = []
    for i in range(n):
        label = i % 2
        before, token = rng.choice(personal if label else other)()
        out.append((f"{word()} {word()} {before}{token} {word()} {word()}", label))
    return out


def fit(spark: SparkSession) -> Model:
    """Trees from half of the generated snippets, and thresholds from the other half."""
    made = snippets(SNIPPETS)
    df = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(made)], "i int, text string, label int")
    rows = df.select("i", "label", F.explode(candidates(F.col("text"))).alias("c")).select("i", "label", *[F.col(f"c.{f}") for f in FEATURES]).collect()
    x = np.array([[r[f] if r[f] is not None else 0 for f in FEATURES] for r in rows])
    y = np.array([r["label"] for r in rows], dtype=float)
    learn = np.array([r["i"] % 4 < 2 for r in rows])
    trees, margin = [], np.zeros(int(learn.sum()))
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        trees.append(_grown(x[learn], y[learn] - p, p * (1 - p), DEPTH))
        margin += trees[-1].values(x[learn])
    held = sum(t.values(x[~learn]) for t in trees)
    thresholds = []
    for g in range(len(GENERATORS)):
        own = x[~learn][:, FEATURES.index("generator")] == g
        order = np.argsort(-held[own])
        right = np.cumsum(y[~learn][own][order])
        margins = held[own][order]
        good = [i for i in range(len(margins)) if right[i] >= PRECISION * (i + 1) and (i + 1 == len(margins) or margins[i + 1] < margins[i])]
        thresholds.append(float(margins[good[-1]]) if good else math.inf)
    return Model(trees, thresholds)


def scan(df: DataFrame, model: Model, text_col: str = "text", spans_col: str = "personal") -> DataFrame:
    """``df`` with ``spans_col``: sorted spans (start, rank, end, kind, token), rank 0 to 3 for the base kinds, 4 for others."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    scored = F.filter(candidates(text), lambda c: model.margin(c) >= model.threshold(c))
    added = F.transform(scored, lambda c: F.struct(c["start"].alias("start"), F.lit(4).alias("rank"), c["end"].alias("end"), c["kind"].alias("kind"), c["token"].alias("token")))
    everything = F.sort_array(F.concat(*base_spans(text), added))

    def uncovered(v: Column) -> Column:
        ends = prefixes(v["all"], lambda s: s["end"], lambda a, b: F.greatest(a, b))
        marked = F.zip_with(v["all"], ends, lambda s, upto: F.struct(s.alias("span"), ((s["rank"] < 4) | (s["start"] >= upto)).alias("keep")))
        return F.transform(F.filter(marked, lambda m: m["keep"]), lambda m: m["span"])

    chosen = let({"all": everything}, uncovered)
    return df.withColumn(spans_col, chosen)


def op6_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data in every text of ``documents``."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), fit(spark)).select("doc_id", "personal")
    base = F.filter("personal", lambda s: s["rank"] < 4)
    count = lambda k: F.size(F.filter("personal", lambda s: s["rank"] == k)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_email"), count(1).alias("n_ip"), count(2).alias("n_card"), count(3).alias("n_phone"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("personal")).alias("spans")
    )
