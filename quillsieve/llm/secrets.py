"""Secret scan: fixed patterns, and sliding-window entropy over candidate strings. Built-in functions only.

Base kinds: ``assign`` (a name like password or token, then a value of 12 characters or more), ``access`` (AKIA keys
of 18 characters or more) and ``hex`` (16 digits or more). The method adds ``entropy`` spans: a candidate is a run of
20 characters or more of one character class that holds both letters and digits. A window slides over it with the
counts of its characters and the sum of c * log2(c): a step takes one character out and one in, which changes two counts
and two terms of the sum, whatever the window's length (Spark's fold copies its state, so the counts of the alphabet
are written anew each step). The span is a finding if the entropy of any window reaches the class's threshold and the
allow list does not suppress the candidate. Only added spans are suppressed by the allow list, and filler words only
count as far as they go: a candidate that holds 20 characters or more beside them stays.

Defined cases: a null text is an empty text and has no spans. Texts and tokens are scanned whole, however long. Kinds
may overlap, and spans that start together are in the order of the kinds; two classes that find the same span give it
once. Rows are independent: repeated rows give equal spans, and an empty table gives an empty result. Columns of the
input named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.functions.exprs import let
from quillsieve.llm.common import table
from quillsieve.llm.spans import SPAN, joined, kinded, prefixes, regex_spans

BASE = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)""",
    "access": r"AKIA[A-Z0-9]{14,}+",
    "hex": r"[0-9a-f]{16,}+",
}
#: Character classes: pattern of a candidate, alphabet, window, threshold in bits.
CLASSES = {
    "hex": (r"(?<![A-Za-z0-9])[0-9A-Fa-f]{20,}+(?![A-Za-z0-9])", "0123456789abcdef", 20, 2.8),
    "base64": (r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", 20, 3.9),
}
#: Characters of a candidate at least.
LEAST = 20
#: Fillers: a candidate in which fewer than ``LEAST`` characters are left without them and without joints is no secret.
FILLERS = r"(?i)0123456789|1234567890|abcdefghij|qwertyuiop|example|placeholder|changeme|xxxxxxxx|[/_-]"
#: Other candidates that are no secrets: paths, UUIDs, and words joined by hyphens or underscores.
ALLOW = [
    r"^/?([A-Za-z]+[0-9]{0,3}/)+[A-Za-z]*[0-9]{0,3}$",
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"^[A-Za-z]+([_-][A-Za-z]+)*([_-][0-9]{1,4})*$",
]


def _term(c: Column) -> Column:
    return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))


def top_entropy(token: Column, alphabet: str, window: int) -> Column:
    """The highest Shannon entropy, in bits, of any ``window`` characters of ``token``, by incremental counts."""
    places = F.transform(F.split(token, ""), lambda ch: F.instr(F.lit(alphabet), ch) - 1)
    lagged = F.concat(F.array_repeat(F.lit(-1), window), places)
    steps = F.zip_with(F.slice(lagged, 1, F.size(places)), places, lambda out, new: F.struct(out.alias("out"), new.alias("new")))
    zero = F.struct(F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0).alias("n"), F.lit(0.0).alias("best"))

    def step(acc: Column, x: Column) -> Column:
        c_out, c_new = F.get(acc["counts"], x["out"]), F.get(acc["counts"], x["new"])
        # a character that leaves and enters at once changes nothing
        total = F.when(x["out"] == x["new"], acc["sum"]).otherwise(
            acc["sum"] + F.when(x["out"] >= 0, _term(c_out - 1) - _term(c_out)).otherwise(F.lit(0.0)) + F.when(x["new"] >= 0, _term(c_new + 1) - _term(c_new)).otherwise(F.lit(0.0))
        )
        counts = F.transform(acc["counts"], lambda c, j: c + (j == x["new"]).cast("int") - (j == x["out"]).cast("int"))
        n = acc["n"] + 1
        bits = F.when(n >= window, F.log2(F.lit(float(window))) - total / window).otherwise(F.lit(0.0))
        return F.struct(counts.alias("counts"), total.alias("sum"), n.alias("n"), F.greatest(acc["best"], bits).alias("best"))

    return F.aggregate(steps, zero, step, lambda acc: acc["best"])


def entropy_spans(text: Column) -> Column:
    """Candidates of any class whose entropy reaches the threshold and that no allow-list pattern matches."""
    return F.array_distinct(F.concat(*[_class_spans(text, *c) for c in CLASSES.values()]))


def _class_spans(text: Column, pattern: str, alphabet: str, window: int, threshold: float) -> Column:
    allowed = "|".join(f"(?:{p})" for p in ALLOW)
    folded = F.lower if alphabet.islower() else (lambda t: t)
    mixed = lambda s: s["token"].rlike("[0-9]") & s["token"].rlike("[A-Za-z]") & ~s["token"].rlike(allowed) & (F.length(F.regexp_replace(s["token"], FILLERS, "")) >= LEAST)
    return F.filter(F.filter(regex_spans(text, pattern), mixed), lambda s: top_entropy(folded(s["token"]), alphabet, window) >= threshold)


def scan(df: DataFrame, text_col: str = "text", spans_col: str = "secrets") -> DataFrame:
    """``df`` with ``spans_col``: sorted spans (start, rank, end, kind, token) of every kind in the whole text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    assign = F.filter(
        F.when(text.rlike(r"(?i)(password|passwd|secret|token|api_?key)"), regex_spans(text, BASE["assign"])).otherwise(F.array().cast(SPAN)),
        lambda s: F.length(F.regexp_extract(s["token"], BASE["assign"], 2)) >= 12,
    )
    access = F.when(text.contains("AKIA"), regex_spans(text, BASE["access"])).otherwise(F.array().cast(SPAN))
    parts = [kinded(assign, "assign", 0), kinded(access, "access", 1), kinded(regex_spans(text, BASE["hex"]), "hex", 2), kinded(entropy_spans(text), "entropy", 3)]
    return df.withColumn(spans_col, F.sort_array(F.concat(*parts)))


def redact(df: DataFrame, text_col: str = "text", spans_col: str = "secrets", mark: str = "[SECRET]") -> DataFrame:
    """``df`` with every found span replaced by ``mark`` (overlapping spans by one mark) and without ``spans_col``."""
    text = F.col(text_col)

    def masked(v: Column) -> Column:
        upto = prefixes(v["spans"], lambda s: s["end"], lambda a, b: F.greatest(a, b))
        pieces = F.zip_with(v["spans"], upto, lambda s, at: F.when(s["start"] >= at, F.concat(F.substring(v["text"], at + 1, s["start"] - at), F.lit(mark))).otherwise(F.lit("")))
        last = F.array_max(F.transform(v["spans"], lambda s: s["end"]))
        return F.concat(F.array_join(pieces, ""), F.substring(v["text"], last + 1, F.length(v["text"])))

    merged = let({"spans": F.col(spans_col), "text": text}, masked)
    return df.withColumn(text_col, F.when(F.size(spans_col) > 0, merged).otherwise(text)).drop(spans_col)


def op7_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Secrets in every text of ``documents``."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "secrets")
    base = F.filter("secrets", lambda s: s["rank"] < 3)
    count = lambda k: F.size(F.filter("secrets", lambda s: s["rank"] == k)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans")
    )


def _sql() -> str:
    either = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
    names = "|".join(map(either, ("password", "passwd", "secret", "token"))) + f"|{either('api')}_?{either('key')}"
    assign = rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    patterns = [assign, "AKIA[A-Z0-9]{14,}", "[0-9a-f]{16,}", "[A-Za-z0-9]{20,}", "[A-Za-z0-9+/_-]{20,}"]
    quoted = [p.replace("'", "''") for p in patterns]
    found = " UNION ALL ".join(f"SELECT rid, {i} AS rank, regexp_extract_all(t, '{p}') AS tokens, string_split_regex(t, '{p}') AS gaps FROM d WHERE regexp_matches(t, '{p}')" for i, p in enumerate(quoted))
    allowed = " OR ".join(f"regexp_matches(token, '{p}')" for p in ALLOW)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({found}),
placed AS (
  SELECT rid, rank, tokens[i] AS token,
    (list_sum(list_transform(gaps[:i], lambda g: length(g))) + coalesce(list_sum(list_transform(tokens[:i - 1], lambda g: length(g))), 0))::BIGINT AS first
  FROM (SELECT *, unnest(range(1, len(tokens) + 1)) AS i FROM found)),
cand AS (
  SELECT rid, first, token, CASE rank WHEN 3 THEN lower(token) ELSE token END AS chars, CASE rank WHEN 3 THEN {CLASSES['hex'][3]} ELSE {CLASSES['base64'][3]} END AS least
  FROM placed
  WHERE (rank = 4 OR rank = 3 AND regexp_full_match(token, '[0-9A-Fa-f]+')) AND regexp_matches(token, '[0-9]') AND regexp_matches(token, '[A-Za-z]')
    AND NOT ({allowed}) AND length(regexp_replace(token, '{FILLERS}', '', 'g')) >= {LEAST}),
windows AS (SELECT *, unnest(range(1, length(chars) - 18)) AS w FROM cand),
letters AS (SELECT rid, first, token, least, w, substr(chars, w + o, 1) AS ch FROM (SELECT *, unnest(range(0, 20)) AS o FROM windows)),
counts AS (SELECT rid, first, token, least, w, ch, count(*) AS c FROM letters GROUP BY ALL),
bits AS (SELECT rid, first, token, least, w, log2(20.0) - sum(c * log2(c)) / 20.0 AS b FROM counts GROUP BY ALL),
spans AS (
  SELECT rid, rank, first, first + length(token) AS last, ['assign', 'access', 'hex'][rank + 1] AS kind FROM placed
  WHERE rank IN (1, 2) OR rank = 0 AND length(regexp_extract(token, '{quoted[0]}', 2)) >= 12
  UNION ALL
  SELECT DISTINCT rid, 3, first, first + length(token), 'entropy' FROM bits WHERE b >= least),
texts AS (
  SELECT rid, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access, count(*) FILTER (WHERE rank = 2) AS n_hex,
    string_agg(kind || ':' || first || ':' || last, ',' ORDER BY first, rank, last) FILTER (WHERE rank < 3) AS base,
    string_agg(kind || ':' || first || ':' || last, ',' ORDER BY first, rank, last) AS spans
  FROM spans GROUP BY rid)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN texts USING (rid)
"""


OP7_SQL = _sql()
