"""Mixing sources to target weights by Poisson replication, in DataFrame operations only.

A source of n rows with target weight w gets the mean repetition rate w * total / n. Every document's count is the
inverse of that Poisson distribution at a number in [0, 1) that is hashed from seed, id and text; the document is
exploded by its count, and the copies are shuffled globally by a seeded hash.

The inverse is searched, not looked up: from a count that is twelve deviations below the mean, probabilities are
multiplied up and added until they pass the number. A source carries four numbers for that, whatever its rate, and a
document takes some 24 * sqrt(rate) + 60 steps, which for high rates is far less than its copies.

Defined cases: a null source is a source of its own (given as None in the weights). A source without a weight, when
weights are given, has weight 0. Null ids and texts hash as empty texts; texts of any length are hashed and copied
whole. Repeated rows share their draw, and so do their copies' places in the mix. An empty table gives an empty result.
Input columns named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.llm.common import free_name, table

#: Sources whose names and numbers take up to this many bytes are broadcast; more are joined by shuffling, with salted keys.
BROADCAST_BYTES, SALTS = 8_000_000, 64


def unit(key: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of a text's md5."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") / float(2**52)


def _reach(rate: Column) -> Column:
    """The counts that matter: below the first and above the last the probability is far under 2**-52."""
    first = F.greatest(F.lit(0).cast("long"), F.floor(rate - 12 * F.sqrt(rate) - 30))
    return F.sequence(first, F.ceil(rate + 12 * F.sqrt(rate)) + 30)


def poisson_start(rate: Column) -> Column:
    """The probability of the first count that matters, from the sum of all that do."""
    step = lambda acc, k: F.struct((acc["w"] * rate / (k + 1)).alias("w"), (acc["sum"] + acc["w"]).alias("sum"))
    return F.aggregate(_reach(rate), F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum")), step, lambda acc: 1 / acc["sum"])


def poisson_count(u: Column, rate: Column, start: Column) -> Column:
    """The least k that matters with P(X <= k) > ``u``: how many counts have a distribution function of ``u`` at most."""
    zero = F.struct(u.alias("u"), start.alias("p"), F.lit(0.0).alias("upto"), F.element_at(_reach(rate), 1).alias("k"))

    def step(acc: Column, k: Column) -> Column:
        upto = acc["upto"] + acc["p"]
        return F.struct(acc["u"].alias("u"), (acc["p"] * rate / (k + 1)).alias("p"), upto.alias("upto"), (acc["k"] + (upto <= acc["u"]).cast("long")).alias("k"))

    return F.when(rate > 0, F.aggregate(_reach(rate), zero, step, lambda acc: acc["k"])).otherwise(F.lit(0).cast("long"))


def rates(df: DataFrame, source_col: str, weights: dict | None, epochs: float) -> DataFrame:
    """source, rate: the mean repetitions of a row of each source so that the mix has ``epochs`` times the rows."""
    counts = df.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        total = counts.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("sources"))
        return counts.crossJoin(F.broadcast(total)).select("source", (F.lit(epochs) * F.col("total") / F.col("sources") / F.col("n")).alias("rate"))
    whole = float(sum(weights.values()))
    given = df.sparkSession.createDataFrame([(k, float(w) / whole) for k, w in weights.items()], "source string, weight double")
    total = counts.agg(F.sum("n").alias("total"))
    kept = counts.alias("c").join(F.broadcast(given).alias("g"), F.col("c.source").eqNullSafe(F.col("g.source")), "left")
    return kept.crossJoin(F.broadcast(total)).select("c.source", (F.lit(epochs) * F.coalesce("weight", F.lit(0.0)) * F.col("total") / F.col("n")).alias("rate"))


def mix(df: DataFrame, weights: dict | None = None, epochs: float = 1.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 41) -> DataFrame:
    """The copies of ``df``'s rows, globally shuffled, with ``n_copies``, ``copy_no`` (from 1) and ``mix_key``.

    ``weights`` maps sources to target weights; None gives all sources equal weight. The rows are in the order of the
    mix: partition by partition, sorted by ``mix_key``.
    """
    new = ("n_copies", "copy_no", "mix_key")
    keep = [c for c in df.columns if c.lower() not in new]
    by_source = rates(df, source_col, weights, epochs)
    sources = by_source.select("source", "rate", F.when(F.col("rate") > 0, poisson_start(F.col("rate"))).alias("start"))
    row, text = free_name(df, "row"), lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    drawn = df.select(
        F.struct(*keep).alias(row),
        F.col(source_col).alias("source"),
        F.concat_ws("|", F.lit(str(seed)), text(id_col), F.md5(text(text_col).cast("binary"))).alias("draw"),
    )
    size = by_source.agg(F.coalesce(F.sum(F.coalesce(F.octet_length("source"), F.lit(0)) + 64), F.lit(0)).alias("bytes")).first()["bytes"]
    if size <= BROADCAST_BYTES:
        paired = drawn.alias("d").join(F.broadcast(sources).alias("r"), F.col("d.source").eqNullSafe(F.col("r.source")))
    else:
        salted = sources.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        paired = drawn.withColumn("salt", F.pmod(F.xxhash64("draw"), F.lit(SALTS)).cast("int")).alias("d").join(salted.alias("r"), F.col("d.source").eqNullSafe(F.col("r.source")) & (F.col("d.salt") == F.col("r.salt")))
    # the number is the start of the fold, so that it is hashed once a row
    counted = paired.select(row, "draw", poisson_count(unit(F.col("draw")), F.col("rate"), F.col("start")).alias("n_copies"))
    copies = counted.where(F.col("n_copies") > 0).withColumn("copy_no", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_copies"))))
    keyed = copies.select(f"{row}.*", "n_copies", "copy_no", F.md5(F.concat_ws("|", F.lit("order"), "draw", F.col("copy_no").cast("string")).cast("binary")).alias("mix_key"))
    return keyed.repartition("mix_key").sortWithinPartitions("mix_key")


def op4_poisson_mix(spark, sf_dir: str) -> DataFrame:
    """``documents`` mixed so that all sources get equal weight, as many rows as there are in expectation."""
    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars"))


OP4_SQL = """
WITH counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (SELECT source, (SELECT sum(n) FROM counts)::DOUBLE / (SELECT count(*) FROM counts) / n AS rate FROM counts),
steps AS (
  SELECT source, rate, k, exp(-rate + k * ln(rate) - lgamma(k + 1.0)) AS p
  FROM rates, LATERAL (SELECT unnest(range(0, (ceil(rate + 12 * sqrt(rate)) + 31)::BIGINT)) AS k)),
cdf AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS upto FROM steps),
drawn AS (SELECT *, '41|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, '')) AS draw FROM documents),
unit AS (SELECT *, ('0x' || substr(md5(draw), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u FROM drawn),
counted AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, d.draw,
         (SELECT count(*) FROM cdf c WHERE c.source IS NOT DISTINCT FROM d.source AND c.upto <= d.u) AS n_copies
  FROM unit d),
copies AS (SELECT *, unnest(range(1, n_copies + 1)) AS copy_no FROM counted)
SELECT doc_id, text, lang, source, n_chars, n_copies, copy_no, md5('order|' || draw || '|' || copy_no::VARCHAR) AS mix_key
FROM copies
"""
