"""N-gram Jaccard join by MinHash banding, verified on full shingle sets.

Words are runs of non-whitespace; a shingle is five words in a row, and a text of one to four words is one shingle.
Equal texts are one class from the start and are compared once. Signatures are cut into bands; texts that share a
band meet in its bucket. Buckets with the same members count as one. Inside a bucket every pair whose first common
bucket this is gets its exact Jaccard similarity, by counting shared shingles for all pairs at once, so pairs are never
rows: a text gives its number of links, and one link to the least text it is connected with. A bucket of many texts or
long texts is dealt into chunks, and each pair of chunks is a task's group of bounded size. Linked texts form classes
by alternating large-star and small-star steps over written tables.

Defined cases: a null text is an empty text. Texts without words have no shingles: equal ones share a class, and they
link to nothing. A very long text is signed and verified whole, and fills a chunk of its own. Null ids sort last when a
class takes its least id; a class without ids has a null class id. Ties of ids within a class go to the text of least
key. Repeated rows are copies. An empty table gives an empty result. Columns of the input named like an inner one do not
clash, since rows travel as structs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsieve.llm.common import free_name, scratch, table, written

WORDS, SIMILARITY, RECALL = 5, 0.8, 0.999
#: Texts and words in a chunk of a bucket, about.
CHUNK_TEXTS, CHUNK_WORDS = 512, 400_000
#: Bytes of text that are hashed at once, and words whose hashes a task remembers.
SLICE_BYTES, CACHE_WORDS = 1_000_000, 200_000

_M = np.uint64(0x9E3779B97F4A7C15)


def bands_and_rows(similarity: float, recall: float, most_hashes: int = 200) -> tuple[int, int]:
    """The most selective bands and rows that find a pair at ``similarity`` with probability ``recall`` at least.

    For each number of rows the least number of bands follows from the recall; of those within ``most_hashes`` the one
    with the most rows lets the fewest dissimilar pairs meet.
    """
    best = (math.ceil(math.log(1 - recall) / math.log(1 - similarity)), 1)
    for rows in range(2, 20):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))
        if bands * rows <= most_hashes:
            best = (bands, rows)
    return best


class _Hashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        import xxhash

        value = xxhash.xxh3_64_intdigest(word.encode())
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = value
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: list[str | None], hashes: _Hashes, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The hashed shingles of all texts, one after the other and with repeats, and their number for each text."""
    words = [t.split() if t else [] for t in texts]
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    flat = np.fromiter((hashes[w] for ws in words for w in ws), dtype=np.uint64, count=int(sizes.sum()))
    starts = np.cumsum(sizes) - sizes
    counts = np.where(sizes >= n, sizes - n + 1, np.minimum(sizes, 1))
    total = len(flat)
    out, valid = np.zeros(total, dtype=np.uint64), np.zeros(total, dtype=bool)
    with np.errstate(over="ignore"):
        if total >= n:
            acc = flat[: total - n + 1].copy()
            for i in range(1, n):
                acc = acc * _M + flat[i : total - n + 1 + i]
            out[: total - n + 1] = _mixed(acc)
            doc = np.repeat(np.arange(len(words)), sizes)
            valid[: total - n + 1] = doc[: total - n + 1] == doc[n - 1 :]
        for i in np.nonzero((sizes > 0) & (sizes < n))[0]:
            acc = np.array([sizes[i]], dtype=np.uint64)
            for h in flat[starts[i] : starts[i] + sizes[i]]:
                acc = acc * _M + h
            out[starts[i]] = _mixed(acc)[0]
            valid[starts[i]] = True
    return out[valid], counts


def _band_hashes(flat: np.ndarray, counts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """For each text with shingles, the hash of each band."""
    rng = np.random.default_rng(1_009)
    a = rng.integers(0, 2**63, size=bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 2**63, size=bands * rows, dtype=np.uint64)
    own = counts[counts > 0]
    starts = np.cumsum(own) - own
    out = np.zeros((len(own), bands), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(bands * rows):
            least = np.minimum.reduceat(flat * a[k] + b[k], starts)
            out[:, k // rows] = out[:, k // rows] * _M + _mixed(least)
        return _mixed(out + np.arange(bands, dtype=np.uint64))


def _signatures(bands: int, rows: int, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for whole in batches:
            texts = whole.column("text").to_pylist()
            start = size = 0
            cuts = []
            for i, t in enumerate(texts):
                size += len(t or "")
                if size >= SLICE_BYTES or i == len(texts) - 1:
                    cuts.append((start, i + 1))
                    start, size = i + 1, 0
            for i, j in cuts:
                flat, counts = shingles(texts[i:j], hashes, n)
                own = _band_hashes(flat, counts, bands, rows) if len(flat) else np.zeros((0, bands), dtype=np.uint64)
                ends = np.concatenate([[0], np.cumsum(np.where(counts > 0, bands, 0))]).astype(np.int32)
                part = whole.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("key"), pa.array(counts), pa.ListArray.from_arrays(pa.array(ends), pa.array(own.view(np.int64).ravel()))], names=["id", "key", "words", "bands"]
                )

    return run


def _shared(sets: list[np.ndarray], most_cells: int = 6_000_000) -> np.ndarray:
    """How many members each pair of sets has in common."""
    m = len(sets)
    out = np.zeros((m, m), dtype=np.float64)
    members = np.concatenate(sets)
    order = np.argsort(members, kind="stable")
    values, owner = members[order], np.repeat(np.arange(m), [len(s) for s in sets])[order]
    new = np.concatenate([[True], values[1:] != values[:-1]])
    times = np.diff(np.concatenate([np.nonzero(new)[0], [len(values)]]))
    run = np.cumsum(new) - 1
    kept = times[run] > 1  # what one set alone holds is in no intersection
    owner, column = owner[kept], (np.cumsum(times > 1) - 1)[run[kept]]
    step = max(1, most_cells // m)
    cuts = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else -1) + 1 + step, step))
    for k in range(len(cuts) - 1):
        at = slice(cuts[k], cuts[k + 1])
        if cuts[k + 1] > cuts[k]:
            here = np.zeros((m, int(column[at].max()) - k * step + 1), dtype=np.float32)
            here[owner[at], column[at] - k * step] = 1
            out += here @ here.T
    return out


def _linked(group: dict[str, list], similarity: float, n: int, hashes: _Hashes) -> tuple[list[bytes], np.ndarray, list[bytes]]:
    """Keys of a group's texts, their numbers of links here, and the least key each is connected with by them."""
    first: dict[bytes, int] = {}
    for i, k in enumerate(group["key"]):
        first.setdefault(k, i)
    at = [*first.values()]
    keys, bucket = [*first], group["bucket"][0]
    flat, counts = shingles([group["text"][i] for i in at], hashes, n)
    sets = [np.unique(s) for s in np.split(flat, np.cumsum(counts)[:-1])]
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    common = _shared(sets)
    similar = common >= similarity * (sizes[:, None] + sizes[None, :] - common) - 1e-9
    np.fill_diagonal(similar, False)
    # a pair counts in the first bucket that both are in: not here if they share an earlier one
    earlier = [(b, row) for row, i in enumerate(at) for b in group["kept"][i] if b < bucket]
    if earlier:
        values, owners = (np.array(x) for x in zip(*sorted(earlier), strict=True))
        for own in np.split(owners, np.nonzero(values[1:] != values[:-1])[0] + 1):
            if len(own) > 1:
                similar[np.ix_(own, own)] = False
    chunk = np.array([group["chunk"][i] for i in at])
    if group["first"][0] != group["second"][0]:
        similar &= chunk[:, None] != chunk[None, :]
    by_key = sorted(range(len(keys)), key=keys.__getitem__)
    label = np.empty(len(keys), dtype=np.int64)
    label[by_key] = np.arange(len(keys))
    links = similar.sum(axis=1)
    (busy,) = np.nonzero(links)
    if len(busy):
        sub = similar[np.ix_(busy, busy)] | np.eye(len(busy), dtype=bool)
        own = label[busy]
        while True:
            least = np.where(sub, own[None, :], np.iinfo(np.int64).max).min(axis=1)
            if (least == own).all():
                break
            own = least
        label[busy] = own
    return keys, links, [keys[by_key[i]] for i in label]


def _verify(similarity: float, n: int):
    names = ["bucket", "first", "second", "chunk", "key", "kept", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        open_key, group = None, {c: [] for c in names}

        def result() -> pa.RecordBatch:
            keys, links, roots = _linked(group, similarity, n, hashes)
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(links.astype(np.int64)), pa.array(roots, pa.binary())], names=["key", "links", "root"])

        for batch in batches:
            ids = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names[:3]], axis=1)
            cuts = [0, *(np.nonzero((ids[1:] != ids[:-1]).any(axis=1))[0] + 1).tolist(), len(ids)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if open_key is not None and tuple(ids[a]) != open_key:
                    yield result()
                    group = {c: [] for c in names}
                open_key = tuple(ids[a])
                for c in names:
                    group[c] += batch.column(c).slice(a, b - a).to_pylist()
        if open_key is not None:
            yield result()

    return run


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` (a, b): root is the least node it is connected with."""
    both = lambda e: e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
    now = written(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = lambda e: e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    seen = mark(now)
    while True:
        # large star: every larger neighbour of u points to the least of u and its neighbours
        links = both(now)
        least = links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = links.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b")).distinct()
        # small star: u and its smaller neighbours point to the least of those
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b"))).where(F.col("a") != F.col("b")).distinct()
        now = written(small, "edges")
        if (after := mark(now)) == seen:
            break
        seen = after
    return now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.col(id_col).alias("id"), F.unhex(F.md5(text.cast("binary"))).alias("key"), text.alias("text"))


def link_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """Two tables: of all rows (id, key), and of all different texts.

    The latter holds key (md5 of the text), n_docs (rows with that text), least (the least id with a flag for null and
    the number of rows that have it), n_links (other texts at ``similarity`` or more) and root (the class's least key).
    """
    bands, rows = bands_and_rows(similarity, recall)
    with scratch(df.sparkSession) as keep:
        keyed = _keyed(df, id_col, text_col)
        id_type = keyed.schema["id"].dataType.simpleString()
        signed = keep(written(keyed.mapInArrow(_signatures(bands, rows, n), f"id {id_type}, key binary, words long, bands array<bigint>"), "signatures"))
        ids = signed.groupBy("key", "id").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "n")).alias("least"), F.sum("n").alias("n_docs"))
        texts = written(signed.select("key", "words", "bands").dropDuplicates(["key"]), "texts")
        banded = texts.select("key", "words", F.explode("bands").alias("bucket"))
        h = F.xxhash64("key")
        buckets = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.sum("words").alias("w"), F.bit_xor(h).alias("x"), F.sum(F.shiftright(h, 8)).alias("s")).where("m > 1")
        kept = buckets.groupBy("m", "w", "x", "s").agg(F.min("bucket").alias("bucket")).select("bucket", F.greatest(F.lit(1), F.ceil(F.col("m") / CHUNK_TEXTS), F.ceil(F.col("w") / CHUNK_WORDS)).cast("int").alias("chunks"))
        meets = banded.join(kept, "bucket").groupBy("key").agg(F.collect_list(F.struct("bucket", "chunks")).alias("meets"))
        wanted = written(meets.join(ids.select("key", "least"), "key"), "candidates")
        same_id = F.col("k.id").eqNullSafe(F.col("w.least.id"))
        found = keyed.alias("k").join(wanted.alias("w").hint("shuffle_hash"), (F.col("k.key") == F.col("w.key")) & same_id).select(F.col("k.key").alias("key"), "text", "meets", F.col("w.least.n").alias("times"))
        once = found.where("times = 1").unionByName(found.where("times > 1").dropDuplicates(["key"]))
        dealt = once.select("key", "text", F.col("meets.bucket").alias("kept"), F.explode("meets").alias("at")).select("key", "text", "kept", "at.bucket", "at.chunks")
        chunk = F.pmod(F.xxhash64("key", "bucket"), F.col("chunks")).cast("int")
        sent = dealt.withColumn("chunk", chunk).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        groups = sent.select("bucket", F.least("chunk", "other").alias("first"), F.greatest("chunk", "other").alias("second"), "chunk", "key", "kept", "text")
        groups = groups.repartition("bucket", "first", "second").sortWithinPartitions("bucket", "first", "second")
        links = written(groups.mapInArrow(_verify(similarity, n), "key binary, links long, root binary").where("links > 0"), "links")
        roots = components(links.select(F.col("key").alias("a"), F.col("root").alias("b")))
        counts = links.groupBy("key").agg(F.sum("links").alias("n_links"))
        out = ids.join(counts, "key", "left").join(roots.withColumnRenamed("node", "key"), "key", "left")
        return signed.select("id", "key"), keep(written(out.select("key", "n_docs", "least", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "key").alias("root")), "linked"))


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One row per row of ``df``: id, class_id (the class's least id), n_links (other texts linked) and n_copies."""
    rows, texts = link_texts(df, id_col, text_col, **kw)
    heads = texts.groupBy("root").agg(F.min("least").alias("head"))
    named = texts.join(heads, "root").select("key", F.col("head.id").alias("class_id"), "n_links", F.col("n_docs").alias("n_copies"))
    return rows.join(named, "key").select(F.col("id").alias(id_col), "class_id", "n_links", "n_copies")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``df`` that stay when each class keeps the row of least id (of equal rows any one)."""
    _, texts = link_texts(df, id_col, text_col, **kw)
    heads = texts.groupBy("root").agg(F.min(F.struct(F.col("least.none"), F.col("least.id"), "key", F.col("least.n"))).alias("head")).select("head.key", "head.id", "head.n")
    heads = heads.select(F.col("key").alias("head_key"), F.col("id").alias("head_id"), F.col("n").alias("head_n"))
    row, key = free_name(df, "row"), F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
    packed = df.select(F.struct(*df.columns).alias(row), key.alias("own_key"), F.col(id_col).alias("own_id"))
    met = packed.join(heads, (F.col("own_key") == F.col("head_key")) & F.col("own_id").eqNullSafe(F.col("head_id")))
    single = met.where("head_n = 1").select(f"{row}.*")
    several = met.where("head_n > 1").dropDuplicates(["own_key"]).select(f"{row}.*")
    return single.unionByName(several)


def op10_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    return classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP10_SQL = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT text, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS ws FROM (SELECT DISTINCT coalesce(text, '') AS text FROM documents)),
sh AS MATERIALIZED (
  SELECT DISTINCT text, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 4], ' ') END AS s
  FROM (SELECT text, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS MATERIALIZED (SELECT text, count(*) AS n FROM sh GROUP BY text),
links AS MATERIALIZED (
  SELECT p.a, p.b FROM (
    SELECT x.text AS a, y.text AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.text <> y.text GROUP BY x.text, y.text) p
  JOIN n na ON na.text = p.a JOIN n nb ON nb.text = p.b
  WHERE 5 * p.c >= 4 * (na.n + nb.n - p.c)),
reach AS (
  SELECT text, text AS other FROM w
  UNION
  SELECT r.text, l.b FROM reach r JOIN links l ON l.a = r.other),
docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
copies AS (SELECT text, min(doc_id) AS least, count(*) AS n_copies FROM docs GROUP BY text),
cls AS (SELECT r.text, min(c.least) AS class_id FROM reach r JOIN copies c ON c.text = r.other GROUP BY r.text),
nl AS (SELECT a AS text, count(*) AS n_links FROM links GROUP BY a)
SELECT d.doc_id, cls.class_id, coalesce(nl.n_links, 0)::BIGINT AS n_links, copies.n_copies::BIGINT AS n_copies
FROM docs d JOIN cls ON cls.text = d.text JOIN copies ON copies.text = d.text LEFT JOIN nl ON nl.text = d.text
"""
