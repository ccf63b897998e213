import random

import duckdb
import pytest
from pyspark.sql import functions as F

from quillsieve.llm import jaccard_join as J

from .conftest import DOCS


def sets(text):
    words = (text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """doc_id -> (class, links) by comparing all different texts."""
    texts = sorted({t or "" for _, t in rows})
    shingled = {t: sets(t) for t in texts}
    links = {t: [u for u in texts if u != t and shingled[t] and shingled[u] and 5 * len(shingled[t] & shingled[u]) >= 4 * len(shingled[t] | shingled[u])] for t in texts}
    root = {}
    for t in texts:
        todo = [t]
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = t
                todo += links[x]
    least = {}
    for i, t in rows:
        r = root[t or ""]
        if i is not None and (least.get(r) is None or i < least[r]):
            least[r] = i
    return sorted(((i, least.get(root[t or ""]), len(links[t or ""])) for i, t in rows), key=str)


def near_copies(seed, groups, size, words):
    rng = random.Random(seed)
    out = []
    for _ in range(groups):
        base = [f"w{rng.randrange(500)}" for _ in range(words)]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            out.append(" ".join(copy))
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = J.classes(df).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == brute(rows)


def test_bands_reach_the_recall():
    bands, rows = J.bands_and_rows(0.8, 0.999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999 and bands * rows <= 200


def test_groups_of_near_copies(spark):
    texts = near_copies(1, 12, 9, 60) + near_copies(2, 5, 6, 12) + near_copies(3, 40, 1, 80)
    check(spark, [(i, t) for i, t in enumerate(texts + texts[:7])])


def test_large_group_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(J, "CHUNK_TEXTS", 32)
    check(spark, [(i, t) for i, t in enumerate(near_copies(4, 2, 120, 50))])


def test_same_rows_as_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    want = con.execute(f"SELECT doc_id, class_id, n_links, n_copies FROM ({J.OP10_SQL}) x").fetchall()
    got = J.op10_jaccard_join(spark, "/root/testdata/sf0.001").select("doc_id", "class_id", "n_links", "n_copies").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_odd_rows(spark, odd_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    check(spark, rows)
    kept = J.keep_one(odd_documents).collect()
    assert sorted((r.doc_id for r in kept), key=str) == [1, 2, 3, 4, 7]
    assert J.classes(odd_documents.limit(0)).count() == 0 and J.keep_one(odd_documents.limit(0)).count() == 0


def test_clashing_names_and_null_ids(spark):
    df = spark.createDataFrame([(None, "a b c d e f", 1), (None, "a b c d e f", 1), (9, "q", 2)], "doc_id long, text string, key int").withColumn("root", F.lit(1)).withColumn("head_id", F.lit(2))
    kept = J.keep_one(df)
    assert kept.columns == df.columns and kept.count() == 2
    assert sorted((r.class_id for r in J.classes(df).collect()), key=str) == [9, None, None]


def test_keep_one_keeps_the_least_id(spark):
    texts = near_copies(5, 6, 5, 70)
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts + texts)], DOCS)
    classes = {r.doc_id: r.class_id for r in J.classes(df).collect()}
    kept = [r.doc_id for r in J.keep_one(df).collect()]
    assert sorted(kept) == sorted(set(classes.values()))


@pytest.mark.parametrize("edges", [[(1, 2), (2, 3), (5, 4), (4, 9), (9, 1)], [(i, i + 1) for i in range(40)], [], [(0, i) for i in range(1, 30)] + [(50, 51)]])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    for _ in edges:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in J.components(df).collect()}
    assert {k: got.get(k, k) for k in root} == root
