import time
import tracemalloc

import numpy as np

from quillsieve.llm import chroma as C


def test_chroma_names_the_pitch():
    for pitch in range(12):
        t = np.arange(4096) / C.RATE
        sound = (10000 * np.sin(2 * np.pi * 220 * 2 ** (pitch / 12) * t)).astype("<i2")
        assert (C.chroma(sound).argmax(axis=1) == pitch).all()


def test_integral_image_filters():
    rng = np.random.default_rng(2)
    image = rng.random((40, 12))
    got = C.packed(image)
    for place in (0, 7, 24):
        value = 0
        for kind, low, height, width in C.filters():
            part = image[place : place + width, low : low + height]
            h, w = height // 2, width // 2
            some = {0: part[:, h:].sum(), 1: part[w:].sum(), 2: part[:w, :h].sum() + part[w:, h:].sum(), 3: 1.5 * part[width // 3 : width - width // 3].sum()}[kind]
            answer = (2 * some - part.sum()) / part.sum()
            level = int(answer > -C.LEVEL) + int(answer > 0) + int(answer > C.LEVEL)
            value = value << 2 | (level ^ level >> 1)
        assert got[place] == value
    assert len(C.packed(image[:15])) == 0 and len(C.packed(image[:16])) == 1


def test_clip_is_found_at_its_offset(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, [float(x) for x in rng.normal(size=64)]) for i in range(40)]
    df = spark.createDataFrame(vectors, "id long, v array<double>")
    whole = C.fingerprint(C.recorded(df)).select("id", "codes")
    clips = C.fingerprint(C.recorded(df.where("id % 4 = 0"), clip=True)).select("id", "codes")
    found = {(r.query_id, r.id): r for r in C.align(clips, whole).collect()}
    for i in range(0, 40, 4):
        assert found[i, i].offset == 32 and found[i, i].bit_error < 0.05
    assert len(found) <= 12


def test_brute_force_votes():
    rng = np.random.default_rng(4)
    recs = [rng.integers(0, 50, 80).astype("<u4") for _ in range(5)]
    query = recs[3][20:60]
    codes, owner = np.concatenate(recs), np.repeat(np.arange(5), 80)
    order = np.argsort(codes, kind="stable")
    got = {r: (o, v) for r, o, v in C.best_offset(query, order, codes[order], owner, np.tile(np.arange(80), 5))}
    for r, rec in enumerate(recs):
        votes = {}
        for i, a in enumerate(query):
            for j in np.nonzero(rec == a)[0]:
                votes[j - i] = votes.get(j - i, 0) + 1
        best = max(votes.items(), key=lambda x: (x[1], -x[0]))
        assert (best[1] < C.LEAST_VOTES and r not in got) or got[r] == best
    assert got[3] == (20, 40) and C.bit_error(query, recs[3], 20) == (0.0, 40) and C.bit_error(query, recs[3], 500)[1] == 0


def test_odd_audio(spark, folder):
    df = spark.createDataFrame([(1, None, 1), (2, bytearray(b"\x00"), 2), (3, bytearray(10_000), 3), (None, bytearray(10_000), 4)], "id long, audio binary, codes int")
    out = C.fingerprint(df)
    rows = {r.id: r for r in out.collect()}
    assert out.columns == ["id", "audio", "n_frames", "codes"] and rows[1].n_frames == 0 and len(rows[3].codes) > 0
    vectors = spark.createDataFrame([(0, [0.0] * 64, 0), (0, [0.0] * 64, 0), (50, None, 0), (100, [None], 0), (1, [float("nan")] * 64, 0), (None, [0.5] * 64, 0)], "vec_id long, embedding array<float>, label int")
    rows = C.op2_chroma(spark, folder(embeddings=vectors)).collect()
    assert len(rows) == 6 and {r.class_id for r in rows if r.vec_id == 0} == {0} and all(r.n_codes == 0 for r in rows if r.vec_id in (50, 100))


def test_empty_table(spark, folder):
    assert C.op2_chroma(spark, folder(embeddings=spark.createDataFrame([], "vec_id long, embedding array<float>, label int"))).count() == 0


def test_every_class_that_aligns_is_returned(spark, folder):
    rng = np.random.default_rng(5)
    whole = rng.normal(size=64)
    near = whole.copy()
    near[60:] = rng.normal(size=4)  # the same passage, and another end
    other = rng.normal(size=64)
    vectors = [(0, whole.tolist(), 0), (1, near.tolist(), 0), (2, other.tolist(), 0), (3, whole.tolist(), 0)]
    rows = {r.vec_id: r for r in C.op2_chroma(spark, folder(embeddings=spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int"))).collect()}
    assert {0, 1} <= {m.match_class for m in rows[0].matches} and 3 not in {m.match_class for m in rows[0].matches}
    best = rows[0].matches[0]
    assert (best.match_class, best.offset, best.votes, best.bit_error) == (rows[0].match_class, rows[0].offset, rows[0].votes, rows[0].bit_error)
    assert all(rows[i].matches is None for i in (1, 2, 3))


def test_next_offset_is_tried(spark):
    """The most voted offset of a pair fails the bit-error test, and the next one passes."""
    rng = np.random.default_rng(6)
    query = rng.integers(0, 2**32, 40).astype("<u4")
    query[:10] = 7
    rec = rng.integers(0, 2**32, 200).astype("<u4")
    rec[100:140] = query ^ np.uint32(1)
    rec[105:110] = 7
    rec[0:10] = 7
    found = C.offsets(query, np.argsort(rec, kind="stable"), np.sort(rec), np.zeros(200, dtype=np.int64), np.arange(200))
    assert found[0][1] == 0 and C.bit_error(query, rec, 0)[0] > C.MOST_ERROR
    frame = lambda codes: spark.createDataFrame([(1, bytearray(codes.tobytes()))], "id long, codes binary")
    got = [(r.offset, r.bit_error <= C.MOST_ERROR) for r in C.align(frame(query), frame(rec)).collect()]
    assert got == [(100, True)]


def test_votes_of_frequent_codes(monkeypatch):
    """All three ways of counting give the votes of every pair of equal codes."""
    rng = np.random.default_rng(9)
    recs = [rng.choice([7, 7, 7, 7, 8, 9, 10, 11], n).astype("<u4") for n in (90, 40, 130, 1)] + [np.full(70, 7, dtype="<u4")]
    query = rng.choice([7, 7, 7, 8, 9, 12], 60).astype("<u4")
    codes, owner = np.concatenate(recs), np.repeat(np.arange(len(recs)), [len(r) for r in recs])
    place = np.concatenate([np.arange(len(r)) for r in recs])
    order = np.argsort(codes, kind="stable")
    want = {}
    for r, rec in enumerate(recs):
        for i, a in enumerate(query):
            for j in np.nonzero(rec == a)[0]:
                want[r, j - i] = want.get((r, j - i), 0) + 1
    want = {k: v for k, v in want.items() if v >= C.LEAST_VOTES}
    for pairs, hot in ((10**9, 10**9), (100, 10**9), (100, 50), (100, 1)):
        monkeypatch.setattr(C, "PAIRS", pairs)
        monkeypatch.setattr(C, "HOT", hot)
        got = C.offsets(query, order, codes[order], owner, place)
        assert {(r, o): v for r, o, v in got} == want and len(got) == len(want)
        assert got == sorted(got, key=lambda x: (x[0], -x[2], x[1]))


def test_thousand_silent_recordings():
    """Recordings of one code in different lengths, and one of an hour, within bounded memory and time."""
    sizes = np.array([1000 + i for i in range(1000)] + [57_600])
    block = {"codes": np.full(sizes.sum(), 5, dtype="<u4").tobytes(), "sizes": sizes.tolist(), "ids": list(range(len(sizes)))}
    asked = {"ids": [1, 2], "sizes": [2000, 57_600], "codes": np.full(59_600, 5, dtype="<u4").tobytes()}
    began = time.monotonic()
    tracemalloc.start()
    got = C._aligned(block, asked).to_pydict()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got["query_id"].count(1) == got["query_id"].count(2) == len(sizes)
    assert time.monotonic() - began < 240 and peak < 1_000_000_000


def test_long_audio_in_slices(monkeypatch):
    pcm = np.random.default_rng(1).integers(-9000, 9000, C.HOP * 300 + C.FRAME).astype("<i2")
    whole = C.chroma(pcm)
    monkeypatch.setattr(C, "SLICE_FRAMES", 7)
    assert np.allclose(C.chroma(pcm), whole, atol=1e-5) and len(whole) == 301


def test_blocks_are_bounded_by_codes(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_CODES", 100)
    monkeypatch.setattr(C, "BLOCK", 4)
    rng = np.random.default_rng(8)
    recs = [(i, bytearray(rng.integers(0, 2**32, n).astype("<u4").tobytes())) for i, n in enumerate([30] * 20 + [500, 40, 40])]
    df = spark.createDataFrame(recs, "id long, codes binary")
    got = {(r.query_id, r.id, r.offset, r.votes) for r in C.align(df, df).collect()}
    assert got == {(i, i, 0, len(c) // 4) for i, c in recs}


def test_one_id_with_several_recordings(spark, folder):
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=64).tolist(), rng.normal(size=64).tolist()
    vectors = spark.createDataFrame([(0, a, 0), (0, b, 0), (1, a, 0), (2, b, 0), (0, a, 0)], "vec_id long, embedding array<double>, label int")
    got = [r for r in C.op2_chroma(spark, folder(embeddings=vectors)).collect() if r.vec_id == 0]
    # the two recordings have classes of their own, 0 for both by the least id, and both are found
    assert len(got) == 3 and got[0].matches == got[1].matches == got[2].matches
    assert sorted(r.n_copies for r in got) == [2, 3, 3] and {m.match_class for m in got[0].matches} == {0}


def test_classes_and_matches_against_brute_force(spark, folder):
    """Every class and every accepted alignment of the query, by plain loops over all pairs."""
    rng = np.random.default_rng(12)
    base = [rng.normal(size=48) for _ in range(12)]
    vectors = [(i, base[i % 12].tolist() if i % 5 else np.concatenate([base[i % 12][:24], rng.normal(size=24)]).tolist(), 0) for i in range(110)]
    rows = {r.vec_id: r for r in C.op2_chroma(spark, folder(embeddings=spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int"))).collect()}
    codes = {i: C.packed(C.chroma(C.melody(np.array(v)))) for i, v, _ in vectors}
    least = {}
    for i in sorted(codes):
        least.setdefault(codes[i].tobytes(), i)
    for i, c in codes.items():
        assert rows[i].class_id == least[c.tobytes()] and rows[i].n_codes == len(c)
        assert rows[i].n_copies == sum(x.tobytes() == c.tobytes() for x in codes.values())
    for q in (0, 50, 100):
        sound = C.melody(np.array(dict((i, v) for i, v, _ in vectors)[q]))
        part = sound[len(sound) // 4 : 3 * len(sound) // 4].astype(float)
        part = np.clip(np.round(part + np.random.default_rng(q).normal(0, 200, size=len(part))), -32768, 32767).astype("<i2")
        query, want = C.packed(C.chroma(part)), {}
        for k in least.values():
            votes = {}
            for i, x in enumerate(query):
                for j in np.nonzero(codes[k] == x)[0]:
                    votes[int(j) - i] = votes.get(int(j) - i, 0) + 1
            for o, v in sorted(votes.items(), key=lambda x: (-x[1], x[0])):
                both = [(x, codes[k][i + o]) for i, x in enumerate(query) if 0 <= i + o < len(codes[k])]
                error = sum(int(x ^ y).bit_count() for x, y in both) / (32 * len(both))
                if v >= C.LEAST_VOTES and error <= C.MOST_ERROR and len(both) >= min(C.LEAST_OVERLAP, len(query)):
                    want[k] = (o, v, len(both))
                    break
        assert {m.match_class: (m.offset, m.votes, m.overlap) for m in rows[q].matches or []} == want and want
