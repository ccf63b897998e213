"""Chroma fingerprints of audio columns, and alignment of recordings by offset histograms and bit errors.

Audio is 16-bit little-endian PCM, one channel. Windowed spectra are folded into twelve pitch classes a frame. On the
integral image of those frames, sixteen filters compare sums of rectangles at every place; each answer becomes two bits
in Gray code, so a place gives one packed 32-bit integer. Two recordings align where many of their equal integers lie
the same number of frames apart: a histogram of those offsets proposes some, the most voted first, and the share of
differing bits along the overlap accepts one.

Recordings with equal fingerprints form a class, and a search compares queries with one recording of each class: a task
holds a few blocks of recordings, and blocks of queries stream past them. Blocks are bounded by their codes as well as
by their recordings. Votes are counted for all recordings of a block at once while their pairs of equal codes are few;
where they are many (silence, drones), recording by recording, and there a code that is frequent on both sides is
counted for all offsets at once by a Fourier transform, so time and memory do not grow with the product of its counts.

Defined cases: audio that is null or shorter than a frame has no frames; a fingerprint needs ``SPAN`` frames, and a
recording without integers belongs to no class and matches nothing. Silence has all-equal integers. Long audio is
transformed in slices of frames and fingerprinted whole. Repeated rows share a class. An id with several recordings asks
with each of them, and gets of each class the alignment with the lowest bit error, then the most votes. Other ties go to
the lower bit error and then the smaller class. An empty table gives an empty result. Input columns named like an output
column are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsieve.llm.common import free_name, met, table, written

#: Samples a second, samples in a frame and between frames, lowest and highest pitch in Hz.
RATE, FRAME, HOP, LOWEST, HIGHEST = 2048, 512, 128, 100.0, 1000.0
#: Frames that the widest filter covers, and the bound between small and large answers.
SPAN, LEVEL = 16, 0.12
#: Votes for an offset, overlap in integers, and the highest share of differing bits of an accepted alignment.
LEAST_VOTES, LEAST_OVERLAP, MOST_ERROR = 4, 16, 0.25
#: Recordings and queries in a block, integers in a block at most (but for a single longer recording), and blocks of
#: recordings that a task holds, about.
BLOCK, QUERIES, BLOCK_CODES, LANE_BLOCKS = 1024, 256, 1_000_000, 4
#: Pairs of equal integers that are counted at once, and the pairs of one integer from which a Fourier transform counts them.
PAIRS, HOT = 2_000_000, 100_000
#: Frames that are transformed at once.
SLICE_FRAMES = 8192


def filters() -> list[tuple[int, int, int, int]]:
    """(kind, first pitch class, pitch classes, frames) by rule: kinds and sizes in turn, so that all pitches are seen."""
    out = []
    for i in range(16):
        height, width = (4, 6, 8, 12)[i // 4], (SPAN // 2, SPAN)[i % 2]
        out.append((i % 4, (5 * i) % (13 - height), height, width))
    return out


def chroma(pcm: np.ndarray, rate: int = RATE) -> np.ndarray:
    """A row of twelve pitch-class shares for each frame."""
    n = max(0, (len(pcm) - FRAME) // HOP + 1)
    if not n:
        return np.zeros((0, 12))
    frames = np.lib.stride_tricks.sliding_window_view(pcm, FRAME)[::HOP][:n]
    hz = np.fft.rfftfreq(FRAME, 1 / rate)
    used = (hz >= LOWEST) & (hz <= HIGHEST)
    fold = np.zeros((len(hz), 12), dtype=np.float32)
    fold[np.nonzero(used)[0], np.round(12 * np.log2(hz[used] / 440.0)).astype(int) % 12] = 1
    window = np.hanning(FRAME).astype(np.float32)
    out = np.concatenate([np.abs(np.fft.rfft(frames[i : i + SLICE_FRAMES].astype(np.float32) * window, axis=1)) ** 2 @ fold for i in range(0, n, SLICE_FRAMES)])
    return out / np.maximum(np.sqrt((out**2).sum(axis=1, keepdims=True)), 1e-6)


def packed(image: np.ndarray) -> np.ndarray:
    """The 32-bit integer at every place where the widest filter fits."""
    places = len(image) - SPAN + 1
    if places <= 0:
        return np.zeros(0, dtype=np.uint32)
    total = np.zeros((len(image) + 1, 13))
    total[1:, 1:] = image.cumsum(axis=0).cumsum(axis=1)
    at = np.arange(places)
    area = lambda t0, t1, p0, p1: total[at + t1, p1] - total[at + t0, p1] - total[at + t1, p0] + total[at + t0, p0]
    out = np.zeros(places, dtype=np.uint32)
    for kind, low, height, width in filters():
        high, middle, half = low + height, low + height // 2, width // 2
        whole = area(0, width, low, high)
        if kind == 0:  # upper against lower pitches
            part = area(0, width, middle, high)
        elif kind == 1:  # later against earlier
            part = area(half, width, low, high)
        elif kind == 2:  # two diagonal quarters against the others
            part = area(0, half, low, middle) + area(half, width, middle, high)
        else:  # the middle third of the time, twice, against the rest
            part = 1.5 * area(width // 3, width - width // 3, low, high)
        answer = (2 * part - whole) / np.maximum(whole, 1e-6)
        level = (answer > -LEVEL).astype(np.uint32) + (answer > 0) + (answer > LEVEL)
        out = out << np.uint32(2) | (level ^ (level >> np.uint32(1))).astype(np.uint32)
    return out


def fingerprint(df: DataFrame, audio_col: str = "audio", codes_col: str = "codes", frames_col: str = "n_frames", drop_audio: bool = False) -> DataFrame:
    """``df`` with ``frames_col`` (int) and ``codes_col`` (binary: little-endian unsigned 32-bit integers)."""
    keep = [c for c in df.columns if c.lower() not in (codes_col.lower(), frames_col.lower()) and not (drop_audio and c == audio_col)]
    audio = free_name(df, "audio_of_row")
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(frames_col, T.IntegerType(), False), T.StructField(codes_col, T.BinaryType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frames, codes = [], []
            for x in batch.column(audio):
                raw = x.as_py() or b""
                image = chroma(np.frombuffer(raw[: len(raw) // 2 * 2], "<i2"))
                frames.append(len(image))
                codes.append(packed(image).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(frames, pa.int32()), pa.array(codes, pa.binary())], names=[*keep, frames_col, codes_col])

    return df.withColumn(audio, F.col(audio_col)).select(*keep, audio).mapInArrow(run, schema)


def _blocks(rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        lane = TaskContext.get().partitionId()
        for batch in batches:
            ids, codes = batch.column("id").to_pylist(), batch.column("codes").to_pylist()
            start = total = 0
            for i, c in enumerate([*codes, None]):
                if i > start and (c is None or i - start == rows or total + len(c) // 4 > BLOCK_CODES):
                    part = codes[start:i]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lane], pa.int32()), pa.array([ids[start:i]], pa.list_(pa.int64())), pa.array([[len(x) // 4 for x in part]], pa.list_(pa.int32())), pa.array([b"".join(part)], pa.binary())],
                        names=["lane", "ids", "sizes", "codes"],
                    )
                    start, total = i, 0
                total += len(c or b"") // 4

    return run


_ones = np.array([bin(i).count("1") for i in range(256)], dtype=np.int64)


def _paired(query: np.ndarray, rec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of one recording that have votes, and the votes, in memory bounded by ``PAIRS`` and the two lengths."""
    base = len(query) - 1  # the offset o is counted at o + base
    votes = np.zeros(len(query) + len(rec) - 1, dtype=np.int64)
    by_query, by_rec = np.argsort(query, kind="stable"), np.argsort(rec, kind="stable")
    values, first, times = np.unique(query[by_query], return_index=True, return_counts=True)
    low, high = np.searchsorted(rec[by_rec], values, "left"), np.searchsorted(rec[by_rec], values, "right")
    pairs = times * (high - low)
    for v in np.nonzero(pairs >= HOT)[0]:
        size = 1 << (len(votes) - 1).bit_length()
        a, b = np.zeros(size), np.zeros(size)
        a[base - by_query[first[v] : first[v] + times[v]]] = 1
        b[by_rec[low[v] : high[v]]] = 1
        votes += np.rint(np.fft.irfft(np.fft.rfft(a) * np.fft.rfft(b), size)[: len(votes)]).astype(np.int64)
    few = np.nonzero((pairs > 0) & (pairs < HOT))[0]
    for cut in np.split(few, np.nonzero(np.diff(np.cumsum(pairs[few]) // PAIRS))[0] + 1):
        if len(cut):
            which = np.repeat(cut, pairs[cut])
            turn = np.arange(len(which)) - np.repeat(np.cumsum(pairs[cut]) - pairs[cut], pairs[cut])
            wide = (high - low)[which]
            votes += np.bincount(by_rec[low[which] + turn % wide] - by_query[first[which] + turn // wide] + base, minlength=len(votes))
    (at,) = np.nonzero(votes)
    return at - base, votes[at]


def voted(query: np.ndarray, order: np.ndarray, values: np.ndarray, owner: np.ndarray, place: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each recording with its offsets of ``LEAST_VOTES`` or more votes, and these votes, the most voted first.

    ``values`` are all codes in order.
    """
    low, high = np.searchsorted(values, query, "left"), np.searchsorted(values, query, "right")
    times = high - low
    if 0 < times.sum() <= PAIRS:
        which = np.repeat(np.arange(len(query)), times)
        at = order[np.repeat(low - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))]
        span = np.int64(1 << 31)
        keys, votes = np.unique(owner[at] * (2 * span) + (place[at] - which + span), return_counts=True)
        keys, votes = keys[votes >= LEAST_VOTES], votes[votes >= LEAST_VOTES]
        recs, firsts = np.unique(keys // (2 * span), return_index=True)
        for rec, a, b in zip(recs.tolist(), firsts, [*firsts[1:], len(keys)][: len(recs)], strict=True):
            best = np.lexsort((keys[a:b], -votes[a:b]))
            yield rec, keys[a:b][best] % (2 * span) - span, votes[a:b][best]
    elif times.sum():
        codes = np.empty(len(values), dtype=values.dtype)
        codes[order] = values
        ends = np.nonzero(np.diff(owner))[0] + 1
        for a, b in zip([0, *ends], [*ends, len(codes)], strict=True):
            offset, votes = _paired(query, codes[a:b])
            offset, votes = offset[votes >= LEAST_VOTES], votes[votes >= LEAST_VOTES]
            best = np.lexsort((offset, -votes))
            yield int(owner[a]), offset[best], votes[best]


def offsets(query: np.ndarray, order: np.ndarray, values: np.ndarray, owner: np.ndarray, place: np.ndarray) -> list[tuple[int, int, int]]:
    """(recording, offset, votes) of everything that ``voted`` gives."""
    return [(rec, *x) for rec, o, v in voted(query, order, values, owner, place) for x in zip(o.tolist(), v.tolist(), strict=True)]


def best_offset(query: np.ndarray, order: np.ndarray, values: np.ndarray, owner: np.ndarray, place: np.ndarray) -> list[tuple[int, int, int]]:
    """The first of ``offsets`` with each recording."""
    found = offsets(query, order, values, owner, place)
    return [x for i, x in enumerate(found) if not i or found[i - 1][0] != x[0]]


def bit_error(a: np.ndarray, b: np.ndarray, offset: int) -> tuple[float, int]:
    """The share of bits in which ``a`` and ``b`` from ``offset`` differ, and their overlap."""
    start, end = max(0, -offset), min(len(a), len(b) - offset)
    if end <= start:
        return 1.0, 0
    differ = a[start:end] ^ b[start + offset : end + offset]
    return float(_ones[differ.view(np.uint8)].sum() / (32 * (end - start))), end - start


def _aligned(block: dict, asked: dict) -> pa.RecordBatch:
    codes, sizes, ids = np.frombuffer(block["codes"], "<u4"), np.array(block["sizes"], dtype=np.int64), block["ids"]
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(ids), dtype=np.int64), sizes)
    place = np.arange(len(codes)) - starts[owner]
    order = np.argsort(codes, kind="stable")
    values = codes[order]
    out, at = [], 0
    for q, n in zip(asked["ids"], asked["sizes"], strict=True):
        query = np.frombuffer(asked["codes"], "<u4", n, 4 * at)
        at += n
        for rec, offset, votes in voted(query, order, values, owner, place):
            for o, v in zip(offset, votes, strict=True):
                error, overlap = bit_error(query, codes[starts[rec] : starts[rec] + sizes[rec]], int(o))
                if error <= MOST_ERROR and overlap >= min(LEAST_OVERLAP, n):
                    out.append((q, ids[rec], int(o), int(v), overlap, error))
                    break
    columns = list(zip(*out, strict=True)) or [()] * 6
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["query_id", "id", "offset", "votes", "overlap", "bit_error"])


def align(queries: DataFrame, recordings: DataFrame) -> DataFrame:
    """Every pair of ``queries`` and ``recordings`` (both id, codes) with an accepted alignment, the most voted of these.

    The offset is of the query's start. An id with several recordings among the queries has its pairs for each of them.
    """
    some = lambda df: df.where("id IS NOT NULL AND octet_length(codes) > 0").select(F.col("id").cast("long").alias("id"), "codes")
    layout = "lane int, ids array<bigint>, sizes array<int>, codes binary"
    recordings, queries = some(recordings), some(queries)
    parts = lambda df, rows: df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("codes")), F.lit(0)).alias("b")).select(F.greatest(F.lit(1), F.ceil(F.col("n") / rows), F.ceil(F.col("b") / (4 * BLOCK_CODES))).alias("parts")).first()["parts"]
    lanes = math.ceil(parts(recordings, BLOCK) / LANE_BLOCKS)
    blocks = written(recordings.repartition(lanes).mapInArrow(_blocks(BLOCK), layout), "recordings")
    asked = written(queries.repartition(parts(queries, QUERIES)).mapInArrow(_blocks(QUERIES), layout), "queries").drop("lane")
    return met(blocks, asked, lanes, _aligned, "query_id long, id long, offset int, votes int, overlap int, bit_error double")


def melody(vector: np.ndarray, note: int = 256) -> np.ndarray:
    """A tone of ``note`` samples for each component: its pitch class follows from the value, with two overtones."""
    pitch = 220.0 * 2.0 ** ((np.floor(np.nan_to_num(vector.astype(float), posinf=0, neginf=0) * 64).astype(np.int64) % 12) / 12)
    phase = 2 * np.pi * np.cumsum(np.repeat(pitch, note)) / RATE
    return (9000 * np.sin(phase) + 3000 * np.sin(2 * phase) + 1000 * np.sin(3 * phase)).astype("<i2")


def _recorded(clip: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 500):
                batch = whole.slice(i, 500)
                out = []
                for key, v in zip(batch.column("id").to_pylist(), batch.column("v").to_pylist(), strict=True):
                    if v is None or any(x is None for x in v):
                        out.append(None)
                        continue
                    sound = melody(np.array(v, dtype=float))
                    if clip:  # the middle half, with noise
                        sound = sound[len(sound) // 4 : 3 * len(sound) // 4].astype(float) + np.random.default_rng(abs(key)).normal(0, 200, size=3 * len(sound) // 4 - len(sound) // 4)
                        sound = np.clip(np.round(sound), -32768, 32767).astype("<i2")
                    out.append(sound.tobytes())
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.binary())], names=["id", "audio"])

    return run


def recorded(df: DataFrame, clip: bool = False) -> DataFrame:
    """id, audio: the melody of each vector of ``df`` (id, v); with ``clip`` its middle half under noise."""
    return df.mapInArrow(_recorded(clip), "id long, audio binary")


def op2_chroma(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and class of the recording of every row of ``embeddings``; for rows whose vec_id is divisible by 50,
    also where a noisy clip of it is found among all recordings (offsets in frames): the best match, and in ``matches``
    every class with an accepted alignment, the best first.

    The test tables hold no audio, so each vector is played as a melody, which is the media column here.
    """
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
    prints = written(fingerprint(recorded(rows), drop_audio=True), "fingerprints").select("id", "n_frames", "codes", F.unhex(F.md5("codes")).alias("key"))
    groups = prints.where(F.octet_length("codes") > 0).groupBy("key").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("n_copies"), F.first("codes").alias("codes"))
    groups = written(groups, "classes")
    clips = fingerprint(recorded(rows.where(F.col("id") % 50 == 0).distinct(), clip=True), drop_audio=True).select("id", "codes")
    pairs = align(clips, groups.select(F.col("class_id").alias("id"), "codes"))
    fit = F.struct("bit_error", (-F.col("votes")).alias("order"), "offset")
    found = pairs.groupBy("query_id", "id").agg(F.min_by(F.struct("offset", "votes", "overlap", "bit_error"), fit).alias("one")).select("query_id", "id", "one.*")
    each = F.struct((-F.col("votes")).alias("order"), "bit_error", F.col("id").alias("match_class"), "offset", "votes", "overlap")
    fields = ["match_class", "offset", "votes", "overlap", "bit_error"]
    matches = F.transform(F.array_sort(F.collect_list(each)), lambda m: F.struct(*[m[c].alias(c) for c in fields]))
    first = found.groupBy(F.col("query_id").alias("id")).agg(matches.alias("matches")).select("id", *[F.col("matches")[0][c].alias(c) for c in fields], "matches")
    named = prints.select("id", "n_frames", (F.octet_length("codes") / 4).cast("int").alias("n_codes"), F.sha2("codes", 256).alias("codes_sha256"), "key")
    out = named.join(groups.select("key", "class_id", "n_copies"), "key", "left").drop("key").join(first, "id", "left")
    return out.withColumnRenamed("id", "vec_id")
