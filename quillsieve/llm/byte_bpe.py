"""Byte-level BPE by DuckDB recursive queries, one in-process database per partition.

Text is split by the tokenizer's pattern. A piece that is itself a token keeps that id. Every other distinct piece
becomes a row of byte tokens, and a recursive query joins its token positions to the merge table and contracts the
leftmost pair of least rank, until no pair of the piece is in the table. Decoding joins id positions to the
vocabulary and concatenates with an ordered aggregate.

A recursive query keeps the rows of all its rounds, and a piece has up to as many rounds as bytes. So pieces go to a
query in groups whose bytes squared sum to ``GROUP_WORK`` at most, and a piece of more than ``WALK_BYTES`` (one word of
thousands of letters) is contracted in the same order with a heap of its pairs, in n log n steps. All three ways give
the leftmost rule's result, so the choice by length is one of plan only.

Defined cases: a null text is an empty text (no ids, empty bytes). Lone surrogates cannot occur in Spark strings. A
text is never cut: one over ``SLICE_BYTES`` is a slice of its own, and words of any length are encoded whole. Ties of
rank go to the leftmost pair. Rows are independent, so repeated rows give equal ids; an empty table gives an empty
result. All other columns pass through; an output column that exists already is replaced, compared without case.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsieve.llm.common import table

#: Text bytes that are split and encoded at once; a single longer text is taken whole.
SLICE_BYTES = 2_000_000
#: Pieces whose ids are remembered within a task (some 80 MB), and the longest such piece in bytes.
CACHE_PIECES, CACHE_BYTES = 400_000, 40
#: Pieces longer than this many bytes are walked with a heap, and a bound of the sum of squared lengths of a query's pieces.
WALK_BYTES, GROUP_WORK = 512, 8_000_000
#: Ids that are decoded at once.
SLICE_IDS = 500_000

#: One contraction of each piece a round: ``w`` piece, ``ids`` its tokens, ``go`` whether the last round changed it.
CONTRACT = """
WITH RECURSIVE s(w, ids, go) AS (
  SELECT w, ids, true FROM pieces
  UNION ALL
  SELECT s.w,
         CASE WHEN m.p IS NULL THEN s.ids ELSE s.ids[:m.p - 1] || [m.r] || s.ids[m.p + 2:] END,
         m.p IS NOT NULL
  FROM s LEFT JOIN (
    SELECT w, min(rank)::INT AS r, arg_min(p, rank::BIGINT * 4294967296 + p) AS p
    FROM (SELECT w, ids, unnest(range(1, len(ids))) AS p FROM s WHERE go) x
    JOIN merges ON pair = (ids[p]::BIGINT << 32) | ids[p + 1]
    GROUP BY w) m ON m.w = s.w
  WHERE s.go)
SELECT w, ids FROM s WHERE NOT go
"""

#: Ordered aggregation of the vocabulary's bytes, each byte as the character of that number.
DECODE = """
SELECT d, array_to_string(list(v.chars ORDER BY p), '') AS chars
FROM coded JOIN vocab v ON v.id = coded.id
GROUP BY d
"""


class Tokenizer:
    """A rank file's tokens with the pattern that splits text; sent to the executors as its bytes (under 2 MB)."""

    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = pattern
        if len({*(bytes([i]) for i in range(256))} - self.ranks.keys()):
            raise ValueError("the rank file must hold all 256 bytes")

    def session(self) -> "Session":
        """This process's database for the tokenizer, made once a worker."""
        key = (self.pattern, len(self.ranks), hash(frozenset(self.ranks.items())))
        if key not in _sessions:
            _sessions[key] = Session(self)
        return _sessions[key]


_sessions: dict[tuple, "Session"] = {}


class Session:
    """One worker's DuckDB database with merge table and vocabulary, and a bounded memory of encoded pieces."""

    def __init__(self, tok: Tokenizer):
        import duckdb
        import regex

        self.ranks, self.find = tok.ranks, regex.compile(tok.pattern).findall
        self.bytes_to_id = np.array([tok.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        self.top = max(tok.ranks.values())
        self.known = np.zeros(self.top + 1, dtype=bool)
        self.known[np.fromiter(tok.ranks.values(), dtype=np.int64)] = True
        self.seen: dict[str, bytes] = {}
        self.con = con = duckdb.connect()
        # nothing is spilled to a folder of this machine: GROUP_WORK bounds what a query holds
        con.execute("SET threads = 1; SET memory_limit = '300MB'; SET preserve_insertion_order = false; SET temp_directory = ''")
        left, right, whole = array("i"), array("i"), array("i")
        get = tok.ranks.get
        for t, r in tok.ranks.items():
            for i in range(1, len(t)):
                a, b = get(t[:i], -1), get(t[i:], -1)
                if a >= 0 and b >= 0:
                    left.append(a)
                    right.append(b)
                    whole.append(r)
        con.register("m", pa.table({"pair": np.array(left, dtype=np.int64) << 32 | np.array(right, dtype=np.int64), "rank": np.array(whole, dtype=np.int32)}))
        con.register("v", pa.table({"id": pa.array([*tok.ranks.values()], pa.int32()), "chars": pa.array([t.decode("latin-1") for t in tok.ranks], pa.string())}))
        con.execute("CREATE TABLE merges AS SELECT * FROM m; CREATE TABLE vocab AS SELECT * FROM v")
        con.unregister("m")
        con.unregister("v")

    def _merged(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        queried = [i for i, p in enumerate(pieces) if len(p) <= WALK_BYTES]
        for a, b in _slices([len(pieces[i]) ** 2 for i in queried], GROUP_WORK):
            group = queried[a:b]
            for i, ids in zip(group, self._contracted([pieces[i] for i in group]), strict=True):
                out[i] = ids
        for i, p in enumerate(pieces):
            if len(p) > WALK_BYTES:
                out[i] = self.walked(p)
        return out

    def _contracted(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece of one group, by a recursive query."""
        flat = self.bytes_to_id[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, pieces), dtype=np.int32, count=len(pieces)))]).astype(np.int32)
        self.con.register("pieces", pa.table({"w": pa.array(np.arange(len(pieces), dtype=np.int32)), "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))}))
        got = self.con.sql(CONTRACT).to_arrow_table().combine_chunks()
        self.con.unregister("pieces")
        ids = got["ids"].chunk(0)
        values, ends = ids.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes(), ids.offsets.to_numpy()
        out: list[bytes] = [b""] * len(pieces)
        for i, a, b in zip(got["w"].to_pylist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            out[i] = values[4 * a : 4 * b]
        return out

    def walked(self, piece: bytes) -> bytes:
        """The ids of one piece of any length: pairs leave a heap by rank and then by place, and links skip what was contracted."""
        get, n = self.ranks.get, len(piece)
        end, before = [*range(1, n + 1)], [*range(-1, n - 1)]  # by the start of a token: its end, and the start of the token before it
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := get(piece[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            _, a, m, b = heappop(heap)
            if end[a] != m or m >= n or end[m] != b:
                continue  # one of the two tokens is gone
            end[a], end[m] = b, -1
            if b < n:
                before[b] = a
                if (r := get(piece[a : end[b]])) is not None:
                    heappush(heap, (r, a, b, end[b]))
            if a and (r := get(piece[before[a] : b])) is not None:
                heappush(heap, (r, before[a], a, b))
        ids, a = array("I"), 0
        while a < n:
            ids.append(self.ranks[piece[a : end[a]]])
            a = end[a]
        return np.frombuffer(ids, dtype=f"u{ids.itemsize}").astype("<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids, as little-endian unsigned 32-bit integers."""
        split = [self.find(t) if t else [] for t in texts]
        new = set(chain.from_iterable(split)).difference(self.seen)
        ids, todo = {}, []
        for p in new:
            raw = p.encode()
            if (own := self.ranks.get(raw)) is not None:
                ids[p] = own.to_bytes(4, "little")
            else:
                todo.append((p, raw))
        if todo:
            ids.update(zip((p for p, _ in todo), self._merged([raw for _, raw in todo]), strict=True))
        self.seen.update(ids)
        out = [b"".join(map(self.seen.__getitem__, pieces)) for pieces in split]
        for p in [p for p in ids if len(p) > CACHE_BYTES]:
            del self.seen[p]
        if len(self.seen) > CACHE_PIECES:
            self.seen = {}
        return out

    def decode(self, coded: list[bytes]) -> list[bytes]:
        """The bytes that each row of ids stands for. An id outside the vocabulary is an error."""
        sizes = np.fromiter((len(c) // 4 for c in coded), dtype=np.int64, count=len(coded))
        flat = np.frombuffer(b"".join(coded), dtype="<u4")
        if len(flat) and (flat.max() > self.top or not self.known[flat].all()):
            raise ValueError("an id is not in the vocabulary")
        self.con.register("coded", pa.table({"d": np.repeat(np.arange(len(coded), dtype=np.int32), sizes), "id": flat.astype(np.int32), "p": np.arange(len(flat), dtype=np.int32)}))
        got = self.con.sql(DECODE).to_arrow_table()
        self.con.unregister("coded")
        out = [b""] * len(coded)
        for d, chars in zip(got["d"].to_pylist(), got["chars"].to_pylist(), strict=True):
            out[d] = chars.encode("latin-1")
        return out


def _slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def _with(batch: pa.RecordBatch, names: list[str], new: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([new[n] if n in new else batch.column(n) for n in names], names=names)


def _schema(df: DataFrame, new: list[T.StructField]) -> T.StructType:
    taken = {f.name.lower() for f in new}
    return T.StructType([f for f in df.schema if f.name.lower() not in taken] + new)


def encode(df: DataFrame, tokenizer: Tokenizer, text_col: str = "text", ids_col: str = "ids", count_col: str = "n_tokens", packed: bool = False, decoded_col: str | None = None) -> DataFrame:
    """``df`` with ``count_col`` (long) and ``ids_col``: an array of int or, ``packed``, little-endian unsigned 32-bit binary.

    With ``decoded_col`` the ids are decoded again in the same pass, into a binary column of that name.
    """
    kind = T.BinaryType() if packed else T.ArrayType(T.IntegerType(), False)
    schema = _schema(df, [T.StructField(count_col, T.LongType(), False), T.StructField(ids_col, kind, False)] + ([T.StructField(decoded_col, T.BinaryType(), False)] if decoded_col else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        session = tokenizer.session()
        for whole in batches:
            sizes = pc.fill_null(pc.binary_length(whole.column(text_col)), 0).to_pylist()
            for a, b in _slices(sizes, SLICE_BYTES):
                batch = whole.slice(a, b - a)
                ids = session.encode(batch.column(text_col).to_pylist())
                counts = np.array([len(x) // 4 for x in ids], dtype=np.int64)
                if packed:
                    column = pa.array(ids, pa.binary())
                else:
                    column = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(np.frombuffer(b"".join(ids), dtype="<i4")))
                new = {count_col: pa.array(counts), ids_col: column}
                if decoded_col:
                    new[decoded_col] = pa.array(session.decode(ids), pa.binary())
                yield _with(batch, names, new)

    names = schema.names
    return df.mapInArrow(run, schema)


def decode(df: DataFrame, tokenizer: Tokenizer, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``df`` with ``bytes_col`` (binary): what the ids, in either form of ``encode``, stand for; null ids are no ids."""
    schema = _schema(df, [T.StructField(bytes_col, T.BinaryType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        session = tokenizer.session()
        for whole in batches:
            coded = whole.column(ids_col).to_pylist()
            if not pa.types.is_binary(whole.column(ids_col).type):
                coded = [np.array(x or [], dtype="<u4").tobytes() for x in coded]
            coded = [x or b"" for x in coded]
            for a, b in _slices([len(x) // 4 for x in coded], SLICE_IDS):
                yield _with(whole.slice(a, b - a), names, {bytes_col: pa.array(session.decode(coded[a:b]), pa.binary())})

    names = schema.names
    return df.mapInArrow(run, schema)


def op3_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` encoded and decoded again; see the module for nulls and other cases."""
    import public_tokenizers

    tokenizer = Tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    coded = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer, packed=True, decoded_col="decoded")
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


#: What is white space in a text, as a class of characters.
_SPACE = r"\t-\r\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def op3_sql(path: str) -> str:
    """SQL for ``op3_byte_bpe`` with a rank file, for texts without the last code point.

    Its patterns have no look ahead, so a mark goes before the last of several white spaces, which belongs to the word
    after them. Letters and numbers that Unicode has added of late are classed otherwise there.
    """
    rank = "printf('%02x%02x%02x%02x', rank & 255, (rank >> 8) & 255, (rank >> 16) & 255, rank >> 24)"
    words = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+".replace("'", "''")
    return rf"""
WITH RECURSIVE ranks AS MATERIALIZED (
  SELECT from_base64(token) AS token, rank FROM read_csv('{path}', delim = ' ', header = false, quote = '', escape = '', columns = {{'token': 'VARCHAR', 'rank': 'INTEGER'}})),
whole AS MATERIALIZED (SELECT hex(token) AS token, rank FROM ranks),
d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
parts AS (
  SELECT rid, string_split(regexp_replace(text, '([{_SPACE}]+)([{_SPACE}][^{_SPACE}])', '\1' || chr(1114109) || '\2', 'g'), chr(1114109)) AS parts FROM d),
found AS (SELECT rid, flatten(list_transform(parts, lambda p: regexp_extract_all(p, '{words}'))) AS pieces FROM parts),
placed AS MATERIALIZED (SELECT rid, unnest(pieces) AS piece, unnest(range(1, len(pieces) + 1)) AS place FROM found),
pieces AS MATERIALIZED (SELECT piece, hex(encode(piece)) AS bytes, row_number() OVER () AS w FROM (SELECT DISTINCT piece FROM placed)),
start AS (
  SELECT w, list_transform(range(1, len(bytes) // 2 + 1), lambda i: bytes[2 * i - 1:2 * i]) AS tokens FROM pieces WHERE bytes NOT IN (SELECT token FROM whole)),
steps(w, tokens, going) AS (
  SELECT w, tokens, true FROM start
  UNION ALL
  SELECT s.w, CASE WHEN m.p IS NULL THEN s.tokens ELSE s.tokens[:m.p - 1] || [s.tokens[m.p] || s.tokens[m.p + 1]] || s.tokens[m.p + 2:] END, m.p IS NOT NULL
  FROM steps s LEFT JOIN (
    SELECT w, arg_min(p, rank * 4294967296::BIGINT + p) AS p
    FROM (SELECT w, unnest(range(1, len(tokens))) AS p, tokens FROM steps WHERE going) x JOIN whole ON whole.token = tokens[p] || tokens[p + 1] GROUP BY w) m ON m.w = s.w
  WHERE s.going),
merged AS (SELECT w, unnest(tokens) AS token, unnest(range(1, len(tokens) + 1)) AS k FROM steps WHERE NOT going),
ids AS MATERIALIZED (
  SELECT w, string_agg({rank}, '' ORDER BY k) AS ids, count(*) AS n
  FROM merged JOIN whole USING (token) GROUP BY w
  UNION ALL
  SELECT w, {rank}, 1 FROM pieces JOIN whole ON whole.token = bytes),
coded AS (SELECT rid, sum(n)::BIGINT AS n_tokens, string_agg(ids, '' ORDER BY place) AS ids FROM placed JOIN pieces USING (piece) JOIN ids USING (w) GROUP BY rid)
SELECT doc_id, coalesce(n_tokens, 0)::BIGINT AS n_tokens, sha256(unhex(coalesce(ids, ''))) AS ids_sha256, sha256(text) AS decoded_sha256 FROM d LEFT JOIN coded USING (rid)
"""
