"""Byte-level BPE encoding and decoding by recursive DuckDB queries inside each partition.

A task splits its texts by the tokenizer's pattern, gathers the distinct pieces that its worker has not met yet, lays them
out as token-position rows and lets one recursive query contract, in every piece at once, the leftmost pair of least rank
until no pair of the merge table is left. Texts are then put together from their pieces. Decoding cuts the ids before each
token that begins with a space, joins the distinct cuts' rows with the vocabulary and concatenates in position order.

Null and empty texts have no tokens. Equal rows give equal results; the input's other columns are ignored unless named in
``keep``. An empty table gives an empty table. Pieces over ``LONG`` bytes take a second query, which contracts all
non-overlapping leftmost occurrences of the least pair in one step where no token built on the new one has a lower rank,
and stops after each 64 steps so that past steps do not pile up.
"""

from __future__ import annotations

import base64
import ctypes
import os
import tempfile
from collections.abc import Iterator
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placemetrics.llm.common import slices, table

#: Bytes of a piece beyond which the stepwise query runs.
LONG = 256
#: Pieces and cuts of a generation that a worker remembers, and rows of bytes that one query takes.
CACHE, ROWS = 200_000, 200_000
#: Bytes of text that are laid out at a time.
CHUNK = 3 << 20

_SHORT_SQL = """
WITH RECURSIVE st(step, g, id) AS (
  SELECT 0, g, id FROM start_rows
  UNION ALL (
    WITH linked AS (
      SELECT step, g, id, lead(id) OVER o AS next_id, lead(g) OVER o AS next_g, lag(g) OVER o AS last_g
      FROM st WINDOW o AS (ORDER BY g)),
    best AS (
      SELECT l.g >> 24 AS piece, min((m.rank::BIGINT << 24) | (l.g & 16777215)) AS b
      FROM linked l JOIN merges m ON m.pair = l.id::BIGINT * 16777216 + l.next_id
      WHERE l.next_g >> 24 = l.g >> 24 GROUP BY 1)
    SELECT step + 1, g, CASE WHEN (g & 16777215) = (b & 16777215) THEN (b >> 24)::INT ELSE id END
    FROM linked JOIN best ON piece = g >> 24
    WHERE last_g IS NULL OR last_g <> ((piece << 24) | (b & 16777215))))
SELECT st.g >> 24 AS piece, list(id ORDER BY st.g) AS ids
FROM st JOIN (SELECT g >> 24 AS piece, max(step) AS step FROM st GROUP BY 1) f ON f.piece = st.g >> 24 AND f.step = st.step
GROUP BY 1
"""

_LONG_SQL = """
WITH RECURSIVE st(step, piece, pos, id) AS (
  SELECT 0, piece, pos, id FROM long_rows
  UNION ALL (
    WITH linked AS (
      SELECT step, piece, pos, id, row_number() OVER o AS rn, lead(id) OVER o AS next_id
      FROM st WINDOW o AS (PARTITION BY piece ORDER BY pos)),
    ranked AS (SELECT l.*, m.rank, m.safe FROM linked l LEFT JOIN merges m ON m.pair = l.id::BIGINT * 16777216 + l.next_id),
    hits AS (
      SELECT *, rank = best AND (safe OR pos = first_value(pos) OVER (PARTITION BY piece ORDER BY rank = best DESC NULLS LAST, pos)) AS hit
      FROM (SELECT *, min(rank) OVER (PARTITION BY piece) AS best FROM ranked) WHERE best IS NOT NULL),
    runs AS (SELECT *, rn - sum(coalesce(hit, false)::INT) OVER (PARTITION BY piece ORDER BY pos) AS run FROM hits),
    taken AS (
      SELECT *, coalesce(hit, false) AND row_number() OVER (PARTITION BY piece, run, coalesce(hit, false) ORDER BY pos) % 2 = 1 AS take
      FROM runs)
    SELECT step + 1, piece, pos, CASE WHEN take THEN best ELSE id END FROM (
      SELECT *, lag(take) OVER (PARTITION BY piece ORDER BY pos) AS gone FROM taken)
    WHERE gone IS NOT TRUE AND step < 64))
SELECT st.piece, pos, id, f.step FROM st JOIN (SELECT piece, max(step) AS step FROM st GROUP BY 1) f ON f.piece = st.piece AND f.step = st.step
"""

_DECODE_SQL = "SELECT piece, unhex(string_agg(hex, '' ORDER BY pos)) AS bytes FROM cut_rows JOIN vocab USING (id) GROUP BY piece"


class _Known(dict):
    """What a worker remembers: two generations, the older one dropped when the younger is full. What is used stays."""

    def __init__(self) -> None:
        super().__init__()
        self.older: dict = {}

    def missing(self, keys: list) -> list:
        """Makes room, takes keys over from the older generation, and gives those that neither holds."""
        if len(self) > CACHE:
            self.older = dict(self)
            self.clear()
        new = [k for k in keys if k not in self]
        self.update((k, self.older[k]) for k in new if k in self.older)
        return [k for k in new if k not in self]


class _Codec:
    """The merge table and vocabulary in DuckDB, with what this worker has encoded and decoded already."""

    def __init__(self, ranks_file: bytes, pattern: str):
        import duckdb
        import pyarrow as pa
        import regex

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks_file.splitlines() if line)}
        self.pattern = regex.compile(pattern)
        self.pieces, self.cuts = _Known(), _Known()
        self.byte_ids = np.array([ranks.get(bytes([i]), -1) for i in range(256)], dtype=np.int32)
        self.opens = np.zeros(max(ranks.values()) + 1, dtype=bool)
        splits = []
        for token, rank in ranks.items():
            self.opens[rank] = token[:1] == b" "
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    splits.append((left, right, rank))
        left, right, rank = (np.array(x, dtype=np.int64) for x in zip(*splits, strict=True))
        least = np.full(len(self.opens), np.iinfo(np.int64).max)  # of the tokens that have a token as a part
        np.minimum.at(least, left, rank)
        np.minimum.at(least, right, rank)
        spill = f"{tempfile.gettempdir()}/duckdb-{os.getpid()}"  # the task's own folder; used only by a piece beyond the limit
        limits = {"threads": 1, "memory_limit": "256MB", "temp_directory": spill, "allocator_flush_threshold": "16MB"}
        self.con = duckdb.connect(":memory:", config=limits)
        merges = pa.table({"pair": left * 16777216 + right, "rank": pa.array(rank, pa.int32()), "safe": least[rank] > rank})
        vocab = pa.table({"id": pa.array(ranks.values(), pa.int32()), "hex": [t.hex() for t in ranks]})
        for name, rows in (("merges", merges), ("vocab", vocab)):
            self.con.register("loading", rows)
            self.con.execute(f"CREATE TABLE {name} AS FROM loading")
            self.con.unregister("loading")

    def rest(self) -> None:
        """Gives back what texts have taken: other stages use the worker after this task."""
        import pyarrow as pa

        self.pieces, self.cuts = _Known(), _Known()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    def _rows(self, name: str, columns: dict, sql: str):
        import pyarrow as pa

        self.con.register(name, pa.table(columns))
        try:
            return self.con.sql(sql).to_arrow_table()
        finally:
            self.con.unregister(name)

    def _learn_pieces(self, new: list[str]) -> None:
        import pyarrow as pa

        raw = [w.encode() for w in new]
        short = [i for i, b in enumerate(raw) if len(b) <= LONG]
        while short:
            lengths = np.array([len(raw[i]) for i in short])
            n = max(1, int(np.searchsorted(np.cumsum(lengths), ROWS, side="right")))
            batch, short, lengths = short[:n], short[n:], lengths[:n]
            ids = self.byte_ids[np.frombuffer(b"".join(raw[i] for i in batch), dtype=np.uint8)]
            at = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            found = self._rows("start_rows", {"g": (np.repeat(np.arange(n), lengths) << 24) | at, "id": ids}, _SHORT_SQL)
            lists = found["ids"].combine_chunks()
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes(), np.asarray(lists.offsets) * 4
            for k, a, b in zip(found["piece"].to_pylist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                self.pieces[new[batch[k]]] = flat[a:b]
        for i in (i for i, b in enumerate(raw) if len(b) > LONG):
            ids, steps = self.byte_ids[np.frombuffer(raw[i], dtype=np.uint8)], 64
            while steps == 64:
                columns = {"piece": np.zeros(len(ids), dtype=np.int32), "pos": np.arange(len(ids)), "id": pa.array(ids, pa.int32())}
                found = self._rows("long_rows", columns, _LONG_SQL).sort_by("pos")
                ids, steps = found["id"].to_numpy(), found["step"][0].as_py()
            self.pieces[new[i]] = ids.astype("<u4").tobytes()

    def _coded(self, pieces, known: _Known, learn, ends: np.ndarray):
        """Runs of pieces with each piece replaced by what is known of it; ``ends`` has the number of pieces up to each run's end."""
        import pyarrow as pa

        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if new := known.missing(distinct):
            learn(new)
        flat = pa.array([known[x] for x in distinct], pa.large_binary()).take(coded.indices)
        offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
        at = np.concatenate(([offsets[0] if len(offsets) else 0], offsets[ends] if len(offsets) else ends)).astype(np.int64)
        return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(at), flat.buffers()[2]])

    def encode(self, texts: list[str]):
        """The ids of each text, as little-endian unsigned 32-bit integers, in an Arrow array."""
        import pyarrow as pa

        split = [self.pattern.findall(t) for t in texts]
        ends = np.cumsum([len(x) for x in split], dtype=np.int64)
        return self._coded(pa.array(list(chain.from_iterable(split)), pa.large_string()), self.pieces, self._learn_pieces, ends)

    def decode(self, packed):
        """The bytes of each run of ids of an Arrow array."""
        import pyarrow as pa

        bounds, data = np.frombuffer(packed.buffers()[1], np.int64)[packed.offset : packed.offset + len(packed) + 1], packed.buffers()[2]
        if not len(bounds) or bounds[0] == bounds[-1]:
            return pa.array([b""] * len(packed), pa.large_binary())
        first, last = int(bounds[0]) // 4, int(bounds[-1]) // 4
        opens = np.flatnonzero(self.opens[np.frombuffer(data, "<u4")[first:last]]) + first
        edges = np.sort(np.concatenate((opens * 4, bounds)), kind="stable")
        edges = edges[np.concatenate(([True], edges[1:] != edges[:-1]))]
        cuts = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), data])
        return self._coded(cuts, self.cuts, self._learn_cuts, np.searchsorted(edges, bounds[1:]))

    def _learn_cuts(self, new: list[bytes]) -> None:
        while new:
            lengths = np.array([len(c) // 4 for c in new])
            n = max(1, int(np.searchsorted(np.cumsum(lengths), ROWS, side="right")))
            batch, new, lengths = new[:n], new[n:], lengths[:n]
            ids = np.frombuffer(b"".join(batch), dtype="<u4").astype(np.int32)
            found = self._rows("cut_rows", {"piece": np.repeat(np.arange(n), lengths), "pos": np.arange(len(ids)), "id": ids}, _DECODE_SQL)
            for k, b in zip(found["piece"].to_pylist(), found["bytes"].to_pylist(), strict=True):
                self.cuts[batch[k]] = b


_CODECS: dict[tuple[bytes, str], _Codec] = {}


def _codec(ranks_file: bytes, pattern: str) -> _Codec:
    """One codec for each worker process, kept between its tasks."""
    import hashlib

    key = (hashlib.sha256(ranks_file).digest(), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = _Codec(ranks_file, pattern)
    return _CODECS[key]


def transcode(df: DataFrame, keep: list[str], ranks: bytes, pattern: str, source: str = "text", encode: bool = True, decode: bool = False) -> DataFrame:
    """``keep`` columns, then n_tokens and ids (packed little-endian unsigned 32-bit integers), then, on request, decoded (bytes).

    ``source`` holds texts when encoding and packed ids when only decoding; nulls count as empty.
    """
    made = [("n_tokens", "long"), ("ids", "binary")] * encode + [("decoded", "binary")] * decode
    rows = df.select(*keep, F.col(source).alias("__source"))
    schema = T.StructType([*rows.select(*keep).schema.fields, *(T.StructField(n, T.LongType() if t == "long" else T.BinaryType()) for n, t in made)])
    shared = df.sparkSession.sparkContext.broadcast(ranks)  # a tokenizer's file: its size does not follow the data

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        codec = _codec(shared.value, pattern)
        for whole in batches:
            for batch in slices(whole, "__source", CHUNK):
                given = [v if v is not None else ("" if encode else b"") for v in batch.column("__source").to_pylist()]
                out = [batch.column(i) for i in range(len(keep))]
                ids = codec.encode(given) if encode else pa.array(given, pa.large_binary())
                if encode:
                    out += [pc.divide(pc.binary_length(ids), 4), ids.cast(pa.binary())]
                if decode:
                    out.append(codec.decode(ids).cast(pa.binary()))
                yield pa.RecordBatch.from_arrays(out, names=schema.names)
        codec.rest()

    return rows.mapInArrow(run, schema)


def rank_file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of documents encoded and decoded; the digests are taken from the operator's ids and bytes."""
    import public_tokenizers as tokenizers

    ranks = rank_file(tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = transcode(table(spark, sf_dir, "documents"), ["doc_id"], ranks, tokenizers.PATTERN, decode=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op1_bpe": op1_bpe}
SQL: dict[str, str] = {}
