"""BPE encoding with content-defined chunk reuse, and decoding.

1. A text's bytes are cut where a rolling hash of the last eight bytes hits a
   mask, so a passage shared by documents is cut alike wherever it stands.
2. Chunk hashes are counted over all documents.  A chunk that stands in more than
   one place is encoded once, in the first of them, and its ids go to the others.
   Only the part between its first and last *safe* boundary is kept as ids.  A
   boundary is safe between an ASCII graphic character and a following blank or
   line feed: the byte-level split never runs across it and looks at nothing before
   it, so ids on both sides are the same in any surroundings.
3. Chunks that stand in one place only are encoded there, and each document's
   joins are repaired: what lies between the last safe boundary on the left and
   the first on the right is encoded anew; when the right chunk has none, the
   stretch grows until one comes or the text ends, and from there both encodings
   agree exactly.

Texts travel once, compressed in packs of a few dozen rows; beside them only
hashes and the ids of shared chunks do.  Ids are taken over only where the
chunk's own hashes agree, so rows that come in another order when they are read
again (or computed again after the loss of an executor) cost reuse, never ids.  A chunk's places are joined, never
gathered, so a chunk that a third of all documents hold is no hot task.  Texts
with the string of a special token are cut nowhere.

Edge cases: null and empty texts have no ids and decode to the empty string;
a text without any safe boundary is encoded whole; ``doc_id`` may be null or
repeat, rows are never merged; other columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import tokens
from tidewatch.llm.scratch import Scratch
from tidewatch.llm.textblock import blocks, mix, span_hashes, text_bytes

#: The vocabulary of the contract query.
VOCABULARY = "byte_bpe_50k.json"
#: One cut in this many bytes, and no chunk shorter than that before its cut.
CHUNK_BITS, CHUNK_MIN = 9, 128
#: Rows of a pack, as a power of two.
PACK_BITS = 5
#: Joins that a task remembers, and bytes of each.
MEMO_JOINS, MEMO_BYTES = 100_000, 64

_FIRST = re.compile(rb"[!-~](?=[ \n])")
_LAST = re.compile(rb"(?s:.*)[!-~](?=[ \n])")
_SHIFTS = np.uint64(64 - CHUNK_BITS)


def cut_points(data: np.ndarray) -> np.ndarray:
    """Positions where the hash of the eight bytes before hits, moved on to the next start of a character."""
    if data.size < 9:
        return np.zeros(0, np.int64)
    window = np.ndarray((data.size - 7,), "<u8", np.ascontiguousarray(data), strides=(1,))
    hits = np.flatnonzero(mix(window * np.uint64(0x9E3779B97F4A7C15)) >> _SHIFTS == 0) + 8
    hits = hits[hits < data.size]
    for _ in range(3):
        inner = (data[np.minimum(hits, data.size - 1)] & 0xC0) == 0x80
        hits = hits + inner
    return hits[hits < data.size]


def chunk_spans(data: np.ndarray, off: np.ndarray, special: tuple[bytes, ...] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the chunks of all rows, at least one to a row, and the n + 1 offsets of each row's chunks."""
    cuts = cut_points(data)
    raw = data.tobytes() if special else b""
    starts, ends, count = [], [], []
    for a, b in itertools.pairwise(off.tolist()):
        own = cuts[np.searchsorted(cuts, a, "right") : np.searchsorted(cuts, b, "left")].tolist()
        if any(raw.find(s, a, b) >= 0 for s in special):
            own = []
        n, at = len(starts), a
        for cut in own:
            if cut - at >= CHUNK_MIN:
                starts.append(at)
                ends.append(cut)
                at = cut
        starts.append(at)
        ends.append(b)
        count.append(len(starts) - n)
    return np.array(starts, np.int64), np.array(ends, np.int64), np.append(0, np.cumsum(count)).astype(np.int64)


def encode_chunk(raw: bytes, encoder) -> tuple[bytes, bytes | None, bytes]:
    """Bytes before the first safe boundary, ids up to the last, bytes after it; without any boundary all bytes and no ids."""
    first = _FIRST.search(raw)
    if first is None:
        return raw, None, b""
    i, j = first.end(), _LAST.match(raw).end()
    return raw[:i], encoder.encode(raw[i:j].decode()) if j > i else b"", raw[j:]


class Joiner:
    """Puts a document's ids together from its encoded chunks."""

    def __init__(self, encoder, limit: int = MEMO_JOINS):
        self.encoder, self.limit, self.memo = encoder, limit, {}

    def _ids(self, raw: bytes) -> bytes:
        out = self.memo.get(raw)
        if out is None:
            out = self.encoder.encode(raw.decode())
            if len(raw) <= MEMO_BYTES:
                if len(self.memo) >= self.limit:
                    self.memo.clear()
                self.memo[raw] = out
        return out

    def join(self, chunks: Iterable[tuple[bytes, bytes | None, bytes]]) -> bytes:
        out, pending = [], []
        for head, core, tail in chunks:
            pending.append(head)
            if core is not None:
                out += (self._ids(b"".join(pending)), core)
                pending = [tail]
        rest = b"".join(pending)
        if rest:
            out.append(self._ids(rest))
        return b"".join(out)


def _spans(block: pa.RecordBatch, text: str, special: tuple[bytes, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a block, and starts, ends and row offsets of its chunks."""
    data, off = text_bytes(block.column(text))
    return data, *chunk_spans(data, off, special)


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each chunk, as signed integers."""
    h1, h2 = span_hashes(data, starts, ends, fold=False), mix(span_hashes(data ^ np.uint8(0x55), starts, ends, fold=False))
    return h1.view(np.int64), h2.view(np.int64)


def _special(encoder) -> tuple[bytes, ...]:
    return tuple(s.encode() for s in encoder.special)


def places(rows: DataFrame, vocabulary: str, text: str) -> DataFrame:
    """Every chunk of every row: _row, n (from 0), h1, h2 (hashes)."""
    special = _special(tokens.byte_encoder(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text):
            data, starts, ends, at = _spans(block, text, special)
            row = np.repeat(np.arange(block.num_rows), np.diff(at))
            cols = [block.column("_row").take(pa.array(row)), pa.array((np.arange(row.size) - at[row]).astype(np.int32)), *map(pa.array, _hashes(data, starts, ends))]
            yield pa.RecordBatch.from_arrays(cols, ["_row", "n", "h1", "h2"])

    return rows.select("_row", text).mapInArrow(run, "_row long not null, n int not null, h1 long not null, h2 long not null")


def _pack(row: str = "_row") -> F.Column:
    return F.shiftright(row, PACK_BITS).alias("pack")


def _packs(rows: DataFrame, text: str) -> DataFrame:
    """All columns of ``rows`` in compressed packs: pack, body."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for block in blocks(batches, text):
            number = block.column("_row").to_numpy() >> PACK_BITS
            edges = [0, *(np.flatnonzero(number[1:] != number[:-1]) + 1).tolist(), len(number)]
            out = []
            for a, b in itertools.pairwise(edges):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, block.schema, options=options) as stream:
                    stream.write_batch(block.slice(a, b - a))
                out.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(number[edges[:-1]]), pa.array(out, pa.binary())], ["pack", "body"])

    return rows.mapInArrow(run, "pack long not null, body binary not null")


def _unpacked(body: pa.Scalar) -> pa.RecordBatch:
    return pa.ipc.open_stream(body.as_buffer()).read_all().combine_chunks().to_batches()[0]


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, text: str = "text", key: str = "doc_id", scratch: Scratch | None = None) -> DataFrame:
    """One row per document: ``key`` and ``ids``, its token ids as little-endian unsigned 32-bit bytes."""
    special = _special(tokens.byte_encoder(vocabulary))
    rows = docs.select(key, text, F.monotonically_increasing_id().alias("_row"))
    all_places = places(rows, vocabulary, text)
    shared = all_places.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("_row", "n")).alias("first")).where("c > 1").select("h1", "h2", "first")
    is_first = (F.col("first._row") == F.col("_row")) & (F.col("first.n") == F.col("n"))
    held = all_places.join(shared, ["h1", "h2"]).select("_row", "n", "h1", "h2", is_first.alias("first"))
    held = (scratch or Scratch(docs.sparkSession, "bpe")).keep(held, "places")
    first = held.where("first")
    first = first.groupBy(_pack()).agg(F.collect_list(F.struct("_row", "n", "h1", "h2")).alias("wanted"))
    packs = _packs(rows, text)

    def sources(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.byte_encoder(vocabulary)
        for batch in batches:
            for body, wanted in zip(batch.column("body"), batch.column("wanted").to_pylist(), strict=True):
                block = _unpacked(body)
                data, starts, ends, at = _spans(block, text, special)
                raw, own = data.tobytes(), {r: (at[i], at[i + 1]) for i, r in enumerate(block.column("_row").to_pylist())}
                h1, h2 = _hashes(data, starts, ends)
                out = []
                for x in wanted:
                    begin, end = own.get(x["_row"], (0, 0))  # a pack may be in two pieces
                    k = begin + x["n"]
                    if k < end and (h1[k], h2[k]) == (x["h1"], x["h2"]):
                        head, core, tail = encode_chunk(raw[starts[k] : ends[k]], coder)
                        out.append((x["h1"], x["h2"], head, None if core is None else coder.narrow(core), tail))
                if out:
                    h1, h2, *rest = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(h1), pa.array(h2), *(pa.array(c, pa.binary()) for c in rest)], ["h1", "h2", "head", "core", "tail"])

    coded = packs.join(first, "pack").select("body", "wanted").mapInArrow(sources, "h1 long not null, h2 long not null, head binary, core binary, tail binary")
    given = held.select("_row", "n", "h1", "h2").join(coded, ["h1", "h2"]).groupBy(_pack()).agg(F.collect_list(F.struct("_row", "n", "h1", "h2", "head", "core", "tail")).alias("given"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joiner = Joiner(tokens.byte_encoder(vocabulary))
        coder = joiner.encoder
        for batch in batches:
            for body, given in zip(batch.column("body"), batch.column("given"), strict=True):
                block = _unpacked(body)
                data, starts, ends, at = _spans(block, text, special)
                raw, got = data.tobytes(), {}
                h1, h2 = _hashes(data, starts, ends)
                for x in given.as_py() or ():
                    got.setdefault(x["_row"], {})[x["n"]] = x["h1"], x["h2"], (x["head"], None if x["core"] is None else coder.widen(x["core"]), x["tail"])
                ids = []
                for i, row in enumerate(block.column("_row").to_pylist()):
                    have, triples, begin = got.get(row, {}), [], None
                    for k in range(at[i], at[i + 1]):
                        mine = have.get(k - at[i])
                        # neighbours that stand here only are one stretch
                        begin = starts[k] if begin is None else begin
                        if mine is not None and mine[:2] == (h1[k], h2[k]):
                            if starts[k] > begin:
                                triples.append(encode_chunk(raw[begin : starts[k]], coder))
                            triples.append(mine[2])
                            begin = None
                    if begin is not None:
                        triples.append(encode_chunk(raw[begin : ends[at[i + 1] - 1]], coder))
                    ids.append(joiner.join(triples))
                yield pa.RecordBatch.from_arrays([block.column(key), pa.array(ids, pa.binary())], [key, "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return packs.join(given, "pack", "left").select("body", "given").mapInArrow(run, f"`{key}` {kind}, ids binary")


def reuse(docs: DataFrame, vocabulary: str = VOCABULARY, text: str = "text") -> tuple[int, int, int]:
    """How many chunks the texts of ``docs`` have, how many of them stand in several places, and how many of those are encoded."""
    rows = docs.select(text, F.monotonically_increasing_id().alias("_row"))
    counts = places(rows, vocabulary, text).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("c"))
    got = counts.agg(F.sum("c"), F.sum(F.when(F.col("c") > 1, F.col("c"))), F.count(F.when(F.col("c") > 1, 1))).first()
    return got[0] or 0, got[1] or 0, got[2]


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY, key: str = "doc_id") -> DataFrame:
    """Adds ``decoded``, the text of ``ids``; special tokens stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.byte_encoder(vocabulary)
        for batch in batches:
            size = max(1, (1 << 20) * batch.num_rows // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                texts = [coder.decode(x or b"") for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(key), part.column("ids"), pa.array(texts, pa.string())], [key, "ids", "decoded"])

    return encoded.select(key, "ids").mapInArrow(run, f"`{key}` {encoded.schema[key].dataType.simpleString()}, ids binary, decoded string")
