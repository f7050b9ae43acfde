"""First-fit-decreasing packing of token sequences.

Documents are dealt at random into groups of a few thousand; each group is
packed on its own, so packing is one shuffle of a few numbers per piece, however
many documents there are, and no group depends on a key of the data.  Within a
group pieces go, longest first, into the first sequence with room; a tournament
tree whose leaves are the free capacities finds it in logarithmic time.

Edge cases: an empty or null text still has its end token and is packed; a
document longer than a sequence is cut into full pieces and a rest; equal
lengths keep the order of (document, start); null and repeated ids are documents
like all others, never merged; an empty table packs into nothing; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import tokens
from tidewatch.llm.textblock import blocks

VOCABULARY = "word_bpe_49k.json"
SEQUENCE = 4096
END_ID = 2
#: Documents in a group, on average.
GROUP_DOCS = 4096


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length (each at most ``capacity``), longest first, ties in the given order."""
    lengths = np.asarray(lengths, np.int64)
    n = lengths.size
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not n:
        return bins, offsets
    size = 1 << max(0, int(n - 1).bit_length())
    tree = [capacity] * (2 * size)
    order = np.argsort(-lengths, kind="stable").tolist()
    need = lengths.tolist()
    for i in order:
        want, node = need[i], 1
        while node < size:
            node *= 2
            if tree[node] < want:
                node += 1
        bins[i], offsets[i] = node - size, capacity - tree[node]
        tree[node] -= want
        while node > 1:
            node //= 2
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
    return bins, offsets


def tokenize(docs: DataFrame, vocabulary: str = VOCABULARY, sequence: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = False, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: its token count with the end token, the CRC-32 of each piece and, if asked, the pieces' ids."""
    end = tokens.pack_ids([end_id])
    step = 4 * sequence

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.word_encoder(vocabulary)
        for block in blocks(batches, text):
            ids = [coder.encode(x or "") + end for x in block.column(text).to_pylist()]
            cut = [[x[at : at + step] for at in range(0, len(x), step)] for x in ids]
            out = [block.column(key), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([[zlib.crc32(p) for p in x] for x in cut], pa.list_(pa.int64()))]
            out.append(pa.array(cut if with_ids else [None] * len(cut), pa.list_(pa.binary())))
            yield pa.RecordBatch.from_arrays(out, [key, "doc_tokens", "crcs", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, doc_tokens long, crcs array<long>, ids array<binary>")


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, sequence: int = SEQUENCE, end_id: int = END_ID, group_docs: int = GROUP_DOCS, with_ids: bool = False, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Pieces of at most ``sequence`` tokens and their places.

    Columns: ``key``, start, length, ids_crc32, doc_tokens, sequence_id, offset
    and, with ``with_ids``, ids (the piece's little-endian unsigned 32-bit ids).
    """
    kind = docs.schema[key].dataType.simpleString()
    groups = max(1, -(-docs.count() // group_docs))
    rows = tokenize(docs, vocabulary, sequence, end_id, with_ids, text, key).withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    pieces = rows.select("_group", key, "doc_tokens", "ids", F.posexplode("crcs").alias("_n", "ids_crc32"))
    start = F.col("_n").cast("long") * sequence
    pieces = pieces.select("_group", key, start.alias("start"), F.least(F.lit(sequence), F.col("doc_tokens") - start).cast("long").alias("length"), "ids_crc32", "doc_tokens", *([F.col("ids")[F.col("_n")].alias("ids")] if with_ids else []))

    def place(group: pa.Table) -> pa.Table:
        # Arrow keeps ids of any size as they are beside null ones
        group = group.sort_by([(key, "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        bins, offsets = first_fit_decreasing(group.column("length").to_numpy(), sequence)
        places = (group.column("_group").to_numpy() << 32) + bins
        return group.drop_columns(["_group"]).append_column("sequence_id", pa.array(places)).append_column("offset", pa.array(offsets))

    schema = f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids + ", sequence_id long, offset long"
    return pieces.groupBy("_group").applyInArrow(place, schema)
