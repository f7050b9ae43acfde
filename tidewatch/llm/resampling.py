"""Target-distribution importance resampling by external sort-count.

1. Every text becomes a stream of feature buckets, two bytes each (the crc32 of a
   run of words, modulo the number of buckets).  The streams of a block of
   documents are packed into one binary value beside the documents' offsets, and
   written out.
2. Counting reads the streams only: each block is sorted and run-length encoded,
   the runs are summed by task, then by bucket in Spark.  What reaches the driver
   is one row per bucket, a number that is a parameter.
3. From the counts of the corpus and of the target comes one gain per bucket.  The
   streams are read again, gains are gathered by bucket and summed at the
   documents' offsets.
4. Documents are drawn without replacement by adding to each weight a Gumbel
   variable that depends on the document's id alone, and taking the highest sums:
   one exchange by range of (score, id), rows numbered within their partition, and
   the sizes of partitions (one number each) added up at the driver.

Edge cases: null and empty texts have no features and weight 0; a null id counts as
the empty string in the Gumbel variable and comes last among equal scores; rows of
a repeated id are rows like all others (among equal scores the one with fewer
features comes first); an empty corpus gives no rows, an empty target counts as no
features; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.scratch import Scratch
from tidewatch.llm.textblock import FOLD, blocks, text_bytes, word_spans

BUCKETS, GRAMS, SEED = 10_000, 1, 2024
#: Documents with fewer words are never drawn; of the others so many in a hundred are.
MIN_WORDS, PERCENT = 20, 10

#: All bytes but digits, letters and those of characters beyond ASCII.
_APART = np.ones(256, bool)
_APART[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def _crc_table() -> np.ndarray:
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(0xEDB88320), crc >> 1)
    return crc


_CRC = _crc_table()
#: Spans longer than this are summed one by one.
_CRC_STEPS = 40


def crc32_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The crc32 of each span of bytes, all spans a byte at a time."""
    lens = ends - starts
    order = np.argsort(-lens, kind="stable")
    at, left = starts[order], lens[order]
    crc = np.full(at.size, 0xFFFFFFFF, np.uint32)
    active = np.searchsorted(-left, -np.arange(1, _CRC_STEPS + 1), "right")
    for j, m in enumerate(active.tolist()):
        if not m:
            break
        own = crc[:m]
        crc[:m] = _CRC[(own ^ data[at[:m] + j]) & 0xFF] ^ (own >> 8)
    out = np.empty(at.size, np.uint32)
    out[order] = ~crc
    for i in order[: int(np.searchsorted(-left, -_CRC_STEPS, "left"))].tolist():
        out[i] = zlib.crc32(data[starts[i] : ends[i]])
    return out


def features(data: np.ndarray, off: np.ndarray, grams: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all runs of 1 to ``grams`` words, row after row; the n + 1 offsets of each row's; words of each row."""
    data = FOLD[data]
    starts, ends, at = word_spans(data, off, _APART)
    words = np.diff(at)
    if grams == 1:
        return (crc32_spans(data, starts, ends) % buckets).astype(np.uint16), at, words
    # words again, one space after each
    lens = ends - starts
    begin = np.cumsum(lens + 1) - (lens + 1)
    spaced = np.full(int((lens + 1).sum()), 0x20, np.uint8)
    spaced[np.repeat(begin - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())] = data[np.repeat(starts - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())]
    row, parts, rows = np.repeat(np.arange(words.size), words), [], []
    for k in range(1, grams + 1):
        first = np.flatnonzero(row[: max(0, row.size - k + 1)] == row[k - 1 :])
        parts.append(crc32_spans(spaced, begin[first], begin[first + k - 1] + lens[first + k - 1]) % buckets)
        rows.append(row[first])
    row = np.concatenate(rows)
    order = np.argsort(row, kind="stable")
    return np.concatenate(parts)[order].astype(np.uint16), np.searchsorted(row[order], np.arange(words.size + 1)), words


def streams(docs: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS, text: str = "text", key: str | None = "doc_id") -> DataFrame:
    """One row per block of documents: keys, n_words and n_features of each, and stream, the buckets of all."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets are written as two bytes")
    keys = docs.select((F.col(key) if key else F.lit(None).cast("long")).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            stream, at, words = features(*text_bytes(block.column("text")), grams, buckets)
            whole = lambda values: pa.array([values])
            cols = [pa.ListArray.from_arrays(pa.array([0, block.num_rows], pa.int32()), block.column("key")), whole(words), whole(np.diff(at)), pa.array([stream.astype("<u2").tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["keys", "n_words", "n_features", "stream"])

    kind = keys.schema["key"].dataType.simpleString()
    return keys.mapInArrow(run, f"keys array<{kind}>, n_words array<long>, n_features array<long>, stream binary")


def runs(stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a stream, sorted, and how often each stands in it."""
    stream = np.sort(stream)
    first = np.flatnonzero(np.append(True, stream[1:] != stream[:-1])) if stream.size else np.zeros(0, np.int64)
    return stream[first], np.diff(np.append(first, stream.size))


def bucket_counts(packed: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features by bucket; ``buckets`` numbers, whatever the size of the streams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for stream in batch.column(0):
                value, count = runs(np.frombuffer(stream.as_buffer(), "<u2"))
                total[value] += count
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    summed = packed.select("stream").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[summed.column("bucket").to_numpy()] = summed.column("n").to_numpy()
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the target's and the corpus's share, one added to each bucket, rounded down."""
    n, s, t = float(corpus.size), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((b + 1) * (s + n) / ((a + 1) * (t + n)))) for a, b in zip(corpus.astype(float).tolist(), target.astype(float).tolist(), strict=True)], np.int64)


def weights(packed: DataFrame, gain: np.ndarray) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight (the sum of its features' gains)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys, words, counts, stream = (batch.column(c)[i] for c in ("keys", "n_words", "n_features", "stream"))
                own = gain[np.frombuffer(stream.as_buffer(), "<u2")]
                count = counts.values.to_numpy()
                some = count > 0
                weight = np.zeros(count.size, np.int64)
                if some.any():
                    weight[some] = np.add.reduceat(own, (np.cumsum(count) - count)[some])
                yield pa.RecordBatch.from_arrays([keys.values, words.values, counts.values, pa.array(weight)], ["doc_id", "n_words", "n_features", "weight"])

    kind = packed.schema["keys"].dataType.elementType.simpleString()
    return packed.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def with_scores(weighed: DataFrame, seed: int = SEED) -> DataFrame:
    """Adds ``score``: the weight and a Gumbel variable in thousandths, which the seed and the id decide."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return weighed.withColumn("score", F.col("weight") + F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296))).cast("long"))


def ranked(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, scratch: Scratch | None = None) -> DataFrame:
    """Adds ``rank``: 1, 2, 3 and so on for the drawn documents, null for all others."""
    scratch = scratch or Scratch(scored.sparkSession, "resampling")
    able = F.col("n_words") >= min_words
    order = [able.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "n_features", "n_words", "weight"]
    # numbers within partitions: the partition's in the upper bits
    sorted_rows = scratch.keep(scored.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("_at", 33)
    sizes = sorted_rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(able, 1)).alias("able")).orderBy("part").collect()
    drawn = percent * sum(r.able for r in sizes) // 100
    before = dict(zip((r.part for r in sizes), itertools.accumulate((r.n for r in sizes), initial=0), strict=False))
    # a number per partition
    starts = scored.sparkSession.createDataFrame(list(before.items()), "_part long, _before long")
    placed = sorted_rows.withColumn("_part", part).join(F.broadcast(starts), "_part", "left")
    place = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    return placed.withColumn("rank", F.when(able & (place <= drawn), place)).drop("_part", "_before", "_at")


def resample(docs: DataFrame, target: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score, rank (null where it is not drawn)."""
    scratch = Scratch(docs.sparkSession, "resampling")
    packed = scratch.keep(streams(docs, grams, buckets, text, key), "streams")
    gain = gains(bucket_counts(packed, buckets), bucket_counts(streams(target, grams, buckets, text, None), buckets))
    return ranked(with_scores(weights(packed, gain), seed), percent, min_words, scratch)
