"""Suffix-array removal of repeated byte strings across a corpus.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts
somewhere else.  The work is dealt out by content: among the grams of ``GRAM``
bytes within each ``LENGTH``-byte string, the one with the least hash (leftmost
on ties) is its *anchor*.  It depends on the string alone, so equal strings have
equal anchors, and starts that share an anchor form a *segment* of text.

1. One pass over the texts yields each document's anchors and segment hashes.
2. Anchors seen once cannot hold a repeated string; they are dropped.  A segment
   that occurs twice as a whole is repeated in full.
3. Only segments seen once whose anchor has other segments too need comparing:
   their texts go to shards by anchor, each shard's suffix array is built by
   induced sorting, and permuted common prefixes of at least ``LENGTH`` mark
   repeated starts.  A shard holds whole anchors.  The segments of an anchor with
   more than ``SHARD_SEGMENTS`` are cut, by where a string stands around the
   anchor, into bands of ``WIDTHS[0]`` starts, which are dealt anew by the bytes
   that all strings of the band have in common; what is still too much is cut
   into narrower bands.  The last bands are single strings, which are counted.
4. The marks go back to the documents, whose bytes are then cut.

No step gathers an anchor's or a segment's occurrences: they are counted with
partial sums, and joins can split a hot key.

Edge cases: null and short texts lose nothing; equal rows count as two
occurrences; ``doc_id`` may be null or repeat (it is never a key on its own);
long texts are cut into overlapping slices; other columns are ignored.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.scratch import Scratch
from tidewatch.llm.suffixes import permuted_prefixes, suffix_array
from tidewatch.llm.textblock import _BYTE_CODE, _power_tables, blocks, mix, text_bytes

LENGTH, GRAM = 200, 48
#: Distinct segments of an anchor that are compared in one shard, bytes of text in one suffix array, bytes looked at together.
SHARD_SEGMENTS, SHARD_BYTES, LOOK_BYTES = 512, 1 << 20, 1 << 20
#: Starts in a band of an anchor that has more segments; each divides the one before, and the last is 1.
WIDTHS = (20, 4, 1)
_POSITION_BITS = 23


def _sums(data: np.ndarray) -> np.ndarray:
    powers, _ = _power_tables(data.size + 1)
    out = np.zeros(data.size + 1, np.uint64)
    np.cumsum(_BYTE_CODE[data] * powers[: data.size], out=out[1:])
    return out


def _print_of(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, inverse = _power_tables(sums.size)
    return mix((sums[end] - sums[start]) * inverse[start])


def segments(data: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Segments of all rows: row, first and last (starts in ``data``), place (of the anchor, from ``first``), anchor, seg (hashes)."""
    limit = 1 << _POSITION_BITS
    if data.size >= limit:
        parts, step = [], limit // 2
        for row in range(off.size - 1):
            for at in range(int(off[row]), max(int(off[row]) + 1, int(off[row + 1]) - length + 1), step):
                end = min(at + step + length - 1, int(off[row + 1]))
                got = segments(data[at:end], np.array([0, end - at]), length, gram)
                got["row"] += row
                got["first"] += at
                got["last"] += at
                parts.append(got)
        return {c: np.concatenate([p[c] for p in parts]) for c in ("row", "first", "last", "place", "anchor", "seg")}
    span = length - gram + 1
    inside = np.zeros(data.size + 1, np.int32)
    sizes = np.diff(off)
    long = np.flatnonzero(sizes >= length)
    none = {c: np.zeros(0, np.int64) for c in ("row", "first", "last", "place")} | {c: np.zeros(0, np.uint64) for c in ("anchor", "seg")}
    if not long.size:
        return none
    np.add.at(inside, off[long], 1)
    np.add.at(inside, off[long + 1] - length + 1, -1)
    starts = np.flatnonzero(np.cumsum(inside[:-1]))
    sums = _sums(data)
    n = data.size - gram + 1
    _, inverse = _power_tables(data.size + 1)
    key = mix((sums[gram:] - sums[:n]) * inverse[:n])
    key &= np.uint64(~(limit - 1) & 0xFFFFFFFFFFFFFFFF)
    key |= np.arange(n, dtype=np.uint64)
    width = 1
    while 2 * width <= span:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if width < span:
        key = np.minimum(key[: key.size - (span - width)], key[span - width :])
    at = (key[starts] & np.uint64(limit - 1)).astype(np.int64)
    new = np.ones(starts.size, bool)
    new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
    head = np.flatnonzero(new)
    first, last = starts[head], starts[np.append(head[1:], starts.size) - 1]
    anchor = at[head]
    return {
        "row": np.searchsorted(off, first, "right") - 1, "first": first, "last": last, "place": anchor - first,
        "anchor": _print_of(sums, anchor, anchor + gram), "seg": _print_of(sums, first, last + length),
    }


def _digest_columns(text: str) -> list[F.Column]:
    whole = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(whole).alias("c1"), F.xxhash64(F.lit(1), whole).alias("c2")]


def _anchors(docs: DataFrame, text: str, key: str, length: int, gram: int) -> DataFrame:
    """Per row: doc_id, n_bytes, c1, c2, whole_sha256, anchors, segs (a segment at most twice)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", LOOK_BYTES):
            data, off = text_bytes(block.column("text"))
            found = segments(data, off, length, gram)
            row, seg = found["row"], found["seg"]
            order = np.lexsort((seg, row))
            row, seg, anchor = row[order], seg[order], found["anchor"][order]
            keep = np.ones(row.size, bool)
            keep[2:] = (row[2:] != row[:-2]) | (seg[2:] != seg[:-2])
            row, seg, anchor = row[keep], seg[keep], anchor[keep]
            ends = pa.array(np.searchsorted(row, np.arange(block.num_rows + 1)).astype(np.int32))
            cols = [block.column(c) for c in ("doc_id", "n_bytes", "c1", "c2", "whole_sha256")]
            cols += [pa.ListArray.from_arrays(ends, pa.array(x.view(np.int64))) for x in (anchor, seg)]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_bytes", "c1", "c2", "whole_sha256", "anchors", "segs"])

    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"), whole.alias("text"), F.octet_length(whole).cast("long").alias("n_bytes"), *_digest_columns(text), F.sha2(whole, 256).alias("whole_sha256"))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, c1 long, c2 long, whole_sha256 string, anchors array<long>, segs array<long>")


def _longs(lists: pa.ListArray, field: str) -> np.ndarray:
    return lists.flatten().field(field).to_numpy(zero_copy_only=False)


def _bodies(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """The texts of the segments that are to be compared: anchor, seg, lo (0), place (of the anchor in it), many (segments of the anchor), body."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", LOOK_BYTES):
            data, off = text_bytes(block.column("text"))
            found = segments(data, off, length, gram)
            marks = block.column("marks")
            owner = np.repeat(np.arange(block.num_rows), np.diff(marks.offsets.to_numpy()))
            wanted = {}
            for o, kind, anchor, seg, many in zip(owner.tolist(), *(_longs(marks, c).tolist() for c in ("kind", "anchor", "seg", "many")), strict=True):
                if kind == 1:
                    wanted[o, seg] = anchor, many
            out: list[tuple] = []
            raw = data.tobytes()
            for row, first, last, place, seg in zip(*(found[c].tolist() for c in ("row", "first", "last", "place")), found["seg"].view(np.int64).tolist(), strict=True):
                if (row, seg) in wanted:
                    anchor, many = wanted.pop((row, seg))
                    out.append((anchor, seg, 0, place, many, raw[first : last + length]))
            if out:
                *numbers, body = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in numbers), pa.array(body, pa.binary())], ["anchor", "seg", "lo", "place", "many", "body"])

    return texts.mapInArrow(run, "anchor long, seg long, lo long, place long, many long, body binary")


def _bands(bodies: DataFrame, width: int, length: int) -> DataFrame:
    """``bodies`` cut into bands of at most ``width`` starts: anchor (the bytes common to the band), sub (the band), seg, lo and hi (its starts in seg), place, body.

    Equal strings stand alike around their anchor, so they are in bands with the same common bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, LOOK_BYTES * batch.num_rows // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                yield band(part, *text_bytes(part.column("body")))

    def band(part: pa.RecordBatch, data: np.ndarray, off: np.ndarray) -> pa.RecordBatch:
        anchor, seg, lo, place = (part.column(c).to_numpy() for c in ("anchor", "seg", "lo", "place"))
        starts = np.diff(off) - length + 1
        # a string's distance to the anchor falls from place to place - starts + 1
        first, last = (place - starts + 1) // width, place // width
        row = np.repeat(np.arange(starts.size), last - first + 1)
        k = last[row] - (np.arange(row.size) - np.repeat(np.cumsum(last - first + 1) - (last - first + 1), last - first + 1))
        begin = np.maximum(0, place[row] - (k + 1) * width + 1)
        end = np.minimum(starts[row], place[row] - k * width + 1)
        sums = _sums(data)
        base = off[row]
        core = base + place[row] - k * width
        key = _print_of(sums, core, core - width + 1 + length) ^ mix(anchor[row].view(np.uint64) + k.astype(np.uint64))
        sub = mix(_print_of(sums, base + begin, base + end - 1 + length) ^ mix(key))
        raw = data.tobytes()
        body = [raw[a:b] for a, b in zip((base + begin).tolist(), (base + end - 1 + length).tolist(), strict=True)]
        cols = [mix(key).view(np.int64), sub.view(np.int64), seg[row], lo[row] + begin, lo[row] + end, place[row] - begin]
        return pa.RecordBatch.from_arrays([*(pa.array(c.astype(np.int64)) for c in cols), pa.array(body, pa.binary())], ["anchor", "sub", "seg", "lo", "hi", "place", "body"])

    return bodies.select("anchor", "seg", "lo", "place", "body").mapInArrow(run, "anchor long, sub long, seg long, lo long, hi long, place long, body binary")


def shard_repeats(bodies: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """For the starts of all ``length``-byte strings in ``bodies``, one after another: whether it also starts elsewhere here, and a number for each distinct string."""
    text = np.frombuffer(b"\xff".join(bodies), np.uint8)  # no UTF-8 text holds the byte 0xFF
    sizes = np.array([len(b) for b in bodies])
    at = np.cumsum(sizes + 1) - sizes - 1
    counts = sizes - length + 1
    starts = np.repeat(at - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    sa = suffix_array(text)
    common = permuted_prefixes(text, sa, length)
    valid = np.zeros(text.size, bool)
    valid[starts] = True
    order = sa[valid[sa]]
    # Suffixes between two valid ones that agree in so many bytes agree as well, so the least over them is theirs.
    same = (common[sa] >= length).astype(np.int64)
    breaks = np.cumsum(same == 0)[np.flatnonzero(valid[sa])]
    group = np.zeros(text.size, np.int64)
    new = np.ones(order.size, bool)
    new[1:] = breaks[1:] != breaks[:-1]
    number = np.cumsum(new) - 1
    group[order] = number
    size = np.bincount(number, minlength=1)
    return size[group[starts]] > 1, group[starts]


def _compared(bodies: DataFrame, length: int, partitions: int) -> DataFrame:
    """Which starts of seg (from ``lo`` and before ``hi``) are repeated among the bodies of their anchor."""

    def shard(rows: pa.Table) -> pa.RecordBatch:
        body = rows.column("body").to_pylist()
        seg, base = rows.column("seg").to_numpy(), rows.column("lo").to_numpy()
        repeated, _ = shard_repeats(body, length)
        counts = np.array([len(b) - length + 1 for b in body])
        owner = np.repeat(np.arange(len(body)), counts)
        within = np.arange(owner.size) - np.repeat(np.cumsum(counts) - counts, counts)
        begin = repeated.copy()
        begin[1:] &= ~(repeated[:-1] & (owner[1:] == owner[:-1]))
        stop = repeated.copy()
        stop[:-1] &= ~(repeated[1:] & (owner[1:] == owner[:-1]))
        b, e = np.flatnonzero(begin), np.flatnonzero(stop)
        cols = seg[owner[b]], base[owner[b]] + within[b], base[owner[b]] + within[e] + 1
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], ["seg", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("anchor").to_numpy()
            edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for a, b in itertools.pairwise(edges):
                if size > SHARD_BYTES and keys[a] != last:
                    yield shard(pa.Table.from_batches(held))
                    held, size = [], 0
                part = batch.slice(a, b - a)
                held.append(part)
                last = keys[a]
                size += part.column("body").nbytes
        if held:
            yield shard(pa.Table.from_batches(held))

    dealt = bodies.select("anchor", "seg", "lo", "body").repartition(partitions, "anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(run, "seg long, lo long, hi long")


def _compared_in_bands(bodies: DataFrame, length: int, partitions: int, scratch: Scratch) -> DataFrame:
    """The same for anchors of more than ``SHARD_SEGMENTS`` segments."""
    big, ranges = scratch.keep(bodies, "many"), []
    for width in WIDTHS:
        if not big.head(1):
            break
        fine = scratch.keep(_bands(big, width, length), "bands")
        subs = fine.groupBy("anchor", "sub").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("seg", "lo")).alias("one"))
        subs = scratch.keep(subs, "band-counts")
        ranges.append(fine.join(subs.where("n > 1").select("anchor", "sub"), ["anchor", "sub"]).select("seg", "lo", "hi"))
        if width == 1:
            break
        open_ = subs.groupBy("anchor").agg(F.count(F.lit(1)).alias("many"), F.min("n").alias("least")).where("many > 1 and least = 1").select("anchor", "many")
        chosen = subs.join(open_, "anchor").select("anchor", "sub", "many", F.col("one.seg").alias("seg"), F.col("one.lo").alias("lo"))
        # one row for each different band
        left = fine.join(chosen, ["anchor", "sub", "seg", "lo"]).select("anchor", "seg", "lo", "place", "many", "body")
        left = scratch.keep(left, "open-bands")
        ranges.append(_compared(left.where(F.col("many") <= SHARD_SEGMENTS), length, partitions))
        big = left.where(F.col("many") > SHARD_SEGMENTS)
    return functools.reduce(DataFrame.unionByName, ranges) if ranges else big.select("seg", "lo", F.col("lo").alias("hi")).limit(0)


def whole_characters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """``gone``, with all bytes of every character of which some are gone."""
    if not data.size:
        return gone
    first = (data & 0xC0) != 0x80
    first[0] = True
    return np.logical_or.reduceat(gone, np.flatnonzero(first))[np.cumsum(first) - 1]


def _cut(texts: DataFrame, length: int, gram: int, whole_chars: bool = False) -> DataFrame:
    """Per content: c1, c2, n_removed, n_spans, kept (the remaining bytes, with ``whole_chars`` those of characters that are left whole)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", LOOK_BYTES):
            data, off = text_bytes(block.column("text"))
            found = segments(data, off, length, gram)
            row, seg, first, last = found["row"], found["seg"].view(np.int64), found["first"], found["last"]
            change = np.zeros(data.size + 1, np.int64)
            whole: dict[int, set] = {}
            marks = block.column("marks")
            owner = np.repeat(np.arange(block.num_rows), np.diff(marks.offsets.to_numpy()))
            for o, kind, s in zip(owner.tolist(), _longs(marks, "kind").tolist(), _longs(marks, "seg").tolist(), strict=True):
                if kind == 0:
                    whole.setdefault(o, set()).add(s)
            parts: dict[tuple, list] = {}
            ranges = block.column("ranges")
            owner = np.repeat(np.arange(block.num_rows), np.diff(ranges.offsets.to_numpy()))
            for o, s, lo, hi in zip(owner.tolist(), *(_longs(ranges, c).tolist() for c in ("seg", "lo", "hi")), strict=True):
                parts.setdefault((o, s), []).append((lo, hi))
            for r, s, a, b in zip(row.tolist(), seg.tolist(), first.tolist(), last.tolist(), strict=True):
                if s in whole.get(r, ()):
                    change[a] += 1
                    change[b + length] -= 1
                elif (r, s) in parts:
                    for lo, hi in parts[r, s]:
                        change[a + lo] += 1
                        change[a + hi - 1 + length] -= 1
            gone = np.cumsum(change[:-1]) > 0
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            edge = off[:-1][off[:-1] < data.size]
            begins[edge] = gone[edge]
            n_gone, n_begin = np.append(0, np.cumsum(gone)), np.append(0, np.cumsum(begins))
            gone = whole_characters(data, gone) if whole_chars else gone
            kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            cols = [block.column("c1"), block.column("c2"), pa.array(n_gone[off[1:]] - n_gone[off[:-1]]), pa.array(n_begin[off[1:]] - n_begin[off[:-1]]), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["c1", "c2", "n_removed", "n_spans", "kept"])

    return texts.select("c1", "c2", "text", "marks", "ranges").mapInArrow(run, "c1 long, c2 long, n_removed long, n_spans long, kept binary")


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, text: str = "text", key: str = "doc_id", scratch: Scratch | None = None, whole_chars: bool = False) -> tuple[DataFrame, DataFrame]:
    """``rows`` (doc_id, n_bytes, c1, c2, whole_sha256, one per row of ``docs``) and ``cuts`` (c1, c2, n_removed, n_spans, kept; one per content that loses bytes)."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "repeats")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = scratch.keep(_anchors(docs, text, key, length, gram).withColumn("rid", F.monotonically_increasing_id()), "anchors")
    pairs = table.select("rid", F.explode(F.arrays_zip("anchors", "segs")).alias("p")).select("rid", F.col("p.anchors").alias("anchor"), F.col("p.segs").alias("seg"))
    often = pairs.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    shared = scratch.keep(pairs.join(often, "anchor"), "shared")
    by_segment = shared.groupBy("anchor", "seg").agg(F.count(F.lit(1)).alias("n"), F.min("rid").alias("rid"))
    by_segment = scratch.keep(by_segment, "segments")
    by_anchor = by_segment.groupBy("anchor").agg(F.count(F.lit(1)).alias("many"), F.min("n").alias("least")).where("many > 1 and least = 1").select("anchor", "many")
    whole = shared.join(by_segment.where("n > 1").select("anchor", "seg"), ["anchor", "seg"]).select("rid", "anchor", "seg", F.lit(0).cast("long").alias("kind"), F.lit(0).cast("long").alias("many"))
    compare = by_segment.join(by_anchor, "anchor").select("rid", "anchor", "seg", F.lit(1).cast("long").alias("kind"), "many")
    marks = whole.distinct().unionByName(compare).groupBy("rid").agg(F.collect_list(F.struct("kind", "anchor", "seg", "many")).alias("marks"))
    # one row per content, that of the smallest row number, has the marks
    first = table.groupBy("c1", "c2").agg(F.min(F.struct("rid", "doc_id")).alias("r")).select("c1", "c2", "r.rid", F.col("r.doc_id").alias("_id"))
    wanted = first.join(marks, "rid")
    own = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), *_digest_columns(text))
    same = (own.c1 == wanted.c1) & (own.c2 == wanted.c2) & own.doc_id.eqNullSafe(wanted._id)
    texts = scratch.keep(own.join(wanted, same).select("rid", own.c1, own.c2, "text", "marks"), "texts")
    found = scratch.keep(_compared(_bodies(texts.select("text", "marks"), length, gram).where(F.col("many") <= SHARD_SEGMENTS), length, partitions), "found")
    crowded = texts.where(F.exists("marks", lambda m: m["many"] > SHARD_SEGMENTS)).select("text", "marks")
    in_bands = _compared_in_bands(_bodies(crowded, length, gram).where(F.col("many") > SHARD_SEGMENTS), length, partitions, scratch)
    ranges = found.unionByName(scratch.keep(in_bands, "found-in-bands"))
    ranges = ranges.join(by_segment.where("n = 1").select("seg", "rid"), "seg").groupBy("rid").agg(F.collect_list(F.struct("seg", "lo", "hi")).alias("ranges"))
    none = F.array().cast("array<struct<seg:long,lo:long,hi:long>>")
    cuts = _cut(texts.join(ranges, "rid", "left").withColumn("ranges", F.coalesce("ranges", none)), length, gram, whole_chars)
    cuts = scratch.keep(cuts.where("n_removed > 0").dropDuplicates(["c1", "c2"]), "cuts")
    return table.select("doc_id", "n_bytes", "c1", "c2", "whole_sha256"), cuts


def report(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows, cuts = repeats(docs, length, gram, text, key)
    cuts = cuts.select("c1", "c2", "n_removed", "n_spans", F.sha2("kept", 256).alias("sha"))
    zero = F.lit(0).cast("long")
    return rows.join(cuts, ["c1", "c2"], "left").select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("sha", "whole_sha256").alias("kept_sha256"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with ``text`` cut; bytes of a character that was cut in part go too, and no other character."""
    _, cuts = repeats(docs, length, gram, text, key, whole_chars=True)
    c1, c2 = _digest_columns(text)
    digest = docs.withColumns({"_c1": c1, "_c2": c2})
    cuts = cuts.select(F.col("c1").alias("_c1"), F.col("c2").alias("_c2"), F.col("kept").cast("string").alias("_left"))
    joined = digest.join(cuts, ["_c1", "_c2"], "left")
    return joined.withColumn(text, F.coalesce("_left", F.col(text))).select(*docs.columns)
