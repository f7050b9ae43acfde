"""Document fingerprints as threshold-scaled sketches, in DataFrame operations only.

A text's set is that of its runs of five words (all its words, if they are fewer;
case of A-Z ignored).  Its sketch keeps every run whose hash lies below a fixed
fraction of all hashes, so it grows with the text, and the share of a sketch that
another one holds estimates the share of the set that the other set holds, however
unequal the two are.  Where no hash lies below, the least one is kept, so a text
with words always has a sketch.  The sketch of a union follows from the sketches
alone (:func:`merge`).  Hashes are the first 16 hexadecimal digits of an md5, and a
fingerprint is the sorted sketch written in one string.

:func:`edits` pairs each document with the next one in falling order of ids, with
neither a window over all rows nor a join: rows are sorted by range, numbered from
the sizes of partitions (one number each at the driver), and dealt in groups of
neighbours, the first row of each group also to the group before, so that a short
window within each group sees every neighbour.

Edge cases: null and empty texts, and texts of white space, have an empty sketch; two
empty sketches are alike (1), an empty and another one are not (0); equal texts have
equal fingerprints; null ids come last; among equal ids the md5 of the text decides
the order, rows are never merged; a single row is its own next document; an empty
table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.scratch import Scratch

SHINGLE = 5
#: The share of all hashes that sketches keep.
FRACTION = 1 / 8
#: Neighbours in a group.
GROUP = 32

_SPACE = r"[\x20\x09-\x0D]+"
_DIGITS = 16


def threshold(fraction: float = FRACTION) -> str:
    """What hashes must lie below, as hexadecimal digits."""
    if not 0 < fraction <= 1:
        raise ValueError("a fraction is over 0 and at most 1")
    return "g" if fraction == 1 else format(int(fraction * 16**_DIGITS), f"0{_DIGITS}x")


def _once(value: Column, then) -> Column:
    """``then(value)``, with ``value`` computed once."""
    return F.transform(F.array(value), then)[0]


def _kept(hashes: Column, fraction: float) -> Column:
    below = F.array_sort(F.array_distinct(F.filter(hashes, lambda h: h < threshold(fraction))))
    return _once(below, lambda b: F.when((F.size(b) > 0) | (F.size(hashes) == 0), b).otherwise(F.array(F.array_min(hashes))))


def sketch(text: Column, shingle: int = SHINGLE, fraction: float = FRACTION) -> Column:
    """Sorted hashes of a text's sketch, an array of strings."""
    folded = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.array_remove(F.split(folded, _SPACE), "")

    def hashes(w: Column) -> Column:
        last = F.greatest(F.size(w) - (shingle - 1), F.least(F.size(w), F.lit(1)))
        starts = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.substring(F.md5(F.array_join(F.slice(w, i, shingle), " ").cast("binary")), 1, _DIGITS))

    return _once(_once(words, hashes), lambda h: _kept(h, fraction))


def merge(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The sketch of the union of two sets."""
    return _once(F.array_union(a, b), lambda h: _kept(h, fraction))


def containment(a: Column, b: Column) -> Column:
    """Which share of the smaller sketch the other one holds: 0 to 1."""
    smaller = F.least(F.size(a), F.size(b))
    return F.when(smaller > 0, F.size(F.array_intersect(a, b)) / smaller).when(F.size(a) == F.size(b), 1.0).otherwise(0.0)


def fingerprint(hashes: Column) -> Column:
    return F.array_join(hashes, "")


def packed(hashes: Column) -> Column:
    """A sketch in eight bytes a hash."""
    return F.unhex(fingerprint(hashes))


def unpacked(body: Column) -> Column:
    size = _DIGITS // 2
    count = (F.octet_length(body) / size).cast("int")
    starts = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    # cut as bytes: a place in a string is found by counting its characters
    return F.transform(starts, lambda i: F.lower(F.hex(F.substring(body, i * size + 1, size))))


def numbered(docs: DataFrame, scratch: Scratch, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, int]:
    """doc_id, text and n (0, 1, 2 and so on in falling order of ids), and the number of rows."""
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.orderBy(F.col("doc_id").desc_nulls_last(), F.md5(F.col("text").cast("binary"))).withColumn("_at", F.monotonically_increasing_id())
    rows = scratch.keep(rows, "sorted")
    part = F.shiftright("_at", 33)
    sizes = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    before = itertools.accumulate((r.n for r in sizes), initial=0)
    # a number per partition
    starts = docs.sparkSession.createDataFrame([(r.part, b) for r, b in zip(sizes, before, strict=False)], "_part long, _before long")
    placed = rows.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return placed.select("doc_id", "text", (F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).alias("n")), sum(r.n for r in sizes)


def edits(docs: DataFrame, shingle: int = SHINGLE, fraction: float = FRACTION, group: int = GROUP, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Each document beside its edited text and the next document: doc_id, text, sketch, edited, edited_sketch, next_sketch.

    In the edited text the second half (rounded down) is replaced by as many
    characters from the beginning of the next document's text, or all it has.
    """
    rows, total = numbered(docs, Scratch(docs.sparkSession, "fingerprints"), text, key)
    groups = -(-total // group) or 1
    own = F.floor(F.col("n") / group).cast("long")
    # the first row of a group also ends the group before it, and the very first row the last group
    ends = F.when(F.col("n") % group == 0, F.struct(F.pmod(own - 1, F.lit(groups)).alias("g"), (F.when(F.col("n") == 0, F.lit(total)).otherwise(F.col("n"))).alias("place"), F.lit(True).alias("copy")))
    begins = F.struct(own.alias("g"), F.col("n").alias("place"), F.lit(False).alias("copy"))
    dealt = rows.withColumn("sketch", packed(sketch(F.col("text"), shingle, fraction))).select("doc_id", "text", "sketch", F.explode(F.array(begins, ends)).alias("at")).where("at is not null")
    following = Window.partitionBy("at.g").orderBy("at.place")
    paired = dealt.withColumns({"next": F.lead("text").over(following), "next_sketch": F.lead("sketch").over(following)}).where("not at.copy")
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.left("text", F.char_length("text") - half), F.left("next", half))
    paired = paired.select("doc_id", "text", unpacked(F.col("sketch")).alias("sketch"), edited.alias("edited"), unpacked(F.col("next_sketch")).alias("next_sketch"))
    return paired.select("doc_id", "text", "sketch", "edited", sketch(F.col("edited"), shingle, fraction).alias("edited_sketch"), "next_sketch")


def report(docs: DataFrame, shingle: int = SHINGLE, fraction: float = FRACTION, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    return edits(docs, shingle, fraction, GROUP, text, key).select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("sketch")).alias("fingerprint"), fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"), containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
