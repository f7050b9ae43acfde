"""Cross-tokenizer alignment by label strings.

Two tokenizers cut the same bytes (a space and the text) into tokens.  Each byte
gets a label: none, A-end, B-end or both.  A regular expression scans the label
string for the spans up to each both-label; the labels in a span say how many
tokens of each kind form a group.  Two tokens overlap in exactly one stretch
between neighbouring ends, so the links are the labelled bytes: the token of each
kind that has begun last.

Both tokenizers cut before every blank that follows an ASCII graphic or a word
character, a last blank excepted: the byte-level split never runs across that place and looks at nothing
before it, and no piece of the other vocabulary (looked up when it is loaded) has
a blank after anything else.  So the units between such places are aligned by
themselves, those of a block that are not known yet together, in one label string,
and kept in a memo of bounded size.

How many documents hold each id pair is counted over all documents.  Documents
are put in packs; a pack counts its own documents first and asks once for each of
its different pairs, so the exchanges hold a row per pack and pair, and a pair
that every document holds has a row per pack.  Answers are gathered by pack and
summed at each document's links.

Edge cases: null and empty texts, and those whose joined B bytes are not a blank
and the text (texts with U+2581, for one), have no tokens: zeros and an empty
digest; strings of special tokens are plain text; ids may be null or repeat, rows
are documents of their own and never merged; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm import tokens
from tidewatch.llm.scratch import Scratch
from tidewatch.llm.textblock import blocks

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text in a block, and in a pack (unless a single text is longer).
BLOCK_BYTES, PACK_BYTES = 1 << 20, 1 << 22
#: Characters of remembered units, with so many for each beside its own.
MEMO_CHARS, UNIT_CHARS = 24_000_000, 64

A_END, B_END, BOTH = 1, 2, 3
_SPANS = re.compile(rb"[^\x03]*\x03")
_SAFE = re.compile(r"[!-~\w]")
#: Blanks that are not cut at, and the places that are; B has no token for a last blank by itself.
_ODD = re.compile(r"[^!-~\w] | \Z")
_CUT = re.compile(r"(?<=[!-~\w])(?= .)", re.S)
_BLANK = "▁"


class PieceEncoder:
    """A ``sentencepiece`` vocabulary and the bytes that each piece stands for."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.pieces = [bytes([int(n[3:5], 16)]) if self.library.is_byte(i) else n.replace(_BLANK, " ").encode() for i, n in enumerate(names)]
        #: Whether texts may be cut before blanks.
        self.local = not any(_BLANK in n.lstrip(_BLANK) for n in names)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


class Aligner:
    """Aligns texts, unit by unit; remembers units."""

    def __init__(self, vocabulary_a: str, vocabulary_b: str, memo_chars: int = MEMO_CHARS):
        self.a, self.b = tokens.byte_encoder(vocabulary_a), PieceEncoder(tokens.resolve(vocabulary_b))
        self.len_a, self.len_b = self.a.lengths, np.array([len(p) for p in self.b.pieces])
        self.names_a, self.names_b = ([str(i) for i in range(n.size)] for n in (self.len_a, self.len_b))
        self.memo_chars, self.memo, self.size = memo_chars, {}, 0

    def units(self, text: str | None) -> list[str]:
        """What is aligned by itself; together a blank and the text.  None for texts without tokens."""
        if not text or _BLANK in text:
            return []
        whole = " " + text
        if not self.b.local:
            return [whole]
        if _ODD.search(whole):
            return _CUT.split(whole)
        return [" " + u for u in text.split(" ")]

    def learn(self, wanted: set[str]) -> None:
        """Remembers the alignment of ``wanted`` units: tokens of A and of B, groups, links, the groups' digits and the id pairs; None where B's bytes differ."""
        new = [u for u in wanted if u not in self.memo]
        if not new:
            return
        if self.size + sum(map(len, new)) + UNIT_CHARS * len(new) > self.memo_chars:
            self.memo.clear()
            self.size, new = 0, list(wanted)
        self.size += sum(map(len, new)) + UNIT_CHARS * len(new)
        ids = self.b.encode([u[1:] for u in new])
        raw = [u.encode() for u in new]
        ids_b = list(itertools.chain.from_iterable(ids))
        sizes = np.array([len(r) for r in raw])
        if not self._same(ids, ids_b, sizes, b"".join(raw)):
            pieces = self.b.pieces
            same = [b"".join([pieces[i] for i in own]) == r for own, r in zip(ids, raw, strict=True)]
            self.memo |= dict.fromkeys(itertools.compress(new, [not x for x in same]))
            new, sizes, ids_b = list(itertools.compress(new, same)), sizes[same], list(itertools.chain.from_iterable(itertools.compress(ids, same)))
        if not new:
            return
        ids_a = self._encode_a(new)
        ends = np.cumsum(sizes)
        a, b = np.array(ids_a), np.array(ids_b)
        labels = np.zeros(ends[-1], np.uint8)
        labels[np.cumsum(self.len_a[a]) - 1] = A_END
        labels[np.cumsum(self.len_b[b]) - 1] += B_END
        at = np.flatnonzero(labels)
        label = labels[at]
        is_a, is_b = (label & A_END).astype(np.int64), (label >> 1).astype(np.int64)
        pairs = (a[np.cumsum(is_a) - is_a] * self.len_b.size + b[np.cumsum(is_b) - is_b]).astype("<i8").tobytes()
        digits = self._digits(labels.tobytes(), ids_a, ids_b)
        links = np.searchsorted(at, ends)
        groups = np.cumsum(label == BOTH)[links - 1]
        per_unit = lambda x: np.diff(x, prepend=0).tolist()
        counts = [per_unit(np.cumsum(is_a)[links - 1]), per_unit(np.cumsum(is_b)[links - 1]), per_unit(groups), per_unit(links)]
        ranges = (zip([0, *x[:-1]], x, strict=True) for x in (groups.tolist(), (8 * links).tolist()))
        self.memo |= {u: (*n, ";".join(digits[g0:g1]), pairs[p0:p1]) for u, *n, (g0, g1), (p0, p1) in zip(new, *counts, *ranges, strict=True)}

    def _same(self, ids: list[list[int]], flat: list[int], sizes: np.ndarray, raw: bytes) -> bool:
        """Whether B's bytes are those of the units, for all of them."""
        ends = np.append(0, np.cumsum(self.len_b[np.array(flat, np.int64)]))[np.cumsum([len(x) for x in ids])]
        return np.array_equal(ends, np.cumsum(sizes)) and b"".join(map(self.b.pieces.__getitem__, flat)) == raw

    def _encode_a(self, units: list[str]) -> list[int]:
        """Ids of all units, one after the other; those that may stand before a blank are encoded as one text."""
        out = []
        for joined, run in itertools.groupby(units, lambda u: _SAFE.match(u[-1]) is not None):
            for text in ["".join(run)] if joined else run:
                out += self.a.encode_plain(text)
        return out

    def _digits(self, labels: bytes, a: list[int], b: list[int]) -> list[str]:
        """The ids of each group in digits, from the spans of the label string."""
        a, b = list(map(self.names_a.__getitem__, a)), list(map(self.names_b.__getitem__, b))
        i = j = 0
        out = []
        for span in _SPANS.findall(labels.translate(None, b"\0")):
            if len(span) == 1:
                out.append(f"{a[i]}|{b[j]}")
                i, j = i + 1, j + 1
            else:
                k, m = i + span.count(b"\1") + 1, j + span.count(b"\2") + 1
                out.append(f"{','.join(a[i:k])}|{','.join(b[j:m])}")
                i, j = k, m
        return out

    def documents(self, texts: list[str | None]) -> list[tuple[int, int, int, int, str, bytes]]:
        """Per text: tokens of A and of B, groups, links, the groups' digits and the id pairs, one after the other."""
        units = [self.units(t) for t in texts]
        self.learn({u for own in units for u in own})
        out = []
        for own in units:
            found = [self.memo[u] for u in own]
            if not found or None in found:
                out.append((0, 0, 0, 0, "", b""))
            else:
                a, b, groups, links, digits, pairs = zip(*found, strict=True)
                out.append((sum(a), sum(b), sum(groups), sum(links), ";".join(digits), b"".join(pairs)))
        return out


@functools.lru_cache(maxsize=2)
def aligner(vocabulary_a: str, vocabulary_b: str) -> Aligner:
    return Aligner(vocabulary_a, vocabulary_b)


_LISTS = {"n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "digests": "string", "n_pairs": "long", "pairs": "long", "held": "long"}
_SCHEMA = ", ".join(f"{c} array<{t}>" for c, t in _LISTS.items()) + ", body binary"


class _Pack:
    """Documents of a task, until their texts have ``PACK_BYTES``."""

    def __init__(self) -> None:
        self.size, self.keys, self.rows, self.pairs, self.many = 0, [], [], [], []

    def add(self, key: pa.Array, size: int, found: list[tuple]) -> None:
        self.size += size
        self.keys.append(key)
        for a, b, groups, links, digits, pairs in found:
            own, many = np.unique(np.frombuffer(pairs, "<i8"), return_counts=True)
            self.rows.append((a, b, groups, links, hashlib.sha256(digits.encode()).hexdigest() if a else "", own.size))
            self.pairs.append(own)
            self.many.append(many)

    def row(self) -> pa.RecordBatch:
        """One row: columns of the documents, the pack's different pairs, in how many documents each is, and which of them each document has how often."""
        pairs, at, held = np.unique(np.concatenate(self.pairs), return_inverse=True, return_counts=True)
        body = pa.compress(np.concatenate([at.astype("<u4"), np.concatenate(self.many).astype("<u4")]).tobytes(), "zstd", asbytes=True)
        lists = [*map(list, zip(*self.rows, strict=True)), pairs, held]
        keys = pa.concat_arrays(self.keys)
        cols = [pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys), *(pa.array([x], pa.list_(pa.string() if t == "string" else pa.int64())) for x, t in zip(lists, _LISTS.values(), strict=True)), pa.array([body], pa.binary())]
        return pa.RecordBatch.from_arrays(cols, ["keys", *_LISTS, "body"])


def packs(docs: DataFrame, vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B, pack_bytes: int = PACK_BYTES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Aligned documents in packs, a row each (see :class:`_Pack`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, pack = aligner(vocabulary_a, vocabulary_b), _Pack()
        for block in blocks(batches, "text", BLOCK_BYTES):
            pack.add(block.column("key"), block.column("text").nbytes, coder.documents(block.column("text").to_pylist()))
            if pack.size >= pack_bytes:
                yield pack.row()
                pack = _Pack()
        if pack.keys:
            yield pack.row()

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"keys array<{rows.schema['key'].dataType.simpleString()}>, {_SCHEMA}")


def pair_counts(asked: DataFrame, size_b: int) -> DataFrame:
    """Per id pair: c, the number of documents that hold it linked, and best, whether no pair of its A id has more."""
    counts = asked.groupBy("pair").agg(F.sum("held").alias("c"))
    # an A id has at most as many pairs as B has ids
    own = Window.partitionBy(F.floor(F.col("pair") / size_b))
    return counts.select("pair", "c", (F.col("c") == F.max("c").over(own)).alias("best"))


def align(docs: DataFrame, vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B, pack_bytes: int = PACK_BYTES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    scratch = Scratch(docs.sparkSession, "alignment")
    made = packs(docs, vocabulary_a, vocabulary_b, pack_bytes, text, key).withColumn("pack", F.monotonically_increasing_id())
    made = scratch.keep(made, "packs")
    asked = made.select("pack", F.explode(F.arrays_zip("pairs", "held")).alias("p")).select("pack", F.col("p.pairs").alias("pair"), F.col("p.held").alias("held"))
    counts = pair_counts(asked, len(PieceEncoder(tokens.resolve(vocabulary_b)).pieces))
    answers = asked.select("pack", "pair").join(counts, "pair").groupBy("pack").agg(F.collect_list(F.struct("pair", "c", "best")).alias("answers"))
    kind = made.schema["keys"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                of = lambda c: batch.column(c)[i]  # noqa: B023, E731
                n_pairs = of("n_pairs").values.to_numpy()
                n_best, count_sum = np.zeros(n_pairs.size, np.int64), np.zeros(n_pairs.size, np.int64)
                total, some = int(n_pairs.sum()), n_pairs > 0
                if total:
                    body = np.frombuffer(pa.decompress(of("body").as_buffer(), 8 * total, "zstd"), "<u4").astype(np.int64)
                    at, many = body[:total], body[total:]
                    given = of("answers").values
                    order = np.argsort(given.field("pair").to_numpy())
                    c = given.field("c").to_numpy()[order]
                    best = given.field("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
                    starts = (np.cumsum(n_pairs) - n_pairs)[some]
                    n_best[some], count_sum[some] = np.add.reduceat(best[at] * many, starts), np.add.reduceat(c[at] * many, starts)
                plain = [of(c).values for c in ("keys", "n_a", "n_b", "n_groups", "n_links")]
                yield pa.RecordBatch.from_arrays([*plain, pa.array(n_best), pa.array(count_sum), of("digests").values], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    joined = made.drop("pairs", "held").join(answers, "pack", "left").drop("pack")
    return joined.mapInArrow(run, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
