"""b-bit MinHash near-duplicates, with every link confirmed on full shingle sets.

1. Each text becomes its set of distinct word shingles (64-bit hashes).  Minima
   under ``BANDS * ROWS`` permutations give one key per band; the low ``BITS``
   bits of all minima are packed into a signature.
2. Texts with equal sets are one class, represented by the smallest document.
3. Representatives that share a band key are candidates.  In each bucket all are
   compared with one centre, by signature first (collision-corrected estimate
   from bit counts, with a slack of six standard deviations), then on full sets.
4. Where a bucket's members are still in several components, those outside its
   largest one (its strays) are compared with all: the bucket is dealt out in
   blocks, each member to one of them, and the strays stream past every block.
   Bit counts pick the texts with a possible partner, exact intersection counts
   through the block's inverted index decide.  A task holds one block.
5. In a bucket of more than ``STRAYS`` strays that would be strays times blocks.
   Its members are dealt anew by their rarest shingles before step 4: a similar
   pair must share one of those that :func:`rare_keys` takes, so no link is lost,
   and texts that share a template alone have none in common.
6. Components over the confirmed links give the groups.

Band keys miss a pair of similarity 0.8 with probability (1 - 0.8^4)^32 < 1e-7.
Pairs are never listed for a whole bucket, and no bucket is capped or dropped.

Edge cases: null, empty and blank texts have an empty set and no links; shorter
texts than a shingle are one shingle; a null ``doc_id`` is never linked (its
component is null, it is kept); a repeated ``doc_id`` counts as one document
whose links are those of all its rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.components import components
from tidewatch.llm.scratch import Scratch
from tidewatch.llm.textblock import blocks, gram_hashes, mix, span_hashes, text_bytes, word_spans

SHINGLE, PERCENT = 5, 80
BANDS, ROWS, BITS = 32, 4, 4
HASHES = BANDS * ROWS
#: Estimates this far under the threshold are still confirmed: six standard deviations at 128 hashes and 4 bits.
SLACK = 0.22
#: Members of a block of a bucket, and shingles of all its members, on average.
BLOCK, BLOCK_SHINGLES = 256, 1 << 18
#: Strays of a bucket that are compared with all its members; with more of them, members are first dealt by rare shingles.
STRAYS = 4 * BLOCK
#: Ratio of the set sizes that are one class when members are dealt by rare shingles.
SIZE_RATIO = 1.05

_RNG = np.random.default_rng(77)
_XOR = _RNG.integers(0, 2**32, HASHES, dtype=np.uint32)
_MUL = _RNG.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_NIBBLES = 0x1111111111111111


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    starts, ends, words = word_spans(data, off)
    hashes = span_hashes(data, starts, ends)
    grams = gram_hashes(hashes, k)
    out = []
    for a, b in zip(words[:-1].tolist(), words[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        else:
            out.append(gram_hashes(hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """Minima of each nonempty set under each permutation, as a matrix of rows by HASHES."""
    sizes = np.array([s.size for s in sets])
    full = np.flatnonzero(sizes)
    out = np.zeros((len(sets), HASHES), np.uint32)
    if full.size:
        x = np.concatenate([sets[i] for i in full])
        x = (x ^ (x >> np.uint64(32))).astype(np.uint32)
        at = np.cumsum(sizes[full]) - sizes[full]
        got = np.empty((HASHES, full.size), np.uint32)
        for j in range(HASHES):
            y = x ^ _XOR[j]
            y *= _MUL[j]
            y ^= y >> np.uint32(15)
            got[j] = np.minimum.reduceat(y, at)
        out[full] = got.T
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    """One 64-bit key per row and band."""
    out = np.zeros((least.shape[0], BANDS), np.uint64)
    wide = least.astype(np.uint64).reshape(-1, BANDS, ROWS)
    for r in range(ROWS):
        out = mix((out ^ wide[:, :, r]) * np.uint64(0x9E3779B97F4A7C15) + np.arange(1, BANDS + 1, dtype=np.uint64))
    return out


def signatures(least: np.ndarray) -> np.ndarray:
    """The low four bits of every minimum, sixteen to a 64-bit word."""
    low = (least & np.uint32(15)).astype(np.uint64).reshape(least.shape[0], HASHES // 16, 16)
    return (low << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(axis=2, dtype=np.uint64)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity from packed signatures, corrected for minima that agree in four bits by chance."""
    x = a ^ b
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    x &= np.uint64(_NIBBLES)
    agree = 1.0 - np.bitwise_count(x).sum(axis=-1) / HASHES
    chance = 0.5**BITS
    return (agree - chance) / (1.0 - chance)


def _estimate_column(a: str, b: str) -> F.Column:
    """The same in Spark expressions, on arrays of longs."""
    def differing(i: int) -> F.Column:
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        return F.bit_count(x.bitwiseAND(F.lit(_NIBBLES)))

    agree = F.lit(1.0) - sum((differing(i) for i in range(HASHES // 16)), F.lit(0)) / F.lit(float(HASHES))
    chance = 0.5**BITS
    return (agree - F.lit(chance)) / F.lit(1.0 - chance)


def _lists(matrix: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(matrix).reshape(-1).view(np.int64))
    return pa.ListArray.from_arrays(pa.array(np.arange(matrix.shape[0] + 1, dtype=np.int32) * matrix.shape[1]), flat)


def _content(sets: list[np.ndarray]) -> np.ndarray:
    """Two 64-bit sums over each set, which stand for its content."""
    out = np.zeros((len(sets), 2), np.uint64)
    for i, s in enumerate(sets):
        if s.size:
            out[i] = s.sum(dtype=np.uint64), mix(s ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)
    return out


def sketch(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: doc_id, n_shingles, c1 and c2 (content of the set), bands, sig."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text):
            sets = shingle_sets(*text_bytes(block.column(text)), shingle)
            least, content = minima(sets), _content(sets).view(np.int64)
            cols = [block.column(key).cast(pa.int64()), pa.array([s.size for s in sets], pa.int64()), pa.array(content[:, 0]), pa.array(content[:, 1]), _lists(band_keys(least)), _lists(signatures(least))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_shingles", "c1", "c2", "bands", "sig"])

    return docs.select(key, text).mapInArrow(run, "doc_id long, n_shingles long, c1 long, c2 long, bands array<long>, sig array<long>")


def _full_sets(docs: DataFrame, wanted: DataFrame, shingle: int, text: str, key: str) -> DataFrame:
    """doc_id and its shingles, for the documents in ``wanted`` (column doc_id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text):
            sets = shingle_sets(*text_bytes(block.column(text)), shingle)
            ends = np.cumsum([0] + [s.size for s in sets]).astype(np.int32)
            flat = pa.array(np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64))
            content = _content(sets).view(np.int64)
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(content[:, 0]), pa.array(content[:, 1]), pa.ListArray.from_arrays(pa.array(ends), flat)], ["doc_id", "c1", "c2", "shingles"])

    own = docs.select(F.col(key).cast("long").alias("doc_id"), text).join(wanted.select("doc_id"), "doc_id", "left_semi")
    sets = own.mapInArrow(run, "doc_id long, c1 long, c2 long, shingles array<long>")
    return sets.join(wanted.select("doc_id", "c1", "c2"), ["doc_id", "c1", "c2"]).dropDuplicates(["doc_id", "c1", "c2"]).select("doc_id", "shingles")


def rare_keys(sets: DataFrame, percent: int) -> DataFrame:
    """band and doc_id: keys by which sets (doc_id, shingles) of similarity ``percent`` or more must meet.

    Shingles are put in one order, rare ones first.  Sets of m and n shingles that
    are similar share at least (m + n) * percent / (100 + percent) of them, so the
    first one that both hold is among the first m + 1 less that many.  A set is
    dealt by these to every class of sizes a partner can have.  Shingles of one set
    alone take places but give no key: a set with enough of them has none at all.
    """
    own = sets.select("doc_id", F.xxhash64("doc_id", "shingles").alias("set"), F.size("shingles").alias("m"), F.explode("shingles").alias("token"))
    common = own.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = own.join(common, "token").groupBy("doc_id", "set", "m").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("shared"))
    size_class = lambda size: F.floor(F.log(size.cast("double")) / F.log(F.lit(SIZE_RATIO))).cast("int")
    smallest, largest = F.greatest(F.floor(F.col("m") * percent / 100), F.lit(1)), F.ceil(F.col("m") * 100 / percent)
    dealt = shared.withColumns({"own": size_class(F.col("m")), "other": F.explode(F.sequence(size_class(smallest), size_class(largest)))})
    # a little under the least size of the class, whatever the logarithm was rounded to
    least = F.floor(F.pow(F.lit(SIZE_RATIO), F.col("other")) * 0.999999)
    need = F.ceil(((F.col("m") + least) * percent / (100 + percent)) - 1e-9)
    dealt = dealt.withColumn("take", F.least(F.col("m") - need + 1 - (F.col("m") - F.size("shared")), F.size("shared")).cast("int")).where("take > 0")
    keys = dealt.select("doc_id", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), F.explode(F.slice("shared", F.lit(1), F.col("take"))).alias("s"))
    return keys.select(F.xxhash64("a", "b", "s.token").alias("band"), "doc_id").distinct()


def _once(members: DataFrame) -> DataFrame:
    """``members`` (band, doc_id) without bands of one document and those that hold the same documents as another."""
    content = members.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("doc_id")).alias("x"), F.bit_xor(F.xxhash64("doc_id", F.lit(1))).alias("y")).where("n > 1")
    return members.join(content.groupBy("n", "x", "y").agg(F.min("band").alias("band")).select("band"), "band", "left_semi")


def _apart(rooted: DataFrame) -> DataFrame:
    """Bands of ``rooted`` (band, n_shingles, doc_id, root) with several components: blocks, top (the largest component) and strays (members outside it)."""
    parts = rooted.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("w"))
    apart = parts.groupBy("band").agg(F.sum("n").alias("n"), F.sum("w").alias("w"), F.max(F.struct("n", "root")).alias("top"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
    blocks_of = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("w") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    return apart.select("band", blocks_of, F.col("top.root").alias("top"), (F.col("n") - F.col("top.n")).alias("strays"))


def _similar(a: str, b: str, percent: int) -> F.Column:
    shared = F.size(F.array_intersect(a, b))
    return shared * 100 >= (F.size(a) + F.size(b) - shared) * percent


class _Signatures:
    """Finds members of a block and strays with a possible partner in another component."""

    schema = "band long, j int, side int, doc_id long, root long"
    names = ("band", "j", "side", "doc_id", "root")

    def __init__(self, block: pa.Table, percent: int):
        self.block, self.least = block, percent / 100 - SLACK
        self.sig, self.root = _signature_rows(block), block.column("root").to_numpy()
        self.near = np.zeros(block.num_rows, bool)

    def _chosen(self, table: pa.Table, which: np.ndarray) -> pa.Table:
        return table.filter(pa.array(which)).select(self.names)

    def meet(self, strays: pa.Table) -> pa.Table:
        own = np.zeros(strays.num_rows, bool)
        for i, (sig, root) in enumerate(zip(_signature_rows(strays), strays.column("root").to_numpy(), strict=True)):
            partner = (estimate(self.sig, sig) >= self.least) & (self.root != root)
            own[i] = partner.any()
            self.near |= partner
        return self._chosen(strays, own)

    def finish(self) -> pa.Table:
        return self._chosen(self.block, self.near)


class _Sets:
    """Finds links between strays and members of a block in other components, enough to join all that are linked."""

    schema = "a long, b long"

    def __init__(self, block: pa.Table, percent: int):
        self.percent, self.ids, self.root = percent, block.column("doc_id").to_numpy(), block.column("root").to_numpy().copy()
        self.sig = _signature_rows(block)
        flat, at = _list_column(block, "shingles")
        self.sizes = np.diff(at)
        order = np.argsort(flat, kind="stable")
        self.holders = np.repeat(np.arange(self.ids.size), self.sizes)[order]
        self.tokens, self.first = np.unique(flat[order], return_index=True)
        self.first = np.append(self.first, flat.size)
        self.joined: dict[int, int] = {}

    def meet(self, strays: pa.Table) -> pa.Table:
        out = []
        flat, at = _list_column(strays, "shingles")
        for i, (x, root, sig) in enumerate(zip(strays.column("doc_id").to_pylist(), strays.column("root").to_pylist(), _signature_rows(strays), strict=True)):
            while root in self.joined:
                root = self.joined[root]
            mine = flat[at[i] : at[i + 1]]
            possible = (self.root != root) & (estimate(self.sig, sig) >= self.percent / 100 - SLACK)
            possible &= np.minimum(self.sizes, mine.size) * 100 >= np.maximum(self.sizes, mine.size) * self.percent
            if not possible.any():
                continue
            token = np.searchsorted(self.tokens, mine)
            token = token[self.tokens[np.minimum(token, self.tokens.size - 1)] == mine]
            counts = self.first[token + 1] - self.first[token]
            take = np.repeat(self.first[token] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            shared = np.bincount(self.holders[take], minlength=self.ids.size)
            for y in np.flatnonzero(possible & (shared * 100 >= (self.sizes + mine.size - shared) * self.percent)).tolist():
                other = int(self.root[y])
                if other != root:
                    out.append((x, int(self.ids[y])))
                    self.joined[other] = root
                    self.root[self.root == other] = root
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    def finish(self) -> None:
        return None


def _signature_rows(table: pa.Table) -> np.ndarray:
    return table.column("sig").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(table.num_rows, -1)


def _list_column(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    lists = table.column(name).combine_chunks()
    at = lists.offsets.to_numpy().astype(np.int64)
    return lists.values.to_numpy()[at[0] : at[-1]], at - at[0]


def _by_block(members: DataFrame, percent: int, partitions: int, kind: type) -> DataFrame:
    """``kind`` over ``members`` (with band, j, side) dealt by band and j: made of a block (side 0), then met by its strays (side 1) a few at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current, block = None, None

        def out(table: pa.Table | None) -> list[pa.RecordBatch]:
            return table.combine_chunks().to_batches() if table is not None and table.num_rows else []

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("band", "j", "side")], axis=1)
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, b in itertools.pairwise(edges):
                own, side = (int(keys[a, 0]), int(keys[a, 1])), int(keys[a, 2])
                if own != current:
                    if block is not None:
                        yield from out(block.finish())
                    held, block, current = [], None, own
                if side == 0:
                    held.append(batch.slice(a, b - a))
                    continue
                if held:
                    block, held = kind(pa.Table.from_batches(held).combine_chunks(), percent), []
                if block is not None:
                    for at in range(a, b, BLOCK):
                        yield from out(block.meet(pa.Table.from_batches([batch.slice(at, min(BLOCK, b - at))]).combine_chunks()))
        if block is not None:
            yield from out(block.finish())

    return members.repartition(partitions, "band", "j").sortWithinPartitions("band", "j", "side").mapInArrow(run, kind.schema)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, text: str = "text", key: str = "doc_id", scratch: Scratch | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (the smallest document reachable by links), kept."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "neardup")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = scratch.keep(sketch(docs, shingle, text, key), "sketches")
    classes = (
        rows.where("doc_id is not null and n_shingles > 0")
        .groupBy("c1", "c2")
        .agg(F.min("doc_id").alias("rep"), F.any_value("n_shingles").alias("n_shingles"), F.any_value("bands").alias("bands"), F.any_value("sig").alias("sig"))
    )
    classes = scratch.keep(classes, "classes")
    members = classes.select("rep", "n_shingles", F.explode("bands").alias("band"))
    rank = F.struct(F.xxhash64("rep").alias("h"), F.col("rep").alias("rep"))
    buckets = members.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min(rank).alias("centre")).where("n > 1").select("band", F.col("centre.rep").alias("centre"))
    members = scratch.keep(members.join(buckets, "band"), "members")
    sig = classes.select(F.col("rep").alias("doc_id"), "c1", "c2", "sig")
    # centres: by signature, then on full sets
    pairs = members.where("rep <> centre").select(F.col("rep").alias("a"), F.col("centre").alias("b")).distinct()
    pairs = pairs.join(sig.select(F.col("doc_id").alias("a"), F.col("sig").alias("sa")), "a").join(sig.select(F.col("doc_id").alias("b"), F.col("sig").alias("sb")), "b")
    pairs = scratch.keep(pairs.where(_estimate_column("sa", "sb") >= percent / 100 - SLACK).select("a", "b"), "pairs")
    wanted = pairs.select(F.col("a").alias("doc_id")).unionAll(pairs.select(F.col("b").alias("doc_id"))).distinct()
    sets = scratch.keep(_full_sets(docs, sig.drop("sig").join(wanted, "doc_id"), shingle, text, key), "sets")
    both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("xa")), "a").join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("xb")), "b")
    links = scratch.keep(both.where(_similar("xa", "xb", percent)).select("a", "b"), "links")
    first = components(links, scratch)
    # what is still apart within a bucket: by signature, then on full sets
    nodes = classes.select(F.col("rep").alias("doc_id"), "n_shingles").join(first, F.col("doc_id") == F.col("node"), "left").select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("root"))
    nodes = scratch.keep(nodes.groupBy("doc_id", "root").agg(F.max("n_shingles").alias("n_shingles")), "nodes")
    rooted = scratch.keep(members.select("band", F.col("rep").alias("doc_id")).distinct().join(nodes, "doc_id"), "rooted")
    apart = scratch.keep(_apart(rooted), "apart")
    crowded = rooted.join(apart.where(F.col("strays") > STRAYS).select("band"), "band", "left_semi").select("doc_id").distinct()
    crowded = scratch.keep(sig.drop("sig").join(crowded, "doc_id"), "crowded")
    if crowded.take(1):
        keys = scratch.keep(rare_keys(scratch.keep(_full_sets(docs, crowded, shingle, text, key), "crowded-sets"), percent), "keys")
        rare = scratch.keep(_once(keys).join(nodes, "doc_id"), "rare")
        rooted = rooted.join(apart.where(F.col("strays") <= STRAYS).select("band"), "band", "left_semi").unionByName(rare)
        apart = scratch.keep(apart.where(F.col("strays") <= STRAYS).unionByName(_apart(rare)), "apart")
    rest = rooted.join(apart, "band")
    placed = rest.select("band", F.pmod(F.xxhash64("doc_id"), "blocks").cast("int").alias("j"), F.lit(0).alias("side"), "doc_id", "root")
    strays = rest.where("root <> top").select("band", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"), F.lit(1).alias("side"), "doc_id", "root")
    close = scratch.keep(_by_block(placed.unionAll(strays).join(sig.select("doc_id", "sig"), "doc_id"), percent, partitions, _Signatures), "close")
    missing = close.select("doc_id").distinct().join(sets.select("doc_id"), "doc_id", "left_anti")
    missing = scratch.keep(sig.drop("sig").join(missing, "doc_id"), "missing")
    more_sets = _full_sets(docs, missing, shingle, text, key).unionByName(sets)
    more = _by_block(close.join(sig.select("doc_id", "sig"), "doc_id").join(more_sets, "doc_id"), percent, partitions, _Sets)
    more = scratch.keep(more.distinct(), "links")
    # an id whose rows are in several classes joins them
    several = rows.where("doc_id is not null and n_shingles > 0").groupBy("doc_id").agg(F.min(F.struct("c1", "c2")).alias("lo"), F.max(F.struct("c1", "c2")).alias("hi")).where("lo <> hi").select("doc_id")
    own = rows.where("n_shingles > 0").select("doc_id", "c1", "c2").join(several, "doc_id").join(classes.select("c1", "c2", "rep"), ["c1", "c2"]).select("doc_id", "rep")
    same = scratch.keep(own.join(own.groupBy("doc_id").agg(F.min("rep").alias("b")), "doc_id").where("rep <> b").select(F.col("rep").alias("a"), "b").distinct(), "same")
    final = components(links.unionAll(more).unionAll(same), scratch)
    by_class = classes.select("c1", "c2", "rep").join(final, F.col("rep") == F.col("node"), "left").select("c1", "c2", F.coalesce("root", "rep").alias("_root"))
    # rows with an empty set go with the other rows of their id
    blank = rows.where("doc_id is not null and n_shingles = 0").select("doc_id").distinct()
    blank = rows.where("n_shingles > 0").select("doc_id", "c1", "c2").join(blank, "doc_id").join(by_class, ["c1", "c2"]).groupBy("doc_id").agg(F.min("_root").alias("_own"))
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("_root", "_own", "doc_id"))
    out = rows.select("doc_id", "n_shingles", "c1", "c2").join(by_class, ["c1", "c2"], "left").join(blank, "doc_id", "left").withColumn("component_id", component)
    return out.select("doc_id", "n_shingles", "component_id", (F.col("component_id").isNull() | (F.col("component_id") == F.col("doc_id"))).alias("kept"))
