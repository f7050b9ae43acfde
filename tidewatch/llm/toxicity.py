"""Toxicity after noisy-channel deobfuscation.

1. A character trigram model is counted over all texts (a table of fixed size).
2. Words that may be disguised (digits or symbols among letters, letters spelt
   out one by one or with dots, a letter three times running) become lattices:
   each observed character is a letter of its own, a letter it stands for, a
   mark to be skipped or a repetition.  Viterbi decoding under the character
   model and the channel's costs restores the word.  A run of one-character
   words is one lattice, whose gaps are skipped or end a word; marks among
   letters may end a word too.  Both readings count, with word ends and without.
   No word or run is too long: decoding is linear and lets go of what is settled.
3. Hashed character grams of restored words get smoothed log odds of toxic
   against clean documents, counted over labelled rows.  A document's score is a
   logistic function of its highest word scores, fitted on other labelled rows
   than those that were counted.

Only rows whose crc32(doc_id) mod 5 is not 0 are learnt from: remainders 1 and 2
are counted, 3 and 4 fit the logistic function.  At most ``TRAIN_ROWS`` labelled
rows are used.

Edge cases: null and empty texts get the score of a text without words; a null
``doc_id`` is not held out and has no label; without labelled rows of both kinds
all scores are 0; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.textblock import _BYTE_CODE, _power_tables, FOLD, blocks, mix, span_hashes, text_bytes, word_spans

TRAIN_ROWS = 20_000
BUCKET_BITS, TOP_WORDS, SMOOTH = 18, 6, 12.0
#: Texts of fewer words than this hardly differ by their length.
FEW_WORDS = 8
FEATURES = TOP_WORDS + 2
PREFIXES, INNER = (4, 5, 6, 7), 6

#: What a character may stand for (fixed values).
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
}
SKIP_MARKS = ".-_*~'^`,/\\"
COST_LEET, COST_SKIP_MARK, COST_REPEAT, COST_DROP = 0.7, 0.2, 0.4, 12.0
#: A gap wider than the narrowest of its run is skipped at this cost; narrow gaps are skipped or end a word at none.
COST_WIDE_GAP = 6.0
GAP, WIDE_GAP = " ", "\t"
#: Words that are remembered at most, and bytes of each; what is longer is decoded each time.
MEMO_WORDS, MEMO_BYTES = 50_000, 64
#: Text bytes worked on at once: what is held beside them is many times that.
BLOCK_BYTES = 1 << 19
#: Characters after which the letters that all paths share are put out.
SETTLE = 512

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LEET_BYTE = np.zeros(256, bool)
_LEET_BYTE[[ord(c) for c in LEET if ord(c) < 128]] = True
_SKIP_BYTE = np.zeros(256, bool)
_SKIP_BYTE[[ord(c) for c in SKIP_MARKS]] = True
_FIRST_BYTE = (np.arange(256) & 0xC0) != 0x80
_TRAILING = np.zeros(256, bool)
_TRAILING[list(b".,;:!?)\"'|")] = True

#: Classes of the character model: 0 edge or other, 1-26 letters, 27-57 the letters after 0xC3, 58 other bytes of letters.
CLASSES = 64
_CLASS = np.zeros(256, np.int64)
_CLASS[65:91] = _CLASS[97:123] = np.arange(1, 27)
_CLASS[0xC3] = 59
_CLASS[0xC4:] = 58
_CLASS[0x80:0xC0] = 58
_CLASS[0xA0:0xBF] = np.arange(27, 58)


def fold_case(data: np.ndarray) -> np.ndarray:
    """Lower case for A-Z and the letters U+00C0 to U+00DE, byte by byte."""
    out = FOLD[data]
    if data.size > 1:
        after = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        out[after] += 0x20
    return out


def char_class(c: str) -> list[int]:
    """The classes of one character's bytes."""
    return _CLASS[np.frombuffer(c.encode(), np.uint8)].tolist()


def count_characters(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Trigram counts of character classes over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**3, np.int64)
        for block in blocks(batches, text, BLOCK_BYTES):
            data, _ = text_bytes(block.column(text))
            if data.size > 2:
                c = _CLASS[fold_case(data)]
                a, b, c = c[:-2], c[1:-1], c[2:]
                # a letter three times running is the channel's, so drawn-out words do not teach the model to keep them
                own = ~((a == b) & (b == c) & (c > 0) & (c < 27))
                total += np.bincount(((a * CLASSES + b) * CLASSES + c)[own], minlength=total.size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["gram", "n"])

    # at most CLASSES ** 3 rows, whatever the input
    rows = docs.select(text).mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(CLASSES**3, np.int64)
    out[rows.column("gram").to_numpy()] = rows.column("n").to_numpy()
    return out


class Deobfuscator:
    """Restores disguised words by Viterbi decoding under a trigram model."""

    def __init__(self, counts: np.ndarray):
        c = counts.reshape(CLASSES, CLASSES, CLASSES).astype(np.float64)
        single = c.sum(axis=(0, 1)) + 1.0
        single /= single.sum()
        double = c.sum(axis=0)
        double = (double + 5 * single[None, :]) / (double.sum(axis=1, keepdims=True) + 5)
        triple = (c + 5 * double[None]) / (c.sum(axis=2, keepdims=True) + 5)
        self.cost = (-np.log(triple)).astype(np.float32)
        self.memo: dict[bytes, tuple[bytes, ...]] = {}

    def restore(self, word: bytes) -> bytes:
        """The likeliest word behind ``word`` (lower case), whose marks and gaps end no word."""
        return self.readings(word)[0]

    def readings(self, word: bytes) -> tuple[bytes, ...]:
        """The likeliest word behind ``word`` (lower case), then, if marks or gaps may end words, the words of that reading."""
        out = self.memo.get(word)
        if out is None:
            plain = word.decode("utf-8", "ignore").lower()
            out = (self._decode(plain),)
            if any(c in SKIP_MARKS or c in (GAP, WIDE_GAP) for c in plain):
                out = tuple(dict.fromkeys((*out, *self._decode(plain, True).split())))
            if len(word) <= MEMO_BYTES:
                if len(self.memo) >= MEMO_WORDS:
                    self.memo.clear()
                self.memo[word] = out
        return out

    @staticmethod
    def _settled(states: dict, letters: list[str]) -> dict:
        """Puts out the letters that the paths to all states share, and the states with paths cut off there."""
        paths = []
        for _, back, _ in states.values():
            path = []
            while back is not None:
                path.append(back)
                back = back[0]
            paths.append(path[::-1])
        shared = 0
        while all(len(p) > shared for p in paths) and len({id(p[shared]) for p in paths}) == 1:
            shared += 1
        if not shared:
            return states
        letters += [node[1] for node in paths[0][:shared]]
        made: dict[int, tuple] = {}
        out = {}
        for (state, (cost, _, last)), path in zip(states.items(), paths, strict=True):
            back = None
            for node in path[shared:]:
                back = made.setdefault(id(node), (back, node[1]))
            out[state] = (cost, back, last)
        return out

    def _decode(self, word: str, ends: bool = False) -> bytes:
        """The likeliest letters behind ``word``; with ``ends``, marks and gaps may end words, which are put apart by spaces."""
        # state: the last two classes and the last letter; value: cost, what was put out on the way there (linked), the last letter
        states: dict[tuple[int, int, str], tuple[float, tuple | None, str]] = {(0, 0, ""): (0.0, None, "")}
        letters: list[str] = []
        # gaps between equal letters do not hide a repetition
        solid = [(i, c) for i, c in enumerate(word) if c not in (GAP, WIDE_GAP)]
        running = [False] * len(word)
        for k in range(len(solid) - 2):
            if solid[k][1] == solid[k + 1][1] == solid[k + 2][1]:
                for i, _ in solid[k : k + 3]:
                    running[i] = True
        for at, (c, in_run) in enumerate(zip(word, running, strict=True)):
            options: list[tuple[str, float]] = []
            if c.isalpha():
                options.append((c, 0.0))
            if c in LEET:
                options += [(x, COST_LEET) for x in LEET[c]]
            skip = 0.0 if c == GAP else COST_WIDE_GAP if c == WIDE_GAP else COST_SKIP_MARK if c in SKIP_MARKS else COST_DROP
            may_end = ends and (c in SKIP_MARKS or c in (GAP, WIDE_GAP))
            after: dict[tuple[int, int, str], tuple[float, tuple | None, str]] = {}
            for state, (cost, back, _) in states.items():
                a, b, last = state
                again = in_run and any(x == last for x, _ in options)
                if again or not c.isalpha():
                    total = cost + (COST_REPEAT if again else skip)
                    if state not in after or total < after[state][0]:
                        after[state] = (total, back, last)
                if may_end and last:
                    new = (b, 0, "")
                    total = cost + float(self.cost[a, b, 0]) + (COST_SKIP_MARK if c in SKIP_MARKS else 0.0)
                    if new not in after or total < after[new][0]:
                        after[new] = (total, (back, " "), "")
                for letter, channel in options:
                    p, q, total = a, b, cost + channel
                    for k in char_class(letter):
                        total += float(self.cost[p, q, k])
                        p, q = q, k
                    new = (p, q, letter)
                    if new not in after or total < after[new][0]:
                        after[new] = (total, (back, letter), letter)
            states = after
            if at % SETTLE == SETTLE - 1:
                states = self._settled(states, letters)
        back = min(states.values(), key=lambda x: x[0])[1]
        rest = []
        while back is not None:
            rest.append(back[1])
            back = back[0]
        return "".join(letters + rest[::-1]).encode()


def restored_words(data: np.ndarray, off: np.ndarray, decoder: Deobfuscator) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct restored words of a block and which rows hold them.

    Returns a byte buffer, starts and ends of the distinct words in it, and the
    distinct (row, word) pairs as two arrays.
    """
    folded = fold_case(data)
    starts, ends, words = word_spans(folded, off)
    row = np.repeat(np.arange(off.size - 1), np.diff(words))
    if not starts.size:
        none = np.zeros(0, np.int64)
        return folded, none, none, none, none
    hashes = span_hashes(folded, starts, ends, fold=False)
    _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    us, ue = starts[first], ends[first]
    # trim: what is no letter at either end, unless it may stand for one
    letter = _LETTER[folded]
    position = np.arange(folded.size)
    next_letter = np.minimum.accumulate(np.where(letter, position, folded.size)[::-1])[::-1]
    last_letter = np.maximum.accumulate(np.where(letter, position, -1))
    last_kept = np.maximum.accumulate(np.where(_TRAILING[folded], -1, position))
    inner_start = np.minimum(next_letter[us], ue)
    inner_end = np.maximum(last_letter[ue - 1] + 1, inner_start)
    tail = np.clip(ue - 1, 2, None)
    thrice = (ue - us > 3) & (folded[tail] == folded[tail - 1]) & (folded[tail] == folded[tail - 2]) & ~letter[tail]
    kept_end = np.where(thrice, inner_end, np.maximum(last_kept[ue - 1] + 1, inner_start))

    def total(x: np.ndarray) -> np.ndarray:
        return np.append(0, np.cumsum(x))

    letters, leets = total(letter), total(_LEET_BYTE[folded])
    run = np.zeros(folded.size, bool)
    run[2:] = letter[2:] & (folded[2:] == folded[1:-1]) & (folded[2:] == folded[:-2])
    runs = total(run)
    has_letter = inner_end > inner_start
    inner_marks = (inner_end - inner_start) - (letters[inner_end] - letters[inner_start])
    odd = has_letter & ((inner_marks > 0) | (leets[kept_end] - leets[np.minimum(us, kept_end)] > 0) | (runs[inner_end] - runs[np.minimum(inner_start + 2, inner_end)] > 0))
    # runs of words of one letter (or what may stand for one, marks beside it or between them)
    lead, at_mark = total(_FIRST_BYTE[folded]), total(_SKIP_BYTE[folded])
    own = total(letter & _FIRST_BYTE[folded])
    cores = own[ends] - own[starts] + leets[ends] - leets[starts]
    chars = lead[ends] - lead[starts]
    single = (cores + at_mark[ends] - at_mark[starts] == chars) & ((cores == 1) | ((cores == 0) & (chars == 1)))
    joined = np.append(False, single[1:] & single[:-1] & (row[1:] == row[:-1]))
    first_of, after_of = np.flatnonzero(single & ~joined), np.flatnonzero(single & ~np.append(joined[1:], False)) + 1
    core_words, letter_words = total(single & (cores == 1)), total(single & (own[ends] > own[starts]))
    some = (core_words[after_of] - core_words[first_of] > 1) & (letter_words[after_of] > letter_words[first_of])
    raw = folded.tobytes()
    spelt: dict[bytes, list[int]] = {}
    if some.any():
        # from the first to the last word with a core, all runs in one buffer, where a gap's last byte stands for it
        held = np.flatnonzero(cores)
        a, b = held[np.searchsorted(held, first_of[some])], held[np.searchsorted(held, after_of[some]) - 1] + 1
        n = b - a
        k = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())
        later = k > np.repeat(a, n)
        gap = np.append(0, starts[1:] - ends[:-1])
        narrow = np.minimum.reduceat(np.append(gap, 0), np.column_stack([a + 1, b]).ravel())[::2]
        begin = starts[k] - later
        size = ends[k] - begin
        to = np.cumsum(size)
        spelling = folded[np.repeat(begin - (to - size), size) + np.arange(to[-1])]
        spelling[(to - size)[later]] = np.where((gap[k] > np.repeat(narrow, n))[later], ord(WIDE_GAP), ord(GAP))
        run_to = to[np.cumsum(n) - 1].tolist()
        joined_up = spelling.tobytes()
        for x, y, r in zip([0, *run_to[:-1]], run_to, row[a].tolist(), strict=True):
            spelt.setdefault(joined_up[x:y], []).append(r)
    extra: list[bytes] = []
    at = folded.size
    # by distinct word: the likeliest word in its place; more readings are words of their own
    places = inner_start.tolist(), inner_end.tolist()
    more_of, more_row, more_word = [], [], []

    def place(word: bytes) -> tuple[int, int]:
        nonlocal at
        extra.append(word)
        at += len(word)
        return at - len(word), at

    for u in np.flatnonzero(odd).tolist():
        one, *more = decoder.readings(raw[us[u] : kept_end[u]])
        places[0][u], places[1][u] = place(one)
        for word in more:
            more_of.append((u, len(places[0])))
            for x, y in zip(places, place(word), strict=True):
                x.append(y)
    for run_bytes, rows in spelt.items():
        for word in decoder.readings(run_bytes):
            more_row += rows
            more_word += [len(places[0])] * len(rows)
            for x, y in zip(places, place(word), strict=True):
                x.append(y)
    ws, we = np.array(places[0], np.int64), np.array(places[1], np.int64)
    buffer = np.concatenate([folded, np.frombuffer(b"".join(extra), np.uint8)]) if extra else folded
    rows_of, words_of = [row, np.array(more_row, np.int64)], [inverse, np.array(more_word, np.int64)]
    if more_of:  # every row that holds a word holds its other readings
        source, made = np.array(more_of, np.int64).T
        order = np.argsort(inverse, kind="stable")
        lo, n = np.searchsorted(inverse[order], source), np.bincount(inverse, minlength=us.size)[source]
        rows_of.append(row[order[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())]])
        words_of.append(np.repeat(made, n))
    pair = np.unique(np.concatenate(rows_of) * np.int64(len(ws)) + np.concatenate(words_of))
    return buffer, ws, we, pair // len(ws), pair % len(ws)


def word_buckets(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of words (whole, prefixes, inner grams): word and bucket, one row for each."""
    powers, inverse = _power_tables(buffer.size + 1)
    sums = np.zeros(buffer.size + 1, np.uint64)
    np.cumsum(_BYTE_CODE[buffer] * powers[: buffer.size], out=sums[1:])
    size = ends - starts
    words, keys = [], []

    def add(which: np.ndarray, a: np.ndarray, b: np.ndarray, salt: int) -> None:
        words.append(which)
        keys.append(mix(((sums[b] - sums[a]) * inverse[a]) ^ np.uint64(salt * 0x1000193)) >> np.uint64(64 - BUCKET_BITS))

    some = np.flatnonzero(size > 1)
    add(some, starts[some], ends[some], 1)
    for n in PREFIXES:
        some = np.flatnonzero(size > n)
        add(some, starts[some], starts[some] + n, 2 + n)
    some = np.flatnonzero(size > INNER)
    count = size[some] - INNER
    which = np.repeat(some, count)
    at = np.repeat(starts[some] + 1 - (np.cumsum(count) - count), count) + np.arange(count.sum())
    add(which, at, at + INNER, 99)
    return np.concatenate(words), np.concatenate(keys).astype(np.int64)


@dataclass(frozen=True)
class Model:
    decoder: Deobfuscator
    odds: np.ndarray  #: by bucket
    weights: np.ndarray  #: of the document features
    bias: float


def document_features(data: np.ndarray, off: np.ndarray, decoder: Deobfuscator, odds: np.ndarray) -> np.ndarray:
    """The highest word scores of each row, in falling order, then how many words score over 2 and how many distinct words there are (logarithms)."""
    n = off.size - 1
    out = np.zeros((n, FEATURES))
    buffer, ws, we, row, word = restored_words(data, off, decoder)
    # among many words some score high by chance
    out[:, TOP_WORDS + 1] = np.log(FEW_WORDS + np.bincount(row, minlength=n))
    if row.size:
        which, bucket = word_buckets(buffer, ws, we)
        score = np.full(len(ws), -9.0)
        np.maximum.at(score, which, odds[bucket])
        high = score[word] > 0
        r, s = row[high], score[word[high]]
        order = np.lexsort((-s, r))
        r, s = r[order], s[order]
        rank = np.arange(r.size) - np.searchsorted(r, r)
        top = rank < TOP_WORDS
        out[r[top], rank[top]] = s[top]
        out[:, TOP_WORDS] = np.log1p(np.bincount(r[s > 2], minlength=n))
    return out


def _fit(x: np.ndarray, y: np.ndarray, steps: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps with a small penalty."""
    z = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    penalty = np.diag(np.append(np.full(x.shape[1], 1.0), 1e-6))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        move = np.linalg.solve((z.T * (p * (1 - p) + 1e-9)) @ z + penalty, z.T @ (y - p) - penalty @ w)
        w += move
        if np.abs(move).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def remainder(key: str) -> F.Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5


def chosen_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, text and toxic of the labelled documents outside the held-out fifth whose ids hash lowest, at most ``rows``; one row for each id, the text of least hash."""
    chosen = labels.where(F.col(key).isNotNull() & F.col("toxic").isNotNull() & (remainder(key) != 0)).groupBy(key).agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64(key), key).limit(rows)
    # at most ``rows`` ids: a proven bound; copies of an id are put together before they are exchanged
    return docs.select(key, text).join(F.broadcast(chosen), key).groupBy(key).agg(F.min_by(text, F.xxhash64(text)).alias(text), F.max("toxic").alias("toxic"))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, text: str = "text", key: str = "doc_id") -> Model:
    decoder = Deobfuscator(count_characters(docs, text))
    sample = chosen_rows(docs, labels, rows, text, key).select(text, "toxic", (remainder(key) <= 2).alias("counted"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, (1 << BUCKET_BITS) + 1), np.int64)
        for block in blocks(batches, text, BLOCK_BYTES):
            buffer, ws, we, row, word = restored_words(*text_bytes(block.column(text)), decoder)
            if not row.size:
                continue
            toxic = np.asarray(block.column("toxic"))[row] > 0
            which, bucket = word_buckets(buffer, ws, we)
            for kind in (0, 1):
                held = np.bincount(word[toxic == bool(kind)], minlength=len(ws))
                total[kind, :-1] += np.bincount(bucket, weights=held[which], minlength=1 << BUCKET_BITS).astype(np.int64)
                total[kind, -1] += held.sum()
        some = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[0, some]), pa.array(total[1, some])], ["bucket", "clean", "toxic"])

    counted = sample.where("counted").select(text, "toxic").mapInArrow(count, "bucket int, clean long, toxic long").groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    table = np.zeros((2, (1 << BUCKET_BITS) + 1))
    table[0, counted.column("bucket").to_numpy()] = counted.column("clean").to_numpy()
    table[1, counted.column("bucket").to_numpy()] = counted.column("toxic").to_numpy()
    share = (table[1, -1] + 1e-9) / (table[:, -1].sum() + 2e-9)
    odds = np.log((table[1, :-1] + SMOOTH * share) / (table[0, :-1] + SMOOTH * (1 - share))) - math.log(share / (1 - share))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text, BLOCK_BYTES):
            x = document_features(*text_bytes(block.column(text)), decoder, odds)
            yield pa.RecordBatch.from_arrays([block.column("toxic"), pa.array(x.tolist(), pa.list_(pa.float64()))], ["toxic", "x"])

    fitted = sample.where("not counted").select(text, "toxic").mapInArrow(features, "toxic int, x array<double>").toArrow()
    y = fitted.column("toxic").to_numpy().astype(np.float64)
    if not table[1, -1] or not 0 < y.sum() < len(y):
        return Model(decoder, np.zeros(1 << BUCKET_BITS), np.zeros(FEATURES), -30.0)
    x = np.array(fitted.column("x").to_pylist())
    order = np.lexsort((*x.T, y))  # sums do not depend on the order of arrival
    return Model(decoder, odds, *_fit(x[order], y[order]))


def score(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All columns of ``docs`` with ``score`` and ``predicted``."""
    own = [c for c in docs.columns if c.lower() not in ("score", "predicted")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text, BLOCK_BYTES):
            x = document_features(*text_bytes(block.column(text)), model.decoder, model.odds)
            p = 1 / (1 + np.exp(-np.clip(x @ model.weights + model.bias, -30, 30)))
            p = np.where(p < 1e-12, 0.0, p)
            yield pa.RecordBatch.from_arrays([*(block.column(c) for c in own), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], [*own, "score", "predicted"])

    return docs.select(*own).mapInArrow(run, docs.select(*own).schema.add("score", "double").add("predicted", "integer"))
