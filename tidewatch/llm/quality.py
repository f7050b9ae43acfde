"""Quality rules: a conditional random field labels lines as content or boilerplate.

Each line of a text has features of its characters, words and repetition; the
field is trained on a bounded sample of labelled documents and decoded by Viterbi
over each document's lines.  A document stays if the base rules pass and enough of
its words are in content lines.

Labels are those of documents, not of lines, so the kinds of lines are learnt by
expectation and maximisation: a first field takes every line for what its document
is; then, for a few rounds, each line of the sample is taken for what its own
features say under the field before (a document of low quality keeps at least its
likeliest line of boilerplate), and a field is trained on those sequences.  So a
text may hold both kinds, and transitions are learnt from where one ends.

The sample holds at most ``TRAIN_ROWS`` documents, one row for each id (the text of
least hash, where an id repeats), of at most ``TRAIN_LINES`` lines each: the driver
gets at most the product of those, each line as ``len(FEATURES)`` numbers.

Edge cases: null or blank texts have no words and fail the base rules; without
labelled rows no line is boilerplate, so the base rules decide; ``doc_id`` may
be null or repeat; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import crf
from tidewatch.llm.textblock import blocks, gram_hashes, mix, span_hashes, text_bytes, word_spans

#: Labelled documents that the field is trained on at most, and lines of each.
TRAIN_ROWS, TRAIN_LINES = 2000, 500
#: Rounds of relabelling, and gradient steps of each (the first field takes all of :func:`tidewatch.llm.crf.train`).
ROUNDS, STEPS = 2, 30
#: Least share of words in content lines.
CONTENT_SHARE = 0.5
MIN_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 20, 8, 30

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_BANG = np.zeros(256, bool)
_BANG[ord("!")] = True
_FIRST_BYTE = (np.arange(256) & 0xC0) != 0x80
_CLOSING = np.zeros(256, bool)
_CLOSING[list(b".,;:!?\"')")] = True

FEATURES = ("bias", "length", "symbols", "capitals", "bangs", "digits", "stutter", "repeated", "duplicate", "closed", "word_length", "fragment")


def _ranks_of_equal(keys: np.ndarray) -> np.ndarray:
    """For each key, how many equal keys stand before it."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(keys.size, bool)
    new[1:] = ordered[1:] != ordered[:-1]
    start = np.maximum.accumulate(np.where(new, np.arange(keys.size), 0))
    out = np.empty(keys.size, np.int64)
    out[order] = np.arange(keys.size) - start
    return out


def _in_row(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return mix(hashes ^ mix(rows.astype(np.uint64) + np.uint64(1)))


def measure(data: np.ndarray, off: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Base counts of each row; line features, words of each line, and the offsets of each row's lines."""
    n_rows = off.size - 1
    starts, ends, words = word_spans(data, off)
    row_of_word = np.repeat(np.arange(n_rows), np.diff(words))

    def counter(table: np.ndarray) -> np.ndarray:
        return np.append(0, np.cumsum(table[data]))

    points, symbols = counter(_FIRST_BYTE), counter(_SYMBOL)
    hashes = span_hashes(data, starts, ends, fold=False)
    # words within windows found twice or more in their text
    grams = gram_hashes(hashes, REPEAT_WINDOW)
    inside = row_of_word[: grams.size] == row_of_word[REPEAT_WINDOW - 1 :] if grams.size else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    key = _in_row(grams[at], row_of_word[at])
    ordered = np.sort(key)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if twice.size:
        where = np.minimum(np.searchsorted(twice, key), twice.size - 1)
        again = at[twice[where] == key]
    else:
        again = at[:0]
    change = np.zeros(starts.size + 1, np.int64)
    np.add.at(change, again, 1)
    np.add.at(change, again + REPEAT_WINDOW, -1)
    repeated = np.cumsum(change[:-1]) > 0
    # lines
    feeds = np.flatnonzero(data == 10)
    n_lines = np.bincount(np.searchsorted(off[1:], feeds, "right"), minlength=n_rows) + 1
    lines = np.append(0, np.cumsum(n_lines))
    row_of_line = np.repeat(np.arange(n_rows), n_lines)
    line_start = np.empty(lines[-1], np.int64)
    is_first = np.zeros(lines[-1], bool)
    is_first[lines[:-1]] = True
    line_start[is_first] = off[:-1]
    line_start[~is_first] = feeds + 1
    line_end = np.empty(lines[-1], np.int64)
    is_last = np.zeros(lines[-1], bool)
    is_last[lines[1:] - 1] = True
    line_end[is_last] = off[1:]
    line_end[~is_last] = feeds
    first_word = np.searchsorted(starts, line_start)
    last_word = np.searchsorted(starts, line_end)
    n_words = last_word - first_word
    line_hash = _in_row(span_hashes(data, line_start, line_end, fold=False), row_of_line)
    duplicate = (_ranks_of_equal(line_hash) > 0) & (n_words > 0)

    def per_row(of_words: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(of_words))
        return total[words[1:]] - total[words[:-1]]

    base = {
        "n_words": np.diff(words), "word_chars": per_row(points[ends] - points[starts]), "n_symbols": symbols[off[1:]] - symbols[off[:-1]],
        "n_dup_lines": np.bincount(row_of_line[duplicate], minlength=n_rows), "n_repeat_words": per_row(repeated),
    }
    stutter = np.zeros(starts.size, bool)
    stutter[1:] = hashes[1:] == hashes[:-1]

    def of_words(x: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(x))
        return (total[last_word] - total[first_word]) / np.maximum(1, n_words)

    def of_bytes(table: np.ndarray) -> np.ndarray:
        total = symbols if table is _SYMBOL else counter(table)
        return (total[line_end] - total[line_start]) / np.maximum(1, line_end - line_start)

    tail = np.maximum(line_end - 1, 0)
    closed = (line_end > line_start) & _CLOSING[data[np.minimum(tail, max(0, data.size - 1))]] if data.size else np.zeros(lines[-1], bool)
    length = (points[line_end] - points[line_start]) / np.maximum(1, n_words)
    features = np.column_stack([
        np.ones(lines[-1]), np.log1p(n_words) / 4, np.minimum(1, 10 * of_bytes(_SYMBOL)), np.minimum(1, 2 * of_bytes(_UPPER)), np.minimum(1, 10 * of_bytes(_BANG)),
        np.minimum(1, 4 * of_bytes(_DIGIT)), of_words(stutter), of_words(repeated), duplicate, closed, np.minimum(length, 20) / 10, n_words < 3,
    ]).astype(np.float64)
    return base, features, n_words, lines


def chosen_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, lines: int = TRAIN_LINES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, text and quality of the labelled documents whose ids hash lowest, at most ``rows``; one row for each id."""
    chosen = labels.where(F.col(key).isNotNull() & F.col("quality").isNotNull()).groupBy(key).agg(F.min("quality").cast("int").alias("quality")).orderBy(F.xxhash64(key), key).limit(rows)
    # at most ``rows`` ids: a proven bound; copies of an id are put together before they are exchanged
    short = F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"))) < lines
    return docs.select(key, text).where(short).join(F.broadcast(chosen), key).groupBy(key).agg(F.min_by(text, F.xxhash64(text)).alias(text), F.min("quality").alias("quality"))


def lines_by_evidence(model: crf.Model, xs: list[np.ndarray], low: list[int]) -> list[np.ndarray]:
    """What each line is by its own features; a document of low quality has one line of boilerplate at least."""
    out = []
    for x, bad in zip(xs, low, strict=True):
        lean = x @ (model.weights[:, 1] - model.weights[:, 0])
        own = (lean > 0).astype(np.int64)
        if bad and len(own) and not own.any():
            own[lean.argmax()] = 1
        out.append(own)
    return out


def fit(xs: list[np.ndarray], low: list[int], rounds: int = ROUNDS) -> crf.Model:
    """A field from the lines' features and the documents' labels (1: low quality)."""
    ys = [np.full(len(x), bad) for x, bad in zip(xs, low, strict=True)]
    model = crf.train(xs, ys)
    for _ in range(rounds):
        now = lines_by_evidence(model, xs, low)
        if all(map(np.array_equal, now, ys)):
            break
        ys, model = now, crf.train(xs, now, steps=STEPS, begin=model)
    return model


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, lines: int = TRAIN_LINES, text: str = "text", key: str = "doc_id") -> crf.Model:
    """A field trained on :func:`chosen_rows`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text):
            _, x, _, lines = measure(*text_bytes(block.column(text)))
            flat = np.ascontiguousarray(x.astype(np.float32)).reshape(-1)
            ends = pa.array((lines * len(FEATURES)).astype(np.int64))
            yield pa.RecordBatch.from_arrays([block.column("quality"), pa.LargeListArray.from_arrays(ends, pa.array(flat)).cast(pa.list_(pa.float32()))], ["quality", "x"])

    sample = chosen_rows(docs, labels, rows, lines, text, key).mapInArrow(run, "quality int, x array<float>").toArrow()
    if not sample.num_rows:
        return crf.Model(np.zeros((len(FEATURES), 2)), np.zeros((2, 2)), np.array([1.0, 0.0]))
    xs, low = [], []
    for batch in sample.to_batches():
        lists = batch.column("x")
        at, flat = lists.offsets.to_numpy(), lists.values.to_numpy().astype(np.float64)
        for a, b, q in zip(at[:-1].tolist(), at[1:].tolist(), batch.column("quality").to_pylist(), strict=True):
            xs.append(flat[a:b].reshape(-1, len(FEATURES)))
            low.append(1 - q)
    # the order of arrival decides nothing
    order = sorted(range(len(xs)), key=lambda i: (len(xs[i]), xs[i].tobytes(), low[i]))
    return fit([xs[i] for i in order], [low[i] for i in order])


def judge(docs: DataFrame, model: crf.Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All columns of ``docs`` with the base counts, base_failed, content_share and kept."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    added = [*names, "base_failed", "content_share", "kept"]
    own = [c for c in docs.columns if c.lower() not in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text):
            base, x, n_words, lines = measure(*text_bytes(block.column(text)))
            content = np.append(0, np.cumsum(np.where(crf.viterbi(model, x, lines) == 0, n_words, 0)))
            share = (content[lines[1:]] - content[lines[:-1]]) / np.maximum(1, base["n_words"])
            failed = (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > REPEAT_PERCENT * base["n_words"])
            cols = [pa.array(base[c].astype(np.int64)) for c in names] + [pa.array(failed), pa.array(share), pa.array(~failed & (share >= CONTENT_SHARE))]
            yield pa.RecordBatch.from_arrays([block.column(c) for c in own] + cols, [*own, *added])

    schema = docs.select(*own).schema
    for c in names:
        schema = schema.add(c, "long")
    return docs.select(*own).mapInArrow(run, schema.add("base_failed", "boolean").add("content_share", "double").add("kept", "boolean"))


def quality_rules(docs: DataFrame, labels: DataFrame, train_docs: DataFrame | None = None) -> DataFrame:
    """Trains on the labelled rows of ``train_docs`` (``docs`` by default) and judges ``docs``."""
    return judge(docs, train(docs if train_docs is None else train_docs, labels))
