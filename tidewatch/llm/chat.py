"""Transcript parsing: a hidden Markov model recovers who speaks, line by line.

States are a role and whether a line opens a turn or goes on with it; a line is
observed as its speaker marker, its length, whether it asks and whether a blank
line stands before it.  Start, transition and emission probabilities are counted
over all transcripts with known roles but a held-out fifth; Viterbi decoding gives
each line its state, and turns are rendered in one canonical form.

A long conversation is written down in parts of ``PART_TURNS`` turns, yet decoded
as a whole: each part is summed up in one matrix (the best score from the state
before it to each of its last states), a pass forward and one back over the
matrices give the states at the borders, and each part is decoded between them.
That is the path of the whole, and nothing of a conversation but one such matrix
for each part passes through one task.

Edge cases: a null or empty transcript has no turns; lines before any marker
belong to the likeliest role; a turn that was opened stays even if it is empty;
control strings within a turn are broken up so that rendering stays unambiguous;
turns with the same number stand in the order of text and role; ids may be null
(one conversation) or repeat; among equal paths smaller states win; columns named
n_turns, roles or chat are replaced, other columns of transcripts are kept, of
turns ignored; an empty table gives none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm import crf
from tidewatch.llm.scratch import Scratch
from tidewatch.llm.textblock import blocks

ROLES = ("system", "user", "assistant")
#: Turns in a part of a transcript.
PART_TURNS = 512
STATES = 2 * len(ROLES)
#: Speaker markers (fixed forms), tried in this order; the rest of the line is text.
MARKERS = (
    ("system", r"(?:system|context|instructions?|note)\s*:\s*"), ("user", r"(?:user|human|question|q|me|customer)\s*:\s*"), ("assistant", r"(?:assistant|ai|bot|answer|a|agent|model)\s*:\s*"),
    ("system#", r"#{1,4}\s*(?:system|instructions?)\s*:?\s*$"), ("user#", r"#{1,4}\s*(?:user|human|question)\s*:?\s*$"), ("assistant#", r"#{1,4}\s*(?:assistant|response|answer)\s*:?\s*$"),
    ("system|", r"<\|system\|>\s*"), ("user|", r"<\|user\|>\s*"), ("assistant|", r"<\|assistant\|>\s*"),
    ("one", r"(?:speaker|person)\s*(?:1|a)\s*:\s*"), ("two", r"(?:speaker|person)\s*(?:2|b)\s*:\s*"), ("dash", r"[-–—]\s+"),
)
_MARKER = re.compile("|".join(f"(?P<m{i}>{p})" for i, (_, p) in enumerate(MARKERS)), re.I)
PARTS = (len(MARKERS) + 2, 5, 2, 2)  # marker, length, asks, after a blank line


def observe(transcript: str, continued: bool = False) -> tuple[list[tuple[str, str]], np.ndarray]:
    """Each line without its marker (as an opening) and whole (as one that goes on), and the symbols seen (a column for each of PARTS).

    Blank lines before all others are left out, unless the transcript is ``continued`` from another part.
    """
    texts, seen = [], []
    blank = True
    for line in transcript.split("\n"):
        stripped = line.strip()
        if not stripped:
            if texts or continued:
                texts.append((line, line))
                seen.append((len(MARKERS) + 1, 0, 0, 0))
            blank = True
            continue
        found = _MARKER.match(stripped)
        marker = int(found.lastgroup[1:]) if found else len(MARKERS)
        rest = stripped[found.end() :] if found else stripped
        # what stands after a marker keeps the blanks at its end, a line without one all of its own
        opening = line.lstrip()[found.end() :] if found else line
        n = len(rest)
        texts.append((opening, line))
        seen.append((marker, 0 if n == 0 else 1 if n < 60 else 2 if n < 160 else 3 if n < 320 else 4, int("?" in rest), int(blank)))
        blank = False
    return texts, np.array(seen, np.int64).reshape(-1, len(PARTS))


@dataclass(frozen=True)
class Model:
    start: np.ndarray
    transition: np.ndarray
    emission: tuple[np.ndarray, ...]  #: for each part, states by symbols


def _cells() -> list[tuple[int, ...]]:
    """The shapes of the tables of counts, in order: start, transition, emissions."""
    return [(STATES,), (STATES, STATES), *((STATES, n) for n in PARTS)]


def count(seen: np.ndarray, states: np.ndarray, continued: bool = False) -> np.ndarray:
    """Counts of one transcript's symbols and states, all tables in one row."""
    tables = [np.zeros(x) for x in _cells()]
    if len(states):
        if not continued:
            tables[0][states[0]] += 1
        np.add.at(tables[1], (states[:-1], states[1:]), 1)
        for p, table in enumerate(tables[2:]):
            np.add.at(table, (states, seen[:, p]), 1)
    return np.concatenate([t.ravel() for t in tables])


def fit(counts: np.ndarray) -> Model:
    """Smoothed probabilities; state 2 r opens a turn of role r, 2 r + 1 goes on with it."""
    edges = np.cumsum([0, *(int(np.prod(x)) for x in _cells())])
    start, transition, *emission = (counts[a:b].reshape(x) for a, b, x in zip(edges[:-1], edges[1:], _cells(), strict=True))
    first = np.full(STATES, 0.1)
    first[1::2] = 1e-6
    step = np.full((STATES, STATES), 0.05)
    for r in range(STATES):  # a turn can only be gone on with by its own role
        for s in range(1, STATES, 2):
            if s // 2 != r // 2:
                step[r, s] = 1e-9
    log = lambda x: np.log(x / x.sum(axis=-1, keepdims=True))
    return Model(log(start + first), log(transition + step), tuple(log(t + 0.2) for t in emission))


def emissions(model: Model, seen: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(sum(table[:, seen[:, p]].T for p, table in enumerate(model.emission))) if len(seen) else np.zeros((0, STATES))


def decode(model: Model, seen: np.ndarray, offsets: np.ndarray, entry: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
    """The likeliest states of each transcript's lines; ``entry`` and ``last`` hold the states before and at the end of each, or -1."""
    start = model.start if entry is None else np.where((entry >= 0)[:, None], model.transition[np.maximum(entry, 0)], model.start)
    return crf.best_path(emissions(model, seen), model.transition, start, offsets, last)


def summed_up(model: Model, seen: np.ndarray, first: bool = False) -> np.ndarray:
    """The best score of these lines from each state before them (or from the start) to each state of the last of them."""
    if not len(seen):
        return np.where(np.eye(STATES, dtype=bool), 0.0, -np.inf) + (model.start if first else 0.0)
    e = emissions(model, seen)
    out = np.tile(model.start, (STATES, 1)) + e[0] if first else model.transition + e[0]
    for row in e[1:]:
        out = (out[:, :, None] + model.transition).max(axis=1) + row
    return out


def turns_of(texts: list[tuple[str, str]], states: list[int]) -> list[tuple[str, str]]:
    """Role and text of each turn; the lines of a turn are joined and trimmed as a whole, empty ones go unless they were opened."""
    out: list[tuple[str, list[str], bool]] = []
    for (opening, whole), state in zip(texts, states, strict=True):
        role = ROLES[state // 2]
        if not out or state % 2 == 0 or out[-1][0] != role:
            out.append((role, [], state % 2 == 0))
        out[-1][1].append(whole if state % 2 else opening)
    joined = ((role, "\n".join(lines).strip(), opened) for role, lines, opened in out)
    return [(role, text) for role, text, opened in joined if text or opened]


def render(turns: list[tuple[str, str]]) -> str:
    """The canonical form of a chat."""
    return "".join(f"<|im_start|>{role}\n{text.replace('<|im_', '<| im_')}<|im_end|>\n" for role, text in turns)


def _borders(parts: DataFrame, model: Model, partitions: int) -> DataFrame:
    """For conversations of several parts: conv_id, part, entry (the state before the part, -1 for the first) and last (its last state)."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "transcript"):
            rows = [summed_up(model, observe(x or "", p > 0)[1], p == 0).ravel().tolist() for x, p in zip(block.column("transcript").to_pylist(), block.column("part").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([block.column("conv_id"), block.column("part"), pa.array(rows, pa.list_(pa.float64()))], ["conv_id", "part", "best"])

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        for batch in batches:
            rows = []
            for part, best in zip(batch.column("part").to_pylist(), batch.column("best").to_pylist(), strict=True):
                through = (at if part else np.zeros(STATES))[:, None] + np.array(best).reshape(STATES, STATES)
                rows.append((through.argmax(axis=0).tolist(), through.max(axis=0).tolist()))
                at = through.max(axis=0)
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("part"), pa.array([r for r, _ in rows], pa.list_(pa.int32())), pa.array([s for _, s in rows], pa.list_(pa.float64()))], ["conv_id", "part", "before", "score"])

    def backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        follows, state = 0, -1
        for batch in batches:
            entry, last = [], []
            for part, before, score in zip(batch.column("part").to_pylist(), batch.column("before").to_pylist(), batch.column("score").to_pylist(), strict=True):
                state = state if follows else int(np.argmax(score))
                last.append(state)
                state = before[state] if part else -1
                entry.append(state)
                follows = part
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("part"), pa.array(entry, pa.int32()), pa.array(last, pa.int32())], ["conv_id", "part", "entry", "last"])

    kind = parts.schema["conv_id"].dataType.simpleString()
    best = parts.select("conv_id", "part", "transcript").mapInArrow(sums, f"conv_id {kind}, part int, best array<double>")
    ahead = best.repartition(partitions, "conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(forward, f"conv_id {kind}, part int, before array<int>, score array<double>")
    return ahead.repartition(partitions, "conv_id").sortWithinPartitions("conv_id", F.desc("part")).mapInArrow(backward, f"conv_id {kind}, part int, entry int, last int")


def parse(transcripts: DataFrame, model: Model, column: str = "transcript") -> DataFrame:
    """All columns but ``column``, with n_turns, roles (comma-joined), chat (canonical form).

    Each row is a transcript of its own; columns ``_part``, ``_entry`` and ``_last``, as :func:`chats` adds them, say what part of a longer one it is.
    """
    own = [c for c in transcripts.columns if c.lower() not in (column.lower(), "n_turns", "roles", "chat", "_part", "_entry", "_last")]
    is_part = {"_part", "_entry", "_last"} <= set(transcripts.columns)
    read = transcripts if is_part else transcripts.withColumns({c: F.lit(v).cast("int") for c, v in (("_part", 0), ("_entry", -1), ("_last", -1))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, column):
            part, entry, last = (block.column(c).to_numpy() for c in ("_part", "_entry", "_last"))
            lines = [observe(x or "", p > 0) for x, p in zip(block.column(column).to_pylist(), part.tolist(), strict=True)]
            off = np.cumsum([0] + [len(t) for t, _ in lines])
            states = decode(model, np.concatenate([s for _, s in lines]), off, entry, last).tolist()
            turns = [turns_of(t, states[a : a + len(t)]) for (t, _), a in zip(lines, off[:-1].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(block.column(c) for c in own), pa.array([len(t) for t in turns], pa.int64()), pa.array([",".join(r for r, _ in t) for t in turns]), pa.array([render(t) for t in turns])], [*own, "n_turns", "roles", "chat"])

    return read.select(*own, column, "_part", "_entry", "_last").mapInArrow(run, transcripts.select(*own).schema.add("n_turns", "long").add("roles", "string").add("chat", "string"))


#: Ways to write a turn down: for system, user and assistant, what stands before the text.
STYLES = (
    ("System: ", "User: ", "Assistant: "), ("### System\n", "### Human\n", "### Assistant\n"), ("<|system|>\n", "<|user|>\n", "<|assistant|>\n"),
    ("Context: ", "Q: ", "A: "), ("Note: ", "Speaker 1: ", "Speaker 2: "), ("- ", "- ", "- "),
)


def numbered(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, turn, role, text and number, each turn's place in its conversation (from 0).

    Turns are sorted over all partitions; a partition's share of a conversation is
    counted, and what earlier partitions hold of it is added, so that no task needs
    a whole conversation.
    """
    partitions = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ("conv_id", "turn", "text", "role")
    rows = turns.select("conv_id", "turn", "role", "text").repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)
    rows = scratch.keep(rows.withColumn("_at", F.monotonically_increasing_id()), "turns").withColumn("_piece", F.shiftright("_at", 33))
    pieces = rows.groupBy("conv_id", "_piece").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = F.sum("_n").over(Window.partitionBy("conv_id").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.select(F.col("conv_id").alias("_conv"), F.col("_piece").alias("_of"), "_first", F.coalesce(earlier, F.lit(0)).alias("_earlier"))
    met = rows.join(pieces, rows.conv_id.eqNullSafe(pieces._conv) & (rows._piece == pieces._of))
    return met.select("conv_id", "turn", "role", "text", (F.col("_earlier") + F.col("_at") - F.col("_first")).alias("number"))


def write_down(turns: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Transcripts (conv_id, part, transcript, truth, n_lines: of each turn) of turns (conv_id, turn, role, text), in a style by conversation.

    A conversation of more than ``PART_TURNS`` turns is several parts, so none is gathered without bound.
    """
    turns = numbered(turns, scratch or Scratch(turns.sparkSession, "chat"))
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES)))
    role = F.when(F.lower("role") == "system", 0).when(F.lower("role") == "assistant", 2).otherwise(1)
    marks = F.array(*[F.array(*[F.lit(m) for m in s]) for s in STYLES])
    line = F.concat(marks[style.cast("int")][role], F.coalesce(F.col("text"), F.lit("")))
    rows = turns.select("conv_id", F.floor(F.col("number") / PART_TURNS).cast("int").alias("part"), F.col("number").alias("n"), line.alias("line"), F.array(*[F.lit(r) for r in ROLES])[role].alias("role"))
    parts = rows.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct("n", "line", "role"))).alias("t"))
    # the blank line between two turns of different parts begins the later part
    lead = F.when(F.col("part") > 0, F.lit("\n")).otherwise(F.lit(""))
    return parts.select("conv_id", "part", F.concat(lead, F.concat_ws("\n\n", F.col("t.line"))).alias("transcript"), F.concat_ws(",", F.col("t.role")).alias("truth"), F.transform("t.line", lambda x: F.size(F.split(x, "\n", -1))).alias("n_lines"))


def held_out(key: str = "conv_id") -> F.Column:
    """Conversations that are not learnt from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(transcripts: DataFrame) -> Model:
    """Counts over all written-down transcripts but the held-out ones; the driver gets a sum for each cell of the tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(sum(int(np.prod(x)) for x in _cells()))
        for block in blocks(batches, "transcript"):
            for row in block.to_pylist():
                found = label_lines(row["transcript"], row["truth"].split(","), row["n_lines"], row["part"] > 0)
                if found is not None:
                    total += count(*found, row["part"] > 0)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some].astype(np.int64))], ["cell", "n"])

    rows = transcripts.where(~held_out()).select("part", "transcript", "truth", "n_lines").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(sum(int(np.prod(x)) for x in _cells()))
    counts[rows.column("cell").to_numpy()] = rows.column("n").to_numpy()
    return fit(counts)


def label_lines(transcript: str, truth: list[str], n_lines: list[int], continued: bool = False) -> tuple[np.ndarray, np.ndarray] | None:
    """Symbols and states of a transcript that :func:`write_down` made of turns of ``n_lines`` lines."""
    _, seen = observe(transcript, continued)
    if continued:
        seen = seen[1:]  # goes on with a turn of the part before
    states = []
    for role, n in zip(truth, n_lines, strict=True):
        r = 2 * ROLES.index(role)
        states += [r] + [r + 1] * n  # the blank line after a turn goes on with it
    states = states[:-1]
    return (seen, np.array(states, np.int64)) if len(states) == len(seen) else None


def chats(turns: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """conv_id, part, n_turns, roles, chat of every conversation; the parts of one follow each other."""
    scratch = scratch or Scratch(turns.sparkSession, "chat")
    transcripts = scratch.keep(write_down(turns, scratch), "transcripts")
    model = train(transcripts)
    partitions = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    long = transcripts.where("part > 0").select(F.col("conv_id").alias("_conv")).distinct()
    whole = transcripts.join(long, transcripts.conv_id.eqNullSafe(long._conv), "left_semi")
    borders = _borders(whole, model, partitions).select(F.col("conv_id").alias("_conv"), F.col("part").alias("_of"), "entry", "last")
    met = transcripts.join(borders, transcripts.conv_id.eqNullSafe(borders._conv) & (transcripts.part == borders._of), "left")
    minus = F.lit(-1)
    return parse(met.select("conv_id", "part", "transcript", F.col("part").alias("_part"), F.coalesce("entry", minus).alias("_entry"), F.coalesce("last", minus).alias("_last")), model)
