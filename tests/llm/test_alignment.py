"""Alignment against whole texts encoded by the libraries and all pairs of tokens compared."""

import collections
import hashlib
import random

import pytest
import sentencepiece
from pyspark.sql import functions as F
from test_operators import AWKWARD, table
from tokenizers import Tokenizer

import public_tokenizers
from tidewatch.llm import alignment


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path(alignment.VOCABULARY_A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.VOCABULARY_B))


def char_bytes():
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


CHARS = char_bytes()


def whole(libraries, text):
    """Tokens of both kinds as (id, from, to), or nothing."""
    a, b = libraries
    if not text:
        return [], []
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    bytes_a = [bytes(CHARS[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in map(b.id_to_piece, ids_b)]
    out = []
    for ids, parts in ((ids_a, bytes_a), (ids_b, bytes_b)):
        if b"".join(parts) != (" " + text).encode():
            return [], []
        at, own = 0, []
        for i, p in zip(ids, parts, strict=True):
            own.append((i, at, at + len(p)))
            at += len(p)
        out.append(own)
    return out


def brute(libraries, rows):
    seen = {}
    for _, text in rows:
        if text not in seen:
            a, b = whole(libraries, text)
            both = sorted({e for *_, e in a} & {e for *_, e in b})
            links, first = [], 0
            for i, s, e in a:
                while first < len(b) and b[first][2] <= s:
                    first += 1
                links += [(i, j) for j, t, u in b[first : first + 80] if t < e and s < u]
            assert all(len([x for x in b if x[1] < e and s < x[2]]) <= 80 for _, s, e in a[:50])
            edges = list(zip([0, *both], both, strict=False))
            in_group = lambda ts, edges=edges: [",".join(str(i) for i, s, _ in ts if x <= s < y) for x, y in edges] if len(ts) < 3000 else None
            digits = hashlib.sha256(";".join(f"{x}|{y}" for x, y in zip(in_group(a), in_group(b), strict=True)).encode()).hexdigest() if a and len(a) < 3000 and len(b) < 3000 else "" if not a else None
            seen[text] = len(a), len(b), len(both), links, digits
    held = collections.Counter(p for _, t in rows for p in set(seen[t][3]))
    top = {}
    for (i, _), c in held.items():
        top[i] = max(top.get(i, 0), c)
    return [(i, a, b, g, len(links), sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links), digits) for i, t in rows for a, b, g, links, digits in [seen[t]]]


def same(got, want):
    got, want = sorted(map(tuple, got), key=str), sorted(want, key=str)
    assert [x[:7] for x in got] == [x[:7] for x in want]
    for x, y in zip(got, want, strict=True):
        assert y[7] is None or x[7] == y[7], x


ODD = ["a  b", "a\n b", " lead", "trail ", "trail  \n", "\t x \t", "é è à", "— x – y", "x — y", "漢字 かな", "🙂 🙂x", "a b c", "x　 y", "é éx", "▁x y", "x ▁", "<|endoftext|> a <|endoftext|>", "</s> <s> <unk>", "\x00 \x1c \x85 x", "ﬁ ﬂ ½ ", "don't we'll 's", "1234567 12 3", "." * 50 + " " + "-" * 40, "       ", " ", "\n", "a\r\nb", "🙂🙂 漢字漢字"]

PLAIN = [t for t in ODD if "▁" not in t]


def test_against_the_libraries(spark, libraries):
    rng = random.Random(4)
    rows = list(enumerate(ODD)) + AWKWARD
    for i in range(150):
        rows.append((100 + i, "".join(rng.choice([*"abcdé,.'0 \n\t", " the", " of and", "  ", *(ODD if i % 9 == 0 else PLAIN)]) for _ in range(rng.randrange(40)))))
    rows += rows[:60]
    docs = table(spark, rows).withColumns({c: F.lit("clash") for c in ("pack", "keys", "pairs", "answers")}).repartition(4)
    want = brute(libraries, rows)
    assert sum(x[1] > 0 for x in want) > 150 and any(x[1] == 0 for x in want)
    same(alignment.align(docs).collect(), want)
    # packs of a few documents count alike
    same(alignment.align(docs, pack_bytes=200).collect(), want)


def test_empty_tables(spark):
    assert alignment.align(table(spark, [])).count() == 0
    assert [tuple(r) for r in alignment.align(table(spark, [(1, None), (None, "")])).orderBy("doc_id").collect()] == [(None, 0, 0, 0, 0, 0, 0, ""), (1, 0, 0, 0, 0, 0, 0, "")]


def test_units_and_memo(libraries):
    """A memo that is emptied again and again, and one that is not, say what whole texts say."""
    small, large = (alignment.Aligner(alignment.VOCABULARY_A, alignment.VOCABULARY_B, n) for n in (500, 10**7))
    assert large.b.local
    rng = random.Random(9)
    for _ in range(30):
        texts = ["".join(rng.choice([*"abé,.'0  \n", " the", "ing ", *ODD]) for _ in range(rng.randrange(30))) for _ in range(5)]
        found = large.documents(texts)
        assert found == small.documents(texts)
        for t, x in zip(texts, found, strict=True):
            a, b = whole(libraries, t)
            assert (x[0], x[1]) == (len(a), len(b))
            if a:
                assert x[4].replace("|", ";").count(",") + 2 * x[2] == len(a) + len(b)
        units = [u for t in texts for u in large.units(t)]
        assert "".join(units) == "".join(" " + t for t in texts if t and "▁" not in t)
    # a vocabulary that cannot be cut before blanks is aligned as a whole
    large.b.local = False
    assert large.units("a b") == [" a b"]
    for t in ODD:
        small.memo.clear()
        assert large.documents([t]) == small.documents([t])


def test_labels():
    """A = [ab][c][de], B = [a][bcd][e]: ends of A at 1, 2, 4 and of B at 0, 3, 4."""
    spans = alignment._SPANS.findall(bytes([2, 1, 1, 2, 3, 0, 3]))
    assert spans == [bytes([2, 1, 1, 2, 3]), bytes([0, 3])]
