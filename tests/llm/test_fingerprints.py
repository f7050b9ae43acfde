"""Sketches against sets of shingles worked out one by one."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F
from test_operators import AWKWARD, table

from tidewatch.llm import fingerprints

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def kept(grams, fraction):
    hashes = sorted({hashlib.md5(g.encode()).hexdigest()[:16] for g in grams})
    below = [h for h in hashes if int(h, 16) < fraction * 16**16]
    return below or hashes[:1]


def likeness(a, b):
    return len({*a} & {*b}) / min(len(a), len(b)) if a and b else float(len(a) == len(b))


def brute(rows, fraction):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5(r[1].encode()).hexdigest()))
    out = []
    for n, (i, t) in enumerate(rows):
        after = rows[(n + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        a, b, c = (kept(shingles(x), fraction) for x in (t, edited, after))
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), "".join(a), "".join(b), likeness(a, b), likeness(a, c)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("count", "fraction"), [(1, 1 / 8), (32, 1 / 3), (97, 1 / 8), (40, 1.0)])
def test_against_brute_force(spark, count, fraction):
    rng = random.Random(count)
    rows = [(i, rng.choice([" ", "\n"]).join(rng.choices(["Alpha", "beta", "漢字", "ünï", "x\x1cy"], k=rng.choice([0, 1, 4, 5, 6, 40, 300])))) for i in range(count)]
    got = fingerprints.report(table(spark, rows).repartition(7), fraction=fraction).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, fraction)


def test_awkward_rows_and_empty_tables(spark):
    rows = AWKWARD * 5
    docs = table(spark, rows).withColumns({c: F.lit("clash") for c in ("sketch", "at", "n", "next")})
    got = fingerprints.report(docs).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 1 / 8)
    assert len({r.fingerprint for r in got if r.doc_id == 4}) == 1
    assert fingerprints.report(table(spark, [])).count() == 0
    for bad in (0, 2, -1):
        with pytest.raises(ValueError):
            fingerprints.threshold(bad)


def test_merged_sketches_are_those_of_the_union(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(500)]
    texts = [(" ".join(rng.choices(words, k=n)), " ".join(rng.choices(words, k=m))) for n, m in [(0, 0), (0, 9), (3, 4), (6, 200), (2000, 30), (7, 7)] * 5]
    rows = spark.createDataFrame(texts, "a string, b string").select("a", "b", fingerprints.merge(fingerprints.sketch(F.col("a")), fingerprints.sketch(F.col("b"))).alias("m"))
    assert all(sorted(r.m) == kept(shingles(r.a) | shingles(r.b), 1 / 8) for r in rows.collect())


def test_estimates_of_unequal_documents(spark):
    """A passage of 2,000 words within a document of 40,000: containment is told, though the two sets are hardly similar."""
    rng = random.Random(6)
    long = [f"w{rng.randrange(10**6)}" for _ in range(40_000)]
    part = long[7_000:9_000]
    half = [*part[:1_000], *(f"v{i}" for i in range(1_000))]
    rows = spark.createDataFrame([(" ".join(long), " ".join(part), " ".join(half))], "a string, b string, c string")
    a, b, c = (fingerprints.sketch(F.col(x)) for x in "abc")
    whole, some, none = rows.select(fingerprints.containment(a, b), fingerprints.containment(a, c), fingerprints.containment(b, fingerprints.sketch(F.lit("some other words altogether here now")))).first()
    assert whole == 1.0 and abs(some - 0.5) < 0.1 and none == 0.0
