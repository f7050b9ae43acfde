"""Importance resampling against counts and sums made one by one."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from test_operators import AWKWARD, table

from tidewatch.llm import resampling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(rows, target, grams, buckets, percent, least, seed):
    def of(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, grams + 1) for i in range(len(w) - k + 1)]

    s, t = (collections.Counter(b for x in texts for b in of(x)) for texts in ([x for _, x in rows], target))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in range(buckets)]
    out = []
    for i, x in rows:
        f = of(x)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(words(x))])
    able = sorted((x for x in out if x[5] >= least), key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[1]))
    for place, x in enumerate(able[: percent * len(able) // 100], 1):
        x[4] = place
    return sorted((tuple(x[:5]) for x in out), key=str)


def found(frame):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in frame.collect()), key=str)


@pytest.mark.parametrize(("grams", "buckets", "percent"), [(1, 10_000, 10), (2, 500, 37), (3, 65_536, 100)])
def test_against_brute_force(spark, grams, buckets, percent):
    rng = random.Random(grams)
    vocabulary = [f"w{i}" for i in range(60)] + ["Straße", "naïve", "漢字", "x" * 90, "MiXeD", "a-b"]
    rows = [(i, rng.choice([" ", "\n", ", "]).join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 19, 20, 60])))) for i in range(150)]
    rows += AWKWARD + [(400, rows[7][1]), (400, rows[7][1]), (7, rows[7][1])]
    target = [" ".join(rng.choices(vocabulary[:20], k=30)) for _ in range(10)] + [None, ""]
    docs = table(spark, rows).repartition(5)
    aims = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(target)], "item_id long, text string, stream string")
    assert found(resampling.resample(docs, aims, grams, buckets, percent, 20, 5)) == brute(rows, target, grams, buckets, percent, 20, 5)


def test_empty_tables_and_rules(spark):
    none, some = table(spark, []), table(spark, AWKWARD)
    assert resampling.resample(none, some).count() == 0
    got = resampling.resample(some, none)
    assert found(got) == brute(AWKWARD, [], 1, 10_000, 10, 20, 2024)
    with pytest.raises(ValueError):
        resampling.streams(some, buckets=70_000)


def test_checksums_and_runs():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000, dtype=np.uint8)
    starts = np.sort(rng.integers(0, 4000, 300))
    ends = starts + rng.integers(0, 90, 300)
    assert resampling.crc32_spans(data, starts, ends).tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
    stream = rng.integers(0, 30, 1000).astype(np.uint16)
    value, count = resampling.runs(stream)
    assert dict(zip(value.tolist(), count.tolist(), strict=True)) == dict(collections.Counter(stream.tolist()))
    assert resampling.runs(stream[:0])[0].size == 0
