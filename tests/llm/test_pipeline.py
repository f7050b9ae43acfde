"""The pipeline's stages compared with what their operators say about the same input."""

import os
import re
import sys
import zlib

from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
import public_tokenizers

from tidewatch.llm import neardup, quality, toxicity

sys.path.insert(0, os.path.dirname(__file__))
from test_operators import brute_groups  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = {
        "toxicity": lambda d: {r.doc_id for r in toxicity.score(d, toxicity.train(d, labels)).where("predicted = 0").collect()},
        "quality rules": lambda d: {r.doc_id for r in quality.quality_rules(d, labels).where("kept").collect()},
        "near-duplicates": lambda d: {r.doc_id for r in neardup.near_duplicates(d).where("kept").collect()},
        "repeated passages": lambda d: {r.doc_id for r in d.collect()},
    }
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.cache()
        docs = stage(spark, before, SF)
        assert docs.columns == before.columns
        assert sorted(r.doc_id for r in docs.collect()) == sorted(judged[name](before)), name
    texts = {r.doc_id: r.text for r in docs.collect()}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in pieces} == set(texts) and all(re.fullmatch(r"\d+", str(r.ids_crc32)) for r in pieces)


def test_run_against_brute_force(spark):
    """Models judge as the operators say; groups, cuts and tokens are worked out text by text."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = toxicity.score(docs, toxicity.train(docs, labels)).where("predicted = 0").select(*docs.columns).cache()
    left = {r.doc_id: r.text for r in quality.quality_rules(scored, labels).where("kept").collect()}
    groups = brute_groups(sorted(left.items()), 5, 80)
    left = sorted((i, t) for i, t in left.items() if groups[i][1] == i)
    seen, kept = {}, {}
    for i, t in left:
        raw = t.encode()
        for k in range(len(raw) - 199):
            seen[raw[k : k + 200]] = seen.get(raw[k : k + 200], 0) + 1
    for i, t in left:
        raw = t.encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 199):
            if seen[raw[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        kept[i] = bytes(x for x, g in zip(raw, gone, strict=True) if not g).decode("utf-8", "ignore")
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {(i, at): zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[at : at + 4096])) for i, t in kept.items() for ids in [[*lib.encode(t, add_special_tokens=False).ids, 2]] for at in range(0, len(ids), 4096)}
    out = corpus_pipeline.run(spark, SF).collect()
    assert {(r.doc_id, r.start): r.ids_crc32 for r in out} == want and len(out) == len(want)
    used = {}
    for r in out:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in used.values():
        places.sort()
        assert [a for a, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))] and sum(n for _, n in places) <= 4096


def test_stages_on_awkward_rows(spark, tmp_path):
    text = " ".join(f"wort{i} und" for i in range(60)) + "."
    rows = [(1, text, 1, "x"), (1, text, 1, "x"), (None, None, None, None), (2, "", 0, "y"), (3, " ".join(f"lang{i}" for i in range(40_000)), 7, None), (None, text + " mehr", 1, "z")]
    schema = "doc_id long, text string, n_chars int, Kept string"
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    for some in (rows, []):
        docs = spark.createDataFrame(some, schema)
        # names of what the stages compute, as columns of the table's own
        docs = docs.withColumns({c: F.lit(c) for c in ("score", "predicted", "n_words", "content_share", "_row", "component_id", "place", "c1", "marks", "rid", "row")})
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns, name
            got = out.collect()
            assert all(r.score == "score" and r._row == "_row" and r.component_id == "component_id" for r in got)
            kinds = {"toxicity": 6, "quality rules": 4, "near-duplicates": 4, "repeated passages": 6}
            assert len(got) == (kinds[name] if some else 0), name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == (len({}) if not some else sum(1 for _ in rows) + packed_extra(rows))


def packed_extra(rows):
    """Pieces beyond the first of each row."""
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return sum(len(lib.encode(t or "", add_special_tokens=False).ids) // 4096 for _, t, *_ in rows)


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0


def test_one_row_of_each_group_stays(spark):
    texts = {n: " ".join(f"{n}{i}" for i in range(80)) for n in ("alpha", "beta", "gamma", "delta")}
    near = texts["alpha"] + " more"
    rows = [
        (7, texts["alpha"]), (7, texts["alpha"]), (3, near),  # repeated rows and a smaller near-duplicate
        (7, texts["beta"]),  # the same id, a text of its own
        (None, texts["gamma"]), (None, texts["gamma"]), (None, texts["beta"]),
        (9, texts["delta"]), (9, texts["delta"]), (9, None),
    ]
    docs = spark.createDataFrame([(i, t, len(t or "")) for i, t in rows], "doc_id long, text string, n_chars int").repartition(3)
    stages = dict(corpus_pipeline.STAGES)
    out = stages["near-duplicates"](spark, docs, SF)
    want = [(3, near), (7, texts["beta"]), (None, texts["gamma"]), (9, texts["delta"]), (9, None)]
    assert sorted(map(str, ((r.doc_id, r.text) for r in out.collect()))) == sorted(map(str, want))
    cut = stages["repeated passages"](spark, out, SF).collect()
    assert sorted(map(str, ((r.doc_id, r.text) for r in cut))) == sorted(map(str, want))


def test_run_on_repeated_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.unionAll(docs).unionAll(docs.withColumn("doc_id", F.lit(None).cast("long"))).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    once, more = (corpus_pipeline.run(spark, d).groupBy("doc_id").sum("length").collect() for d in (SF, str(tmp_path)))
    once, more = ({r[0]: r[1] for r in x} for x in (once, more))
    assert sum(more.get(i) == n for i, n in once.items()) >= 0.9 * len(once)
