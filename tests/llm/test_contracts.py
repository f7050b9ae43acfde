"""The registered queries over sf0.001, column by column, against the libraries and brute force."""

import collections
import hashlib
import zlib

import pytest
import sentencepiece
import test_alignment
import test_fingerprints
import test_resampling
from test_operators import brute_groups, brute_quality, quality_row
from tokenizers import Tokenizer

import public_tokenizers
from tidewatch.llm import alignment, entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def little(ids):
    return b"".join(i.to_bytes(4, "little") for i in ids)


def test_op2(spark, docs):
    texts = dict(docs)
    rows = entry.op2_quality_rules(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert all(quality_row(r) == brute_quality(texts[r.doc_id]) and not (r.kept and r.base_failed) for r in rows)


def test_op3(spark, docs):
    rows = entry.op3_toxicity(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_op5(spark, docs):
    want = brute_groups(sorted(docs), 4, 80)
    rows = entry.op5_minhash_near_dedup(spark, SF).collect()
    assert len(rows) == len(docs) and all((r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.component_id == r.doc_id) for r in rows)


def test_op6(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: [*library.encode(t, add_special_tokens=False).ids, 2] for i, t in docs}
    pieces, places = collections.defaultdict(list), collections.defaultdict(list)
    for r in entry.op6_packing(spark, SF).collect():
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(little(ids[r.doc_id][r.start : r.start + r.length]))
        pieces[r.doc_id].append((r.start, r.length))
        places[r.sequence_id].append((r.offset, r.length))
    for spans, whole in [*((pieces[i], len(x)) for i, x in ids.items()), *((p, None) for p in places.values())]:
        at = 0
        for start, length in sorted(spans):
            assert start == at
            at += length
        assert at == whole if whole else at <= 4096


def test_op7(spark):
    rows = entry.op7_html_extraction(spark, SF).collect()
    assert rows and all(r.n_chars == len(r.text) and "<" not in r.text and "\t" not in r.text for r in rows)


def test_op10(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in entry.op10_bpe_roundtrip(spark, SF).collect()}
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    for i, t in docs:
        ids = library.encode(t, add_special_tokens=False).ids
        assert got[i] == (len(ids), sha(little(ids)), sha(library.decode(ids, skip_special_tokens=False).encode()))


def test_op11(spark, docs):
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert test_resampling.found(entry.op11_target_resampling(spark, SF)) == test_resampling.brute(docs, target, 1, 10_000, 10, 20, 2024)


def test_op12(spark, docs):
    a = Tokenizer.from_file(public_tokenizers.path(alignment.VOCABULARY_A))
    a.encode_special_tokens = True
    libraries = a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.VOCABULARY_B))
    test_alignment.same(entry.op12_cross_tokenizer_alignment(spark, SF).collect(), test_alignment.brute(libraries, docs))


def test_op13(spark, docs):
    assert sorted(map(tuple, entry.op13_document_fingerprints(spark, SF).collect()), key=str) == test_fingerprints.brute(docs, 1 / 8)
