"""Rows that must come through unharmed: stray quotes, large ids, replacement characters, repeated ids."""

import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import table

from tidewatch.llm import licenses, mtree, packing, pages, quality, repeats, toxicity


def texts_of(page):
    return [b[0] for b in pages.leaf_blocks(page)]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<p class=it's>Hello world one.</p><p>don't stop here.</p><p>last</p>", ["Hello world one.", "don't stop here.", "last"]),
        ("<div data-q=o'brien><p>a</p></div><p>b's</p><p>c</p>", ["a", "b's", "c"]),
        ('<p title=a"b>one</p><p>two</p>', ["one", "two"]),
        ('<p title="a>b">one</p><p title = \'c>d\'>two</p>', ["one", "two"]),
        ('<p title="never closed>one</p><p>two</p>', ["one", "two"]),
        ('<a href=/x?q="y>z</a> w', ["z w"]),
        ("<p =\"x\" b>one</p>", ["one"]),
        ("a < b <i>c</i> 1<2", ["a < b c 1<2"]),
        ("text <p class='x", ["text"]),
        ("text <p and no end <b", ["text <p and no end"]),
        ("a<br/>b<p/>c", ["a b", "c"]),
    ],
)
def test_tags_with_stray_quotes(page, want):
    assert texts_of(page) == want


def test_hostile_pages_take_linear_time():
    size = 2 << 20
    units = ['<a "x ', "<a b=\"x>\" c", "<a b='", "<div>", "<b></ul>", "<p><b>", "<li><b></li>", "<", "<!--", "</x ", "<script>", "&amp", "<a x=", "<table><td>", '<p title="', "<i></i><div></div>", "<dt><i></dd>"]
    for unit in units:
        began = time.process_time()
        pages.leaf_blocks(unit * (size // len(unit)))
        assert time.process_time() - began < 20, unit
    began = time.process_time()
    pages.leaf_blocks('<a "x ' * (size // 6))
    assert time.process_time() - began < 5


def test_deep_pages_keep_their_text():
    n = 3000
    page = "<div>" * n + "inner" + "</div>" * n + "<p>after</p>" + "<ul>" * n + "<li>x" + "</ul>" * n + "<p>last</p>"
    assert texts_of(page) == ["inner", "after", "x", "last"]
    found = pages.leaf_blocks(page)
    assert found[1][1] == pages.leaf_blocks("<p>after</p>")[0][1] and found[-1][1] == found[1][1]


def test_packed_ids_of_any_size(spark):
    ids = [9007199254740993, 9007199254740995, None, -(2**63), 2**63 - 1, None]
    out = packing.pack(table(spark, [(i, f"some words {n}") for n, i in enumerate(ids)])).collect()
    assert sorted(map(str, (r.doc_id for r in out))) == sorted(map(str, ids))
    named = packing.pack(spark.createDataFrame([("b", "x y"), (None, "z"), ("a", "x y")], "doc_id string, text string"))
    assert sorted(map(str, (r.doc_id for r in named.collect()))) == ["None", "a", "b"]


def test_cut_texts_keep_all_other_characters(spark):
    """A repeated passage that begins and ends within characters; replacement characters of the author's stay."""
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh") for _ in range(260))
    own = ["�keep� é" + "é", "�too è" + "é"]
    # é and è share their first byte, ê and é their neighbours: the repeat covers half of a character on each side
    rows = [(1, own[0] + "è" + passage + "ĉ end�"), (2, own[1] + "é" + passage + "ę other�")]
    out = {r.doc_id: r.text for r in repeats.remove_repeats(table(spark, rows)).collect()}
    for i, t in rows:
        a, b = t.index(passage), t.index(passage) + len(passage)
        assert out[i].startswith(t[: a - 1]) and out[i].endswith(t[b + 1 :]) and passage[5:-5] not in out[i]
        assert out[i].count("�") == t.count("�")
    whole = np.frombuffer("aéz漢".encode(), np.uint8)
    gone = np.zeros(whole.size, bool)
    gone[[2, 5]] = True
    assert repeats.whole_characters(whole, gone).tolist() == [False, True, True, False, True, True, True]


def test_training_rows_are_bounded_though_ids_repeat(spark):
    """Ten rows mean ten rows, whatever ids they have, and other copies decide nothing."""
    rng = random.Random(5)
    rows = [(i % 7, " ".join(rng.choice(["good", "bad", "fine", "word"]) for _ in range(30)) + f" {i}") for i in range(400)]
    docs = table(spark, rows)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(7)], "doc_id long, quality int, toxic int")
    for chosen in (quality.chosen_rows(docs, labels, 5), toxicity.chosen_rows(docs, labels, 5)):
        got = chosen.collect()
        assert 0 < len(got) <= 5 and len({r.doc_id for r in got}) == len(got)
        for r in got:
            assert r.text == min((t for i, t in rows if i == r.doc_id), key=lambda t: hash_of(spark, t))
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 for r in toxicity.chosen_rows(docs, labels, 50).collect())


def hash_of(spark, text):
    return spark.range(1).select(F.xxhash64(F.lit(text))).first()[0]


def test_a_text_may_hold_both_kinds_of_lines(spark):
    """Labels are of documents; lines of both kinds are told apart within one text."""
    rng = random.Random(8)
    words = ["river", "stone", "morning", "letter", "window", "garden", "quiet", "under", "walking", "paper"]
    good = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(6, 14))).capitalize() + "."
    junk = lambda: " ".join(rng.choice(words).upper() + rng.choice(["!!", "###", "***"]) for _ in range(rng.randrange(6, 14)))
    rows, marks = [], []
    for i in range(300):
        low = i % 3 == 0
        lines = [junk() if low and rng.random() < 0.8 else good() for _ in range(rng.randrange(4, 20))]
        rows.append((i, "\n".join(lines)))
        marks.append((i, int(not low)))
    mixed = ["\n".join([good() for _ in range(a)] + [junk() for _ in range(b)] + [good() for _ in range(c)]) for a, b, c in [(6, 6, 0), (8, 4, 8), (2, 10, 2), (10, 1, 10)]]
    docs = table(spark, [*rows, *((1000 + i, t) for i, t in enumerate(mixed))])
    model = quality.train(docs, spark.createDataFrame(marks, "doc_id long, quality int"))
    out = {r.doc_id: r for r in quality.judge(docs, model).collect()}
    for i, t in enumerate(mixed):
        want = sum(len(x.split()) for x in t.split("\n") if x[1:2].islower()) / len(t.split())
        assert out[1000 + i].content_share == pytest.approx(want, abs=0.05), i
        assert out[1000 + i].kept == (want >= 0.5 and not out[1000 + i].base_failed)
    assert sum(0 < r.content_share < 1 for r in out.values()) > 40


def test_products_beyond_a_score_are_an_error(spark):
    rows = spark.createDataFrame([(0, [1e20, 0.0]), (50, [1.0, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="do not fit"):
        mtree.top_k(rows, rows).collect()
    # large ones that fit are exact
    rows = spark.createDataFrame([(0, [2.0**20, 0.0]), (50, [2.0**19 + 1, 2.0])], "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in mtree.top_k(rows, rows).collect()}
    assert got == {(0, 50): 2**28 * (2**27 + 256), (50, 0): 2**28 * (2**27 + 256)}


def test_blocks_and_trees_of_many_lists_are_exact(spark, monkeypatch):
    """Several lists of small trees and small blocks, in separated groups, of two sizes: all pairs say the same, and trees are left out."""
    monkeypatch.setattr(mtree, "TREE_LIST", 3)
    monkeypatch.setattr(mtree, "TREE_ROWS", 40)
    monkeypatch.setattr(mtree, "BLOCK_QUERIES", 7)
    rng = np.random.default_rng(4)
    rows = []
    for i in range(900):
        group, size = i // 90, 6 if i % 90 < 80 else 3
        rows.append((i, (rng.normal(size=size) * 0.05 + np.eye(10)[group][:size] * 3 + 0.1).tolist()))
    frame, products = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(2), []
    out = mtree.top_k(frame, frame.where("vec_id % 5 = 0"), products=products).collect()
    whole = {i: np.floor(256 * np.array(v)).astype(np.int64) for i, v in rows}
    want = []
    for q in range(0, 900, 5):
        found = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q and v.size == whole[q].size)[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out) == want
    assert 0 < products[0] < 180 * 800


def test_templates_fit_in_their_bits(spark, monkeypatch):
    assert max(len(w.split()) for _, w in licenses.TEMPLATES) <= 64
    monkeypatch.setattr(licenses, "TEMPLATES", (("long", " ".join(f"w{i}" for i in range(65))),))
    with pytest.raises(ValueError):
        licenses.template_bigrams(spark)
