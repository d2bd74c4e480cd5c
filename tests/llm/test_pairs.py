"""Decontamination and near-duplicates."""

import itertools
import os
import random
import time

import numpy as np
import pytest

from cliquespark.llm import decontamination as D
from cliquespark.llm import neardup as N
from tests.llm.conftest import ODD, frame, prose


def edited(text, seed, share):
    r = random.Random(seed)
    return " ".join(w if r.random() > share else "edit" + str(r.randint(0, 99)) for w in text.split())


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(k, prose(5_000 + k, 40)) for k in range(20)] + [(90, None), (91, ""), (92, "too short")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_copies_and_edited_copies_are_found_and_clean_texts_are_not(spark, benchmark):
    item = lambda k: prose(5_000 + k, 40)
    docs = [(k, prose(k, 300)) for k in range(40)]
    docs += [(100, prose(100, 200) + " " + item(3) + " " + prose(101, 200)), (101, item(4).upper().replace(" ", ",\n ")), (102, prose(102, 50) + " " + edited(item(5), 1, 0.12)), (103, item(6) + " " + prose(4, 20) + " " + item(7))]
    got = D.contaminated(frame(spark, docs), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(100, 3), (101, 4), (102, 5), (103, 6), (103, 7)}
    text = dict(docs)
    exact = next(r for r in got if r["doc_id"] == 100)
    assert exact["score"] == 1 and text[100][exact["start"] : exact["end"]] == item(3)


def test_every_copy_that_reaches_the_limit_is_found(spark):
    """Evenly spaced and random edits up to the limit: replaced, removed and inserted words, long and very short items."""
    r, items, docs, expected = random.Random(9), {}, [], set()
    for k in range(60):
        item = items[k] = prose(5_000 + k, r.choice((4, 5, 6, 8, 16, 40, 59)))
        words, step, share, kind = item.split(), 4 + k % 3, r.uniform(0.1, 0.3), k % 5
        many = int(0.75 * len(words))
        copies = [
            [f"x{i}" if i % step == step - 1 else w for i, w in enumerate(words)],
            [f"x{i}" if r.random() < share else w for i, w in enumerate(words)],
            [w for i, w in enumerate(words) if r.random() > share],
            [x for i, w in enumerate(words) for x in ([w, f"x{i}"] if i < many else [w])],
            [x for i, w in enumerate(words) for x in r.choice(([w], [w], [f"x{i}"], [w, f"x{i}"]))],
        ]
        for c in copies[kind:] + copies[:kind]:
            docs.append((len(docs), prose(len(docs), 120) + " " + " ".join(c) + " " + prose(len(docs) + 7_000, 120)))
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    made = D.Items.of(list(items.items()))
    for d, text in docs:
        ids = D.encode(text, made.vocabulary)
        expected |= {(d, k) for k, item in zip(made.ids, made.words, strict=True) if D.smith_waterman(item, ids)[0] >= 0.6 * D.MATCH * len(item)}
    got = {(r["doc_id"], r["item_id"]) for r in D.contaminated(frame(spark, docs), benchmark).collect()}
    assert got == expected and len(expected) > 150


def test_recall_on_the_labelled_tables(spark):
    """All documents against all items of the test tables, without seeds."""
    folder = "/root/testdata/sf0.01"
    if not os.path.exists(folder):
        pytest.skip("no test tables")
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    made = D.Items.of([(r["item_id"], r["text"]) for r in items.collect()])
    expected = set()
    for r in docs.select("doc_id", "text").collect():
        ids = D.encode(r["text"] or "", made.vocabulary)
        for k, item in zip(made.ids, made.words, strict=True):
            # a quick bound: words that the text shares with the item
            if len(ids) and np.isin(item, ids).sum() >= 0.6 * len(item) and D.smith_waterman(item, ids)[0] >= 0.6 * D.MATCH * len(item):
                expected.add((r["doc_id"], k))
    got = {(r["doc_id"], r["item_id"]) for r in D.contaminated(docs, items).collect()}
    assert got == expected and len(expected) > 10


def test_near_copies_on_the_labelled_tables(spark):
    """Recall of merged documents against all pairs of the test table: at least 0.95."""
    folder = "/root/testdata/sf0.01"
    if not os.path.exists(folder):
        pytest.skip("no test tables")
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").limit(600).collect()]
    expected = brute_classes(rows)
    got = {r["doc_id"]: r["class_id"] for r in N.classes(frame(spark, rows)).collect()}
    merged = [d for d in expected if expected[d] != d]
    assert len(merged) > 20 and sum(got[d] != d for d in merged) >= 0.95 * len(merged)
    assert all(expected[d] == expected[c] for d, c in got.items())


def test_blocks_give_the_same(spark, benchmark):
    docs = frame(spark, [(k, prose(k, 60) + " " + prose(5_000 + k % 20, 40)) for k in range(30)])
    whole, parts = D.contaminated(docs, benchmark), D.contaminated(docs, benchmark, block_words=100)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(whole) == rows(parts) and len(rows(whole)) == 30


def test_smith_waterman_against_brute_force():
    r = np.random.default_rng(3)
    for _ in range(150):
        a, b = r.integers(1, 5, r.integers(1, 9)), r.integers(0, 5, r.integers(1, 12))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, j in itertools.product(range(len(a)), range(len(b))):
            table[i + 1, j + 1] = max(0, table[i, j] + (D.MATCH if a[i] == b[j] else D.MISMATCH), table[i, j + 1] + D.GAP, table[i + 1, j] + D.GAP)
        score, start, end = D.smith_waterman(a, b)
        assert score == table.max() and 0 <= start <= end <= len(b)


def test_decontamination_of_odd_rows(spark, odd, empty, benchmark):
    assert D.contaminated(odd, benchmark).collect() == []
    assert D.contaminated(empty, benchmark).collect() == []
    assert D.contaminated(odd, benchmark.limit(0)).collect() == []
    assert D.clean(odd, benchmark).columns == odd.columns and D.clean(odd, benchmark).count() == len(ODD)


def test_spans_are_those_of_the_text_as_it_is(spark, benchmark):
    """Letters that become two when lowered stand before and in the passage."""
    item = prose(5_003, 40).replace("i", "İ")
    text = "İİİ İ " + prose(1, 30) + " " + item + " " + prose(2, 30)
    [r] = D.contaminated(frame(spark, [(1, text)]), spark.createDataFrame([(3, item)], "item_id long, text string")).collect()
    assert r["score"] == 1 and text[r["start"] : r["end"]] == item


def test_clean_in_blocks(spark, benchmark):
    docs = frame(spark, [(k, prose(k, 60) + (" " + prose(5_000 + k % 20, 40) if k % 2 else "")) for k in range(30)])
    assert sorted(r["doc_id"] for r in D.clean(docs, benchmark, block_words=100).collect()) == list(range(0, 30, 2))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_distance_against_brute_force():
    r = random.Random(5)
    for _ in range(1_500):
        a = [r.randint(0, 4) for _ in range(r.randint(0, 14))]
        b = [x for x in a if r.random() > 0.15] + [r.randint(0, 4) for _ in range(r.randint(0, 3))]
        band, full = r.randint(0, 8), distance(a, b)
        expected = full if full <= band else None
        x, y = np.array(a, np.uint32), np.array(b, np.uint32)
        assert N.banded_distance(x, y, band) == expected
        if a and b and a[0] != b[0]:
            assert N.short_distance(a, b, band) == N.long_distance(x, y, band) == (expected if full else None)


def test_distance_of_long_texts():
    """Hundreds of thousands of words, as bags of words equal."""
    r = np.random.default_rng(1)
    a = r.integers(0, 5_000, 200_000).astype(np.uint32)
    b = a.copy()
    b[r.choice(len(a), 300, replace=False)] += 1
    began = time.process_time()
    assert N.alike(a, b) and N.alike(a, np.delete(b, np.arange(100, 20_000)))
    assert N.banded_distance(a, b, 300) == 300
    assert len(N.order_sketches(r.integers(0, 1 << 62, 2_000_000).astype(np.uint64))) == N.SKETCHES
    small = r.integers(0, 900, 300).astype(np.uint64)
    whole, N.TOGETHER = N.order_sketches(small), 1
    assert N.order_sketches(small) == whole
    N.TOGETHER = 1 << 21
    mixed = r.permutation(a[:20_000])
    assert not N.alike(a[:20_000], mixed) and time.process_time() - began < 60


def brute_classes(rows):
    words = {d: N.word_hashes(t or "") for d, t in rows if d is not None}
    parent = {d: d for d in words}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, x), (b, y) in itertools.combinations(words.items(), 2):
        if x.tobytes() == y.tobytes() or (min(len(x), len(y)) >= 5 and N.alike(x, y)):
            p, q = sorted((root(a), root(b)))
            parent[q] = p
    return {d: root(d) for d in words}


def test_near_copies_against_brute_force(spark):
    rows = [(k, prose(k, 150)) for k in range(40)]
    rows += [(100 + k, edited(prose(k, 150), k, 0.02)) for k in range(20)]
    rows += [(200 + k, edited(prose(7, 150), 50 + k, 0.015)) for k in range(60)]
    rows += [(300, prose(3, 150)), (301, prose(3, 150).upper()), (302, ""), (303, None), (304, "two words"), (305, "Two words!")]
    got = {r["doc_id"]: r["class_id"] for r in N.classes(frame(spark, rows)).collect()}
    assert got == brute_classes(rows)


def test_a_shared_passage_is_no_copy(spark):
    passage = prose(77, 60)
    rows = [(k, prose(k, 50) + " " + passage + " " + prose(k + 500, 50)) for k in range(80)]
    got = {r["doc_id"]: r["class_id"] for r in N.classes(frame(spark, rows)).collect()}
    assert all(d == c for d, c in got.items())


def test_near_copies_of_odd_rows(spark, odd, empty):
    got = N.classes(odd).collect()
    assert len(got) == len(ODD)
    named = {r["doc_id"]: r["class_id"] for r in got}
    assert named[1] == named[2] == named[3] == 1 and named[10] == 9 and named[None] is None
    assert N.classes(empty).collect() == []
    assert N.representatives(odd).columns == odd.columns


def test_repeated_occurrences_are_told_apart():
    a = N.labelled_shingles(np.tile(np.arange(1, 6, dtype=np.uint64), 4))
    assert len(set(a.tolist())) == len(a)


def test_texts_that_fail_their_pivot_meet_the_linked_ones(spark):
    """Chains: A-B and B-C are near, A-C is not, whichever of them is the pivot."""
    rows = []
    for g in range(40):
        words = prose(2_000 + g, 150).split()
        for k in range(6):
            # each text replaces another tenth of the template in one place, so that ends keep long common runs
            rows.append((10 * g + k, " ".join([f"new{g}x{i}" if i < 12 * k else w for i, w in enumerate(words)])))
    got = {r["doc_id"]: r["class_id"] for r in N.classes(frame(spark, rows)).collect()}
    assert got == brute_classes(rows)


def test_groups_that_share_a_template_against_brute_force(spark):
    """More texts than a block holds, most pairs of them too far apart."""
    r = random.Random(8)
    template, rows = prose(3_000, 150).split(), []
    for k in range(40):
        own = [w if 30 < i < 110 or r.random() < 0.5 else f"own{k}x{i}" for i, w in enumerate(template)]
        rows += [(1_000 * k + c, " ".join(w if r.random() > 0.07 else f"edit{k}x{c}x{i}" for i, w in enumerate(own))) for c in range(5)]
    candidates = lambda a, b: set(N.order_sketches(N.word_hashes(a))) & set(N.order_sketches(N.word_hashes(b)))
    expected = {d: d for d, _ in rows}
    for (a, x), (b, y) in itertools.combinations(rows, 2):
        if expected[a] != expected[b] and candidates(x, y) and N.alike(N.word_hashes(x), N.word_hashes(y)):
            low, high = sorted((expected[a], expected[b]))
            expected = {d: low if c == high else c for d, c in expected.items()}
    got = {r["doc_id"]: r["class_id"] for r in N.classes(frame(spark, rows), block=16).collect()}
    assert got == expected
