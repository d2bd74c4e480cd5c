import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cliquespark.llm import linededup as L
from tests.llm.conftest import ODD, frame

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    holders = {}
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(UPPER)
    ident = lambda d: L.LAST_DOC if d is None else d
    for doc, text, *_ in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(ident(doc))
    out = []
    for doc, text, *_ in rows:
        lines = (text or "").split("\n")
        keep = [x for x in lines if not (len(key(x)) >= 10 and len(holders[key(x)]) >= 2 and min(holders[key(x)]) != ident(doc))]
        out.append((doc, len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out, key=str)


def test_against_brute_force(spark, odd):
    assert sorted(map(tuple, L.line_digests(odd).collect()), key=str) == brute(ODD)


def test_hundreds_of_shards_and_blocks_give_the_same(spark, odd, monkeypatch):
    monkeypatch.setattr(L, "LEAST_BLOCK", 4)
    rows = [(k, "\n".join(f"a line that is numbered {(k * 7 + j) % 300}" for j in range(5)) + "\none line that is everywhere") for k in range(200)]
    found = L.dedup_lines(frame(spark, rows).select("doc_id", "text"), counts=True, keys_per_shard=1)
    shared = L.shared_keys(L.reference_table(frame(spark, rows))).count()
    assert shared > 200
    assert sorted((r["doc_id"], r["n_lines"], r["n_dropped"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in found.collect()) == sorted(brute(rows))


def test_empty_table(empty):
    assert L.line_digests(empty).collect() == []


def test_other_columns_stay(spark, odd):
    found = L.dedup_lines(odd)
    assert found.columns == odd.columns and found.filter("n_lines__ = 'x' AND row__ = 'x'").count() == len(ODD)


def test_deletion_undoes_insertion(spark):
    first = [(1, "line number one here\nshared line of text"), (2, "shared line of text\nonly in the second"), (2, "shared line of text")]
    second = [(3, "line number one here\nshared line of text"), (0, "only in the second\nquite new line"), (3, "line number one here")]
    rows = lambda df, *c: sorted(map(tuple, df.select("h1", "h2", *c).collect()))
    one = ("refs", "first_doc", "last_doc")
    counts = L.line_counts(frame(spark, first))
    assert rows(L.key_table(counts), *one) == rows(L.reference_table(frame(spark, first)), *one)
    grown = L.insert_documents(counts, frame(spark, second))
    assert rows(L.key_table(grown), *one) == rows(L.reference_table(frame(spark, first + second)), *one)
    back = L.delete_documents(grown, frame(spark, second))
    assert rows(back, "doc", "refs") == rows(counts, "doc", "refs")
    assert rows(L.key_table(L.delete_documents(grown, frame(spark, first))), *one) == rows(L.reference_table(frame(spark, second)), *one)


def test_filters_follow_the_table(spark):
    keys = spark.range(500).selectExpr("xxhash64(id) h1", "xxhash64(1, id) h2", "0L first_doc")
    more = spark.range(500, 600).selectExpr("xxhash64(id) h1", "xxhash64(1, id) h2", "0L first_doc")
    filters = L.build_filters(keys, 4)
    grown = L.update_filters(filters, 4, more, keys.limit(0))
    back = {r["shard"]: L.CuckooFilter.from_bytes(r["filter"]) for r in L.update_filters(grown, 4, more.limit(0), more).collect()}
    held = {r["shard"]: L.CuckooFilter.from_bytes(r["filter"]) for r in grown.collect()}
    for df, where in ((keys, back), (keys, held), (more, held)):
        for r in df.collect():
            assert where[r["h2"] % 4].contains(np.array([r["h1"]]))[0]
    gone = [back[r["h2"] % 4].contains(np.array([r["h1"]]))[0] for r in more.collect()]
    assert sum(gone) < 5


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=300))
def test_cuckoo_filter_never_misses(keys):
    keys = np.array(sorted(keys), np.int64)
    made = L.CuckooFilter.of(keys)
    assert made.contains(keys).all()
    assert L.CuckooFilter.from_bytes(made.to_bytes()).contains(keys).all()
    half = keys[: len(keys) // 2]
    made.delete(half)
    assert made.contains(keys[len(half) :]).all()
    assert np.count_nonzero(made.table) == len(keys) - len(half)
    made.delete(keys[len(half) :])
    assert not made.table.any()


def test_cuckoo_filter_is_selective():
    rng = np.random.default_rng(1)
    made = L.CuckooFilter.of(rng.integers(-(2**63), 2**63 - 1, 20_000))
    assert made.contains(rng.integers(-(2**63), 2**63 - 1, 20_000)).mean() < 0.002
