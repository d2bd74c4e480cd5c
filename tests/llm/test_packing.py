import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cliquespark.llm import packing, tokens
from tests.llm.conftest import ODD, frame, prose


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_plan_holds_every_piece_once_and_no_bin_overflows(lengths):
    histogram = {x: lengths.count(x) for x in lengths}
    bins = packing.minimum_bin_slack(histogram, 40)
    used = {}
    for chosen, times in bins:
        assert sum(x * m for x, m in chosen.items()) <= 40 and times > 0
        for x, m in chosen.items():
            used[x] = used.get(x, 0) + m * times
    assert used == histogram


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 3), max_size=6), st.integers(1, 30))
def test_fullest_is_the_best_subset_sum(counts, room):
    items = [x for x, n in counts.items() for _ in range(n)]
    sums = {0}
    for x in items:
        sums |= {s + x for s in sums}
    chosen = packing.fullest(counts, sorted(counts, reverse=True), room)
    assert sum(x * m for x, m in chosen.items()) == max(s for s in sums if s <= room)
    assert all(m <= counts[x] for x, m in chosen.items())


def test_cut_only_shortens_the_first_piece():
    assert packing.cut(5, 8) == [(0, 5)]
    assert packing.cut(8, 8) == [(0, 8)]
    assert packing.cut(17, 8) == [(0, 1), (1, 8), (9, 8)]


def test_pieces_round_trip_and_sequences_have_no_gaps(spark, odd):
    rows = packing.pack_documents(odd, capacity=64).collect()
    tokenizer = tokens.load_tokenizer(tokens.byte_bpe_path())
    expected = sorted(tokens.pack_ids([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]) for _, t in ODD)
    ends = {}
    by_doc = {}
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] and r["length"] <= 64
        by_doc.setdefault(r["doc_id"], []).append(r)
        ends.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in ends.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r["length"] for r in rows)
    assert total == sum(len(x) // 4 for x in expected)
    assert len(ends) <= -(-total // 64) + 2
    eleven = b"".join(bytes(r["ids"]) for r in sorted(by_doc[11], key=lambda r: r["start"]))
    assert eleven in expected


def test_sequences_are_those_of_a_direct_packing(spark):
    """The query's sequences hold the lengths that the planned bins do, and few small ones need more than the least number."""
    rows = [(k, prose(k, 3 + k % 45)) for k in range(120)]
    got = packing.packed_digests(frame(spark, rows), capacity=64).collect()
    held = {}
    for r in got:
        held.setdefault(r["sequence_id"], []).append(r["length"])
    tokenizer = tokens.load_tokenizer(tokens.byte_bpe_path())
    lengths = [n for _, t in rows for _, n in packing.cut(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1, 64)]
    histogram = {n: lengths.count(n) for n in lengths}
    planned = [sorted(x for x, m in chosen.items() for _ in range(m)) for chosen, times in packing.minimum_bin_slack(histogram, 64) for _ in range(times)]
    assert sorted(map(sorted, held.values())) == sorted(planned)

    def least(items, room=20):
        best = len(items)

        def place(at, bins):
            nonlocal best
            if len(bins) >= best:
                return
            if at == len(items):
                best = len(bins)
                return
            for k, free in enumerate(bins):
                if free >= items[at] and free not in bins[:k]:
                    place(at + 1, [*bins[:k], free - items[at], *bins[k + 1 :]])
            place(at + 1, [*bins, room - items[at]])

        place(0, [])
        return best

    rng, more = np.random.default_rng(0), 0
    for _ in range(60):
        items = sorted(rng.integers(1, 16, 9).tolist(), reverse=True)
        used = sum(times for _, times in packing.minimum_bin_slack({x: items.count(x) for x in items}, 20))
        assert used <= least(items) + 1
        more += used > least(items)
    assert more < 6


def test_digests_are_those_of_the_ids(spark, odd):
    full = {(r["doc_id"], r["piece"], r["start"]): zlib.crc32(bytes(r["ids"])) for r in packing.tokenized_pieces(odd).collect()}
    digests = packing.packed_digests(odd).collect()
    assert {(r["doc_id"], r["piece"], r["start"]): r["ids_crc32"] for r in digests} == full
    assert len(digests) == len(packing.tokenized_pieces(odd).collect())


def test_empty_table(empty):
    assert packing.packed_digests(empty).collect() == []


def test_encoder_equals_the_tokenizer():
    rng = np.random.default_rng(4)
    letters = list("ab \n.'s1ñ\t\x01\x1c\xa0İßΣ日")
    texts = ["", " ", "\n", "a  b", "x" * 300 + " y", "it's 's", *("".join(rng.choice(letters, rng.integers(0, 25))) for _ in range(400))]
    for path in (tokens.byte_bpe_path(), tokens.word_bpe_path()):
        made, plain = tokens.PieceEncoder(path), tokens.load_tokenizer(path)
        for text, packed in zip(texts, made.encode(texts), strict=True):
            assert packed == tokens.pack_ids(plain.encode(text, add_special_tokens=False).ids), repr(text)


def test_memo_forgets(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_PIECES", 20)
    monkeypatch.setattr(tokens, "MEMO_WORDS", 10)
    made, plain = tokens.PieceEncoder(tokens.byte_bpe_path()), tokens.load_tokenizer(tokens.byte_bpe_path())
    texts = [f"word{k} other{k} same" for k in range(200)]
    assert made.encode(texts) == [tokens.pack_ids(plain.encode(t, add_special_tokens=False).ids) for t in texts]
    assert made.encode(texts) == [tokens.pack_ids(plain.encode(t, add_special_tokens=False).ids) for t in texts]
    assert len(made.memo) <= 24 and len(made.memo.older) <= 24 and max(map(len, made.words)) <= 10


def test_one_length_and_repeated_rows(spark):
    """A length that all pieces have, ids missing or repeated: each row has a place of its own."""
    rows = frame(spark, [(None, "same text")] * 40 + [(1, "same text")] * 40)
    got = packing.packed_digests(rows, capacity=9).collect()
    assert len(got) == 80 and len({(r["sequence_id"], r["offset"]) for r in got}) == 80
