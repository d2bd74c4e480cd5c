"""Near-duplicate documents by Order MinHash, verified by banded alignment.

A sketch takes, under one hash order, the few smallest occurrence-labelled shingles (five
words and how often they occurred before) and keeps them in text order; two texts share a
sketch with a probability that falls with their edit distance, not only with their
vocabulary. Texts that share one of the sketches are candidates. Exact copies (same words)
are one text from the start.

Within a set of texts that share a sketch, each is first aligned with the set's pivot; the
pivot is the text with the smallest hash, so the same pivots serve in most sets of a group. A
set whose texts are then all in one component is settled, which is linear however large it is.
In every other set each two texts of different components are compared, once over all sets:
those outside the set's largest component with one another and with its members, by blocks of
a bounded number of texts. A count of common words rules most pairs out before alignment. A
candidate is linked if the edit distance in words, found inside the band that the threshold
allows, leaves a similarity of 0.8 or more. Classes are the connected components of the links,
named by their smallest ``doc_id``.

Defined results: documents without a word (null or empty) are one class; shorter ones than five
words are in a class with copies only; rows that repeat a ``doc_id`` are one document; a null
``doc_id`` has the class of its copies, if any, and else none; very long texts are compared
in whole, a pair in time that grows with their length times their distance; of several documents that
could name a class the smallest ``doc_id`` does; an empty table gives an empty result; other
columns pass through ``representatives`` whatever their names, and ``classes`` leaves them out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliquespark.llm.shared import materialize, texts
from cliquespark.operators.components import components

SHINGLE = 5
SIMILARITY = 0.8
#: Sketches per text, and shingles in each: a pair with shingle similarity s shares one with probability 1 - (1 - s**PICKED)**SKETCHES.
SKETCHES = 24
PICKED = 3
#: Texts of a set in a block; two blocks are compared in one call.
BLOCK = 128
#: Counters of words that bound the distance of two texts from below.
COUNTERS = 1024
#: Hashes that are compared at once for the sketches of one text.
TOGETHER = 1 << 21
#: Up to this band diagonals are followed one by one, beyond it all together.
SHORT_BAND = 64
WORD = re.compile(r"\w+")
MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(text: str) -> np.ndarray:
    import xxhash

    words = WORD.findall(text.lower())
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def labelled_shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of five words and the number of earlier occurrences, in text order."""
    n = len(words) - SHINGLE + 1
    grams = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        grams = mixed(grams * MIX + words[k : k + n])
    distinct, inverse = np.unique(grams, return_inverse=True)
    if len(distinct) < n:
        order = np.argsort(inverse, kind="stable")
        ranked = inverse[order]
        occurrence = np.empty(n, np.uint64)
        occurrence[order] = (np.arange(n) - np.searchsorted(ranked, ranked)).astype(np.uint64)
        grams = mixed(grams + occurrence * MIX)
    return grams


def seeds(sketches: int) -> np.ndarray:
    return np.random.default_rng(20).integers(1, 1 << 63, (sketches, 2), np.int64).astype(np.uint64) | np.uint64(1)


def order_sketches(words: np.ndarray, sketches: int = SKETCHES, picked: int = PICKED) -> list[int]:
    """One signed 64-bit value per sketch; none for texts of fewer than five words."""
    if len(words) < SHINGLE:
        return []
    grams = labelled_shingles(words)
    table = seeds(sketches)
    out = table[:, 0].copy()
    # a very long text takes a few sketches at a time
    step = max(1, TOGETHER // len(grams))
    for part in range(0, sketches, step):
        some = table[part : part + step]
        if len(grams) > picked:
            values = (grams[None, :] ^ some[:, :1]) * some[:, 1:]
            values ^= values >> np.uint64(31)
            at = np.sort(np.argpartition(values, picked - 1, axis=1)[:, :picked], axis=1)
        else:
            at = np.tile(np.arange(len(grams)), (len(some), 1))
        chosen = grams[at]
        for k in range(at.shape[1]):
            out[part : part + step] = mixed(out[part : part + step] * MIX + chosen[:, k])
    return out.view(np.int64).tolist()


def short_distance(a: list[int], b: list[int], band: int) -> int | None:
    """:func:`banded_distance` of lists without a common start, a diagonal at a time."""
    n, m = len(a), len(b)
    goal = m - n
    reach = {0: 0}
    for distance in range(1, band + 1):
        fresh = {}
        for diagonal in range(max(-distance, -n, -band), min(distance, m, band) + 1):
            # the goal must still be within what is left of the band
            if abs(goal - diagonal) > band - distance:
                continue
            i = max(reach.get(diagonal, -2) + 1, reach.get(diagonal + 1, -2) + 1, reach.get(diagonal - 1, -1))
            i = min(i, n, m - diagonal)
            if i < 0 or i + diagonal < 0:
                continue
            while i < n and i + diagonal < m and a[i] == b[i + diagonal]:
                i += 1
            fresh[diagonal] = i
        if fresh.get(goal, -1) >= n:
            return distance
        reach |= fresh
    return None


def run_length(a: np.ndarray, b: np.ndarray) -> int:
    """How long two arrays are equal from their start."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        differ = np.flatnonzero(a[at : min(n, at + step)] != b[at : min(n, at + step)])
        if len(differ):
            return at + int(differ[0])
        at, step = at + step, step * 4
    return n


def long_distance(a: np.ndarray, b: np.ndarray, band: int) -> int | None:
    """:func:`banded_distance` of arrays without a common start, all diagonals at once."""
    n, m = len(a), len(b)
    goal, zero, never = m - n, band + 1, -(1 << 40)
    reach = np.full(2 * band + 3, never, np.int64)
    reach[zero] = 0
    for distance in range(1, band + 1):
        left = band - distance
        low, high = max(-distance, -n, goal - left), min(distance, m, goal + left)
        if low > high:
            return None
        at = np.arange(low, high + 1)
        here = zero + low, zero + high + 1
        x = np.maximum(np.maximum(reach[here[0] : here[1]], reach[here[0] + 1 : here[1] + 1]) + 1, reach[here[0] - 1 : here[1] - 1])
        x = np.minimum(x, np.minimum(n, m - at))
        x[(x < 0) | (x + at < 0)] = never
        going = np.flatnonzero((x >= 0) & (x < n) & (x + at < m))
        while len(going) > 4:
            going = going[a[x[going]] == b[x[going] + at[going]]]
            x[going] += 1
            going = going[(x[going] < n) & (x[going] + at[going] < m)]
        for k in going:
            x[k] += run_length(a[x[k] :], b[x[k] + at[k] :])
        reach[here[0] : here[1]] = x
        if low <= goal <= high and x[goal - low] >= n:
            return distance
    return None


def banded_distance(a: np.ndarray, b: np.ndarray, band: int) -> int | None:
    """Edit distance in words if it is at most ``band``, else None.

    Diagonals outside the band are never entered. Within it each distance extends the furthest
    point of every diagonal, so near copies take little more than one pass over their words.
    """
    if abs(len(a) - len(b)) > band:
        return None
    first = run_length(a, b)
    a, b = a[first:], b[first:]
    last = run_length(a[::-1], b[::-1])
    a, b = a[: len(a) - last], b[: len(b) - last]
    longest = max(len(a), len(b))
    if not len(a) or not len(b):
        return longest if longest <= band else None
    # words that only one has; each edit takes at most one of them
    common = np.minimum(np.bincount(a % COUNTERS, minlength=COUNTERS), np.bincount(b % COUNTERS, minlength=COUNTERS)).sum()
    if longest - common > band:
        return None
    if band <= SHORT_BAND:
        return short_distance(a.tolist(), b.tolist(), band)
    return long_distance(a, b, band)


def alike(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    longest = max(len(a), len(b))
    band = int((1 - similarity) * longest + 1e-9)
    return banded_distance(a, b, band) is not None


def sketch_table(docs: DataFrame, sketches: int, picked: int) -> DataFrame:
    """``doc_id``, ``k1``, ``k2`` (128 bits of the words), ``n`` words, ``sketch``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for part in range(0, batch.num_rows, 2_000):
                rows = batch.slice(part, 2_000)
                keys, sizes, values = [], [], []
                for text in rows["text"]:
                    words = word_hashes(text.as_py() or "")
                    keys.append(xxhash.xxh3_128_digest(words.tobytes()))
                    sizes.append(len(words))
                    values.append(order_sketches(words, sketches, picked))
                halves = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [rows["doc_id"], pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(sizes, pa.int32()), pa.array(values, pa.list_(pa.int64()))], names=["doc_id", "k1", "k2", "n", "sketch"]
                )

    return docs.mapInArrow(run, "doc_id long, k1 long, k2 long, n int, sketch array<long>")


def words_of(docs: DataFrame) -> DataFrame:
    """``id, words``: packed word hashes, of 32 bits here, since only words of two texts are compared with them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 2_000):
                rows = batch.slice(part, 2_000)
                packed = [word_hashes(t.as_py() or "").astype(np.uint32).tobytes() for t in rows["text"]]
                yield pa.RecordBatch.from_arrays([rows["doc_id"], pa.array(packed, pa.binary())], names=["id", "words"])

    return docs.mapInArrow(run, "id long, words binary")


def verify(pairs: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """``id, pivot, linked`` of pairs of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = [alike(np.frombuffer(a.as_py(), np.uint32), np.frombuffer(b.as_py(), np.uint32), similarity) for a, b in zip(batch["words"], batch["pivot_words"], strict=True)]
            yield pa.RecordBatch.from_arrays([batch["id"], batch["pivot"], pa.array(linked, pa.bool_())], names=["id", "pivot", "linked"])

    joined = pairs.join(words, "id").join(words.select(F.col("id").alias("pivot"), F.col("words").alias("pivot_words")), "pivot")
    return joined.select("id", "pivot", "words", "pivot_words").mapInArrow(run, "id long, pivot long, linked boolean")


def with_pivots(members: DataFrame, rows: int) -> DataFrame:
    """Members (``value, id, n``) of sets of two and more with the ``pivot`` of their set and its length.

    The minimum per set combines before the shuffle. It is written first, so that the join reads
    two tables and adaptive execution can split it where one set holds a great part of all rows.
    """
    chosen = members.groupBy("value").agg(F.count("*").alias("size"), F.min(F.struct(F.xxhash64("id").alias("h"), F.col("id"), F.col("n"))).alias("p")).filter("size > 1")
    return members.join(materialize(chosen.select("value", F.col("p.id").alias("pivot"), F.col("p.n").alias("pivot_n")), "pivots", rows), "value")


def unsettled(members: DataFrame, stars: DataFrame, rows: int) -> DataFrame:
    """``value, id, comp`` of sets whose texts are in several components, with ``most``, the largest of these there, and the numbers of texts in it and outside."""
    named = materialize(members.join(stars.select(F.col("a").alias("id"), F.col("b").alias("star")), "id", "left").select("value", "id", F.coalesce("star", "id").alias("comp")), "set-members", rows)
    sizes = named.groupBy("value", "comp").agg(F.count("*").alias("size"))
    sets = sizes.groupBy("value").agg(F.count("*").alias("comps"), F.sum("size").alias("all"), F.max(F.struct("size", "comp")).alias("m")).filter("comps > 1")
    return named.join(materialize(sets.select("value", F.col("m.comp").alias("most"), F.col("m.size").alias("inner"), (F.col("all") - F.col("m.size")).alias("outer")), "unsettled-sets", rows), "value")


def block_pairs(rest: DataFrame, block: int) -> DataFrame:
    """Each text of an unsettled set once per pair of blocks that it is in: ``value, i, j, id, comp, side``.

    The texts outside the largest component are dealt to blocks, each of which meets itself, the
    others and the blocks of the largest component. Side 2 stands for a block that meets itself.
    """
    many = lambda n: F.ceil(F.col(n) / F.lit(block)).cast("int")
    inner = F.col("comp") == F.col("most")
    at = F.when(inner, F.col("r") + F.pmod(F.xxhash64("id"), F.col("c")).cast("int")).otherwise(F.pmod(F.xxhash64("id"), F.col("r")).cast("int"))
    dealt = rest.withColumns({"r": many("outer"), "c": many("inner")}).withColumn("at", at)
    with_ = F.sequence(F.lit(0), F.when(inner, F.col("r") - 1).otherwise(F.col("r") + F.col("c") - 1))
    met = dealt.select("value", "id", "comp", "at", F.explode(with_).alias("o"))
    side = F.when(F.col("at") == F.col("o"), 2).when(F.col("at") < F.col("o"), 0).otherwise(1)
    return met.select("value", F.least("at", "o").alias("i"), F.greatest("at", "o").alias("j"), "id", "comp", side.alias("side"))


def counters(words: list[np.ndarray]) -> np.ndarray:
    """Occurrences of words by hash: what two rows have in common is at least what the texts have in common."""
    out = np.zeros((len(words), COUNTERS), np.int32)
    for k, w in enumerate(words):
        out[k] = np.bincount(w % COUNTERS, minlength=COUNTERS)
    return out.astype(np.uint8 if out.size and out.max() < 256 else np.int32)


def block_links(value: int, ids: list[int], comps: list[int], sides: np.ndarray, words: list[np.ndarray], held: list[list[int]], similarity: float) -> list[tuple[int, int]]:
    """Links between texts of different components; a pair of several sets belongs to the one of the smallest value."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    sizes, table = np.array([len(w) for w in words]), counters(words)
    shared = [set(h) for h in held]
    left, right = np.flatnonzero(sides != 1), np.flatnonzero(sides != 0)
    comp, found = np.array(comps), []
    for a in left:
        others = right[(right > a) | (sides[right] == 1)]
        others = others[comp[others] != comp[a]]
        longest = np.maximum(sizes[others], sizes[a])
        band = ((1 - similarity) * longest + 1e-9).astype(np.int64)
        near = np.abs(sizes[others] - sizes[a]) <= band
        others, longest, band = others[near], longest[near], band[near]
        common = np.minimum(table[others], table[a]).sum(axis=1, dtype=np.int64)
        for b in others[longest - common <= band]:
            p, q = root(comps[a]), root(comps[b])
            if p != q and min(shared[a] & shared[b]) == value and alike(words[a], words[b], similarity):
                parent[max(p, q)] = min(p, q)
                found.append((ids[a], ids[b]))
    return found


def compare_blocks(pairs: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: the links of ``value, i, j, id, comp, side, held, words``."""

    def run(group: pa.Table) -> pa.Table:
        words = [np.frombuffer(w.as_py(), np.uint32) for w in group["words"]]
        found = block_links(group["value"][0].as_py(), group["id"].to_pylist(), group["comp"].to_pylist(), np.array(group["side"].to_pylist()), words, group["held"].to_pylist(), similarity)
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return pairs.groupBy("value", "i", "j").applyInArrow(run, "a long, b long")


def classes(docs: DataFrame, similarity: float = SIMILARITY, sketches: int = SKETCHES, picked: int = PICKED, block: int = BLOCK) -> DataFrame:
    """``doc_id, class_id``: one row per document."""
    docs = texts(docs)
    table = materialize(sketch_table(docs, sketches, picked), "sketches")
    texts_ = table.filter("doc_id IS NOT NULL").groupBy("k1", "k2").agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    # a sketch's value starts from its number, so that the value alone tells the sketches apart
    members = texts_.select("id", "n", F.explode("sketch").alias("value"))
    n_docs = table.count()
    dealt = materialize(with_pivots(members, sketches * n_docs), "dealt", sketches * n_docs)

    # the similarity cannot be reached if one text is too short for the other
    close = F.least("n", "pivot_n") >= similarity * F.greatest("n", "pivot_n") - 1e-9
    n_dealt = dealt.count()
    pairs = materialize(dealt.filter("id <> pivot").filter(close).select("id", "pivot").distinct(), "pairs", n_dealt)
    wanted = dealt.select(F.col("id").alias("doc_id")).distinct()
    # the ids grow with the corpus, so both sides are dealt by id at every size
    words = materialize(words_of(docs.join(wanted.hint("merge"), "doc_id", "left_semi")), "words")
    judged = materialize(verify(pairs, words, similarity), "judged")
    stars = components(judged.filter("linked").select(F.col("id").alias("a"), F.col("pivot").alias("b")), pairs.count())

    rest = materialize(unsettled(dealt.select("value", "id"), stars, n_dealt), "unsettled", n_dealt)
    held = rest.groupBy("id").agg(F.collect_list("value").alias("held"))
    compared = block_pairs(rest, block).join(held.join(words, "id"), "id")
    links = materialize(compare_blocks(compared, similarity), "compared")
    stars = components(stars.unionByName(links), stars.count() + links.count())
    named = texts_.select("k1", "k2", "id").join(stars.select(F.col("a").alias("id"), F.col("b").alias("least")), "id", "left").select("k1", "k2", F.coalesce("least", "id").alias("class_id"))
    # written first, so that the join can be split where one text has very many copies
    return table.select("doc_id", "k1", "k2").join(materialize(named, "named", n_docs), ["k1", "k2"], "left").select("doc_id", "class_id")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """All columns of one row of each group: the one of the smallest ``doc_id``, rows without one last.

    Rows are judged each on its own text: where ids are missing or repeated, rows get numbers of their own.
    """
    doc_id = docs[id_col].cast("long")
    if docs.select(doc_id.alias("i")).groupBy("i").agg(F.count("*").alias("n")).filter("n > 1 OR i IS NULL").isEmpty():
        found = classes(docs.select(doc_id.alias("doc_id"), docs[text_col].alias("text")), similarity)
        gone = materialize(found.filter("doc_id <> class_id").select(F.col("doc_id").alias("gone__")).distinct(), "near-copies")
        return docs.join(gone, doc_id == gone["gone__"], "left_anti")
    # the row travels as one column, so that its names cannot clash with the others
    rows = materialize(docs.select(F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns]).alias("r"), doc_id.alias("id"), docs[text_col].cast("string").alias("t"), F.monotonically_increasing_id().alias("key")), "rows")
    named = classes(rows.select(F.col("key").alias("doc_id"), F.col("t").alias("text")), similarity)
    first = named.join(rows.select(F.col("key").alias("doc_id"), "id"), "doc_id").groupBy("class_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", F.col("doc_id").alias("key"))).alias("m"))
    stay = materialize(first.select("m.key"), "representatives")
    return rows.join(stay, "key", "left_semi").select("r.*")
