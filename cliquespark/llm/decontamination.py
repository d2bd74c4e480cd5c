"""Benchmark decontamination: word-pair seeds by the counting bound, then Smith-Waterman alignment.

Test items are indexed by pairs of neighbouring words, all of them. An alignment of ``m`` words of
an item of ``n`` with ``x`` edits scores ``2 m - x``, and its edits split the words into ``x + 1``
runs at most, so one that reaches the part ``p`` of the best score keeps at least
``(2 p - 1) n - 1`` pairs whole, and no insertions shift them by more than ``(2 - 2 p) n`` words.
Passages with so many pairs so close together are scored by local alignment of words; no other
can reach the limit. Items so short that the bound is below one pair are indexed by single words,
of which a passage keeps the part ``p``. One pass over the corpus, which does not shuffle texts:
what travels are the matches. The benchmark is taken in blocks of a fixed number of words, each
sent to the executors; a larger benchmark takes more passes.

Defined results: null and empty texts match nothing; items of fewer than ``LEAST_WORDS`` words
cannot be told from ordinary text and match nothing; a document has one row per item, the
best-scoring passage, of equal ones the first, and repeated rows repeat it; a null ``doc_id`` is
reported as such and a null ``item_id`` matches nothing; very long texts are searched in whole, and
aligned only around seeds; spans are code points of the text as it is; empty tables give an empty
result; of either table only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliquespark.llm.shared import ship_package, texts

#: Items of fewer words match nothing.
LEAST_WORDS = 4
#: Words of benchmark items that are held at once; the executors get some 30 bytes for each and 150 for each distinct one.
BLOCK_WORDS = 1_000_000
MATCH, MISMATCH, GAP = 2, -1, -1
#: Part of the best possible score of an item that a passage must reach.
LEAST_SCORE = 0.6
WORD = re.compile(r"\w+")
MATCHES = "doc_id long, item_id long, score double, start long, end long"


def word_list(text: str) -> list[str]:
    """Lower-case words, one for each match of ``WORD`` in the text as it is."""
    low = text.lower()
    # a few letters become several when lowered, which would change where words end
    return WORD.findall(low) if len(low) == len(text) else [w.lower() for w in WORD.findall(text)]


def pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One number for two word ids; a single word has 0 as its second."""
    return (first << 32) | second


def needed(words: int, least: float) -> tuple[bool, int]:
    """Whether word pairs are enough to find an item of so many words, and how many seeds a passage keeps at least."""
    kept = int(np.ceil((2 * least - 1) * words - 1 - 1e-9))
    return (True, kept) if kept >= 1 else (False, max(1, int(np.ceil(least * words - 1e-9))))


@dataclass
class Items:
    """A block of benchmark items with the index that the executors get."""

    ids: list[int]
    words: list[np.ndarray] = field(default_factory=list)
    vocabulary: dict[str, int] = field(default_factory=dict)

    @classmethod
    def of(cls, rows: list[tuple[int, str]]) -> Items:
        made = cls([i for i, _ in rows])
        for _, text in rows:
            made.words.append(np.array([made.vocabulary.setdefault(w, len(made.vocabulary) + 1) for w in word_list(text)], np.int64))
        return made

    def index(self, least: float) -> Items:
        """Every seed of every item with its places, the seeds that each item needs, and how far insertions shift them."""
        keys, rows, self.need = [np.zeros(0, np.int64)], [np.zeros((0, 2), np.int64)], np.zeros(len(self.words), np.int64)
        for k, words in enumerate(self.words):
            paired, self.need[k] = needed(len(words), least)
            keys.append(pairs(words[:-1], words[1:]) if paired else pairs(words, np.zeros_like(words)))
            rows.append(np.stack([np.full(len(keys[-1]), k), np.arange(len(keys[-1]))], axis=1))
        self.slack = np.array([max(4, len(w) // 4, int((2 - 2 * least) * len(w) + 1e-9)) for w in self.words], np.int64)
        seeds, places = np.concatenate(keys), np.concatenate(rows)
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.places = seeds[order], places[order]
        self.single = bool(len(seeds)) and bool((seeds & 0xFFFFFFFF == 0).any())
        return self


def encode(text: str, vocabulary: dict[str, int]) -> np.ndarray:
    """Word ids; 0 for words of no item."""
    get = vocabulary.get
    return np.array([get(w, 0) for w in word_list(text)], np.int64)


def seeds_in(ids: np.ndarray, single: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions and numbers of the pairs, and with ``single`` the words, that consist of benchmark words."""
    inside = ids > 0
    at = np.flatnonzero(inside[:-1] & inside[1:])
    keys = pairs(ids[at], ids[at + 1])
    if single:
        alone = np.flatnonzero(inside)
        at, keys = np.concatenate([at, alone]), np.concatenate([keys, pairs(ids[alone], np.zeros_like(alone))])
    return at, keys


def dense(begins: np.ndarray, need: int, slack: int) -> np.ndarray:
    """Of sorted numbers those that lie with ``need`` of them in a span of ``slack``."""
    first = np.flatnonzero(begins[need - 1 :] - begins[: len(begins) - need + 1] <= slack)
    cover = np.zeros(len(begins) + 1, np.int64)
    np.add.at(cover, first, 1)
    np.add.at(cover, first + need, -1)
    return begins[np.cumsum(cover[:-1]) > 0]


def smith_waterman(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local score with linear gaps, and where in the passage that alignment starts and ends.

    A row at a time: gaps along the row follow from a running maximum. Starts travel with the
    scores, so no traceback matrix is kept.
    """
    n = len(passage)
    steps = np.arange(1, n + 1) * -GAP
    score, begin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best = (0, 0, 0)
    places = np.arange(n)
    for word in item:
        diagonal = score[:-1] + np.where(passage == word, MATCH, MISMATCH)
        up = score[1:] + GAP
        cell = np.maximum(np.maximum(diagonal, up), 0)
        start = np.where(cell == 0, places + 1, np.where(cell == diagonal, begin[:-1], begin[1:]))
        lifted = cell + steps
        run = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == run, places, 0))
        cell = np.maximum(run - steps, 0)
        start = np.where(cell > 0, start[source], places + 1)
        score[1:], begin[1:] = cell, start
        top = int(cell.argmax())
        if cell[top] > best[0]:
            best = (int(cell[top]), int(start[top]), top + 1)
    return best


def matches(ids: np.ndarray, items: Items, least: float) -> list[tuple[int, float, int, int]]:
    """``(item, score, first word, word after the last)`` of the best passage per item."""
    if not len(items.seeds) or not len(ids):
        return []
    at, keys = seeds_in(ids, items.single)
    left = np.searchsorted(items.seeds, keys, "left")
    many = np.searchsorted(items.seeds, keys, "right") - left
    if not many.any():
        return []
    rows = np.repeat(left, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    where, places = np.repeat(at, many), items.places[rows]
    hit = places[:, 0]
    enough = np.bincount(hit, minlength=len(items.words)) >= items.need
    found = []
    for k in np.flatnonzero(enough):
        item, slack = items.words[k], int(items.slack[k])
        mine = hit == k
        begins = dense(np.sort(where[mine] - places[mine, 1]), int(items.need[k]), slack)
        if not len(begins):
            continue
        best = (0, 0, 0)
        # starts that lie close together are one passage
        for group in np.split(begins, np.flatnonzero(np.diff(begins) > slack) + 1):
            first, last = max(0, int(group[0]) - slack), min(len(ids), int(group[-1]) + len(item) + slack)
            passage = ids[first:last]
            if MATCH * np.isin(item, passage).sum() < least * MATCH * len(item):
                continue
            score, a, b = smith_waterman(item, passage)
            if score > best[0]:
                best = (score, first + a, first + b)
        share = best[0] / (MATCH * len(item))
        if share >= least:
            found.append((int(k), share, best[1], best[2]))
    return found


def blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[int, str]]]:
    rows, size = [], 0
    for r in benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).filter("i IS NOT NULL AND t IS NOT NULL").orderBy("i", "t").toLocalIterator():
        n = len(word_list(r["t"]))
        if n >= LEAST_WORDS:
            if size + n > block_words and rows:
                yield rows
                rows, size = [], 0
            rows.append((r["i"], r["t"]))
            size += n
    if rows:
        yield rows


def align(docs: DataFrame, sent, least: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        for batch in batches:
            rows = []
            for doc, text in ((d.as_py(), t.as_py()) for d, t in zip(batch["doc_id"], batch["text"], strict=True)):
                if not text:
                    continue
                if found := matches(encode(text, items.vocabulary), items, least):
                    spans = [m.span() for m in WORD.finditer(text)]
                    rows += [(doc, items.ids[k], score, spans[a][0], spans[b - 1][1]) for k, score, a, b in found]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "item_id", "score", "start", "end"])

    return docs.mapInArrow(run, MATCHES)


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST_SCORE, block_words: int = BLOCK_WORDS, item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Rows ``doc_id, item_id, score, start, end`` (code points of the passage)."""
    docs = texts(docs)
    spark, parts = docs.sparkSession, []
    for rows in blocks(benchmark, item_col, item_text_col, block_words):
        parts.append(align(docs, spark.sparkContext.broadcast(Items.of(rows).index(least)), least))
    if not parts:
        return spark.createDataFrame([], MATCHES)
    return reduce(DataFrame.unionByName, parts)


def holds_passage(sent, least: float):
    """A column function: whether a text holds a passage of the broadcast items."""

    @F.arrow_udf("boolean")
    def holds(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        items = sent.value
        for part in parts:
            yield pa.array([bool(t) and bool(matches(encode(t, items.vocabulary), items, least)) for t in (x.as_py() for x in part)], pa.bool_())

    return holds


def clean(docs: DataFrame, benchmark: DataFrame, least: float = LEAST_SCORE, text_col: str = "text", block_words: int = BLOCK_WORDS, item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark passage, each judged on its own text where it is: no join, no shuffle."""
    ship_package(docs.sparkSession)
    for rows in blocks(benchmark, item_col, item_text_col, block_words):
        sent = docs.sparkSession.sparkContext.broadcast(Items.of(rows).index(least))
        docs = docs.filter(~holds_passage(sent, least)(docs[text_col].cast("string")))
    return docs
