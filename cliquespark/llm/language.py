"""Language identification by cross-parsing entropy.

For each language a suffix automaton of a bounded sample of labelled text accepts exactly the
sample's substrings. A text is parsed greedily into the longest phrases that the automaton
accepts; the language that needs the fewest, at equal price per phrase, is the closest. Samples and
texts are UTF-8 bytes, so every script has the same small alphabet and no letter is left out. Texts
are parsed in whole, in blocks of ``BLOCK_BYTES`` that each start a phrase, so that many blocks advance
together through one transition table in numpy; a seam adds at most one phrase for any language.

The sample: of each language's labelled rows the ``SAMPLE_DOCS`` with the smallest hash of id and
text, the first ``SAMPLE_BYTES`` characters of each, cut at ``SAMPLE_BYTES`` bytes of letters, marks and
single spaces together. Every phrase costs the same whatever the sample, so a language with a tiny
sample needs more phrases and cannot win by it. Automata have fewer than twice as many states as
the sample has bytes and are sent as packed tables of some 0.4 MB a language.

Defined results: a null text, or one without a letter, is ``und`` with score 0; without any
labelled row every text is ``und``; of languages with equally few phrases the first in code point
order is given; very long texts are parsed in whole; repeated rows are scored like any other; an
empty table gives an empty result; a null ``doc_id`` is never learned from; other columns are neither
read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cliquespark.llm.shared import ship_package

SAMPLE_BYTES = 16_384
SAMPLE_DOCS = 40
BLOCK_BYTES = 1_024
UNKNOWN = "und"
NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
LETTER = regex.compile(r"\p{L}")
#: Bytes that are parsed together; bounds the arrays in memory.
TOGETHER_BYTES = 2_000_000
#: Slots that are searched at once for a place in the packed table.
WINDOW = 2_048


def plain(text: str) -> str:
    """Lower-case letters and their marks with single spaces for everything between them; empty without a letter."""
    found = NOT_LETTERS.sub(" ", text.lower()).strip()
    return found if LETTER.search(found) else ""


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def suffix_automaton(data: bytes) -> list[dict[int, int]]:
    """Transitions by state; state 0 is the start, to which none leads back."""
    links, lengths, nexts = [-1], [0], [{}]
    last = 0
    for code in data:
        state, at = len(nexts), last
        links.append(0)
        lengths.append(lengths[last] + 1)
        nexts.append({})
        while at >= 0 and code not in nexts[at]:
            nexts[at][code] = state
            at = links[at]
        if at >= 0:
            follow = nexts[at][code]
            if lengths[follow] != lengths[at] + 1:
                copy = len(nexts)
                links.append(links[follow])
                lengths.append(lengths[at] + 1)
                nexts.append(dict(nexts[follow]))
                while at >= 0 and nexts[at].get(code) == follow:
                    nexts[at][code] = copy
                    at = links[at]
                links[follow] = follow = copy
            links[state] = follow
        last = state
    return nexts


class Automaton:
    """A suffix automaton packed by row displacement.

    The transition of ``state`` by ``byte`` is in slot ``base[state] + byte`` if ``owner`` of that slot is
    the state, and there is none otherwise.
    """

    def __init__(self, data: bytes):
        nexts = suffix_automaton(data)
        many = sum(map(len, nexts))
        taken = np.zeros(many * 2 + len(nexts) + 4 * WINDOW, bool)
        self.base = np.zeros(len(nexts), np.int32)
        low = 256
        for state in sorted((k for k, row in enumerate(nexts) if len(row) > 1), key=lambda k: -len(nexts[k])):
            codes = sorted(nexts[state])
            while low < len(taken) and taken[low]:
                low += 1
            at = low - codes[0]
            while True:
                if at + 256 + WINDOW > len(taken):
                    taken = np.concatenate([taken, np.zeros(len(taken), bool)])
                clash = taken[at + codes[0] : at + codes[0] + WINDOW].copy()
                for c in codes[1:]:
                    clash |= taken[at + c : at + c + WINDOW]
                first = int(clash.argmin())
                if not clash[first]:
                    break
                at += WINDOW
            self.base[state] = at + first
            taken[at + first + np.array(codes)] = True
        # states with one transition take any slot that is left
        single = [k for k, row in enumerate(nexts) if len(row) == 1]
        taken = np.concatenate([taken, np.zeros(len(single) + 512, bool)])
        free = np.flatnonzero(~taken[256:])[: len(single)] + 256
        self.base[single] = free - np.array([next(iter(nexts[k])) for k in single], np.int64)
        taken[free] = True
        size = int(np.flatnonzero(taken).max(initial=0)) + 257
        kind = np.uint16 if len(nexts) < 1 << 16 else np.int32
        self.owner, self.target = np.zeros(size, kind), np.zeros(size, kind)
        for state, row in enumerate(nexts):
            for code, to in row.items():
                self.owner[self.base[state] + code], self.target[self.base[state] + code] = state, to
        self.first = np.array([nexts[0].get(c, 0) for c in range(256)], np.int32)

    def follow(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The next states, 0 where there is none."""
        slots = self.base[states] + codes
        return np.where(self.owner[slots] == states, self.target[slots], 0).astype(np.int32)


class Identifier:
    """The automata of all languages; scores many texts at once."""

    def __init__(self, samples: dict[str, str], sample_bytes: int = SAMPLE_BYTES):
        self.names = sorted(samples)
        self.automata = [Automaton(samples[n].encode()[:sample_bytes].decode(errors="ignore").encode()) for n in self.names]

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases needed, ``[text, language]``."""
        coded = [t.encode() for t in texts]
        lengths = np.array([len(t) for t in coded], np.int64)
        data = np.frombuffer(b"".join(coded), np.uint8).astype(np.int32)
        starts, owners, sizes = [], [], []
        at = 0
        for k, n in enumerate(lengths):
            begin = np.arange(at, at + n, BLOCK_BYTES)
            starts.append(begin)
            owners.append(np.full(len(begin), k))
            sizes.append(np.minimum(BLOCK_BYTES, at + n - begin))
            at += n
        starts, owners, sizes = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, owners, sizes))
        # longest blocks first: those that still run are always the first ones
        order = np.argsort(-sizes, kind="stable")
        starts, owners, sizes = starts[order], owners[order], sizes[order]
        out = np.zeros((len(texts), len(self.names)), np.int64)
        if not len(starts):
            return out
        running = np.searchsorted(-sizes, -np.arange(int(sizes[0])), "left")
        for j, automaton in enumerate(self.automata):
            state = np.zeros(len(starts), np.int32)
            count = np.zeros(len(starts), np.int64)
            for i, n in enumerate(running):
                codes, before = data[starts[:n] + i], state[:n]
                follow = automaton.follow(before, codes)
                ended = follow == 0
                # a phrase starts where none was open, and where the byte does not fit the open one; a byte that the sample lacks is a phrase of its own
                count[:n] += ended | (before == 0)
                if ended.any():
                    follow[ended] = automaton.first[codes[ended]]
                state[:n] = follow
            out[:, j] = np.bincount(owners, count, len(texts))
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        cleaned = [plain(t) if t else "" for t in texts]
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.names:
            return names, scores
        group, size = [], 0
        for k, t in enumerate(cleaned):
            if t:
                group.append(k)
                size += len(t)
            if group and (size >= TOGETHER_BYTES or k == len(cleaned) - 1):
                needed = self.phrases([cleaned[g] for g in group])
                best = needed.argmin(1)
                for g, row, b in zip(group, needed, best, strict=True):
                    names[g] = self.names[b]
                    rest = np.delete(row, b)
                    scores[g] = float(rest.min() / (rest.min() + row[b])) if len(rest) else 1.0
                group, size = [], 0
        return names, scores


def samples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> dict[str, str]:
    """A bounded sample of labelled text per language, the same for every order and partitioning of the rows.

    Ranks are limited in each partition before they are shuffled, and only ids and hashes are.
    """
    labelled = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    labelled = labelled.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    keyed = labelled.select("lang", F.xxhash64("doc_id", "text").alias("h"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = {(r["lang"], r["h"]) for r in keyed.withColumn("nth", nth).filter(F.col("nth") <= sample_docs).collect()}
    rows = labelled.withColumn("h", F.xxhash64("doc_id", "text")).filter(F.col("h").isin([h for _, h in chosen])).select("lang", "h", F.substring("text", 1, sample_bytes).alias("text")).distinct().collect() if chosen else []
    found: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["h"])):
        if (r["lang"], r["h"]) in chosen and (text := plain(r["text"])):
            found.setdefault(r["lang"], []).append(text)
    return {lang: " ".join(texts)[:sample_bytes] for lang, texts in found.items()}


def identify(docs: DataFrame, chosen: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``doc_id, held_out, lang_pred, score``; the texts are all that a prediction sees."""
    ship_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(Identifier(chosen))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = sent.value
        for batch in batches:
            for part in range(0, batch.num_rows, 1_000):
                rows = batch.slice(part, 1_000)
                names, scores = made.predict(rows["text"].to_pylist())
                yield pa.RecordBatch.from_arrays([rows["doc_id"], rows["held_out"], pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), held_out(F.col(id_col).cast("long")).alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def language_rows(docs: DataFrame) -> DataFrame:
    """The contract's rows: learned from the labelled rows that are not held out, predicted for all."""
    return identify(docs, samples(docs))
