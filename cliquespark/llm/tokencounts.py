"""Token counts per section by offset-mapped attribution.

Whole documents are encoded once; each token comes with the character span that it was made
from, put together from the spans inside the pieces between single spaces, which repeat. Spans are joined to the sections' intervals by binary search inside the document, so
nothing is encoded twice and nothing is shuffled. A token whose span crosses a boundary goes
by an explicit rule: ``majority`` (the section with most of its characters, the earlier one on
a tie), ``first`` or ``last``. Tokens of one multi-byte character share its span and count one
each. Tokens that touch no section are counted as outside.

Defined results: a null or empty text has no tokens, and one empty section in the query; very long
texts are encoded in whole; overlapping or unsorted sections are refused; rows with a null or repeated ``doc_id`` are counted
like any other; an empty table gives an empty result; other columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cliquespark.llm import tokens
from cliquespark.llm.shared import texts

RULES = ("majority", "first", "last")
COUNTS = "doc_id long, n_tokens long, n_sections long, n_crossing long, n_outside long, section_tokens array<long>"
#: Characters that are encoded together.
BLOCK_CHARS = 1_000_000


def line_sections(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the lines, each with its line feed."""
    ends = np.cumsum([len(x) + 1 for x in text.split("\n")])
    return np.concatenate([[0], ends[:-1]]), np.minimum(ends, len(text))


def attribute(spans: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str = "majority") -> tuple[np.ndarray, int, int]:
    """Tokens per section, tokens that cross a boundary, tokens outside all sections.

    ``spans``: rows of start and end; sections are sorted and do not overlap.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    if len(starts) and ((ends < starts).any() or (starts[1:] < ends[:-1]).any()):
        raise ValueError("sections must be sorted and must not overlap")
    counts = np.zeros(len(starts), np.int64)
    if not len(spans) or not len(starts):
        return counts, 0, len(spans)
    begin, stop = spans[:, 0], np.maximum(spans[:, 1], spans[:, 0] + 1)
    first = np.searchsorted(ends, begin, "right")
    last = np.searchsorted(starts, stop, "left") - 1
    inside = first <= last
    whole = inside & (first == last) & (starts[np.minimum(first, len(starts) - 1)] <= begin) & (stop <= np.maximum(ends, starts + 1)[np.minimum(first, len(starts) - 1)])
    counts += np.bincount(first[whole], minlength=len(starts))
    crossing = np.flatnonzero(inside & ~whole)
    for k in crossing:
        candidates = range(int(first[k]), int(last[k]) + 1)
        if rule == "first":
            chosen = candidates[0]
        elif rule == "last":
            chosen = candidates[-1]
        else:
            chosen = max(candidates, key=lambda s: (min(stop[k], ends[s]) - max(begin[k], starts[s]), -s))
        counts[chosen] += 1
    return counts, len(crossing), int((~inside).sum())


def count_tokens(docs: DataFrame, sections: Callable[[str], tuple[np.ndarray, np.ndarray]] = line_sections, rule: str = "majority", tokenizer_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document; ``section_tokens`` has the tokens of each section in order."""
    path = tokenizer_path or tokens.byte_bpe_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.SpanEncoder(tokens.encoder(path))
        for batch in batches:
            for block in tokens.in_blocks(batch, BLOCK_CHARS):
                out: tuple[list, ...] = ([], [], [], [], [], [])
                for (doc, text), spans in zip(block, coder.encode([t for _, t in block]), strict=True):
                    counts, crossing, outside = attribute(spans, *sections(text), rule)
                    for column, value in zip(out, (doc, len(spans), len(counts), crossing, outside, counts), strict=True):
                        column.append(value)
                kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["doc_id", "n_tokens", "n_sections", "n_crossing", "n_outside", "section_tokens"])

    return texts(docs, id_col, text_col).mapInArrow(run, COUNTS)
