"""Best-fit packing of token sequences by minimum bin slack.

Lengths are bounded by the capacity, so the whole packing problem is a histogram of at
most ``capacity`` counts, however many pieces there are. The driver plans bins from that
histogram alone: each bin takes the longest piece left, then a bitset subset-sum over the
lengths still available finds the fullest feasible filling, which is removed as often as
the counts allow. Executors then give each piece its rank among those of its length and
look the rank up in the plan.

Defined results: a null or empty text is one piece that holds only the end id; rows with a
null or repeated ``doc_id`` are packed like any other; which of several pieces of one length takes
which place is settled by their order in the written table; very long texts are encoded in whole and cut
into pieces; an empty table gives an empty result; other columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cliquespark.llm import tokens
from cliquespark.llm.shared import materialize, texts

CAPACITY = 2048
END_ID = 0
#: Pieces of one length that are ranked together; a length's pieces are dealt over so many hash buckets.
PIECES_PER_BUCKET = 65_536
LEAST_BUCKETS = 64

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)
ARROW_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` ids; only the first may be shorter than the capacity."""
    first = (n - 1) % capacity + 1
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def tokenized_pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer_path: str | None = None, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece with its ids as little-endian unsigned 32-bit integers."""
    path, end = tokenizer_path or tokens.byte_bpe_path(), tokens.pack_ids([end_id])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.encoder(path)
        for batch in batches:
            for block in tokens.in_blocks(batch):
                out: tuple[list, ...] = ([], [], [], [], [])
                for (doc, _), packed in zip(block, coder.encode([t for _, t in block]), strict=True):
                    packed += end
                    for k, (start, length) in enumerate(cut(len(packed) // 4, capacity)):
                        for column, value in zip(out, (doc, k, start, length, packed[4 * start : 4 * (start + length)]), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, ARROW_PIECES, strict=True)], schema=ARROW_PIECES)

    return texts(docs, id_col, text_col).mapInArrow(encode, PIECES)


def fullest(counts: dict[int, int], lengths: list[int], room: int) -> dict[int, int]:
    """The multiset of available lengths with the largest sum up to ``room``, longest first; bit i of ``reach`` says that i can be filled."""
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in lengths:
        left, part = min(counts[length], room // length), 1
        while left > 0 and not reach >> room & 1:
            take = min(part, left)
            steps.append((length, take, reach))
            reach |= (reach << (take * length)) & mask
            left, part = left - take, part * 2
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            at -= take * length
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def minimum_bin_slack(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """``(lengths in a bin with their multiplicities, number of such bins)``; every counted piece is in one bin.

    Each round uses up what is left of at least one length or shrinks it below its
    multiplicity in a bin, so there are at most about ``capacity * log(capacity)`` rounds.
    """
    counts = {length: n for length, n in histogram.items() if n > 0}
    if counts and not 0 < min(counts) <= max(counts) <= capacity:
        raise ValueError("lengths must be between 1 and the capacity")
    lengths, bins = sorted(counts, reverse=True), []
    while lengths:
        first = lengths[0]
        counts[first] -= 1
        room = capacity - first
        chosen = fullest(counts, [x for x in lengths if x <= room], room) if room else {}
        counts[first] += 1
        chosen[first] = chosen.get(first, 0) + 1
        times = min(counts[x] // m for x, m in chosen.items())
        for x, m in chosen.items():
            counts[x] -= m * times
        bins.append((chosen, times))
        lengths = [x for x in lengths if counts[x]]
    return bins


def plan_table(bins: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows ``length, first rank, multiplicity, first sequence, offset``, by length and rank.

    At most a few rows per round and length: its size follows the capacity, not the data.
    """
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for chosen, times in bins:
        offset = 0
        for length in sorted(chosen, reverse=True):
            rows.append((length, used.get(length, 0), chosen[length], sequence, offset))
            used[length] = used.get(length, 0) + chosen[length] * times
            offset += length * chosen[length]
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def assign_sequences(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    Needs ``length``; further columns pass through, so a narrow
    table costs a narrow shuffle. A length that holds a third of all pieces is ranked in many
    hash buckets whose counts are summed first.
    """
    spark, kept = pieces.sparkSession, pieces.columns
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    # rows are told apart by a number of their own, since ids may be missing or repeated
    pieces = materialize(pieces.withColumn("row__", F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(plan_table(minimum_bin_slack(histogram, capacity)))
    buckets = max(LEAST_BUCKETS, -(-sum(histogram.values()) // PIECES_PER_BUCKET))

    dealt = pieces.withColumn("bucket__", F.pmod(F.xxhash64("row__"), F.lit(buckets)))
    before = (
        dealt.groupBy("length", "bucket__")
        .agg(F.count("*").alias("n__"))
        .withColumn("base__", F.sum("n__").over(Window.partitionBy("length").orderBy("bucket__").rowsBetween(Window.unboundedPreceding, -1)))
        .select("length", "bucket__", F.coalesce("base__", F.lit(0)).alias("base__"))
    )
    ranked = dealt.withColumn("rank__", F.row_number().over(Window.partitionBy("length", "bucket__").orderBy("row__")) - 1)
    ranked = ranked.join(before, ["length", "bucket__"]).withColumn("rank__", F.col("rank__") + F.col("base__"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = plan.value
        # rank < 2**51 and length < 2**12, so both fit one sortable integer
        keys = (table[:, 0] << 51) + table[:, 1]
        for batch in batches:
            length, rank = (batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank__"))
            row = table[np.searchsorted(keys, (length << 51) + rank, "right") - 1]
            nth = rank - row[:, 1]
            sequence, offset = row[:, 3] + nth // row[:, 2], row[:, 4] + nth % row[:, 2] * length
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"])

    return ranked.select(*kept, "rank__").mapInArrow(place, schema)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer_path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Packed pieces with their ids: group by ``sequence_id`` and order by ``offset`` for the training sequences."""
    return assign_sequences(tokenized_pieces(docs, capacity, tokenizer_path, end_id), capacity)


def with_digest(pieces: DataFrame) -> DataFrame:
    """``ids`` replaced by their CRC-32."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def packed_digests(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The contract's rows: the ids become a checksum before anything is shuffled."""
    return assign_sequences(with_digest(tokenized_pieces(docs, capacity)), capacity)
