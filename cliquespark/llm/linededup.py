"""Line dedup with sharded cuckoo filters over exact reference-count tables.

A line's key is known by 128 bits of hash. The table of keys has one row each: how many lines
refer to it and the smallest and largest document that holds it. A key is shared if those two
differ; its lines stay only in the smallest document. Cuckoo filters, one per hash shard, hold the
shared keys in two bytes each: lines whose key is in no filter pass at once, and only the others
meet the exact table, which settles every false positive. Lines are dealt to their shard's filter
in blocks of a bounded number, so a key that holds a third of all lines is probed in many tasks,
each with a copy of one filter.

Incremental use keeps the references per key and document (:func:`line_counts`), from which the
table of keys follows. Inserting a batch adds to them, deleting documents subtracts, and the filters
take in keys that became shared and lose those that no longer are; a deletion needs nothing but the
deleted documents and undoes the insertion.

Defined results: null and empty texts have one empty line; a null ``doc_id`` is a document
after all others; rows that repeat a ``doc_id`` belong to one document, and their texts stay apart;
a document that holds a key several times keeps all of these lines if it is the smallest; very long
texts are lines like any others; an empty table gives an empty result; other columns pass through
whatever their names, and ``line_digests`` leaves them out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliquespark.llm.shared import materialize, texts

LEAST_CHARS = 10
#: Shared keys of a filter, until there are so many shards.
KEYS_PER_SHARD, MOST_SHARDS = 8_192, 65_536
#: Lines that are probed together: a 4096th of all within these bounds.
LEAST_BLOCK, LARGEST_BLOCK = 16_384, 1 << 20
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LAST_DOC = (1 << 63) - 1
SLOTS = 4


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a key's second bucket follows from its first and its fingerprint.

    All operations take arrays of keys. ``insert`` returns False when the filter is too full,
    which the caller answers with a larger one.
    """

    def __init__(self, capacity: int = 0, table: np.ndarray | None = None):
        buckets = 1 << max(1, int(np.ceil(np.log2(max(1, capacity) / (SLOTS * 0.85)))))
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else table
        self.mask = np.uint64(len(self.table) - 1)

    @staticmethod
    def _mix(x: np.ndarray) -> np.ndarray:
        x = x.astype(np.uint64)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return x ^ (x >> np.uint64(29))

    def _place(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mixed = self._mix(keys.view(np.uint64) if keys.dtype == np.int64 else keys)
        prints = (mixed >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        return (mixed & self.mask).astype(np.int64), prints

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return ((bucket.astype(np.uint64) ^ self._mix(prints)) & self.mask).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(0, bool)
        first, prints = self._place(keys)
        second = self._other(first, prints)
        wanted = prints[:, None]
        return (self.table[first] == wanted).any(1) | (self.table[second] == wanted).any(1)

    def _fill(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """Put prints into free slots of their buckets; returns which found one."""
        order = np.argsort(bucket, kind="stable")
        ranked = bucket[order]
        rank = np.arange(len(ranked)) - np.searchsorted(ranked, ranked)
        free = self.table[ranked] == 0
        fits = rank < free.sum(1)
        nth = np.cumsum(free, 1) - 1
        slot = ((nth == rank[:, None]) & free).argmax(1)
        self.table[ranked[fits], slot[fits]] = prints[order][fits]
        done = np.zeros(len(bucket), bool)
        done[order[fits]] = True
        return done

    def insert(self, keys: np.ndarray, rounds: int = 500) -> bool:
        bucket, prints = self._place(keys)
        rng = np.random.default_rng(7)
        for _ in range(rounds):
            if not len(bucket):
                return True
            left = ~self._fill(bucket, prints)
            bucket, prints = self._other(bucket[left], prints[left]), prints[left]
            left = ~self._fill(bucket, prints)
            bucket, prints = bucket[left], prints[left]
            # each full bucket gives up one random fingerprint, which moves to its other bucket
            _, firsts = np.unique(bucket, return_index=True)
            slot = rng.integers(0, SLOTS, len(firsts))
            victims = self.table[bucket[firsts], slot].copy()
            self.table[bucket[firsts], slot] = prints[firsts]
            moved = self._other(bucket[firsts], victims)
            rest = np.ones(len(bucket), bool)
            rest[firsts] = False
            bucket, prints = np.concatenate([moved, bucket[rest]]), np.concatenate([victims, prints[rest]])
        return not len(bucket)

    def delete(self, keys: np.ndarray) -> None:
        """Take out keys that are known to be in; one fingerprint each.

        A fingerprint and one bucket give the other bucket, so equal fingerprints in a pair of
        buckets stand for each other: of each such group as many go as there are keys.
        """
        first, prints = self._place(keys)
        second = self._other(first, prints)
        groups, many = np.unique(np.stack([np.minimum(first, second), np.maximum(first, second), prints.astype(np.int64)], axis=1), axis=0, return_counts=True)
        low, high, print_ = groups.reshape(-1, 3).T
        equal = np.concatenate([self.table[low] == print_[:, None], (self.table[high] == print_[:, None]) & (low != high)[:, None]], axis=1)
        row, slot = np.nonzero(equal & (np.cumsum(equal, axis=1) <= many[:, None]))
        self.table[np.where(slot < SLOTS, low[row], high[row]), slot % SLOTS] = 0

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        capacity = max(1, len(keys))
        while not (made := cls(capacity)).insert(keys):
            capacity *= 2
        return made

    def to_bytes(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        return cls(table=np.frombuffer(data, "<u2").astype(np.uint16).reshape(-1, SLOTS))


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def key_hashes(key: Column) -> Column:
    """128 bits in two columns; a leading literal gives the second hash its own seed."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def keyed_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``doc``, ``row`` (hash of the text, tells rows of one id apart), ``pos``, ``h1``, ``h2`` of every line whose key is long enough."""
    found = texts(docs).select(
        F.coalesce("doc_id", F.lit(LAST_DOC)).alias("doc"), F.xxhash64("text").alias("row"), F.posexplode(F.transform(split_lines(F.col("text")), line_key)).alias("pos", "key")
    )
    return found.filter(F.length("key") >= least_chars).select("doc", "row", "pos", key_hashes(F.col("key")).alias("k")).select("doc", "row", "pos", "k.h1", "k.h2")


def reference_table(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """The table of keys: ``h1, h2, refs, first_doc, last_doc``. Counts, minima and maxima combine before the shuffle."""
    return keyed_lines(docs, least_chars).groupBy("h1", "h2").agg(F.count("*").alias("refs"), F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"))


def line_counts(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """The references per key and document, ``h1, h2, doc, refs``: what incremental use keeps."""
    return keyed_lines(docs, least_chars).groupBy("h1", "h2", "doc").agg(F.count("*").alias("refs"))


def key_table(counts: DataFrame) -> DataFrame:
    """:func:`reference_table` from :func:`line_counts`."""
    return counts.groupBy("h1", "h2").agg(F.sum("refs").alias("refs"), F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"))


def insert_documents(counts: DataFrame, docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """The counts after a batch of new documents."""
    return counts.unionByName(line_counts(docs, least_chars)).groupBy("h1", "h2", "doc").agg(F.sum("refs").alias("refs"))


def delete_documents(counts: DataFrame, deleted: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """The counts after documents left."""
    gone = line_counts(deleted, least_chars).withColumn("refs", -F.col("refs"))
    return counts.unionByName(gone).groupBy("h1", "h2", "doc").agg(F.sum("refs").alias("refs")).filter("refs > 0")


def shared_keys(table: DataFrame) -> DataFrame:
    return table.filter("first_doc < last_doc").select("h1", "h2", "first_doc")


def shard_of(n: int) -> Column:
    return F.pmod(F.col("h2"), F.lit(n)).cast("int")


def build_filters(keys: DataFrame, n_shards: int) -> DataFrame:
    """One cuckoo filter per shard: ``shard, filter``."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "filter": [CuckooFilter.of(pdf["h1"].to_numpy(np.int64)).to_bytes()]})

    return keys.select(shard_of(n_shards).alias("shard"), "h1").groupBy("shard").applyInPandas(build, "shard int, filter binary")


def update_filters(filters: DataFrame, n_shards: int, added: DataFrame, removed: DataFrame) -> DataFrame:
    """Filters after keys became shared (``added``) or stopped being so (``removed``); a filter that gets too full is a sign to rebuild it from the table, which is done by the caller with :func:`build_filters`."""
    changes = added.select(shard_of(n_shards).alias("shard"), "h1", F.lit(True).alias("add")).unionByName(removed.select(shard_of(n_shards).alias("shard"), "h1", F.lit(False).alias("add")))

    def apply(key: tuple, old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter.from_bytes(old["filter"].iloc[0]) if len(old) else CuckooFilter(KEYS_PER_SHARD)
        made.delete(new.loc[~new["add"].astype(bool), "h1"].to_numpy(np.int64))
        if not made.insert(new.loc[new["add"].astype(bool), "h1"].to_numpy(np.int64)):
            raise ValueError("a filter is full: rebuild the filters from the reference table with more shards")
        return pd.DataFrame({"shard": [key[0]], "filter": [made.to_bytes()]})

    return filters.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(apply, "shard int, filter binary")


def shard_blocks(table: DataFrame, filters: DataFrame, n_shards: int) -> DataFrame:
    """``shard, blocks``: among how many blocks the lines of each shard that has a filter are dealt."""
    loads = table.groupBy(shard_of(n_shards).alias("shard")).agg(F.sum("refs").alias("lines")).join(filters.select("shard"), "shard")
    total = loads.agg(F.sum("lines")).first()[0] or 0
    block = min(LARGEST_BLOCK, max(LEAST_BLOCK, total // 4096))
    return loads.select("shard", F.ceil(F.col("lines") / F.lit(block)).cast("int").alias("blocks"))


def probe(lines: DataFrame, filters: DataFrame, blocks: DataFrame, n_shards: int) -> DataFrame:
    """The lines that some filter may hold. ``blocks`` has ``MOST_SHARDS`` rows at most and is sent to every executor."""
    columns = lines.columns
    dealt = lines.withColumn("shard", shard_of(n_shards)).join(F.broadcast(blocks), "shard")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("doc", "row", "pos"), F.col("blocks")).cast("int")).drop("blocks")
    copies = filters.join(F.broadcast(blocks), "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "filter")

    def test(some: pa.Table, held: pa.Table) -> pa.Table:
        hit = np.zeros(some.num_rows, bool)
        if some.num_rows and held.num_rows:
            hit = CuckooFilter.from_bytes(held["filter"][0].as_py()).contains(some["h1"].to_numpy())
        return some.select(columns).filter(pa.array(hit))

    return dealt.groupBy("shard", "block").cogroup(copies.groupBy("shard", "block")).applyInArrow(test, lines.schema)


def dropped_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, keys_per_shard: int = KEYS_PER_SHARD) -> DataFrame:
    """``doc``, ``row`` and the positions of the lines that go."""
    table = materialize(reference_table(docs, least_chars), "line-keys")
    shared = shared_keys(table)
    n_shards = min(MOST_SHARDS, max(1, -(-shared.count() // keys_per_shard)))
    filters = materialize(build_filters(shared, n_shards), "line-filters")
    blocks = materialize(shard_blocks(table, filters, n_shards), "line-blocks", MOST_SHARDS)
    maybe = probe(keyed_lines(docs, least_chars), filters, blocks, n_shards)
    # shared keys and texts grow with the corpus, so both joins are dealt by key at every size
    sure = maybe.join(shared.hint("merge"), ["h1", "h2"]).filter("first_doc < doc")
    return sure.groupBy("doc", "row").agg(F.collect_set("pos").alias("drop"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, counts: bool = False, keys_per_shard: int = KEYS_PER_SHARD) -> DataFrame:
    """All columns of ``docs`` with the text less its repeated lines; ``counts``: ``doc_id``, ``text``, ``n_lines`` and ``n_dropped`` instead."""
    # written first, so that the join can be split where many rows without an id have the same text
    drops = materialize(dropped_lines(texts(docs, id_col, text_col), least_chars, keys_per_shard), "dropped-lines")
    # the row travels as one column, so that its names cannot clash with those of the join
    plain = F.col(text_col).cast("string")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_DOC)).alias("doc"), F.xxhash64(plain).alias("row"), plain.alias("t"))
    joined = keyed.join(drops.hint("merge"), ["doc", "row"], "left")
    lines = split_lines(F.col("t"))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("drop"))
    # the array of one binds the lines to a name, so that they are split once per text and not once per line
    rest = F.transform(F.array(lines), lambda ls: F.array_join(F.transform(kept, lambda i: ls[i]), "\n"))[0]
    text = F.when(F.col("drop").isNull(), F.coalesce("t", F.lit(""))).otherwise(rest)
    if counts:
        return joined.select(F.col("r")[id_col].cast("long").alias("doc_id"), text.alias("text"), F.size(lines).cast("long").alias("n_lines"), F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"))
    return joined.select(*[text.alias(c) if c == text_col else F.col("r")[c].alias(c) for c in docs.columns])


def line_digests(docs: DataFrame) -> DataFrame:
    """The contract's rows."""
    return dedup_lines(texts(docs), counts=True).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
