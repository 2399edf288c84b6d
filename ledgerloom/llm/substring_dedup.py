"""Repeated passages: Rabin-Karp hashes of every window of `window` words.

One pass hashes all windows of a batch of documents with prefix sums
(S[i + w] - S[i]) * B^-i mod 2^64. A window that starts in an earlier document of
the same batch is decided there; of each hash only the windows of the batch's
smallest document go on, packed by hash range. The owner of a range finds the
smallest document of each hash over all batches and sends removal positions to
the group of documents they belong to. There the windows merge into maximal
removal intervals. A passage that a third of all documents share therefore
costs one entry for each batch, not one for each document or pair.

The number of hash ranges and document groups follows the text volume. So does
the hash width: a window is mistaken for another with a probability below 2^-28
up to the full 64 bits.

Defined cases: a null or empty text has no words; a text with fewer words than a
window loses nothing; windows repeated within one document only stay; a null
doc_id comes before every other; identical repeated rows are one document and
share its result; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import as_bytes, documents, pieces, texts

WINDOW = 13
BATCH_BYTES = 8 << 20
RANGE_BYTES = 4 << 20  # text whose windows one hash range holds
GROUP_BYTES = 2 << 20  # text that one group of documents holds
CACHE_WORDS = 250_000
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
NO_ID = -(1 << 63)


class WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def flat(self, split: list[list[bytes]], total: int) -> np.ndarray:
        if len(self) > CACHE_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, chain.from_iterable(split)), np.uint64, total)


def powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def window_hashes(flat: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    sums = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(flat * powers(BASE, len(flat)), out=sums[1:])
    return mixed((sums[starts + window] - sums[starts]) * powers(INVERSE, len(flat))[starts])


def to_planes(values: np.ndarray) -> bytes:
    """Unsigned integers as byte planes, without the planes that are zero throughout."""
    values = np.ascontiguousarray(values, "<u8")
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + values.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def from_planes(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, : data[0]] = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], n).T
    return out.view("<u8").ravel()


def spots_to_bytes(ids: np.ndarray, spots: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
    """Documents, counts and positions; equal ids stand together."""
    first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    own = ids[first]
    steps = np.diff(own.view(np.uint64), prepend=np.uint64(0))  # wraps, as does the sum of it
    return len(own), to_planes(steps), to_planes(np.diff(np.r_[first, len(ids)])), to_planes(spots)


def spots_from_bytes(n: int, docs: bytes, counts: bytes, spots: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids = np.cumsum(from_planes(docs, n), dtype=np.uint64).view(np.int64)
    counts = from_planes(counts, n).astype(np.int64)
    return np.repeat(ids, counts), from_planes(spots, int(counts.sum())).astype(np.int64)


def group_of(ids: np.ndarray, groups: int) -> np.ndarray:
    bits = ids.view(np.uint64)
    return ((bits ^ (bits >> np.uint64(17))).view(np.int64) % groups).astype(np.int64)


def group_column(doc_id: Column, groups: int) -> Column:
    return F.pmod(doc_id.bitwiseXOR(F.shiftrightunsigned(doc_id, 17)), F.lit(groups))


class Rows:
    """Packed rows on their way to Arrow: key, hashes (null: these are removals), n, docs, counts, spots."""

    SCHEMA = "key long, hashes binary, n int, docs binary, counts binary, spots binary"
    KINDS = (pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    NAMES = ("key", "hashes", "n", "docs", "counts", "spots")

    def __init__(self):
        self.rows = []

    def add(self, key: int, hashes: bytes | None, ids: np.ndarray, spots: np.ndarray):
        self.rows.append((key, hashes, *spots_to_bytes(ids, spots)))

    def add_removals(self, ids: np.ndarray, spots: np.ndarray, groups: int):
        group = group_of(ids, groups)
        order = np.lexsort((spots, ids, group))
        ids, spots, group = ids[order], spots[order], group[order]
        cuts = np.flatnonzero(np.diff(group)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(ids)]):
            if b > a:
                self.add(int(group[a]), None, ids[a:b], spots[a:b])

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self.rows) if self.rows else [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, self.KINDS)], names=self.NAMES)


def repeated_windows(docs: DataFrame, window: int, ranges: int, groups: int, bits: int) -> DataFrame:
    """Removal positions, packed by document group."""
    shift = np.uint64(bits - ranges.bit_length() + 1)  # ranges is a power of two
    low = np.uint64((1 << int(shift)) - 1)

    def hashed(batches):
        known = WordHashes()
        for batch in pieces(batches, "text", BATCH_BYTES):
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.argsort(ids, kind="stable")
            split = [text.split() for text in batch.column("text").take(pa.array(order)).to_pylist()]
            ids = ids[order]
            words = np.array([len(w) for w in split], np.int64)
            flat = known.flat(split, int(words.sum()))
            del split
            count = np.maximum(words - window + 1, 0)
            doc = np.repeat(np.arange(len(ids)), count)
            spot = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            h = window_hashes(flat, np.repeat(np.cumsum(words) - words, count) + spot, window) >> np.uint64(64 - bits)
            own = ids[doc]
            # documents ascend, so the first of equal hashes is in the smallest one
            by_hash = np.argsort(h, kind="stable")
            ordered = h[by_hash]
            first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(h) else np.zeros(0, np.int64)
            least = np.repeat(own[by_hash][first], np.diff(np.r_[first, len(h)]))
            gone = np.zeros(len(h), bool)
            gone[by_hash] = own[by_hash] > least
            rows = Rows()
            rows.add_removals(own[gone], spot[gone], groups)
            for row in range(len(rows.rows)):  # these only pass through; spread them over the ranges
                rows.rows[row] = (rows.rows[row][0] * ranges + rows.rows[row][0] % ranges, *rows.rows[row][1:])
            h, own, spot = h[~gone], own[~gone], spot[~gone]
            part = (h >> shift).astype(np.uint32)
            order = np.argsort(part.astype(np.uint16) if ranges <= 1 << 16 else part, kind="stable")
            h, own, spot, part = h[order] & low, own[order], spot[order], part[order]
            cuts = np.flatnonzero(np.diff(part)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(part)]):
                if b > a:
                    rows.add(int(part[a]), to_planes(h[a:b]), own[a:b], spot[a:b])
            yield rows.batch()

    def decided(table: pa.Table) -> pa.Table:
        found, hashes, ids, spots = Rows(), [], [], []
        for batch in table.to_batches():
            for row in batch.to_pylist():
                if row["hashes"] is None:
                    found.rows.append((row["key"] // ranges, None, row["n"], row["docs"], row["counts"], row["spots"]))
                    continue
                own, spot = spots_from_bytes(row["n"], row["docs"], row["counts"], row["spots"])
                hashes.append(from_planes(row["hashes"], len(own)))
                ids.append(own)
                spots.append(spot)
        if hashes:
            h, own, spot = np.concatenate(hashes), np.concatenate(ids), np.concatenate(spots)
            del hashes, ids, spots
            order = np.argsort(h, kind="stable")
            h, own, spot = h[order], own[order], spot[order]
            first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            gone = own > np.repeat(np.minimum.reduceat(own, first), np.diff(np.r_[first, len(h)]))
            found.add_removals(own[gone], spot[gone], groups)
        return pa.Table.from_batches([found.batch()])

    packed = docs.select("doc_id", as_bytes()).mapInArrow(hashed, Rows.SCHEMA)
    at = F.when(F.col("hashes").isNull(), F.pmod("key", F.lit(ranges))).otherwise(F.col("key"))
    return packed.groupBy(at.alias("at")).applyInArrow(decided, Rows.SCHEMA).select("key", "n", "docs", "counts", "spots")


def without_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, intervals (word numbers, end exclusive), kept_sha256 and kept_text.

    The kept words are joined by one space; `with_text=False` leaves the text out.
    """
    volume = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = 1 << max(2, math.ceil(math.log2(max(1, volume / RANGE_BYTES))))
    groups = 2 * math.ceil(max(4, volume / GROUP_BYTES) / 2) + 1
    bits = min(64, max(48, 8 * math.ceil((math.log2(max(2, volume / 6)) + 28) / 8)))
    plain = texts(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text")
    removals = repeated_windows(plain, window, ranges, groups, bits)
    schema = "doc_id long, n_words long, n_removed long, intervals array<struct<begin:int,end:int>>, kept_sha256 string"
    schema += ", kept_text string" if with_text else ""
    interval = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [spots_from_bytes(r["n"], r["docs"], r["counts"], r["spots"]) for r in right.to_pylist()]
        ids = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
        spots = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
        order = np.argsort(ids, kind="stable")
        ids, spots = ids[order], spots[order]
        rows = []
        own = left.column("doc_id").to_numpy()
        begin, end = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
        for doc_id, text, a, b in zip(own, left.column("text").to_pylist(), begin, end):
            words = text.split()
            n, spans, kept = len(words), [], words
            if b > a:
                edge = np.zeros(n + 1, np.int64)
                np.add.at(edge, spots[a:b], 1)
                np.add.at(edge, spots[a:b] + window, -1)
                covered = np.cumsum(edge[:-1]) > 0
                turns = np.flatnonzero(np.diff(np.r_[False, covered, False]))
                spans = list(zip(turns[::2].tolist(), turns[1::2].tolist()))
                kept = [w for w, gone in zip(words, covered.tolist()) if not gone]
            body = b" ".join(kept)
            row = (None if doc_id == NO_ID else int(doc_id), n, n - len(kept),
                   [{"begin": x, "end": y} for x, y in spans], hashlib.sha256(body).hexdigest())
            rows.append((*row, body.decode()) if with_text else row)
        kinds = (pa.int64(), pa.int64(), pa.int64(), interval, pa.string(), pa.string())
        names = ("doc_id", "n_words", "n_removed", "intervals", "kept_sha256", "kept_text")[: 6 if with_text else 5]
        columns = zip(*rows) if rows else [[]] * len(names)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(names))

    texts_by_group = plain.select(group_column(F.col("doc_id"), groups).alias("key"), "doc_id", as_bytes())
    return texts_by_group.groupBy("key").cogroup(removals.groupBy("key")).applyInArrow(cut, schema)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(documents(spark, sf_dir), with_text=False)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256", "intervals")
