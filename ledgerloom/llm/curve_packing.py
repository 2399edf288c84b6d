"""Packing in the order of a space-filling curve, so that neighbours in a sequence are alike.

The distinct pairs of neighbouring token ids of a document, hashed with signs to
`CELLS` cells, are its vector; a fixed Gaussian matrix projects the vector's
direction to `DIMENSIONS` coordinates. The coordinates' cell on a grid of 2^BITS steps a side has a key on
the Hilbert curve. Documents are sorted by ranges of that key and laid end to
end; every `capacity` tokens a sequence ends. What is left at the end of the
curve is cut into sequences of descending powers of two, so that no sequence is
padded at all.

Token ids are made once and written. Only keys and lengths are sorted; the ids
move once, to the start that their document got.

Defined cases: a null or empty text is the end token alone; documents of any
length are cut wherever a sequence ends; equal keys ascend by doc_id (null
first), equal and repeated rows are packed separately; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import as_bytes, documents, pieces, stage, texts

CAPACITY = 1024
END_ID = 0
ID_TYPE = "<u2"  # as the ids are stored; holds every id of a vocabulary of up to 65,536 pieces
CELLS = 1024
DIMENSIONS = 4
BITS = 15
SEED = 11
BATCH_BYTES = 4 << 20
# Beyond these lead bytes (U+0240 and up) and in texts that may hold special tokens, the tokenizer itself decides.
PLAIN = re.compile(rb"[\xc9-\xff]|<\|")


class ByteIds:
    """Ids of whole texts by a byte-level vocabulary given twice: as a tokenizer file and as its ranks."""

    of_path: dict[tuple[str, str], ByteIds] = {}

    @classmethod
    def of(cls, path: str, ranks: str) -> ByteIds:
        if (path, ranks) not in cls.of_path:
            cls.of_path[path, ranks] = cls(path, ranks)
        return cls.of_path[path, ranks]

    def __init__(self, path: str, ranks: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(ranks, "rb") as lines:
            known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})

    def __call__(self, text: bytes) -> list[int]:
        if PLAIN.search(text):
            return self.tokenizer.encode(text.decode(), add_special_tokens=False).ids
        return self.encoding.encode_ordinary(text.decode())


class Projection:
    """Coordinates of documents, about standard normal, from their token ids."""

    def __init__(self, cells: int = CELLS, dimensions: int = DIMENSIONS, seed: int = SEED):
        self.cells = cells
        self.matrix = np.random.default_rng(seed).standard_normal((cells, dimensions))

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        ids = ids.astype(np.uint64)
        pairs = np.unique(ids[:-1] << np.uint64(32) | ids[1:]) if len(ids) > 1 else ids
        mixed = pairs * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xC2B2AE3D27D4EB4F)
        cell = (mixed >> np.uint64(40)) % np.uint64(self.cells)
        sign = 1.0 - 2.0 * (mixed >> np.uint64(39) & np.uint64(1))
        vector = np.bincount(cell.astype(np.int64), sign, self.cells)
        return vector @ self.matrix / max(np.sqrt(vector @ vector), 1e-12)


def grid(coordinates: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Steps 0 .. 2^bits - 1 of coordinates between -4 and 4."""
    top = (1 << bits) - 1
    return np.clip((coordinates + 4) / 8 * top, 0, top).astype(np.int64)


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of rows of grid steps; bits times columns is 63 at most.

    From the coarsest level down, the orientation of each sub-cube is undone by
    swaps and reflections of the finer bits; what is left is a Gray code.
    """
    axes = [column.copy() for column in points.T]
    for level in range(bits - 1, 0, -1):
        below = (1 << level) - 1
        for i, axis in enumerate(axes):
            upper = (axis >> level & 1).astype(bool)
            exchanged = np.where(upper, 0, (axes[0] ^ axis) & below)
            axes[0] = np.where(upper, axes[0] ^ below, axes[0] ^ exchanged)
            if i:
                axes[i] = axis ^ exchanged
    for i in range(1, len(axes)):
        axes[i] ^= axes[i - 1]
    turned = np.zeros_like(axes[-1])
    for level in range(bits - 1, 0, -1):
        turned ^= np.where(axes[-1] >> level & 1, (1 << level) - 1, 0)
    key = np.zeros_like(axes[0])
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            key = key << 1 | ((axis ^ turned) >> level & 1)
    return key


def tokenised(docs: DataFrame, path: str, ranks: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, key, doc_tokens, ids and (part, row), which name a row. Stage the result before use."""

    def run(batches):
        encode, project, part, row = ByteIds.of(path, ranks), Projection(), TaskContext.get().partitionId(), 0
        for batch in pieces(batches, "text", BATCH_BYTES):
            ids = [np.array(encode(text) + [end_id], ID_TYPE) for text in batch.column("text").to_pylist()]
            keys = hilbert_keys(grid(np.array([project(x) for x in ids])))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(keys), pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([part] * len(ids), pa.int32()),
                    pa.array(range(row, row + len(ids)), pa.int64()),
                ],
                names=["doc_id", "key", "doc_tokens", "ids", "part", "row"],
            )
            row += len(ids)

    schema = "doc_id long, key long, doc_tokens long, ids binary, part int, row long"
    return texts(docs).select("doc_id", as_bytes()).mapInArrow(run, schema)


def along_curve(staged: DataFrame) -> DataFrame:
    """part, row, slice and before: the tokens that lie ahead of a row within its slice of the curve. Stage it before use."""
    order = ["key", "doc_id", "part", "row"]
    sorted_rows = staged.select(*order, "doc_tokens").repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches):
        own, ahead = TaskContext.get().partitionId(), 0
        for batch in batches:
            length = batch.column("doc_tokens").to_numpy()
            ends = np.cumsum(length) + ahead
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("row"), pa.array(np.full(len(length), own, np.int32)), pa.array(ends - length), pa.array(length)],
                names=["part", "row", "slice", "before", "own"],
            )
            ahead = int(ends[-1]) if len(ends) else ahead

    return sorted_rows.mapInArrow(run, "part int, row long, slice int, before long, own long")


def tail(total: int, capacity: int = CAPACITY) -> np.ndarray:
    """Starts of the sequences after the last full one, and the end: one for each power of two in the rest."""
    rest, ends = total % capacity, [total - total % capacity]
    for power in reversed(range(rest.bit_length())):
        if rest >> power & 1:
            ends.append(ends[-1] + (1 << power))
    return np.array(ends, np.int64)


def cut(start: int, length: int, ends: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, int, int, int]]:
    """(start in the document, length, sequence, offset) of the pieces of a document that starts at `start` on the curve."""
    full = int(ends[0]) // capacity
    at, stop, out = start, start + length, []
    while at < stop:
        if at < ends[0]:
            sequence = at // capacity
            first, last = sequence * capacity, (sequence + 1) * capacity
        else:
            i = int(np.searchsorted(ends, at, "right"))
            sequence, first, last = full + i - 1, int(ends[i - 1]), int(ends[i])
        last = min(last, stop)
        out.append((at - start, last - at, sequence, at - first))
        at = last
    return out


def curve_packed(
    docs: DataFrame, path: str, ranks: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece; `with_ids` adds its ids."""
    staged = stage(tokenised(docs, path, ranks, end_id), "curve-ids")
    starts = stage(along_curve(staged), "curve-starts")
    # one row for each range partition of the sort
    sizes = dict(sorted((r["slice"], r["size"]) for r in starts.groupBy("slice").agg(F.sum("own").alias("size")).collect()))
    base = np.zeros(max(sizes, default=0) + 1, np.int64)
    base[list(sizes)] = np.cumsum([0, *sizes.values()])[:-1]
    ends = tail(sum(sizes.values()), capacity)
    starts = starts.select(F.col("part").alias("s_part"), F.col("row").alias("s_row"), "slice", "before")
    placed = staged.join(starts, (F.col("part") == F.col("s_part")) & (F.col("row") == F.col("s_row")))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches):
        for batch in pieces(batches, "ids", BATCH_BYTES):
            first = base[batch.column("slice").to_numpy()] + batch.column("before").to_numpy()
            rows, ids = [], []
            for doc_id, at, own in zip(batch.column("doc_id").to_pylist(), first.tolist(), batch.column("ids").to_pylist()):
                own = np.frombuffer(own, ID_TYPE).astype("<u4")
                for start, length, sequence, offset in cut(at, len(own), ends, capacity):
                    piece = own[start : start + length]
                    rows.append((doc_id, start, length, zlib.crc32(piece.tobytes()), len(own), sequence, offset))
                    if with_ids:
                        ids.append(piece.astype(np.int32))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "ids"][: len(columns)])

    schema = ", ".join(f"{name} long" for name in names) + (", ids array<int>" if with_ids else "")
    return placed.select("doc_id", "ids", "slice", "before").mapInArrow(run, schema)


def vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op11_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_packed(documents(spark, sf_dir), *vocabulary())
