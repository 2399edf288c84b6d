"""Best-two-fit packing of tokenised documents into sequences of fixed capacity.

The packing is planned on the histogram of piece lengths, which has at most
`capacity` entries however large the corpus is. A bin is filled greedily with
the longest pieces that fit; then its smallest piece is exchanged for the two
unpacked pieces that fit the widened gap most tightly, if they fill it better.
As long as no used length runs out, the next bin comes out the same, so a plan
is a short list of bin patterns with multiplicities. Every piece then finds its
place from its rank among the pieces of equal length.

Defined cases: a null or empty text is the end token alone; a document longer
than the capacity is cut into full pieces and one shorter last piece; equal and
repeated rows are packed separately; a null doc_id is kept; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_right
from collections import Counter
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.common import as_bytes, documents, pieces, stage, texts

CAPACITY = 4096
END_ID = 1
BATCH_BYTES = 4 << 20
ODD_WORDS = 1 << 15  # words beyond the plain alphabet whose ids a worker remembers, the latest used

SPACE = " \t\n\r\x0b\x0c"
# A plain text has ASCII without controls and apostrophes, and the letters of Latin-1.
ODD = re.compile(rf"[^{SPACE}\x21-\x26\x28-\x7eÀ-ÖØ-öø-ÿ]")
# In such a text the tokenizer cuts at white space and around each digit and each run of marks.
MARKS = re.compile(r"[!-&(-@\[-`{-~]+")
DIGITS = re.compile(r"([0-9]|[^0-9]+)")
SINGLE = {chr(c): f" {chr(c)} " for c in range(33, 127)}
WORD_END = "</w>"


def is_odd(text: str) -> bool:
    """Whether only the tokenizer itself can read the text: other letters, or perhaps special tokens, whose case counts."""
    return "<|" in text or ODD.search(text) is not None


def byte_symbols() -> dict[str, int]:
    """The characters by which byte-level vocabularies write the 256 bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def end_marked(path: str) -> tuple[dict[bytes, int], np.ndarray]:
    """The vocabulary as ranks of byte strings whose last space stands for the word's end, and the id of each rank.

    The end is a symbol of its own here, so joining it to the byte before comes
    first; then the merges follow in their order.
    """
    with open(path, encoding="utf-8") as lines:
        vocabulary = json.load(lines)["model"]["vocab"]
    symbols, tokens = byte_symbols(), []
    for token, i in vocabulary.items():
        stem = token.removesuffix(WORD_END)
        text = bytes(symbols[c] for c in stem)
        tokens.append((stem != token and len(text) == 1, i, text + b" " * (stem != token)))
    # single bytes have the lowest ids; the bytes that end a word go before all longer tokens
    singles = [(i, t) for ends, i, t in tokens if len(t) == 1]
    last = [(i, t) for ends, i, t in tokens if ends]
    merges = [(i, t) for ends, i, t in tokens if len(t) > 1 and not ends]
    ordered = sorted(singles) + sorted(last) + sorted(merges)
    return {t: rank for rank, (_, t) in enumerate(ordered)}, np.array([i for i, _ in ordered], "<u4")


class WordIds:
    """Little-endian ids of whole texts by a lower-case vocabulary with word ends.

    Plain texts are cut into words, each followed by a space, and go through the
    byte merges in one call. Other words go to the tokenizer itself; it drops
    white space before anything else looks at it, so words stand for themselves.
    """

    of_path: dict[str, WordIds] = {}

    @classmethod
    def of(cls, path: str) -> WordIds:
        if path not in cls.of_path:
            cls.of_path[path] = cls(path)
        return cls.of_path[path]

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        ranks, self.ids = end_marked(path)
        self.encoding = tiktoken.Encoding("words", pat_str=r"[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
        self.odd = lru_cache(ODD_WORDS)(lambda word: np.array(tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes())

    def plain(self, text: str) -> bytes:
        text = MARKS.sub(lambda m: SINGLE.get(m[0]) or DIGITS.sub(r" \1 ", m[0]), text.lower())
        for c in SPACE[1:]:
            text = text.replace(c, " ")
        return self.ids[self.encoding.encode_ordinary(text + " ")].tobytes()

    def whole(self, text: str) -> bytes:
        if not is_odd(text):
            return self.plain(text)
        out = []
        for odd, words in groupby(text.translate(SPACES).split(" "), is_odd):
            out += map(self.odd, words) if odd else [self.plain(" ".join(words))]
        return b"".join(out)

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        return [self.whole(text.decode()) for text in texts]


SPACES = str.maketrans(SPACE, " " * len(SPACE))


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False):
    """doc_id, piece, start, length, ids_crc32 and (part, nth): the piece is the nth of its length in task `part`.

    `with_ids` adds the ids themselves. Stage the result before use: `part` is
    a fact of the run that made it.
    """
    schema = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, nth long"
    schema += ", ids array<int>" if with_ids else ""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        encode, part, seen = WordIds.of(path), TaskContext.get().partitionId(), Counter()
        for batch in pieces(batches, "text", BATCH_BYTES):
            rows, ids = [], []
            for doc_id, encoded in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text").to_pylist())):
                encoded += end
                for piece, at in enumerate(range(0, len(encoded), 4 * capacity)):
                    own = encoded[at : at + 4 * capacity]
                    n = len(own) // 4
                    rows.append((doc_id, piece, at // 4, n, zlib.crc32(own), part, seen[n]))
                    seen[n] += 1
                    if with_ids:
                        ids.append(np.frombuffer(own, "<i4"))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return texts(docs).select("doc_id", as_bytes()).mapInArrow(cut, schema)


def tighter_pair(left: dict[int, int], room: int, smallest: int) -> tuple[int, int] | None:
    """The two unpacked lengths whose sum is largest, at most `room` and over `smallest`."""
    sizes = np.array(sorted(s for s, n in left.items() if n and s < room), np.int64)
    if not len(sizes):
        return None
    other = np.searchsorted(sizes, np.minimum(sizes, room - sizes), "right") - 1
    own = np.arange(len(sizes))
    single = np.array([left[int(s)] < 2 for s in sizes])
    other = np.where((other == own) & single, other - 1, other)
    total = np.where(other >= 0, sizes + sizes[np.maximum(other, 0)], 0)
    best = int(total.argmax())
    return (int(sizes[best]), int(sizes[other[best]])) if total[best] > smallest else None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Places (length, first rank, copies in a bin, first sequence, offset), by length and rank.

    `counts` maps each length to the number of its pieces. Ranks count from 0
    within a length; a place serves the ranks up to the next one of its length.
    """
    left, used_up = {s: n for s, n in counts.items() if n}, Counter()
    sizes, places, sequence = sorted(left), [], 0
    while sizes:
        gap, chosen = capacity, Counter()
        top = len(sizes)
        while top := bisect_right(sizes, gap, 0, top):
            size = sizes[top - 1]
            n = min(left[size], gap // size)
            chosen[size] += n
            gap -= n * size
            top -= 1
        smallest = min(chosen)
        if gap and chosen.total() > 1:
            rest = {s: n - chosen[s] for s, n in left.items() if s < gap + smallest}
            rest[smallest] = 0  # giving it back and taking it again gains nothing over another length
            if pair := tighter_pair(rest, gap + smallest, smallest):
                chosen[smallest] -= 1
                chosen.update(pair)
        chosen = +chosen
        bins = min(left[s] // n for s, n in chosen.items())
        offset = 0
        for size in sorted(chosen, reverse=True):
            n = chosen[size]
            places.append((size, used_up[size], n, sequence, offset))
            offset += n * size
            used_up[size] += n * bins
            left[size] -= n * bins
        sequence += bins
        if any(left[s] == 0 for s in chosen):
            left = {s: n for s, n in left.items() if n}
            sizes = sorted(left)
    return sorted(places)


def pack(staged: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`staged` token pieces with sequence_id and offset."""
    counts = {r["length"]: r["count"] for r in staged.groupBy("length").count().collect()}  # at most `capacity` rows
    places = np.array(plan(counts, capacity), np.int64).reshape(-1, 5)
    mine = W.partitionBy("length").orderBy("part")
    before = (
        staged.groupBy("length", "part")
        .count()
        .select(
            F.col("length").alias("b_length"), F.col("part").alias("b_part"),
            (F.sum("count").over(mine) - F.col("count")).alias("before"),
        )
    )
    ranked = staged.join(before, (F.col("length") == F.col("b_length")) & (F.col("part") == F.col("b_part"))).select(
        *[c for c in staged.columns if c not in ("part", "nth")], (F.col("before") + F.col("nth")).alias("rank")
    )
    kept = [f for f in ranked.schema.fields if f.name != "rank"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", sequence_id long, offset long"

    def place(batches):
        keys = places[:, 0] << 44 | places[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy().astype(np.int64)
            rank = batch.column("rank").to_numpy()
            at = places[np.searchsorted(keys, length << 44 | rank, "right") - 1]
            nth = rank - at[:, 1]
            found = [at[:, 3] + nth // at[:, 2], at[:, 4] + nth % at[:, 2] * length] if len(rank) else [rank, rank]
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + [pa.array(x, pa.int64()) for x in found],
                names=[f.name for f in kept] + ["sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, doc_ids, ids: the packed sequences themselves, from pieces made `with_ids`."""
    return (
        packed.groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("list"))
        .select("sequence_id", F.col("list.doc_id").alias("doc_ids"), F.flatten("list.ids").alias("ids"))
    )


def best_fit(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False):
    return pack(stage(token_pieces(docs, path, capacity, end_id, with_ids), "token-pieces"), capacity)


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = best_fit(documents(spark, sf_dir), vocabulary())
    return placed.select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset"
    )
