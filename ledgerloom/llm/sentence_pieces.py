"""SentencePiece encoding and decoding.

An Aho-Corasick automaton over the pieces reads a text once. At each position it
reports, along its output links, every piece that ends there; each of them
relaxes the best score of that position, and the best path is read backwards
(Viterbi). The model file's scores are read as a unigram model, whatever kind of
model it was trained as, and are summed in double precision. Where no piece
covers a character, it costs the least score minus 10 and becomes its UTF-8
bytes if the vocabulary has byte pieces, else the unknown id.

A text is cut where no piece can reach across, before a space mark and around
characters that stand in no longer piece, and further between two characters
that stand side by side in no piece. The ids of such units are remembered.

Defined cases: a null text is empty; an empty text has no ids; of equal scores
the path whose last piece is longer wins; a literal space mark in a text decodes
as a space (`round_trip` is false then); repeated rows get equal results; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from array import array
from itertools import pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm.common import documents, pieces, texts

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # fixed values of the file format
PENALTY = 10.0
CACHE_UNITS = 600_000
BATCH_BYTES = 4 << 20


class Vocabulary:
    """Pieces, scores and kinds of a model file, and the flags of its normaliser."""

    def __init__(self, content: bytes):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(content)
        rules = model.normalizer_spec
        if rules.precompiled_charsmap or model.trainer_spec.treat_whitespace_as_suffix or not rules.escape_whitespaces:
            raise ValueError("only models that leave characters as they are and mark spaces in front can be read")
        self.entries = [(p.piece, p.score, p.type) for p in model.pieces]
        self.prefix, self.squeeze = rules.add_dummy_prefix, rules.remove_extra_whitespaces


class Coder:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.known = vocabulary, {}
        entries = vocabulary.entries
        self.automaton = ahocorasick.Automaton()
        usable = [(p, s, i) for i, (p, s, kind) in enumerate(entries) if kind in (NORMAL, USER)]
        for piece, score, i in usable:
            self.automaton.add_word(piece, (len(piece), score, i))
        self.automaton.make_automaton()
        self.penalty = min((s for _, s, _ in usable), default=0.0) - PENALTY
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(entries) if kind == BYTE}
        self.unknown = next((i for i, (_, _, kind) in enumerate(entries) if kind == UNKNOWN), 0)
        surface = {UNKNOWN: " ⁇ ".encode(), CONTROL: b"", UNUSED: b""}
        self.surfaces = [
            bytes([int(p[3:5], 16)]) if kind == BYTE else surface.get(kind, p.replace(MARK, " ").encode())
            for p, _, kind in entries
        ]
        self.neighbours = {pair for p, _, _ in usable for pair in pairwise(p)}
        longer = {c for p, _, _ in usable if len(p) > 1 for c in p}
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in longer)
        cut = f"[{alone}]|" if alone else ""
        crossing = any(MARK in p.lstrip(MARK) for p, _, _ in usable)
        self.units = re.compile(".+" if crossing else f"{cut}{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+", re.DOTALL)

    def normalised(self, text: str) -> str:
        if self.vocabulary.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        return (MARK if self.vocabulary.prefix else "") + text.replace(" ", MARK)

    def viterbi(self, unit: str) -> list[int]:
        """Ids of the best path over the whole unit."""
        n, penalty = len(unit), self.penalty
        best, width, chosen = [-math.inf] * (n + 1), [1] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        done = 0  # positions up to here have their final score
        for last, (length, score, i) in self.automaton.iter(unit):
            while done < last:  # step over characters for which there is no piece
                done += 1
                if best[done - 1] + penalty > best[done]:
                    best[done], width[done], chosen[done] = best[done - 1] + penalty, 1, -1
            value = best[last + 1 - length] + score
            if value > best[last + 1]:
                best[last + 1], width[last + 1], chosen[last + 1] = value, length, i
        while done < n:
            done += 1
            if best[done - 1] + penalty > best[done]:
                best[done], width[done], chosen[done] = best[done - 1] + penalty, 1, -1
        out, at = [], n
        while at:
            if chosen[at] < 0:
                data = unit[at - 1].encode()
                out += [self.bytes[b] for b in reversed(data)] if len(self.bytes) == 256 else [self.unknown]
            else:
                out.append(chosen[at])
            at -= width[at]
        out.reverse()
        return out

    def unit_ids(self, unit: str) -> bytes:
        """Ids of a unit, put together from its parts between neighbours that stand in no piece together."""
        cuts = [i for i, pair in enumerate(pairwise(unit), 1) if pair not in self.neighbours]
        found = []
        for a, b in zip([0, *cuts], [*cuts, len(unit)]):
            part = unit[a:b]
            ids = self.known.get(part)
            if ids is None:
                ids = self.known[part] = array("i", self.viterbi(part)).tobytes()
            found.append(ids)
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        units = self.units.findall(self.normalised(text))
        try:
            return b"".join(map(self.known.__getitem__, units))
        except KeyError:
            if len(self.known) > CACHE_UNITS:
                self.known = {}
            for unit in [u for u in set(units) if u not in self.known]:
                self.known[unit] = self.unit_ids(unit)
            return b"".join(map(self.known.__getitem__, units))

    def decode(self, ids: list[int]) -> str:
        data = b"".join(map(self.surfaces.__getitem__, ids))
        if self.vocabulary.prefix and data[:1] == b" ":
            data = data[1:]
        return data.decode("utf-8", "replace")


CODERS: dict[int, Coder] = {}


def coder(content: bytes) -> Coder:
    """One coder a worker process for each model."""
    key = zlib.crc32(content)
    if key not in CODERS:
        CODERS[key] = Coder(Vocabulary(content))
    return CODERS[key]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, n_tokens, ids_crc32 and the decoded text's digest and round_trip of every row."""
    with open(path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    schema = "doc_id long, ids array<int>, n_tokens long, ids_crc32 long, decoded_sha256 string, round_trip boolean"

    def run(batches):
        own = coder(model.value)
        for batch in pieces(batches, "text", BATCH_BYTES):
            found, digests, same = [], [], []
            for text in batch.column("text").to_pylist():
                ids = own.encode(text)
                back = own.decode(np.frombuffer(ids, "<i4").tolist())
                found.append(ids)
                digests.append(hashlib.sha256(back.encode()).hexdigest())
                same.append(back == text)
            sizes = np.array([len(x) // 4 for x in found], np.int64)
            offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
            values = pa.array(np.frombuffer(b"".join(found), "<i4"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(offsets, values), pa.array(sizes),
                 pa.array([zlib.crc32(x) for x in found], pa.int64()), pa.array(digests), pa.array(same)],
                names=["doc_id", "ids", "n_tokens", "ids_crc32", "decoded_sha256", "round_trip"],
            )

    return texts(docs).mapInArrow(run, schema)


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows (doc_id, ids); null ids decode as an empty text."""
    with open(path, "rb") as file:
        model = rows.sparkSession.sparkContext.broadcast(file.read())

    def run(batches):
        own = coder(model.value)
        for batch in batches:
            texts = [own.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(documents(spark, sf_dir), vocabulary_path())
