"""Language of a text by a string kernel.

The blended-spectrum presence kernel of two texts is the number of character
n-grams (n = 1 .. `SPECTRUM`) present in both, divided by the geometric mean of
their numbers of n-grams. N-grams are hashed to `CELLS` cells. `LANDMARKS` texts
give the Nystroem map phi(x) = K(L,L)^(-1/2) k(L,x), on which one-versus-rest
kernel ridge regression is solved. Texts are scored in batches: presence matrix
times landmark matrix, then times the coefficients.

The classifier is fitted on a bounded sample: for each language at most
`BUCKETS` labelled rows, the one with the least hash of each hash bucket. It
learns from the texts and labels alone; everything else covers all rows.

Defined cases: a text that is null or has no letter is `und` with score 0; rows
with a null label teach nothing; without labelled rows every text is `und`; ties
go to the language that sorts first; repeated rows get equal results; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import documents, pieces

SPECTRUM = 3
CELLS = 1 << 15
LANDMARKS = 128  # over all languages
BUCKETS = 256  # labelled rows a language at most
RIDGE = 1e-2
BATCH_BYTES = 4 << 20
BLOCK = 128  # texts a presence matrix holds
UNKNOWN = "und"
LEAST_SCORE = 0.1  # what a filtering stage keeps; short clean texts score 0.15 and more
MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def cells_of(text: str) -> np.ndarray:
    """Cells of all n-grams of the lower-cased text, with repetition."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out, h = [], np.zeros(len(points), np.uint64)
    for n in range(SPECTRUM):
        if len(points) <= n:
            break
        h = (h[: len(points) - n] + points[n:] + np.uint64(n + 1)) * MULTIPLIERS[n % 3]
        h = h ^ (h >> np.uint64(29))
        out.append(((h * MULTIPLIERS[0]) >> np.uint64(40)) % np.uint64(CELLS))
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)


def presence(texts: list[str]) -> np.ndarray:
    """A row of 0 and 1 for each text, divided by its length as a vector."""
    x = np.zeros((len(texts), CELLS), np.float32)
    for row, text in zip(x, texts):
        row[cells_of(text)] = 1
    return x / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


class Model:
    """Landmark matrix (cells x landmarks) and coefficients (landmarks x languages)."""

    def __init__(self, landmarks: np.ndarray, coefficients: np.ndarray, languages: list[str]):
        self.landmarks, self.coefficients, self.languages = landmarks, coefficients, languages

    def scores(self, texts: list[str]) -> np.ndarray:
        return (presence(texts) @ self.landmarks) @ self.coefficients


def fit(texts: list[str], labels: list[str]) -> Model | None:
    """Nystroem features of the bounded sample and ridge regression on them, on the driver."""
    languages = sorted(set(labels))
    if not languages:
        return None
    # landmarks take turns over the languages
    turns = {name: [i for i, label in enumerate(labels) if label == name] for name in languages}
    chosen = [rows[k] for k in range(max(map(len, turns.values()))) for rows in turns.values() if k < len(rows)][:LANDMARKS]
    landmarks = presence([texts[i] for i in chosen]).T.copy()
    kernel = np.concatenate(
        [presence(texts[i : i + BLOCK]) @ landmarks for i in range(0, len(texts), BLOCK)]
    ).astype(np.float64)
    values, vectors = np.linalg.eigh(kernel[chosen])
    root = vectors @ np.diag(np.maximum(values, 1e-6) ** -0.5) @ vectors.T
    phi = kernel @ root
    target = np.array([[float(label == name) for name in languages] for label in labels])
    # every language weighs the same, however many rows it has
    weight = np.array([1 / len(turns[label]) for label in labels])[:, None] * len(labels) / len(languages)
    ridge = phi.T @ (weight * phi) + RIDGE * len(labels) / len(chosen) * np.eye(len(chosen))
    coefficients = root @ np.linalg.solve(ridge, phi.T @ (weight * target))
    return Model(landmarks, coefficients.astype(np.float32), languages)


def sample(labelled: DataFrame) -> tuple[list[str], list[str]]:
    """Texts and labels of the bounded sample of (doc_id, text, lang)."""
    h = F.xxhash64("doc_id", F.lit(17))
    chosen = (
        labelled.where("lang is not null and doc_id is not null")
        .groupBy("lang", F.pmod(h, F.lit(BUCKETS)).alias("bucket"))
        .agg(F.min(F.struct(F.xxhash64("doc_id", F.lit(18)).alias("order"), "doc_id")).alias("least"))
    )
    ids = sorted({r["doc_id"] for r in chosen.select("least.doc_id").collect()})  # at most BUCKETS for each language
    rows = labelled.where(F.col("doc_id").isin(ids)).where("text is not null and lang is not null")
    # a doc_id may stand on many rows, of which each (language, bucket) takes one, with a letter if there is such
    best = F.min(F.struct((~F.col("text").rlike(r"\p{L}")).alias("bare"), F.xxhash64("doc_id", F.lit(18)).alias("order"), "doc_id", "text"))
    rows = rows.groupBy("lang", F.pmod(h, F.lit(BUCKETS)).alias("bucket")).agg(best.alias("best"))
    rows = rows.select("best.doc_id", "best.text", "lang")
    rows = sorted((r["doc_id"], r["lang"], r["text"]) for r in rows.collect() if has_letter(r["text"]))
    return [r[2] for r in rows], [r[1] for r in rows]


def judge(model: Model | None, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    usable = [i for i, t in enumerate(texts) if model is not None and has_letter(t)]
    for at in range(0, len(usable), BLOCK):
        rows = usable[at : at + BLOCK]
        found = model.scores([texts[i] for i in rows])
        best = found.argmax(1)
        for i, k, value in zip(rows, best, found[np.arange(len(rows)), best]):
            names[i], scores[i] = model.languages[k], min(1.0, max(0.0, float(value)))
    return names, scores


def shared(spark: SparkSession, model: Model | None):
    return spark.sparkContext.broadcast(None if model is None else (model.landmarks, model.coefficients, model.languages))


def identified(docs: DataFrame, model: Model | None, *carried: str) -> DataFrame:
    """The carried columns of every row with lang_pred and score, in one pass over `text`."""
    fields = [docs.schema[c] for c in carried]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields) + "lang_pred string, score double"
    sent = shared(docs.sparkSession, model)

    def run(batches):
        own = None if sent.value is None else Model(*sent.value)
        for batch in pieces(batches, "text", BATCH_BYTES):
            names, scores = judge(own, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in carried] + [pa.array(names, pa.string()), pa.array(scores)],
                names=[*carried, "lang_pred", "score"],
            )

    return docs.select(*carried, "text").mapInArrow(run, schema)


def recognised(docs: DataFrame, model: Model | None, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of `docs`, all columns, whose language is known with a score of `least` or more."""
    sent = shared(docs.sparkSession, model)

    def run(batches):
        own = None if sent.value is None else Model(*sent.value)
        for batch in pieces(batches, "text", BATCH_BYTES):
            names, scores = judge(own, batch.column("text").to_pylist())
            known = [name != UNKNOWN and score >= least for name, score in zip(names, scores)]
            yield batch.filter(pa.array(known, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 == 0


def trained(docs: DataFrame, doc_id: str = "doc_id") -> Model | None:
    """Fitted on the rows that are not held out."""
    rows = docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id")))
    return fit(*sample(rows))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = identified(docs.select("doc_id", "text"), trained(docs), "doc_id")
    return found.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")
