"""Exact duplicates by composable polynomial fingerprints.

A chunk of bytes c_0 .. c_(n-1) has, for each modulus p, the hash
sum((c_i + 1) * B^(n-1-i)) mod p and the shift B^n mod p. Chunks combine as
(h, s) . (h', s') = (h * s' + h', s * s'), so the chunks of a huge document are
hashed by different tasks and put together afterwards. Documents with equal
fingerprints are then compared chunk by chunk with one document of their group.

Defined cases: a null text counts as empty, empty texts equal one another; A-Z
equal a-z and nothing else is folded; a null doc_id is below every other; rows
that share doc_id and text are one document and share its result; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import UPPER, documents, stage, texts

PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1664525003)
CHUNK_CHARS = 1 << 20  # code points of a chunk row
BLOCK = 1 << 15  # bytes whose products fit a 64-bit sum


def powers(base: int, prime: int, n: int) -> np.ndarray:
    """base^(n-1) .. base^0 mod prime."""
    out = np.ones(n, np.uint64)
    for i in range(1, n):
        out[i] = out[i - 1] * base % prime
    return out[::-1].copy()


class Hasher:
    def __init__(self, primes=PRIMES, bases=BASES):
        self.moduli = [(p, b % p, powers(b % p, p, BLOCK)) for p, b in zip(primes, bases)]

    def __call__(self, data: bytes) -> list[int]:
        """hash and shift for each modulus, in turn."""
        out = []
        values = np.frombuffer(data, np.uint8)
        for prime, base, table in self.moduli:
            h, s = 0, 1
            for start in range(0, len(values), BLOCK):
                block = values[start : start + BLOCK].astype(np.uint64) + 1
                shift = pow(base, len(block), prime)
                h = (h * shift + int(block @ table[BLOCK - len(block) :])) % prime
                s = s * shift % prime
            out += [h, s]
        return out


def chunk_rows(docs: DataFrame, chunk_chars: int, *carried: Column | str) -> DataFrame:
    """One row for each chunk of a text: `at` counts from 0, `chunks` is their number."""
    n = F.greatest(F.lit(1), F.ceil(F.length("text") / chunk_chars)).cast("int")
    cut = F.when(n == 1, F.array("text")).otherwise(
        F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.substring(F.col("text"), i * chunk_chars + 1, F.lit(chunk_chars)),
        )
    )
    return docs.select("doc_id", "text_key", *carried, n.alias("chunks"), F.posexplode(cut).alias("at", "chunk"))


def folded(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def fingerprints(docs: DataFrame, primes=PRIMES, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """doc_id, text_key, text_sha256 and the fingerprint columns n_bytes, fp of every row of `docs`.

    `docs` has doc_id, text and text_key. The sum over a document's chunks is
    keyed by a row number that lives within this one job.
    """
    bases = BASES[: len(primes)]
    long_digest = F.when(F.length("text") > chunk_chars, F.sha2(folded(F.col("text")), 256)).alias("digest")
    rows = chunk_rows(
        docs.withColumn("row", F.monotonically_increasing_id()), chunk_chars, "row", long_digest
    ).withColumn("chunk", F.col("chunk").cast("binary"))
    parts = [f"{kind}{i}" for i in range(len(primes)) for kind in "hs"]
    schema = "row long, doc_id long, text_key long, at int, n_bytes long, digest string, " + ", ".join(f"{c} long" for c in parts)

    def hashed(batches):
        hasher = Hasher(primes, bases)
        for batch in batches:
            found, digests, sizes = [], [], []
            for text, chunks, digest in zip(
                batch.column("chunk").to_pylist(), batch.column("chunks").to_pylist(), batch.column("digest").to_pylist()
            ):
                text = text.lower()  # bytes: A-Z only
                found.append(hasher(text))
                sizes.append(len(text))
                digests.append(hashlib.sha256(text).hexdigest() if chunks == 1 else digest)
            columns = [batch.column(c) for c in ("row", "doc_id", "text_key", "at")]
            columns += [pa.array(sizes, pa.int64()), pa.array(digests, pa.string())]
            columns += [pa.array([f[i] for f in found], pa.int64()) for i in range(len(parts))]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "text_key", "at", "n_bytes", "digest", *parts])

    def combined(acc, x):
        return F.struct(
            *[((acc[f"h{i}"] * x[f"s{i}"] + x[f"h{i}"]) % p).alias(f"h{i}") for i, p in enumerate(primes)]
        )

    zero = F.struct(*[F.lit(0).cast("long").alias(f"h{i}") for i in range(len(primes))])
    return (
        rows.mapInArrow(hashed, schema)
        .groupBy("row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("text_key").alias("text_key"),
            F.max("digest").alias("text_sha256"),
            F.sum("n_bytes").alias("n_bytes"),
            F.array_sort(F.collect_list(F.struct("at", *parts))).alias("list"),
        )
        .select("doc_id", "text_key", "text_sha256", "n_bytes", F.aggregate("list", zero, combined).alias("fp"))
    )


def differing(docs: DataFrame, pairs: DataFrame, chunk_chars: int) -> DataFrame:
    """doc_id, text_key of the pairs whose texts are not equal, compared chunk by chunk.

    `pairs` has doc_id, text_key and lead_id, lead_key. The leader's chunks are
    joined by key and chunk number; a group with many members is an ordinary
    skewed join that adaptive execution splits.
    """
    member = docs.join(pairs, docs["doc_id"].eqNullSafe(pairs["doc_id"]) & (docs["text_key"] == pairs["text_key"])).select(
        docs["doc_id"], docs["text_key"], "text", "lead_id", "lead_key"
    )
    leads = pairs.select("lead_id", "lead_key").distinct()
    lead = docs.join(leads, docs["doc_id"].eqNullSafe(leads["lead_id"]) & (docs["text_key"] == leads["lead_key"])).select(
        "doc_id", "text_key", "text"
    )
    a = chunk_rows(member, chunk_chars, "lead_id", "lead_key")
    b = chunk_rows(lead, chunk_chars).dropDuplicates(["doc_id", "text_key", "at"]).select(
        F.col("doc_id").alias("b_id"), F.col("text_key").alias("b_key"), F.col("at").alias("b_at"),
        F.col("chunks").alias("b_chunks"), F.col("chunk").alias("b_chunk"),
    )
    same = F.when(a["chunk"] == b["b_chunk"], True).otherwise(folded(a["chunk"]) == folded(b["b_chunk"]))
    return (
        a.join(b, a["lead_id"].eqNullSafe(b["b_id"]) & (a["lead_key"] == b["b_key"]) & (a["at"] == b["b_at"]), "left")
        .groupBy("doc_id", "text_key")
        .agg(F.min(F.coalesce(same & (a["chunks"] == b["b_chunks"]), F.lit(False))).alias("equal"))
        .where(~F.col("equal"))
        .select("doc_id", "text_key")
    )


def exact_groups(docs: DataFrame, primes=PRIMES, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row.

    Texts whose fingerprints collide without being equal are grouped again
    among themselves, until every group holds equal texts only.
    """
    plain = texts(docs).withColumn("text_key", F.xxhash64("text"))
    prints = stage(fingerprints(plain, primes, chunk_chars), "exact-prints")
    key = ["n_bytes", "fp"]
    # the largest id leads; of rows that share it, the larger text key
    order = F.struct(F.col("doc_id"), F.col("text_key"))
    rest, settled = prints, None
    while True:
        groups = rest.groupBy(*key).agg(F.max(order).alias("lead"), F.count("*").alias("members"))
        lead = groups.where("members > 1").select(
            F.col("n_bytes").alias("g_bytes"), F.col("fp").alias("g_fp"),
            F.col("lead.doc_id").alias("lead_id"), F.col("lead.text_key").alias("lead_key"),
        )
        linked = rest.join(lead, (rest["n_bytes"] == lead["g_bytes"]) & (rest["fp"] == lead["g_fp"]), "left").select(
            *rest.columns, "lead_id", "lead_key"
        )
        linked = stage(linked, "exact-groups")
        pairs = linked.where("lead_key is not null and not (doc_id <=> lead_id and text_key = lead_key)").select(
            "doc_id", "text_key", "lead_id", "lead_key"
        ).distinct()
        unequal = stage(differing(plain, pairs, chunk_chars), "exact-unequal")
        again = unequal.select(F.col("doc_id").alias("u_id"), F.col("text_key").alias("u_key"))
        match = linked["doc_id"].eqNullSafe(again["u_id"]) & (linked["text_key"] == again["u_key"])
        done = linked.join(again, match, "left_anti")
        settled = done if settled is None else settled.unionByName(done)
        if unequal.isEmpty():
            break
        rest = linked.join(again, match, "left_semi").select(*rest.columns)
    alone = F.col("lead_key").isNull()
    settled = settled.select(
        "doc_id", "text_sha256", *key,
        F.when(alone, F.col("doc_id")).otherwise(F.col("lead_id")).alias("keep_id"),
        F.when(alone, F.col("text_key")).otherwise(F.col("lead_key")).alias("keep_key"),
    )
    sizes = settled.groupBy("keep_id", "keep_key").agg(F.count("*").alias("group_size")).select(
        F.col("keep_id").alias("s_id"), F.col("keep_key").alias("s_key"), "group_size"
    )
    return settled.join(
        sizes, settled["keep_id"].eqNullSafe(sizes["s_id"]) & (settled["keep_key"] == sizes["s_key"])
    ).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir))


SQL = f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS body FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(body) AS text_sha256
FROM t WINDOW w AS (PARTITION BY body)
"""
