"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Each shingle of five words is hashed once. The top bits of the hash name one of
`BINS` bins, a bin keeps its least hash, and an empty bin takes the value of the
first filled one in a random order of bins of its own (optimal densification).
Of every bin the `BITS` low-order bits are stored, two hexadecimal digits. Two
unequal values agree in these bits with probability c = 2^-BITS, so the share m
of agreeing bins estimates the similarity as (m - c) / (1 - c).

Defined cases: a null text is empty; a text without words has the empty
fingerprint, whose likeness is 1 to itself and 0 to any other; fewer than five
words make one shingle; identical repeated rows are one document and share its
result; a null doc_id comes first in the order; the next document of a single
one is itself; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.common import documents, stage, texts

SHINGLE = 5
BINS = 128
BITS = 8
SEED = 20240611


def bin_orders() -> list[list[int]]:
    """For each bin, the order in which it looks for a filled one."""
    chance = np.random.default_rng(SEED)
    return [chance.permutation(BINS).tolist() for _ in range(BINS)]


def bin_of(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - BINS.bit_length() + 1).cast("int")


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """`df` with the fingerprint of column `text` in column `name`.

    Arrays that a lambda refers to are columns of their own, so that they are
    made once for each row.
    """
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    df = df.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
    h, n = F.col("_h"), F.size("_h")
    many = F.transform(
        F.sequence(F.lit(0), n - SHINGLE), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(SHINGLE)])
    )
    shingles = F.when(n >= SHINGLE, many).when(n > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("_s", F.sort_array(shingles))
    s = F.col("_s")
    least = F.filter(s, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(s, i - 1))))
    df = df.withColumn("_m", least).withColumn("_b", F.transform("_m", bin_of))
    m, bins = F.col("_m"), F.col("_b")
    orders = F.from_json(F.lit(json.dumps(bin_orders())), "array<array<int>>")
    digits = F.split(F.lit(",".join(f"{v:02x}" for v in range(1 << BITS))), ",")

    def code(i: Column) -> Column:
        own = F.array_position(bins, i)
        other = F.array_position(bins, F.get(F.array_intersect(F.get(orders, i), bins), F.lit(0)))
        at = F.when(own > 0, own).otherwise(other).cast("int") - 1
        return F.get(digits, F.get(m, at).bitwiseAND((1 << BITS) - 1).cast("int"))

    codes = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), code)
    return df.withColumn(name, F.when(n > 0, F.array_join(codes, "")).otherwise("")).drop("_h", "_s", "_m", "_b")


def likeness(a: Column, b: Column) -> Column:
    """Estimated similarity of two fingerprints, 0 to 1."""
    width = BITS // 4
    agree = F.size(
        F.filter(
            F.sequence(F.lit(0), F.lit(BINS - 1)),
            lambda i: F.substring(a, i * width + 1, F.lit(width)) == F.substring(b, i * width + 1, F.lit(width)),
        )
    )
    chance = 2.0**-BITS
    estimate = (agree / F.lit(float(BINS)) - chance) / (1 - chance)
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(F.greatest(F.lit(0.0), estimate))


def neighbours(ids: DataFrame) -> DataFrame:
    """ids (doc_id, text_key, n) with next_id, next_key, next_n in ascending order, the first after the last.

    The order is cut into ranges; a window runs within each range, and the ends
    of the ranges, one row each, are tied together by a window of their own.
    """
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = ids.distinct().repartitionByRange(parts, F.col("doc_id"), F.col("text_key"))
    ranged = stage(ranged.withColumn("range", F.spark_partition_id()), "fingerprint-order")
    own = F.struct("doc_id", "text_key", "n")
    firsts = ranged.groupBy("range").agg(F.min(own).alias("first"))
    ends = firsts.select(
        F.col("range").alias("e_range"),
        F.coalesce(
            F.lead("first").over(W.orderBy("range")),
            F.first("first").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)),
        ).alias("after"),
    )
    step = F.lead(own).over(W.partitionBy("range").orderBy("doc_id", "text_key"))
    linked = ranged.withColumn("following", step).join(ends, F.col("range") == F.col("e_range"))
    following = F.coalesce("following", "after")
    return linked.select(
        "doc_id", "text_key", "n",
        following["doc_id"].alias("next_id"), following["text_key"].alias("next_key"), following["n"].alias("next_n"),
    )


def same(a_id: str, a_key: str, b_id: str, b_key: str) -> Column:
    return (F.col(a_key) == F.col(b_key)) & F.col(a_id).eqNullSafe(F.col(b_id))


def op4_doc_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprinted_edits(documents(spark, sf_dir))


def fingerprinted_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edit, whose second half is the head of the next document."""
    keyed = texts(docs).withColumn("text_key", F.xxhash64("text"))
    ids = keyed.select("doc_id", "text_key", F.length("text").alias("n"))
    order = stage(neighbours(ids), "fingerprint-next")
    # each document hands its head to the one before it; whole texts are shuffled once
    before = order.select(
        F.col("next_id").alias("b_id"), F.col("next_key").alias("b_key"), F.col("doc_id").alias("to_id"),
        F.col("text_key").alias("to_key"), F.floor(F.col("n") / 2).cast("int").alias("half"),
    )
    heads = keyed.join(before, same("doc_id", "text_key", "b_id", "b_key")).select(
        "to_id", "to_key", "half", F.col("doc_id").alias("next_id"), F.col("text_key").alias("next_key"),
        F.substring(F.col("text"), F.lit(1), F.col("half")).alias("head"),
    )
    both = keyed.join(heads, same("doc_id", "text_key", "to_id", "to_key"))
    both = both.withColumn("n_chars", F.length("text").cast("long")).withColumn(
        "edited", F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - F.col("half")).cast("int")), "head")
    )
    both = both.select("doc_id", "text_key", "next_id", "next_key", "n_chars", "text", "edited")
    made = with_fingerprint(with_fingerprint(both, "text", "fingerprint"), "edited", "edited_fingerprint").select(
        "doc_id", "text_key", "next_id", "next_key", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint",
    )
    made = stage(made, "fingerprints").dropDuplicates(["doc_id", "text_key"])
    following = made.select(
        F.col("doc_id").alias("f_id"), F.col("text_key").alias("f_key"), F.col("fingerprint").alias("next_fingerprint")
    )
    result = made.join(following, same("next_id", "next_key", "f_id", "f_key"))
    rows = ids.select(F.col("doc_id").alias("r_id"), F.col("text_key").alias("r_key"))
    return rows.join(result, same("r_id", "r_key", "doc_id", "text_key")).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
