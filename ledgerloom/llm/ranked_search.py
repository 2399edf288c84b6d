"""Ranked lexical search for a stated set of items, term at a time with limited accumulators.

The terms of an item are taken rarest first, in batches that double. A batch
adds the contributions of its postings to accumulators, one for each item and
document met so far. Then the leading accumulators of an item are brought up to
date at once, so that the kth score is as high as it can be. An accumulator
whose score and the bounds of the terms to come stay below it is dropped; once
these bounds alone stay below it, the item creates no more accumulators. The
survivors are then updated with all remaining terms, exactly, from the rows of
their documents. A term's bound is the largest contribution of any of its postings.

Only terms of items are indexed: a document's row holds its length and those of
its terms whose hash is set in a bit table of fixed size made from the items; an
exact join decides later. Postings of frequent terms are thus met by open items
only, and later by survivors only.

Defined cases: a null or empty text has no terms; an item without terms, or
whose terms no document holds, has no rows; equal scores ascend by doc_id (null
first), then by a fixed order of the rows; a repeated row is a document of its
own, a repeated item an item of its own; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import chain

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.common import as_bytes, documents, pieces, stage

K = 10
FIRST_BATCH = 2
TABLE_BITS = 1 << 23
BATCH_BYTES = 4 << 20
TERM_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz"
FOLD = bytes(c if c >= 128 else ord(chr(c).lower()) if chr(c).lower().encode() in {bytes([b]) for b in TERM_BYTES} else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """All terms in turn: digits, A-Z lower-cased, a-z and every character beyond ASCII."""
    return text.translate(FOLD).split()


def indexed(rows: DataFrame, wanted: bytes | None = None) -> DataFrame:
    """row (a number of its own), id, n (terms with repeats), terms and tfs of every row (id, text).

    `wanted` is a bit table of term hashes that leaves other terms out of the
    lists. Stage the result before use: `row` is a fact of the run that made it.
    """

    def run(batches):
        at = TaskContext.get().partitionId() << 40
        for batch in pieces(batches, "text", BATCH_BYTES):
            counts, lists = [], []
            for text in batch.column("text").to_pylist():
                words = terms_of(text or b"")
                counts.append(len(words))
                own = Counter(words)
                if wanted is not None:
                    bits = ((w, zlib.crc32(w) % TABLE_BITS) for w in own)
                    own = {w: own[w] for w, bit in bits if wanted[bit >> 3] >> (bit & 7) & 1}
                lists.append(own)
            ends = [0]
            for own in lists:
                ends.append(ends[-1] + len(own))
            terms = pa.array(list(chain.from_iterable(lists)), pa.binary()).cast(pa.string())
            tfs = pa.array(list(chain.from_iterable(own.values() for own in lists)), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(at, at + len(counts)), pa.int64()), batch.column("id"), pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), terms), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tfs),
                ],
                names=["row", "id", "n", "terms", "tfs"],
            )
            at += len(counts)

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", as_bytes()).mapInArrow(run, f"row long, id {kind}, n long, terms array<string>, tfs array<long>")


def bit_table(terms: DataFrame) -> bytes:
    """The hashes of `terms` as a table of TABLE_BITS bits, however many terms there are."""
    bit = F.crc32("term") % TABLE_BITS + 1
    maps = terms.groupBy(F.bitmap_bucket_number(bit).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    table, width = bytearray(TABLE_BITS // 8), 4096
    for r in maps.collect():
        at = (r["part"] - 1) * width
        table[at : at + width] = r["bits"]
    return bytes(table)


def postings(docs: DataFrame) -> DataFrame:
    """doc, term and gain (the contribution without the term's weight) of every listed term."""
    found = docs.select("doc", "m", F.explode(F.arrays_zip("terms", "tfs")).alias("p"))
    gain = F.expr("(1000000000 * p.tfs) div (1000 * p.tfs + 8 * m)")
    return found.select("doc", F.col("p.terms").alias("term"), gain.alias("gain"))


def best(rows: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first k rows of each item; Spark cuts each task's rows to k before they are moved."""
    return rows.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)


class Search:
    """The staged index and the terms of the items in processing order."""

    def __init__(self, docs: DataFrame, items: DataFrame, k: int):
        self.k = k
        self.items = stage(indexed(items), "search-items").withColumnRenamed("row", "item")
        wanted = stage(self.items.select("item", F.explode("terms").alias("term")), "search-item-terms")
        index = stage(indexed(docs, bit_table(wanted)), "search-index").withColumnRenamed("row", "doc")
        n_docs, length = index.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        self.index = index.where("size(terms) > 0").withColumn("m", F.expr(f"10 + (90 * n * {n_docs}L) div {max(length, 1)}L"))
        words = wanted.select(F.col("term").alias("w_term")).distinct()
        seen = postings(self.index).groupBy("term").agg(F.count("*").alias("df"), F.max("gain").alias("most"))
        seen = seen.join(words, F.col("term") == F.col("w_term"), "left_semi")
        weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2).cast("double") / (2 * F.col("df") + 1)))
        own = wanted.join(seen.withColumnRenamed("term", "s_term"), F.col("term") == F.col("s_term"))
        own = own.select("item", "term", "df", weight.alias("w"), (weight * F.col("most")).alias("bound")).where("w > 0")
        turn = W.partitionBy("item").orderBy("df", "term")
        whole = W.partitionBy("item")
        ahead = F.sum("bound").over(whole) - F.sum("bound").over(turn.rowsBetween(W.unboundedPreceding, 0))
        # `ahead`: what the terms after this one can add at most
        self.terms = stage(own.select("item", "term", "w", (F.row_number().over(turn) - 1).alias("turn"), ahead.alias("ahead")), "search-terms")

    def updates(self, pairs: DataFrame, terms: DataFrame) -> DataFrame:
        """item, doc, more: what `terms` (item, term, w) add to the pairs (item, doc)."""
        pairs = pairs.select(F.col("item").alias("p_item"), F.col("doc").alias("p_doc"))
        index = self.index.join(pairs, F.col("doc") == F.col("p_doc")).select("p_item", "doc", "m", "terms", "tfs")
        found = index.select("p_item", "doc", "m", F.explode(F.arrays_zip("terms", "tfs")).alias("p"))
        gain = F.expr("(1000000000 * p.tfs) div (1000 * p.tfs + 8 * m)")
        both = found.join(terms, (F.col("p_item") == F.col("item")) & (F.col("p.terms") == F.col("term")))
        return both.groupBy("item", "doc").agg(F.sum(F.col("w") * gain).alias("more"))

    def raised(self, accumulators: DataFrame, state: DataFrame) -> DataFrame:
        """r_item and kth: the kth score of each open item, after its leading accumulators were brought up to date."""
        leading = best(accumulators.where("open"), self.k, F.col("score").desc(), F.col("doc")).select("item", "doc", "score")
        leading = stage(leading, "search-leading")
        coming = self.terms.join(state.select(F.col("item").alias("t_item"), "done"), F.col("item") == F.col("t_item")).where("turn >= done")
        more = self.updates(leading, coming.select("item", "term", "w")).select(F.col("item").alias("m_item"), F.col("doc").alias("m_doc"), "more")
        full = leading.join(more, (F.col("item") == F.col("m_item")) & (F.col("doc") == F.col("m_doc")), "left")
        full = full.select("item", (F.col("score") + F.coalesce("more", F.lit(0))).alias("score"))
        return full.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(f"n = {self.k}").select(F.col("item").alias("r_item"), "kth")

    def survivors(self) -> tuple[DataFrame, DataFrame]:
        """Accumulators (item, doc, score) that may be among the first k, and state (item, done): terms already added."""
        zero = F.lit(0).cast("long")
        state = self.terms.groupBy("item").agg(F.count("*").alias("size")).select(
            "item", "size", zero.alias("done"), zero.alias("least"), F.lit(True).alias("open")
        )
        state, accumulators, low, high = stage(state, "search-state"), None, 0, FIRST_BATCH
        while not state.where("open").isEmpty():
            open_items = state.where("open").select(F.col("item").alias("o_item"))
            batch = self.terms.where(f"turn >= {low} and turn < {high}").join(open_items, F.col("item") == F.col("o_item"), "left_semi")
            batch = batch.select("item", F.col("term").alias("b_term"), "w")
            added = postings(self.index).join(batch, F.col("term") == F.col("b_term")).select("item", "doc", (F.col("w") * F.col("gain")).alias("score"))
            added = added.groupBy("item", "doc").agg(F.sum("score").alias("score"))
            if accumulators is not None:
                added = added.unionByName(accumulators.select("item", "doc", "score")).groupBy("item", "doc").agg(F.sum("score").alias("score"))
            done = F.when(F.col("open"), F.least("size", F.lit(high).cast("long"))).otherwise(F.col("done"))
            state = state.select("item", "size", done.alias("done"), "least", "open")
            last = self.terms.select(F.col("item").alias("a_item"), (F.col("turn") + 1).alias("a_done"), "ahead")
            state = stage(state.join(last, (F.col("item") == F.col("a_item")) & (F.col("done") == F.col("a_done"))).drop("a_item", "a_done"), "search-state")
            accumulators = stage(self.promising(added, state), "search-accumulators")
            raised = self.raised(accumulators, state)
            state = state.join(raised, F.col("item") == F.col("r_item"), "left").select(
                "item", "size", "done", "ahead", F.greatest("least", F.coalesce("kth", zero)).alias("least"), "open"
            )
            state = stage(state.withColumn("open", F.expr("open and done < size and ahead >= least")), "search-state")
            low, high = high, 2 * high
        return accumulators, state

    @staticmethod
    def promising(accumulators: DataFrame, state: DataFrame) -> DataFrame:
        own = state.select(F.col("item").alias("o_item"), "ahead", "least", "open")
        joined = accumulators.select("item", "doc", "score").join(own, F.col("item") == F.col("o_item")).where("score + ahead >= least")
        return joined.select("item", "doc", "score", "open")


def ranked(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score of the k best documents (doc_id, text) of every item (item_id, text)."""
    search = Search(docs.select(F.col("doc_id").alias("id"), "text"), items.select(F.col("item_id").alias("id"), "text"), k)
    accumulators, state = search.survivors()
    if accumulators is None:
        kinds = (search.items.schema["id"].dataType.simpleString(), search.index.schema["id"].dataType.simpleString())
        return docs.sparkSession.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")
    accumulators = stage(search.promising(accumulators, state), "search-survivors")
    coming = search.terms.join(state.select(F.col("item").alias("t_item"), "done"), F.col("item") == F.col("t_item")).where("turn >= done")
    more = search.updates(accumulators, coming.select("item", "term", "w")).select(F.col("item").alias("m_item"), F.col("doc").alias("m_doc"), "more")
    full = accumulators.join(more, (F.col("item") == F.col("m_item")) & (F.col("doc") == F.col("m_doc")), "left")
    full = full.select("item", "doc", (F.col("score") + F.coalesce("more", F.lit(0))).alias("score")).where("score > 0")
    names = search.index.select(F.col("doc").alias("n_doc"), F.col("id").alias("doc_id"))
    named = full.join(names, F.col("doc") == F.col("n_doc"))
    first = best(named, k, F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("doc"))
    own = search.items.select(F.col("item").alias("i_item"), F.col("id").alias("item_id"))
    return first.join(own, F.col("item") == F.col("i_item")).select("item_id", "rank", "doc_id", "score")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _terms(table: str, key: str) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    return f"SELECT {key}, unnest(regexp_extract_all(translate(text, '{upper}', '{upper.lower()}'), '{pattern}')) AS term FROM {table}"


SQL = f"""
WITH d AS ({_terms("documents", "doc_id")}), q AS (SELECT DISTINCT * FROM ({_terms("benchmark", "item_id")})),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY ALL),
s AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS total FROM n),
m AS (SELECT doc_id, 100 - 90 + (90 * n * n_docs) // total AS m FROM n CROSS JOIN s),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY ALL) CROSS JOIN s),
scores AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
           FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= {K}
"""
