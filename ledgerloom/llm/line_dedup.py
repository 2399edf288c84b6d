"""Repeated runs of lines, found by winnowing.

Blank lines (without words) are left aside. From each other line a window runs
over the shortest run of lines that holds `WORDS` words or more; a text with
fewer words is one window. Every window selects its line of least hash (the last
one on a tie) as a fingerprint, so two documents that share a run of `WORDS`
words or more share a fingerprint. Only fingerprints that stand at two or more
positions are looked at further: their windows are joined with the earliest
position of the same window, and the match is extended line by line as long as
both go on alike. Before a match nothing is left to extend: a line that is alike
there too begins an earlier match itself. Matches that overlap or touch become
one run, and the later runs are deleted. Each position meets the earliest one
only, so a line or passage that a third of all documents hold costs one row for
each occurrence.

So a line goes if it lies in a window, or in its extension, that also starts
earlier: in a document with a smaller doc_id or further up in the same one. A
blank line goes with the lines around it: if the next other lines before and
after it go, or the only one of them at an end of the text. Windows are judged
on the input, not on what is left.

Defined cases: a null or empty text has no lines; blank lines alone are never a
repeat; a null doc_id comes before every other; identical repeated rows are one
document and share its result; an empty table gives an empty result; other
columns are kept or ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import as_bytes, documents, pieces, stage
from ledgerloom.llm.substring_dedup import mixed

WORDS = 10
BATCH_BYTES = 4 << 20
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def lines_of(text: bytes) -> list[bytes]:
    return text.split(b"\n") if text else []


def spans(counts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First line, end and end of the extension of every window over lines of so many words each."""
    upto = np.concatenate([[0], np.cumsum(counts)])
    if not len(counts) or upto[-1] < least:
        n = min(1, len(counts))
        return np.zeros(n, np.int64), np.full(n, len(counts)), np.full(n, len(counts))
    stop = np.searchsorted(upto, upto[:-1] + least)
    start = np.flatnonzero(stop < len(upto))
    stop = stop[start]
    return start, stop, np.searchsorted(upto, upto[stop] + least) - 1


def winnowed(lines: list[bytes], least: int) -> list[tuple[int, list[dict]]]:
    """(fingerprint, the consecutive windows that select it); lines are not blank."""
    h = np.fromiter((xxhash.xxh3_64_intdigest(line) for line in lines), np.uint64, len(lines))
    start, stop, far = spans(np.fromiter((len(line.split()) for line in lines), np.int64, len(lines)), least)
    if not len(start):
        return []
    whole, lowest, chosen = np.zeros(len(start), np.uint64), h[start], start.copy()
    for i in range(int((stop - start).max())):
        inside = start + i < stop
        at = start[inside] + i
        whole[inside] = mixed((whole[inside] + h[at]) * GOLDEN)
        lower = h[at] <= lowest[inside]
        lowest[inside] = np.where(lower, h[at], lowest[inside])
        chosen[inside] = np.where(lower, at, chosen[inside])
    signed, names = h.view(np.int64), whole.view(np.int64).tolist()
    windows = [
        {"hash": name, "start": a, "stop": b, "tail": signed[b:c].tolist()}
        for name, a, b, c in zip(names, start.tolist(), stop.tolist(), far.tolist())
    ]
    first = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
    return [(int(signed[chosen[a]]), windows[a:b]) for a, b in zip(first, [*first[1:], len(windows)])]


WINDOW = pa.struct([("hash", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()), ("tail", pa.list_(pa.int64()))])


def fingerprints(docs: DataFrame, least: int) -> DataFrame:
    """fingerprint, doc_id, text_key, windows: the selected lines of all texts."""

    def select(batches):
        for batch in pieces(batches, "text", BATCH_BYTES):
            rows = []
            for doc_id, key, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_key", "text"))):
                own = [line for line in lines_of(text) if line.strip()]
                rows += [(fp, doc_id, key, windows) for fp, windows in winnowed(own, least)]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(WINDOW))
            columns = zip(*rows) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["fingerprint", "doc_id", "text_key", "windows"]
            )

    return docs.select("doc_id", "text_key", as_bytes()).mapInArrow(
        select,
        "fingerprint long, doc_id long, text_key long, windows array<struct<hash:long,start:int,stop:int,tail:array<long>>>",
    )


def later_runs(docs: DataFrame, least: int) -> DataFrame:
    """s_id, s_key, runs (start, stop): windows that also start earlier, with their extensions."""
    found = stage(fingerprints(docs, least), "line-fingerprints")
    repeated = found.groupBy("fingerprint").agg(F.count("*").alias("times")).where("times > 1")
    repeated = stage(repeated.select(F.col("fingerprint").alias("r_fingerprint")), "line-repeated")
    windows = stage(
        found.join(repeated, F.col("fingerprint") == F.col("r_fingerprint"))
        .select("doc_id", "text_key", F.explode("windows").alias("w"))
        .select(F.col("w.hash").alias("window"), F.struct("doc_id", "text_key", "w.start").alias("at"), "w.stop", "w.tail"),
        "line-windows",
    )
    earliest = windows.groupBy("window").agg(F.min(F.struct("at", "tail")).alias("first"), F.count("*").alias("times"))
    earliest = stage(earliest.where("times > 1").select(F.col("window").alias("e_window"), "first"), "line-earliest")
    same = F.zip_with("tail", "first.tail", lambda a, b: F.coalesce(a == b, F.lit(False)))
    differs = F.array_position(same, F.lit(False))
    alike = F.when(differs > 0, differs - 1).otherwise(F.size("tail"))
    return (
        windows.join(earliest, F.col("window") == F.col("e_window"))
        .where("not (at <=> first.at)")
        .groupBy(F.col("at.doc_id").alias("s_id"), F.col("at.text_key").alias("s_key"))
        .agg(F.collect_set(F.struct("at.start", (F.col("stop") + alike).cast("int").alias("stop"))).alias("runs"))
    )


def cut(text: str | None, runs: list[dict] | None) -> tuple[str | None, int, int]:
    """What is left of a text without the runs, its number of lines and of lines that go."""
    lines = text.split("\n") if text else []
    if not runs:
        return text, len(lines), 0
    worded = [i for i, line in enumerate(lines) if line.encode().strip()]
    steps = np.zeros(len(worded) + 1, np.int64)
    for run in runs:
        steps[run["start"]] += 1
        steps[run["stop"]] -= 1
    gone = np.cumsum(steps[:-1]) > 0
    # a blank line goes if both neighbours go; an end of the text counts as one that goes
    padded = np.r_[True, gone, True]
    after = np.searchsorted(worded, np.arange(len(lines)))
    all_gone = padded[after] & padded[after + 1]
    all_gone[worded] = gone
    return "\n".join(line for line, g in zip(lines, all_gone) if not g), len(lines), int(all_gone.sum())


def free_name(base: str, taken: list[str]) -> str:
    while base in taken:
        base = f"_{base}"
    return base


def with_runs(docs: DataFrame, least: int) -> tuple[DataFrame, str]:
    """`docs` with one more column, the runs that go, and its name."""
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_key", F.xxhash64("text"))
    found = later_runs(keyed, least)
    names = {c: free_name(c, docs.columns) for c in found.columns}
    found = found.withColumnsRenamed(names)
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    same = docs["doc_id"].eqNullSafe(F.col(names["s_id"])) & (key == F.col(names["s_key"]))
    return docs.join(found, same, "left").select(*docs.columns, names["runs"]), names["runs"]


def without_runs(docs: DataFrame, least: int = WORDS) -> DataFrame:
    """doc_id, kept (the text without later runs), n_lines and n_removed of every row."""
    joined, runs = with_runs(docs.select("doc_id", "text"), least)

    def run(batches):
        for batch in pieces(batches, "text", BATCH_BYTES):
            found = [cut(t, r) for t, r in zip(batch.column("text").to_pylist(), batch.column(runs).to_pylist())]
            kept, counts, removed = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(kept, pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())],
                names=["doc_id", "kept", "n_lines", "n_removed"],
            )

    return joined.mapInArrow(run, "doc_id long, kept string, n_lines long, n_removed long")


def deduplicated(docs: DataFrame, least: int = WORDS) -> DataFrame:
    """`docs` with later runs cut out of their texts; rows that lose all of their lines go."""
    joined, runs = with_runs(docs, least)
    at = docs.columns.index("text")

    def run(batches):
        for batch in pieces(batches, "text", BATCH_BYTES):
            found = [cut(t, r) for t, r in zip(batch.column("text").to_pylist(), batch.column(runs).to_pylist())]
            columns = [batch.column(c) for c in docs_columns]
            columns[at] = pa.array([kept for kept, *_ in found], pa.string())
            left = pa.array([removed == 0 or removed < n for _, n, removed in found], pa.bool_())
            yield pa.RecordBatch.from_arrays(columns, names=docs_columns).filter(left)

    docs_columns = docs.columns
    return joined.mapInArrow(run, T.StructType(docs.schema.fields))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_runs(documents(spark, sf_dir))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


_COUNT = r"len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))"

SQL = f"""
WITH split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text <> ''
), worded AS (
  SELECT *, row_number() OVER w AS i, sum(n) OVER w AS upto FROM (SELECT *, {_COUNT} AS n FROM split) WHERE n > 0
  WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), doc AS (
  SELECT doc_id, list(line ORDER BY i) AS lines, list_prepend(0, list(upto ORDER BY i)) AS upto, count(*) AS size FROM worded GROUP BY doc_id
), ends AS (
  SELECT doc_id, lines, upto, size, i, CASE WHEN upto[size + 1] < {WORDS} THEN size
           ELSE len(list_filter(upto, lambda u: u < upto[i] + {WORDS})) END AS stop
  FROM doc, unnest(range(1, size + 1)) r(i) WHERE upto[size + 1] >= {WORDS} OR i = 1
), windows AS (
  SELECT doc_id, i, stop, lines[i:stop] AS body,
         lines[stop + 1 : len(list_filter(upto, lambda u: u < upto[stop + 1] + {WORDS})) - 1] AS tail
  FROM ends WHERE stop <= size
), first AS (
  SELECT *, first_value(tail) OVER w AS other, row_number() OVER w AS nth FROM windows WINDOW w AS (PARTITION BY body ORDER BY doc_id, i)
), runs AS (
  SELECT doc_id, i, stop + len(list_filter(range(1, len(tail) + 1), lambda k: tail[1:k] = other[1:k])) AS stop FROM first WHERE nth > 1
), gone AS (
  SELECT w.doc_id, w.pos, bool_or(r.i IS NOT NULL) AS gone
  FROM worded w LEFT JOIN runs r ON w.doc_id = r.doc_id AND w.i BETWEEN r.i AND r.stop GROUP BY ALL
), marked AS (
  SELECT doc_id, pos, line, coalesce(gone,
           coalesce(last_value(gone IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true)
           AND coalesce(first_value(gone IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), true)
           AND bool_or(gone) OVER (PARTITION BY doc_id)) AS gone
  FROM split LEFT JOIN gone USING (doc_id, pos)
), kept AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (gone IS NOT TRUE), '') AS body
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
