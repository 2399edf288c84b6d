"""Secrets, judged by how widely a candidate is owned across the corpus.

Fixed patterns give the base spans. Long mixed tokens are further candidates.
The hashes of all candidates are counted by distinct repositories and owners
over the whole corpus. A repository is a distinct text, so copies of a document
count once. What many owners hold, or few owners in many repositories, is a
copied example; what one or two owners hold in a few repositories looks live.
Live-looking tokens are added to the spans; base spans stay whatever their label.

Hot candidates (one key in a third of all documents) are counted in steps that
combine before each shuffle: per candidate and owner, and candidate and
repository, then per candidate.

Defined cases: a null text is empty and has no spans; a null owner is one owner
of its own; spans of different kinds may overlap, a token that overlaps a base
span is left out; repeated rows each get their result and count as one
repository; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import documents, stage

# The base patterns, their order and least lengths.
ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "token")
KEYWORDS = ("passw", "secret", "token", "api_key", "apikey")

TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
TOKEN_ENTROPY = 3.5  # bits a character
LIVE_OWNERS = 2  # more owners than this make an example
LIVE_REPOSITORIES = 10  # and so do more repositories
REPLACEMENT = "[SECRET]"


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, secret), leftmost and not overlapping within a kind."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out)


def entropy(token: str) -> float:
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values())


def token_spans(text: str, base: list) -> list[tuple[int, int, int, str]]:
    out = []
    for m in TOKEN.finditer(text):
        token = m[0]
        if any(c.isdigit() for c in token) and any(c.isalpha() for c in token) and entropy(token) >= TOKEN_ENTROPY:
            if not any(s < m.end() and m.start() < e for s, _, e, _ in base):
                out.append((m.start(), 3, m.end(), token))
    return out


def written(spans: list) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end, *_ in spans)


def candidates(docs: DataFrame, owner: Column) -> DataFrame:
    """row, doc_id, text_key, owner, base counts and digest, spans (start, kind, end, secret hash) of every row."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("secret", pa.int64())]))
    schema = (
        "row long, doc_id long, text_key long, owner string, n_assign long, n_access long, n_hex long, "
        "base_sha256 string, spans array<struct<start:int,kind:int,end:int,secret:long>>"
    )

    def run(batches):
        for batch in batches:
            counts, digests, spans = [], [], []
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                counts.append(Counter(s[1] for s in base))
                digests.append(hashlib.sha256(written(base).encode()).hexdigest())
                spans.append(
                    [
                        {"start": s, "kind": k, "end": e, "secret": xxhash.xxh3_64_intdigest(v) - (1 << 63)}
                        for s, k, e, v in sorted(base + token_spans(text, base))
                    ]
                )
            columns = [batch.column(c) for c in ("row", "doc_id", "text_key", "owner")]
            columns += [pa.array([c[i] for c in counts], pa.int64()) for i in range(3)]
            columns += [pa.array(digests, pa.string()), pa.array(spans, span)]
            names = ["row", "doc_id", "text_key", "owner", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64(text).alias("text_key"),
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"), text.alias("text"),
    ).mapInArrow(run, schema)


def ownership(found: DataFrame) -> DataFrame:
    """secret, owners, repositories over the whole corpus; equal texts are one repository."""
    held = found.select("owner", "text_key", F.explode("spans.secret").alias("secret"))
    return held.groupBy("secret").agg(F.count_distinct("owner").alias("owners"), F.count_distinct("text_key").alias("repositories"))


def scan(docs: DataFrame, owner: Column, live_owners: int = LIVE_OWNERS, live_repositories: int = LIVE_REPOSITORIES) -> DataFrame:
    """A row for each row of `docs`: base counts and digest, and spans with kind, start, end, live."""
    found = stage(candidates(docs, owner), "secret-candidates")
    known = stage(ownership(found), "secret-owners").withColumnRenamed("secret", "k_secret")
    each = found.select("row", F.explode("spans").alias("span"))
    judged = each.join(known, F.col("span.secret") == F.col("k_secret")).select(
        F.col("row").alias("j_row"), "span", "owners", "repositories",
        ((F.col("owners") <= live_owners) & (F.col("repositories") <= live_repositories)).alias("live"),
    )
    token = KINDS.index("token")
    lists = (
        judged.where((F.col("span.kind") != token) | F.col("live"))
        .groupBy("j_row")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        F.col("span.start").alias("start"), F.col("span.kind").alias("kind"), F.col("span.end").alias("end"),
                        "live", "owners", "repositories",
                    )
                )
            ).alias("spans")
        )
    )
    empty = F.array().cast(lists.schema["spans"].dataType)
    return found.drop("spans").join(lists, F.col("row") == F.col("j_row"), "left").select(
        "doc_id", "text_key", "n_assign", "n_access", "n_hex", "base_sha256", F.coalesce("spans", empty).alias("spans")
    )


def spans_text(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redacted(docs: DataFrame, owner: Column, replacement: str = REPLACEMENT) -> DataFrame:
    """`docs` with every span of its texts replaced; overlapping spans become one replacement."""
    spans = (
        scan(docs.select("doc_id", "text", owner.alias("owner")), F.col("owner"))
        .where(F.size("spans") > 0)
        .select(F.col("doc_id").alias("s_id"), F.col("text_key").alias("s_key"), "spans.start", "spans.end")
        .dropDuplicates(["s_id", "s_key"])
    )
    names = docs.columns
    packed = docs.select(F.struct(*names).alias("doc"))
    key = F.xxhash64(F.coalesce("doc.text", F.lit("")))
    joined = packed.join(spans, F.col("doc.doc_id").eqNullSafe(F.col("s_id")) & (key == F.col("s_key")), "left")

    @F.arrow_udf("string")
    def cut(text: pa.Array, start: pa.Array, end: pa.Array) -> pa.Array:
        out = []
        for t, starts, ends in zip(text, start.to_pylist(), end.to_pylist()):
            t = t.as_py()
            if starts is not None:
                parts, at = [], 0
                for a, b in sorted(zip(starts, ends)):
                    if a >= at:
                        parts += [t[at:a], replacement]
                    at = max(at, b)
                t = "".join(parts) + t[at:]
            out.append(t)
        return pa.array(out, pa.string())

    text = cut(F.col("doc.text"), "start", "end")
    return joined.select(*[text.alias(n) if n == "text" else F.col("doc")[n].alias(n) for n in names])


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir), F.col("source"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", spans_text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
    )
