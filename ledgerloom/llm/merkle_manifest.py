"""A Merkle manifest of a table of documents: leaves, subroots, root, proofs.

A leaf is the SHA-256 of a document's fields. The leaves of a language ascend
by doc_id; runs of `arity` consecutive nodes become their hash until one node is
left, the subroot. Subroots in order of language give the root the same way.

Every level is an equijoin of its nodes with themselves on computed sibling
indices: the index with its last bit flipped for binary trees, the other slots
of the run otherwise. Rows in slot zero, which see their whole run, emit the
parents. Each level is written once, with the siblings of every node. Proofs go
down the same levels: a node puts its own siblings before the path of its parent.

Defined cases: a null field is hashed as `-`; documents without a language are a
tree of their own, which comes first; a null doc_id comes before all others;
rows with the same doc_id ascend by leaf, and identical rows are leaves each; a
lone leaf is its own subroot; a last run may have fewer nodes, even one, and is
hashed like any other; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.common import documents, stage

ARITY = 2
ROWS_A_FILE = 100_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """SHA-256 as 32 bytes of the parts, which are strings."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def hexed(column: Column) -> Column:
    return F.lower(F.hex(column))


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(changed: dict[str, Column] | None = None) -> Column:
    """The leaf of a document, with other values for the fields in `changed`."""
    return digest(*[field((changed or {}).get(name, F.col(name))) for name in FIELDS])


def tampered(doc_id: Column) -> Column:
    """The documents whose n_chars the tampering trial raises by 1."""
    return F.crc32(doc_id.cast("string")) % 7 == 0


def leaves(docs: DataFrame) -> DataFrame:
    """tree, doc_id, digest, changed of every document; `changed` is its leaf after tampering, else null."""
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-"))  # sorts null first, then by bytes
    changed = F.when(tampered(F.col("doc_id")), leaf({"n_chars": F.col("n_chars") + 1}))
    return docs.select(tree.alias("tree"), "doc_id", leaf().alias("digest"), changed.alias("changed"))


def numbered(nodes: DataFrame, *order: str) -> DataFrame:
    """`nodes`, staged, with idx (the place in its tree, from 0, in this order) and n (the size of the tree).

    Rows are sorted by ranges. A row's place is its number in the range's part
    of the tree plus the sizes of the parts before, of which there is one row
    for each range and tree.
    """
    nodes = stage(nodes.withColumn("seed", F.monotonically_increasing_id()), "merkle-nodes")
    order = ["tree", *order, "seed"]
    sorted_rows = nodes.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = sorted_rows.select(
        *[c for c in nodes.columns if c != "seed"],
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"),
    )
    placed = stage(placed, "merkle-order")
    parts = placed.groupBy("tree", "part").agg(F.count("*").alias("size"), F.min("row").alias("first"))
    whole = W.partitionBy("tree")
    parts = parts.select(
        F.col("tree").alias("p_tree"), F.col("part").alias("p_part"),
        (F.sum("size").over(whole.orderBy("part")) - F.col("size") - F.col("first")).alias("shift"),
        F.sum("size").over(whole).alias("n"),
    )
    joined = placed.join(parts, (F.col("tree") == F.col("p_tree")) & (F.col("part") == F.col("p_part")))
    rest = [c for c in placed.columns if c not in ("part", "row")]
    return joined.select(*rest, (F.col("row") + F.col("shift")).alias("idx"), "n")


def with_siblings(nodes: DataFrame, arity: int = ARITY) -> DataFrame:
    """tree, idx, n, others (bytes of the run's other digests, left to right) and parent (in slot zero only)."""
    slot = F.col("idx") % arity
    if arity == 2:
        indices = [F.col("idx").bitwiseXOR(F.lit(1))]
    else:
        indices = [F.col("idx") - slot + (slot + offset) % arity for offset in range(1, arity)]
    joined = nodes
    for i, index in enumerate(indices):
        other = nodes.select(F.col("tree").alias("s_tree"), F.col("idx").alias("s_idx"), F.col("digest").alias(f"s{i}"))
        joined = joined.join(other, (F.col("tree") == F.col("s_tree")) & (index == F.col("s_idx")), "left").drop("s_tree", "s_idx")
    present = F.array(*[F.struct(index.alias("at"), F.col(f"s{i}").alias("d")) for i, index in enumerate(indices)])
    present = F.array_sort(F.filter(present, lambda x: x["d"].isNotNull()))
    others = F.aggregate(present, F.lit(b""), lambda acc, x: F.concat(acc, x["d"]))
    joined = joined.select("tree", "idx", "n", "digest", others.alias("others"))
    parent = F.when(slot == 0, digest(hexed(F.col("digest")), hexed(F.col("others"))))
    return joined.select("*", parent.alias("parent"))


def climb(nodes: DataFrame, arity: int = ARITY) -> tuple[list[DataFrame], DataFrame]:
    """The levels (tree, idx, n, digest, others, parent) of all trees from the leaves up, and the roots
    (tree, digest, depth), where depth is the number of levels below a root.
    """
    nodes = nodes.select("tree", "idx", "n", "digest")
    most, total = nodes.agg(F.coalesce(F.max("n"), F.lit(0)), F.count("*")).first()
    levels, roots = [], [nodes.where("n = 1").withColumn("depth", F.lit(0))]
    while most > 1:
        own = with_siblings(nodes.where("n > 1"), arity).coalesce(1 + total // ROWS_A_FILE)
        levels.append(stage(own, "merkle-level"))
        nodes = levels[-1].where("parent is not null").select(
            "tree", F.floor(F.col("idx") / arity).alias("idx"), F.ceil(F.col("n") / arity).alias("n"),
            F.col("parent").alias("digest"),
        )
        roots.append(nodes.where("n = 1").withColumn("depth", F.lit(len(levels))))
        most, total = -(-most // arity), -(-total // arity)
    return levels, reduce(DataFrame.unionByName, roots).select("tree", "digest", "depth")


def descend(levels: list[DataFrame], roots: DataFrame, arity: int = ARITY) -> DataFrame:
    """tree, idx, path and the inherited columns of `roots` for every leaf.

    `roots` has tree, depth, the path above a root and columns that all leaves
    below inherit. A path holds, level by level upwards, the slot and the
    siblings' digests. A tree's root joins in at its own depth.
    """
    inherited = [c for c in roots.columns if c not in ("tree", "depth", "path")]

    def rooted(depth: int) -> DataFrame:
        zero = F.lit(0).cast("long")
        return roots.where(F.col("depth") == depth).select(F.col("tree").alias("p_tree"), zero.alias("p_idx"), F.col("path").alias("p_path"), *inherited)

    found = rooted(len(levels))
    for depth in reversed(range(len(levels))):
        level = levels[depth].select("tree", "idx", "others")
        parent = F.floor(F.col("idx") / arity)
        step = F.struct((F.col("idx") % arity).cast("int").alias("slot"), F.col("others"))
        below = level.join(found, (F.col("tree") == F.col("p_tree")) & (parent == F.col("p_idx"))).select(
            F.col("tree").alias("p_tree"), F.col("idx").alias("p_idx"), F.concat(F.array(step), "p_path").alias("p_path"), *inherited
        )
        found = below.unionByName(rooted(depth))
    return found.select(F.col("p_tree").alias("tree"), F.col("p_idx").alias("idx"), F.col("p_path").alias("path"), *inherited)


PATH = "array<struct<slot:int,others:binary>>"


def proof(path: Column) -> Column:
    """All siblings of a path as one hex text."""
    return F.array_join(F.transform(path, lambda step: hexed(step["others"])), "")


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""

    def up(own, step):
        others, left = hexed(step["others"]), step["slot"] * 64
        return F.sha2(F.concat(F.substring(others, F.lit(1), left), own, F.substring(others, left + 1, F.length(others))), 256)

    return F.aggregate(path, hexed(start), up)


def manifest(docs: DataFrame, arity: int = ARITY) -> DataFrame:
    """doc_id, digest, changed, subroot, root (bytes) and path of every document."""
    rows = stage(numbered(leaves(docs), "doc_id", "digest"), "merkle-leaves")
    levels, subroots = climb(rows, arity)
    # one tree over the subroots, in the order of their names
    tops = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("own"), "digest", F.col("depth").alias("below"))
    tops = stage(numbered(tops, "own"), "merkle-tops")
    upper, root = climb(tops, arity)
    root = stage(root.select("tree", "depth", F.array().cast(PATH).alias("path"), F.col("digest").alias("root")), "merkle-root")
    above = descend(upper, root, arity).select(F.col("idx").alias("a_idx"), "path", "root")
    roots = tops.join(above, F.col("idx") == F.col("a_idx")).select(
        F.col("own").alias("tree"), F.col("below").alias("depth"), "path", F.col("digest").alias("subroot"), "root"
    )
    paths = descend(levels, stage(roots, "merkle-roots"), arity)
    paths = paths.select(F.col("tree").alias("l_tree"), F.col("idx").alias("l_idx"), "path", "subroot", "root")
    joined = rows.join(paths, (F.col("tree") == F.col("l_tree")) & (F.col("idx") == F.col("l_idx")))
    return joined.select("doc_id", "digest", "changed", "subroot", "root", "path")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = manifest(documents(spark, sf_dir))
    folded_root = folded(F.coalesce("changed", "digest"), F.col("path"))
    return found.select(
        "doc_id", hexed(F.col("digest")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"),
        hexed(F.col("root")).alias("root"), F.sha2(proof(F.col("path")), 256).alias("proof_sha256"),
        folded_root.alias("folded_root"),
    ).select("*", (F.col("folded_root") == F.col("root")).alias("verified"))


def _field(name: str, value: str | None = None) -> str:
    text = f"CAST({value or name} AS VARCHAR)"
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


def _leaf(n_chars: str | None = None) -> str:
    return "sha256(" + " || ".join(_field(name, n_chars if name == "n_chars" else None) for name in FIELDS) + ")"


# crc32 of a decimal doc_id, bit by bit, as DuckDB has none
_CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
  lambda a, c: list_reduce(list_prepend(xor(a, c), range(8)::BIGINT[]), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"""

# Both trees climb in one recursion each; a document folds its own way up in the last one.
SQL = f"""
WITH RECURSIVE leaf AS (
  SELECT coalesce('=' || lang, '-') AS tree, doc_id, {_leaf()} AS h,
         CASE WHEN xor({_CRC}, 4294967295) % 7 = 0 THEN {_leaf("n_chars + 1")} END AS changed
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS idx,
         count(*) OVER (PARTITION BY tree) AS n FROM leaf),
low AS (
  SELECT tree, 0 AS lvl, idx, n, h FROM placed
  UNION ALL
  SELECT tree, lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx))
  FROM low WHERE n > 1 GROUP BY tree, lvl, idx // 2, n),
tops AS (
  SELECT tree, lvl AS depth, h, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
  SELECT 0 AS lvl, idx, n, h FROM tops
  UNION ALL
  SELECT lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM high WHERE n > 1 GROUP BY lvl, idx // 2, n),
nodes AS (
  SELECT tree, lvl, idx, h FROM low WHERE n > 1
  UNION ALL
  SELECT t.tree, t.depth + g.lvl, g.idx, g.h FROM tops t CROSS JOIN high g WHERE g.n > 1),
fold AS (
  SELECT tree, idx AS id, 0 AS lvl, idx, n > 1 AS low, coalesce(changed, h) AS own, '' AS proof FROM placed
  UNION ALL
  SELECT f.tree, f.id, f.lvl + 1, p.at // 2, f.low,
         CASE WHEN s.h IS NULL THEN sha256(f.own) WHEN p.at % 2 = 1 THEN sha256(s.h || f.own) ELSE sha256(f.own || s.h) END,
         f.proof || coalesce(s.h, '')
  FROM fold f JOIN tops t ON f.tree = t.tree
  JOIN LATERAL (SELECT CASE WHEN f.lvl = t.depth THEN t.idx ELSE f.idx END AS at) p ON true
  LEFT JOIN nodes s ON s.tree = f.tree AND s.lvl = f.lvl AND s.idx = xor(p.at, 1)
  WHERE f.lvl < t.depth + (SELECT max(lvl) FROM high))
SELECT p.doc_id, p.h AS leaf, t.h AS subroot, r.h AS root, sha256(f.proof) AS proof_sha256,
       f.own AS folded_root, f.own = r.h AS verified
FROM placed p JOIN tops t ON p.tree = t.tree CROSS JOIN (SELECT h FROM high WHERE n = 1) r
JOIN fold f ON f.tree = p.tree AND f.id = p.idx AND f.lvl = t.depth + (SELECT max(lvl) FROM high)
"""
