"""URL verdicts from rules and from path templates.

Each host has a tree of path segments. Level by level, segments that are rare
under their parent become a wildcard of their shape, unless the bad share of
their labelled pages differs from that of all rare siblings of the shape (a
two-sided test at three standard deviations): those stay literal. Of the
frequent ones, those whose children and labels are distributed like all frequent
siblings together (chi-square and a two-sided test of the bad share, both at
three standard deviations) merge into one branch; the others stay literal. A template, the
path of generalised segments, is rejected when its smoothed labelled purity
(bad + s * p) / (labelled + s) reaches a threshold; p is the share of bad pages
among all pages and s the strength of that prior.

All steps work on distinct (host, path) pairs with their counts. A level's join
holds literal segments only: at most 1 / `SHARE` frequent ones of a parent, and
the rare ones whose labels differ, however many. Levels go on as long as some
parent can still split: it has `LEAST` pages and two different paths. Below a
parent that cannot, the rest of a path is decided at once, as its levels would.

Defined cases: a null url, or one without `://`, has an empty host and path; a
url without a fitting rule is judged by its template; an empty path is the
template `/`; paths are followed to their end; null labels do not count; equal
urls get equal verdicts; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import UPPER, pages, stage

LEAST = 5  # a literal segment has at least so many pages
SHARE = 0.02  # a segment with this share of its parent's pages is compared with the others that have it
STRENGTH = 10.0
REJECT = 0.8
DEVIATIONS = 3.0
SHAPES = ("none", "number", "coded", "word")

Rule = tuple[str, str, str]  # host, path, verdict

RULES: list[Rule] = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    whole = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(whole, pattern, 1), UPPER, UPPER.lower()), F.regexp_extract(whole, pattern, 2)


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def shape(segment: Column) -> Column:
    return (
        F.when(segment.isNull(), "none")
        .when(segment.rlike(r"^[0-9]+([.][a-z]+)?$"), "number")
        .when(segment.rlike("[0-9]"), "coded")
        .otherwise("word")
    )


def literals(paths: DataFrame) -> DataFrame:
    """host, prefix, seg, branch: the segments of a level that do not become a wildcard of their shape."""
    nodes = paths.where("seg is not null").groupBy("host", "prefix", "seg").agg(
        F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"),
        *[F.sum(F.when(F.col("next") == s, F.col("n")).otherwise(0)).alias(s) for s in SHAPES],
    )
    parents = nodes.groupBy("host", "prefix").agg(F.sum("n").alias("total"))
    often = (F.col("n") >= LEAST) & (F.col("n") >= SHARE * F.col("total"))
    segments = stage(nodes.join(parents, ["host", "prefix"]).withColumn("frequent", often), "url-segments")
    frequent = segments.where("frequent")
    pooled = frequent.groupBy("host", "prefix").agg(
        F.sum("n").alias("p_n"), F.sum("bad").alias("p_bad"), F.count("*").alias("siblings"),
        *[F.sum(s).alias(f"p_{s}") for s in SHAPES],
    )
    both = frequent.join(pooled, ["host", "prefix"])
    expected = {s: F.col("n") * F.col(f"p_{s}") / F.col("p_n") for s in SHAPES}
    chi = sum(F.when(F.col(f"p_{s}") > 0, (F.col(s) - e) * (F.col(s) - e) / e).otherwise(0.0) for s, e in expected.items())
    free = sum(F.when(F.col(f"p_{s}") > 0, 1.0).otherwise(0.0) for s in SHAPES) - 1
    rate = F.col("p_bad") / F.col("p_n")
    spread = F.sqrt(F.col("n") * rate * (1 - rate))
    alike = (chi <= free + DEVIATIONS * F.sqrt(2 * free)) & (F.abs(F.col("bad") - F.col("n") * rate) <= DEVIATIONS * spread)
    branch = F.when((F.col("siblings") > 1) & alike, F.lit("*")).otherwise(F.col("seg"))
    known = both.select("host", "prefix", "seg", branch.alias("branch")).unionByName(deviating(segments.where("not frequent")))
    return known.select(F.col("host").alias("l_host"), F.col("prefix").alias("l_prefix"), F.col("seg").alias("l_seg"), "branch")


def deviating(rare: DataFrame) -> DataFrame:
    """host, prefix, seg, branch: rare segments whose labels differ from those of all rare siblings of their shape."""
    rare = rare.withColumn("shape", shape(F.col("seg")))
    key = ["host", "prefix", "shape"]
    pooled = rare.groupBy(*key).agg(F.sum("labelled").alias("p_labelled"), F.sum("bad").alias("p_bad"))
    pooled = pooled.where("p_bad > 0 and p_bad < p_labelled")  # else all labels agree
    rate = F.col("p_bad") / F.col("p_labelled")
    # a variance below one page says little about so few labels
    spread = F.sqrt(F.greatest(F.col("labelled") * rate * (1 - rate), F.lit(1.0)))
    unlike = F.abs(F.col("bad") - F.col("labelled") * rate) > DEVIATIONS * spread
    return rare.where(F.col("n") >= LEAST).join(pooled, key).where(unlike).select("host", "prefix", "seg", F.col("seg").alias("branch"))


def settled(rows: DataFrame, level: int) -> DataFrame:
    """`rows` with template, which is null below parents that can still split at `level`."""
    parents = rows.groupBy("host", "prefix").agg(F.sum("n").alias("total"), F.count("*").alias("paths"))
    rest = F.slice("segs", level + 1, F.size("segs"))
    shapes = F.transform(rest, lambda s: F.concat(F.lit("<"), shape(s), F.lit(">")))
    below = lambda tail: F.concat("prefix", F.lit("/"), F.array_join(tail, "/"))
    template = (
        F.when(F.size("segs") <= level, F.col("prefix"))
        .when(F.col("total") < LEAST, below(shapes))
        .when(F.col("paths") == 1, below(rest))  # alone, and with pages enough: literal to the end
    )
    return rows.join(parents, ["host", "prefix"]).select(*rows.columns, template.alias("template"))


def templates(paths: DataFrame) -> DataFrame:
    """host, path, template for (host, path, n, labelled, bad)."""
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    rows = paths.select("host", "path", "n", "labelled", "bad", segments.alias("segs"), F.lit("").alias("prefix"))
    level, done = 0, []
    while True:
        level_rows = stage(settled(rows, level), "url-level")
        done.append(level_rows.where("template is not null").select("host", "path", "template"))
        rows = level_rows.where("template is null").drop("template")
        if rows.isEmpty():
            break
        seg, after = F.get("segs", F.lit(level)), F.get("segs", F.lit(level + 1))
        rows = rows.withColumns({"seg": seg, "next": shape(after)})
        known = stage(literals(rows), "url-literals")
        match = (F.col("host") == F.col("l_host")) & (F.col("prefix") == F.col("l_prefix")) & (F.col("seg") == F.col("l_seg"))
        wild = F.concat(F.lit("<"), shape(F.col("seg")), F.lit(">"))
        rows = rows.join(known, match, "left").select(
            "host", "path", "n", "labelled", "bad", "segs", F.concat("prefix", F.lit("/"), F.coalesce("branch", wild)).alias("prefix")
        )
        level += 1
    whole = reduce(DataFrame.unionByName, done)
    return whole.withColumn("template", F.when(F.col("template") == "", F.lit("/")).otherwise(F.col("template")))


def judged(urls: DataFrame, evidence: DataFrame | None, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity for every row of (page_id, url).

    `evidence` has page_id and bad (0 or 1). Pages that a rule decides are
    labelled by it.
    """
    host, path = host_and_path(F.col("url"))
    rows = urls.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("found", longest_rule(F.col("host"), F.col("path"), rules))
    ruled = F.when(F.col("found").isNotNull(), (F.col("found.verdict") == "block").cast("int"))
    if evidence is None:
        labelled = rows.withColumn("label", ruled)
    else:
        own = evidence.groupBy(F.col("page_id").alias("e_id")).agg(F.max("bad").alias("e_bad"))
        labelled = rows.join(own, F.col("page_id") == F.col("e_id"), "left").withColumn("label", F.coalesce(ruled, "e_bad"))
    paths = stage(
        labelled.groupBy("host", "path").agg(
            F.count("*").alias("n"), F.count("label").alias("labelled"), F.sum(F.coalesce("label", F.lit(0))).alias("bad")
        ),
        "url-paths",
    )
    totals = paths.agg(F.sum("bad"), F.sum("n")).first()
    prior = (totals[0] or 0) / max(1, totals[1] or 0)
    named = stage(templates(paths), "url-templates")
    counted = (
        paths.join(named, ["host", "path"])
        .groupBy("host", "template")
        .agg(((F.sum("bad") + STRENGTH * prior) / (F.sum("labelled") + STRENGTH)).alias("purity"))
    )
    verdicts = stage(named.join(counted, ["host", "template"]), "url-verdicts").select(
        F.col("host").alias("v_host"), F.col("path").alias("v_path"), "template", "purity"
    )
    by_method = F.when(F.col("purity") >= REJECT, "block").otherwise("allow")
    return rows.join(verdicts, (F.col("host") == F.col("v_host")) & (F.col("path") == F.col("v_path"))).select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", by_method).alias("verdict"), "template", "purity",
    )


def document_labels(urls: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id, bad: pages whose last path segment is the number of a labelled document are bad if it is toxic."""
    _, path = host_and_path(F.col("url"))
    number = F.regexp_extract(path, r"/([0-9]{1,18})(?:[.][a-z]+)?/?$", 1)
    named = urls.select("page_id", number.try_cast("long").alias("number"))
    own = labels.where("toxic is not null").groupBy(F.col("doc_id").alias("number")).agg(F.max("toxic").alias("bad"))
    return named.join(own, "number").select("page_id", "bad")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = pages(spark, sf_dir).select("page_id", "url")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return judged(urls, document_labels(urls, labels), RULES)
