"""The corpus pipeline, stage by stage, against brute force."""

from __future__ import annotations

import re
from collections import Counter

import corpus_pipeline
from ledgerloom.llm import language_id, secret_scan
from tests.llm import corpus

ROWS = [r for r in dict.fromkeys(corpus.messy_documents()) if r[0] is not None]


def test_stages_follow_each_other(spark, tmp_path):
    folder = corpus.write_tables(spark, tmp_path, ROWS)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, texts = docs.columns, {r[0]: r[1] for r in ROWS}
    labelled = sorted((d, lang, t) for d, t, lang, _ in ROWS if lang and language_id.has_letter(t))
    model = language_id.fit([t for *_, t in labelled], [lang for _, lang, _ in labelled])
    kept_by = {}
    for name, function in corpus_pipeline.STAGES:
        path = f"{tmp_path}/{name}"
        function(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == columns
            got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in docs.collect()}
            assert all(n == len(t) for t, n in got.values()) and docs.count() == len(got)
            kept_by[name] = {d: t for d, (t, _) in got.items()}

    def accepted(text):
        names, scores = language_id.judge(model, [text])
        return names[0] != "und" and scores[0] >= language_id.LEAST_SCORE

    want = {d: t for d, t in texts.items() if accepted(t)}
    assert kept_by["language_id"] == want
    lines = corpus.brute_lines([(d, t) for d, t in want.items()])
    want = {d: t for d, (n, removed, t) in lines.items() if removed < n}
    assert kept_by["line_dedup"] == want
    near = corpus.brute_near([(d, t) for d, t in want.items()], size=5)
    want = {d: t for d, t in want.items() if near[d][1] == d}
    assert kept_by["near_dedup"] == want

    owners: dict[str, set] = {}
    texts_of: dict[str, set] = {}
    source = {r[0]: r[3] for r in ROWS}
    for d, t in want.items():
        for *_, token in secret_scan.token_spans(t, secret_scan.base_spans(t)):
            owners.setdefault(token, set()).add(source[d])
            texts_of.setdefault(token, set()).add(t)

    def redacted(text):
        spans = corpus.brute_base_spans(text)
        tokens = secret_scan.token_spans(text, secret_scan.base_spans(text))
        spans += [(a, k, b) for a, k, b, token in tokens if len(owners[token]) <= 2 and len(texts_of[token]) <= 10]
        marks = [False] * len(text)
        for a, _, b in spans:
            marks[a:b] = [True] * (b - a)
        starts = {a for a, *_ in spans}
        out = "".join("\0" if m and (i in starts and (i == 0 or not marks[i - 1] or i in starts)) else "" if m else c
                      for i, (c, m) in enumerate(zip(text, marks)))
        return re.sub("\0+", secret_scan.REPLACEMENT, out)

    want = {d: redacted(t) for d, t in want.items()}
    assert kept_by["secret_scan"] == want
    pieces = Counter(r["doc_id"] for r in docs.collect())
    assert set(pieces) == set(want) and docs.columns[:4] == ["doc_id", "piece", "start", "length"]


def test_run_gives_the_last_stage(spark, tmp_path):
    folder = corpus.write_tables(spark, tmp_path, ROWS)
    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows and {"sequence_id", "offset"} <= set(rows[0].asDict())


def test_empty_documents(spark, tmp_path):
    folder = corpus.write_tables(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, folder).collect() == []
