"""Curve packing, ranked search and the Merkle manifest against brute force on awkward tables."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerloom.llm import curve_packing, merkle_manifest, queries, ranked_search
from tests.llm import corpus

ROWS = corpus.messy_documents()


@pytest.fixture(scope="module")
def messy(spark, tmp_path_factory):
    folder = corpus.write_tables(spark, tmp_path_factory.mktemp("messy"), ROWS)
    spark.createDataFrame(ITEMS, "item_id long, text string, doc_id long, row string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


WORDS = corpus.prose(3, 60)
ITEMS = [
    (1, " ".join(WORDS[5:40]), 7, "x"),
    (2, " ".join(corpus.prose(1, 120)), None, None),
    (3, "same LINE words of some", 1, "y"),
    (4, "", 1, "y"),
    (5, None, 1, "y"),
    (6, "nowhere2be3found", 1, "y"),
    (7, "KEY é 你好 tie", 1, "y"),
    (None, "the dog", 1, "y"),
    (8, " ".join(corpus.prose(12, 9000)[:300]), 1, "y"),
]


# --- curve packing ---------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("dimensions, bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_keys_walk_the_grid_in_unit_steps(dimensions, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)), np.int64)
    keys = curve_packing.hilbert_keys(points, bits)
    assert sorted(keys.tolist()) == list(range(len(points)))
    walk = points[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_byte_ids_are_those_of_the_tokenizer():
    path, ranks = curve_packing.vocabulary()
    encode, chance = curve_packing.ByteIds(path, ranks), random.Random(5)
    alphabet = [chr(c) for c in range(0x24F)] + list("  \n\n\t'sdtre ") * 20 + ["<|endoftext|>", "你", "\U0001f600", "ſ", "́"]
    texts = ["".join(chance.choice(alphabet) for _ in range(chance.randrange(60))) for _ in range(2000)]
    texts += [t or "" for _, t, *_ in ROWS]
    for text in texts:
        assert encode(text.encode()) == encode.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def check_packing(got, want_ids, capacity):
    """Every id lies in one piece; sequences are gapless and full or a power of two."""
    spans, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        spans[r["doc_id"]].append((r["start"], r["length"], r["doc_tokens"], r["ids_crc32"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(spans) == set(want_ids)
    for doc_id, ids in want_ids.items():
        own = sorted(spans[doc_id])
        copies = sum(start == 0 for start, *_ in own)
        assert sum(n for _, n, *_ in own) == copies * len(ids) and {t for *_, t, _ in own} == {len(ids)}
        assert {start for start, *_ in own} - {start + n for start, n, *_ in own} == {0}
        for start, n, _, crc in own:
            assert crc == zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())
    sizes = []
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        sizes.append(at)
    assert all(n <= capacity and (n == capacity or n & (n - 1) == 0) for n in sizes)
    assert sum(n < capacity for n in sizes) <= capacity.bit_length()
    return sizes


@pytest.mark.parametrize("capacity", [64, 100, 1024])
def test_curve_packing(spark, messy, capacity):
    docs = spark.read.parquet(f"{messy}/documents.parquet")
    paths = curve_packing.vocabulary()
    encode = curve_packing.ByteIds(*paths)
    rows = [r for r in ROWS if r[0] is not None]
    want = {d: encode((t or "").encode()) + [0] for d, t, *_ in rows}
    packed = curve_packing.curve_packed(docs.where("doc_id is not null"), *paths, capacity, with_ids=True).collect()
    sizes = check_packing(packed, want, capacity)
    assert sum(sizes) == sum(len(want[r[0]]) for r in rows)
    assert all(r["ids"] == want[r["doc_id"]][r["start"] : r["start"] + r["length"]] for r in packed)
    everything = queries.QUERIES["op11_curve_packing"](spark, messy).collect()
    assert sum(r["length"] for r in everything) == sum(len(encode((t or "").encode())) + 1 for _, t, *_ in ROWS)


def test_neighbours_on_the_curve_are_alike(spark):
    kinds = [corpus.prose(100 + k, 400) for k in range(8)]
    chance = random.Random(3)
    rows = [(i, " ".join(chance.choices(kinds[i % 8], k=300))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    packed = curve_packing.curve_packed(docs, *curve_packing.vocabulary()).orderBy("sequence_id", "offset").collect()
    order = list(dict.fromkeys(r["doc_id"] for r in packed))
    same = sum(a % 8 == b % 8 for a, b in zip(order, order[1:])) / len(order)
    assert same > 0.25  # an eighth by chance


# --- ranked search ---------------------------------------------------------------------------------------------------


def brute_ranking(rows, items, k=10):
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    docs = [(d, Counter(terms(t))) for d, t, *_ in rows]
    n_docs = sum(bool(c) for _, c in docs)
    total = sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = {}
    for item, text, *_ in items:
        scores = []
        for d, c in docs:
            n = sum(c.values())
            m = 10 + (90 * n * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in set(terms(text)) if c[t]
            )
            if score > 0:
                scores.append((-score, -1 if d is None else d))
        out[item] = [(rank, None if d < 0 else d, -s) for rank, (s, d) in enumerate(sorted(scores)[:k], 1)]
    return {item: found for item, found in out.items() if found}


def ranking_of(rows):
    out = defaultdict(list)
    for r in rows:
        out[r["item_id"]].append((r["rank"], r["doc_id"], r["score"]))
    return {item: sorted(found) for item, found in out.items()}


def test_ranked_search(spark, messy):
    assert ranking_of(queries.QUERIES["op12_ranked_search"](spark, messy).collect()) == brute_ranking(ROWS, ITEMS)


def test_ranked_search_with_frequent_terms_ties_and_many_accumulators(spark):
    chance = random.Random(8)
    vocabulary = corpus.prose(31, 300)
    weights = [1 / (i + 1) for i in range(300)]
    rows = [(i, " ".join(chance.choices(vocabulary, weights, k=chance.randint(1, 60)))) for i in range(600)]
    rows += [(600 + i, rows[i % 3][1]) for i in range(40)]
    items = [(i, " ".join(chance.choices(vocabulary, weights, k=40))) for i in range(25)] + [(99, vocabulary[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    queried = spark.createDataFrame(items, "item_id long, text string")
    for k in (1, 10):
        assert ranking_of(ranked_search.ranked(docs, queried, k).collect()) == brute_ranking(rows, items, k)


def test_closed_items_create_no_accumulators(spark):
    """A term in every second document is met by survivors only, once rarer terms decide."""
    rare = [f"rare{i}" for i in range(6)]
    rows = [(i, " ".join(rare + ["common"])) for i in range(12)] + [(100 + i, "common filler") for i in range(300)]
    rows += [(1000 + i, "filler other") for i in range(300)]
    search = ranked_search.Search(
        spark.createDataFrame(rows, "id long, text string"), spark.createDataFrame([(1, " ".join(rare + ["common"]))], "id long, text string"), 10
    )
    accumulators, state = search.survivors()
    assert accumulators.count() == 12 and state.first()["done"] < 7


# --- Merkle manifest -------------------------------------------------------------------------------------------------


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(doc_id, text, lang, source, n_chars):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def climbed(nodes, arity):
    """Levels from the leaves to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        own = levels[-1]
        levels.append([h(*own[i : i + arity]) for i in range(0, len(own), arity)])
    return levels


def siblings(levels, at, arity):
    out = []
    for level in levels[:-1]:
        first = at // arity * arity
        out.append((at - first, [x for i, x in enumerate(level[first : first + arity], first) if i != at]))
        at //= arity
    return out


def brute_manifest(rows, arity=2):
    """Sorted (doc_id, leaf, subroot, root, proof, folded root, verified)."""
    trees = defaultdict(list)
    for d, t, lang, source in rows:
        n = None if t is None else len(t)
        leaf = brute_leaf(d, t, lang, source, n)
        moved = d is not None and n is not None and zlib.crc32(str(d).encode()) % 7 == 0
        trees[lang].append((d is not None, d or 0, leaf, brute_leaf(d, t, lang, source, n + 1) if moved else leaf))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {name: climbed([x[2] for x in sorted(trees[name])], arity) for name in names}
    top, out = climbed([built[name][-1][0] for name in names], arity), []
    for i, name in enumerate(names):
        for at, (known, d, leaf, start) in enumerate(sorted(trees[name])):
            path = siblings(built[name], at, arity) + siblings(top, i, arity)
            own = start
            for slot, others in path:
                own = h(*others[:slot], own, *others[slot:])
            proof = h(*[x for _, others in path for x in others])
            out.append((d if known else None, leaf, built[name][-1][0], top[-1][0], proof, own, own == top[-1][0]))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_merkle_manifest(spark, messy):
    got = queries.QUERIES["op13_merkle_manifest"](spark, messy).collect()
    got = sorted((tuple(r[c] for c in COLUMNS) for r in got), key=str)
    assert got == brute_manifest(ROWS)
    tampered = {r[0] for r in got if not r[-1]}
    assert tampered == {d for d, t, *_ in ROWS if d is not None and t is not None and zlib.crc32(str(d).encode()) % 7 == 0}


@pytest.mark.parametrize("arity, n", [(3, 40), (4, 17), (2, 1), (3, 1), (2, 5)])
def test_merkle_runs_of_other_sizes(spark, arity, n):
    rows = [(i, f"text {i}", ("en", "de", None)[i * i % 3] if n > 1 else "en", "s") for i in range(n)]
    docs = spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars int")
    found = merkle_manifest.manifest(docs, arity)
    start = merkle_manifest.F.coalesce("changed", "digest")
    found = found.withColumn("proof", merkle_manifest.proof(found["path"])).withColumn("own", merkle_manifest.folded(start, found["path"]))
    got = [
        (r["doc_id"], r["digest"].hex(), r["subroot"].hex(), r["root"].hex(), h(r["proof"]), r["own"], r["own"] == r["root"].hex())
        for r in found.collect()
    ]
    assert sorted(got, key=str) == brute_manifest(rows, arity)
