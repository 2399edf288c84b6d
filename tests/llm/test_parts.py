"""The parts of the operators that need no Spark, and the shared graph step."""

from __future__ import annotations

import random
from collections import Counter
from itertools import product

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import exact_dedup, line_dedup, near_dedup, packing, sentence_pieces, substring_dedup
from ledgerloom.llm.components import components


@given(st.binary(max_size=300), st.binary(max_size=300))
@settings(max_examples=60, deadline=None)
def test_chunk_fingerprints_compose(a, b):
    hasher = exact_dedup.Hasher()
    whole, left, right = hasher(a + b), hasher(a), hasher(b)
    for i, prime in enumerate(exact_dedup.PRIMES):
        (h, s), (k, t) = left[2 * i : 2 * i + 2], right[2 * i : 2 * i + 2]
        assert whole[2 * i : 2 * i + 2] == [(h * t + k) % prime, s * t % prime]


def test_a_fingerprint_spans_blocks():
    data = bytes(random.Random(1).randbytes(3 * exact_dedup.BLOCK + 17))
    h = 0
    for c in data:
        h = (h * exact_dedup.BASES[0] + c + 1) % exact_dedup.PRIMES[0]
    assert exact_dedup.Hasher()(data)[0] == h


@given(st.lists(st.integers(0, 2**64 - 1), max_size=40))
def test_byte_planes_round_trip(values):
    a = np.array(values, np.uint64)
    assert substring_dedup.from_planes(substring_dedup.to_planes(a), len(a)).tolist() == values


@given(st.lists(st.tuples(st.integers(-(2**63), 2**63 - 1), st.integers(0, 2**31)), min_size=1, max_size=40))
def test_spots_round_trip(rows):
    rows.sort()
    ids, spots = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    back = substring_dedup.spots_from_bytes(*substring_dedup.spots_to_bytes(ids, spots))
    assert back[0].tolist() == ids.tolist() and back[1].tolist() == spots.tolist()


def test_window_hashes_agree_with_direct_sums():
    flat = np.array([random.Random(i).getrandbits(64) for i in range(50)], np.uint64)
    got = substring_dedup.window_hashes(flat, np.arange(38), 13)
    base = int(substring_dedup.BASE)
    for i in range(38):
        direct = sum(int(flat[i + k]) * pow(base, k, 1 << 64) for k in range(13)) % (1 << 64)
        assert got[i] == substring_dedup.mixed(np.array([direct], np.uint64))[0]


def one_at_a_time(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-two-fit, a bin after the other."""
    left, bins = sorted(lengths, reverse=True), []
    while left:
        gap, own = capacity, []
        for x in list(left):
            if x <= gap:
                own.append(x)
                left.remove(x)
                gap -= x
        if gap and len(own) > 1:
            least = min(own)
            others = list((Counter(left) - Counter([least] * left.count(least))).elements())
            pairs = [(a + b, a, b) for i, a in enumerate(others) for b in others[i + 1 :] if least < a + b <= gap + least]
            if pairs:
                best = max(pairs)[0]
                a, b = max((max(a, b), min(a, b)) for s, a, b in pairs if s == best)
                own.remove(least)
                left.append(least)
                own += [a, b]
                left.remove(a)
                left.remove(b)
                left.sort(reverse=True)
        bins.append(own)
    return bins


def test_plan_packs_like_single_bins():
    chance = random.Random(5)
    for capacity, n in product((10, 37, 100), (0, 1, 7, 60, 200)):
        lengths = [chance.choice([chance.randint(1, capacity), capacity // 3 + 1]) for _ in range(n)]
        counts, places = Counter(lengths), packing.plan(Counter(lengths), capacity)
        filled, last = Counter(), 0
        for size, rank, copies, sequence, offset in places:
            later = [p[1] for p in places if p[0] == size and p[1] > rank]
            for nth in range((min(later) if later else counts[size]) - rank):
                filled[sequence + nth // copies] += size
                last = max(last, offset + nth % copies * size + size)
        assert sum(filled.values()) == sum(lengths) and last <= capacity and all(v <= capacity for v in filled.values())
        assert len(filled) == len(one_at_a_time(lengths, capacity))


def best_score(text: str, pieces: dict[str, float], penalty: float) -> float:
    best = [0.0] + [-np.inf] * len(text)
    for end in range(1, len(text) + 1):
        best[end] = best[end - 1] + penalty
        for start in range(end):
            if text[start:end] in pieces:
                best[end] = max(best[end], best[start] + pieces[text[start:end]])
    return best[-1]


def test_viterbi_finds_the_best_path():
    with open(sentence_pieces.vocabulary_path(), "rb") as file:
        coder = sentence_pieces.coder(file.read())
    entries = coder.vocabulary.entries
    pieces = {p: s for p, s, kind in entries if kind == sentence_pieces.NORMAL}
    chance = random.Random(7)
    for _ in range(300):
        text = "".join(chance.choice("theanditor ▁é你\n\U0001f600x.") for _ in range(chance.randint(0, 14)))
        marked = coder.normalised(text)
        ids = np.frombuffer(coder.encode(text), "<i4").tolist()
        assert coder.decode(ids) == text.replace("▁", " ")
        score, run = 0.0, b""
        for i in ids:
            piece, value, kind = entries[i]
            if kind == sentence_pieces.BYTE:
                run += bytes([int(piece[3:5], 16)])
                if not run.decode("utf-8", "ignore"):
                    continue
                value, run = coder.penalty, b""
            score += value
        assert score == best_score(marked, pieces, coder.penalty)


def test_viterbi_agrees_with_the_library_on_words():
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    with open(sentence_pieces.vocabulary_path(), "rb") as file:
        content = file.read()
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(content)
    model.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    coder, chance = sentence_pieces.coder(content), random.Random(11)
    for _ in range(300):
        word = "".join(chance.choice("theanditorsuch") for _ in range(chance.randint(1, 12)))
        assert np.frombuffer(coder.encode(word), "<i4").tolist() == library.nbest_encode(word, nbest_size=2)[0]


def test_registers_merge_and_estimate():
    chance = np.random.default_rng(1)
    pool = chance.integers(0, 2**63, 3000, dtype=np.int64).astype(np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[1000:])
    regs = near_dedup.registers([a, b, np.union1d(a, b)])
    assert (near_dedup.merged(regs[0], regs[1]) == regs[2]).all()
    up, down = (regs[[0]] > regs[[1]]).sum(1), (regs[[0]] < regs[[1]]).sum(1)
    grid = np.linspace(0, 1, 101)
    size = np.array([2000.0])
    fit = near_dedup.log_likelihoods(up, down, regs.shape[1] - up - down, size, size, grid[None, :])[0]
    assert abs(grid[fit.argmax()] - 1 / 3) < 0.1
    assert near_dedup.plausible(regs[[0]], regs[[0]], size, size, 80).all()
    assert not near_dedup.plausible(regs[[0]], regs[[1]], size, size, 80).any()


def test_registers_do_not_depend_on_the_batch():
    chance = np.random.default_rng(2)
    sets = [np.unique(chance.integers(0, 2**62, n).astype(np.uint64)) for n in (1, 2, 5, 700, 30)] + [np.zeros(0, np.uint64)]
    whole = near_dedup.registers(sets)
    assert all((near_dedup.registers([s])[0] == row).all() for s, row in zip(sets, whole))
    assert (whole[-1] == 0).all()


def test_line_windows_select_what_they_hold():
    chance = random.Random(3)
    lines = [" ".join(chance.choice("abc") for _ in range(chance.randint(1, 4))).encode() for _ in range(600)]
    seen = {}
    for fingerprint, windows in line_dedup.winnowed(lines, 5):
        for w in windows:
            body = lines[w["start"] : w["stop"]]
            assert len(b" ".join(body).split()) >= 5 > len(b" ".join(body[:-1]).split())
            assert len(b" ".join(lines[w["stop"] :][: len(w["tail"])]).split()) < 5
            assert seen.setdefault(tuple(body), (w["hash"], fingerprint)) == (w["hash"], fingerprint)
    assert len({h for h, _ in seen.values()}) == len(seen) and len(seen) > 100
    (fingerprint, windows), = line_dedup.winnowed([b"a", b"b"], 5)
    assert [(w["start"], w["stop"], w["tail"]) for w in windows] == [(0, 2, [])]
    assert line_dedup.winnowed([], 5) == []


def test_components(spark):
    chance = random.Random(9)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(chance.randrange(200, 300), chance.randrange(200, 300)) for _ in range(60)]
    edges += [(5, 5), (7, 6), (100, 101)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u != v:
            a, b = root(u), root(v)
            parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for x in parent}


def test_word_ids_are_those_of_the_tokenizer():
    from tokenizers import Tokenizer

    path, chance = packing.vocabulary(), random.Random(1)
    tokenizer, encode = Tokenizer.from_file(path), packing.WordIds(path)
    alphabet = [chr(c) for c in range(0x180)] + list("abcdeéßüÉÀ ...'\"!?12 \n\t'sdtm") * 8 + ["<|endoftext|>", "<|", "ſ", "你", "́"]
    texts = ["".join(chance.choice(alphabet) for _ in range(chance.randrange(40))) for _ in range(4000)]
    letters = "etaoinshrdlucmfwypvbgkjqxzéßüñèóçäö"
    texts += ["".join(chance.choice(letters) for _ in range(chance.randrange(1, 16))) for _ in range(20000)]
    texts += [word.removesuffix("</w>") for word in tokenizer.get_vocab()]
    got = encode([t.encode() for t in texts])
    for text, own, want in zip(texts, got, tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
        assert np.frombuffer(own, "<u4").tolist() == want.ids, repr(text)
