from __future__ import annotations

import random
from collections import Counter

import numpy as np
import xxhash

from stratalog.llm import simhash as S
from stratalog.llm.simhash import SimhashConfig


def plain_code(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(codes, limit=2):
    """Smallest reachable place by comparing all pairs."""
    label = list(range(len(codes)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(codes)):
        for j in range(i):
            if bin(codes[i] ^ codes[j]).count("1") <= limit:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(codes))]


def signed(code):
    return code - (1 << 64) if code >> 63 else code


def test_fingerprints():
    for text in ("", " \t\n", "One", "one two", "A b C d É f", "the of and " * 50, "\x1c a \x85 b", "x " * 70_000):
        assert S.fingerprint_of(text.encode()) == plain_code(text), text[:20]


def cluster_codes(rng, centres, each):
    out = set()
    for _ in range(centres):
        code = rng.getrandbits(64)
        for _ in range(each):
            out.add(code)
            if rng.random() < 0.8:
                code ^= 1 << rng.randrange(64)
            if rng.random() < 0.3:
                code ^= 1 << rng.randrange(64)
    return sorted(out)


def linked_groups(spark, codes, cfg):
    frame = spark.createDataFrame([(signed(c),) for c in codes], "fp long")
    links = S.fingerprint_links(frame, cfg).collect()
    place = {signed(c): i for i, c in enumerate(codes)}
    for r in links:
        assert r["a"] != r["b"]
    roots = {r["a"]: r["root"] for r in S.connected(spark.createDataFrame([tuple(r) for r in links], "a long, b long")).collect()}
    got = [place[roots.get(signed(c), signed(c))] for c in codes]
    return got


def same_partition(one, two):
    return len(set(zip(one, two, strict=True))) == len(set(one)) == len(set(two))


def test_links_lose_none(spark):
    rng = random.Random(5)
    codes = cluster_codes(rng, 60, 15)
    for cfg in (SimhashConfig(), SimhashConfig(small_cell=2, large_cell=10_000), SimhashConfig(small_cell=2, large_cell=3), SimhashConfig(max_bits=3)):
        assert same_partition(linked_groups(spark, codes, cfg), groups(codes, cfg.max_bits))


def test_dense_group_stays_linear(spark):
    rng = random.Random(6)
    centre = rng.getrandbits(64)
    codes = sorted({centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(1_500)})
    frame = spark.createDataFrame([(signed(c),) for c in codes], "fp long")
    for cfg in (SimhashConfig(), SimhashConfig(large_cell=100)):
        assert S.fingerprint_links(frame, cfg).count() <= 6 * len(codes)
        assert same_partition(linked_groups(spark, codes, cfg), groups(codes))


def test_components():
    a, b = np.array([5, 1, 2, 7]), np.array([3, 2, 3, 8])
    assert S.components(9, a, b).tolist() == [0, 1, 1, 1, 4, 1, 6, 7, 7]


DATA = (
    [(7, "alpha beta gamma delta " * 30, "x", 1), (3, "ALPHA beta gamma delta " * 30, "x", 1), (3, "ALPHA beta gamma delta " * 30, "x", 1)]
    + [(9, None, None, None), (8, "", "x", 1), (12, " \n", "x", 1), (None, "quite another text", "x", 1), (None, None, "x", 1)]
    + [(20, " ".join(f"w{i}" for i in range(40_000)), "x", 1), (21, "lone", "x", 1), (21, "other text with one id", "x", 1)]
)


def test_hard_rows(spark):
    docs = spark.createDataFrame(DATA, "doc_id long, text string, fp string, root int")
    rows = S.near_duplicates(docs).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(d[0] for d in DATA)
    codes = [plain_code(d[1]) for d in DATA]
    least = {}
    roots = groups(codes)
    for d, r in zip(DATA, roots, strict=True):
        least[r] = min((x for x in (least.get(r), d[0]) if x is not None), default=None)
    want = Counter((d[0], signed(c), least[r]) for d, c, r in zip(DATA, codes, roots, strict=True))
    assert Counter((r["doc_id"], r["fp"], r["component_id"]) for r in rows) == want
    assert S.near_duplicates(docs.limit(0)).count() == 0
    kept = S.one_per_group(docs)
    assert kept.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(
        [(3, DATA[1][1]), (8, ""), (None, "quite another text"), (20, DATA[8][1]), (21, "lone"), (21, "other text with one id")]
    )
    assert S.one_per_group(docs.limit(0)).count() == 0
