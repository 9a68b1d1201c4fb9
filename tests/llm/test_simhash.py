import random
from itertools import combinations

import pytest
import xxhash

from homesense.llm.simhash import blocks_of_positions, fingerprint, hex16, simhash_components
from tests.llm.cases import empty, frame, texts


def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode()
    for c in b"\x09\x0a\x0b\x0c\x0d":
        low = low.replace(bytes([c]), b" ")
    words = [w for w in low.split(b" ") if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, fps, bits):
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in combinations(range(len(rows)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= bits:
            root[find(i)] = find(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(rows[i][0])
    return [min((x for x in members[find(i)] if x is not None), default=None) for i in range(len(rows))]


def key(x):
    return tuple(-1 if v is None else v for v in x)


def test_any_four_positions_hold_a_block():
    blocks = [set(b) for b in blocks_of_positions()]
    assert len(blocks) == 20
    assert all(any(b <= set(four) for b in blocks) for four in combinations(range(8), 4))


def test_components_against_brute_force(spark):
    rng = random.Random(1)
    rows = texts()
    base = rows[0][1].split()
    for k in range(60):    # near copies in chains and stars
        w = list(base)
        for _ in range(rng.randint(1, 4)):
            w[rng.randrange(len(w))] = "q%d" % rng.randrange(9)
        rows.append((100 + k, " ".join(w)))
    fps = [slow_fingerprint(t) for _, t in rows]
    assert fps == [fingerprint(None if t is None else t.encode()) for _, t in rows]
    want = sorted(zip([r[0] for r in rows], ["%016x" % f for f in fps], brute(rows, fps, 4)), key=key)
    got = simhash_components(frame(spark, rows)).select("doc_id", hex16().alias("f"), "component_id").collect()
    assert sorted(map(tuple, got), key=key) == want
    assert simhash_components(empty(spark)).count() == 0


def test_long_lists_in_blocks(spark, monkeypatch):
    from homesense.llm import lists
    rows = [(i, f"common words of every text {i % 40}") for i in range(300)]
    fps = [slow_fingerprint(t) for _, t in rows]
    want = sorted(zip([r[0] for r in rows], brute(rows, fps, 4)))
    monkeypatch.setattr(lists.blocked, "__defaults__", (3,))
    got = simhash_components(frame(spark, rows)).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, got)) == want


def test_bit_bound(spark):
    with pytest.raises(ValueError):
        simhash_components(empty(spark), max_bits=5)
