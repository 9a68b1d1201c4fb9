import hashlib
import random
import zlib

import pytest

from homesense.llm import trie

SCHEMA = "conv_id long, turn int, role string, text string, node string, depth string, `last` string, skip string, n_convs string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "n", "d", "l", "s", "c") for r in rows], SCHEMA).repartition(3)


def conversations(seed, n=120):
    rng = random.Random(seed)
    openings = [("user", t) for t in ("hi", "hello", "", None, "é日")]
    rows = []
    for c in range(n):
        same = c % 3 == 0       # a third of the conversations are copies
        k = 5 if same else rng.randint(1, 9)
        for t in range(k):
            who, text = openings[0 if same else rng.choice([0, 0, 1, 2, 3, 4])]
            rows.append((c, t, who if t % 2 == 0 else rng.choice(["assistant", None]) if not same else "assistant", text))
    rows += [(500, None, "user", "no turn"), (500, 0, "user", "hi"), (500, 0, "user", "hi"), (None, 0, "user", "lost"),
             (301, 0, "user", "only"), (-7, 0, "user", "below"), (-7, 1, None, None)]
    rng.shuffle(rows)
    return rows


def ordered(rows):
    out = {}
    for c, turn, role, text in rows:
        if c is not None:
            out.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    # the operator orders equal turns by their hash; the fixture's equal turns are equal texts
    return {c: [(r, t) for _, _, r, t in sorted(ts, key=lambda x: x[:2])] for c, ts in out.items()}


def brute(seqs):
    members = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    out = set()
    for p, cs in members.items():
        below = [q for q in members if q[:len(p)] == p]
        leaves = [q for q in below if not any(len(x) == len(q) + 1 and x[:len(q)] == q for x in members)]
        kids = [q for q in below if len(q) == len(p) + 1]
        saved = sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q)
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(seqs[c]) == len(p)))
        out.add((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(kids), len(leaves), saved,
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def rebuilt(seqs):
    out = {}
    for c, own in seqs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = seqs.get(base, [])[:h] + own[h:]
    return out


def result(nodes, ends):
    empty = hashlib.sha256(b"").hexdigest()
    rows = nodes.join(trie.ends_digest(ends), "node", "left").collect()
    got = [(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256 or empty)
           for r in rows]
    return got


@pytest.mark.parametrize("top_nodes,queue", [(200_000, 100_000), (3, 100_000), (40, 8)])
def test_equals_brute_force(spark, top_nodes, queue):
    rows = conversations(top_nodes)
    for heads, seqs in ((trie.shared_heads, rebuilt(ordered(rows))), (None, ordered(rows))):
        got = result(*trie.prefix_trie(frame(spark, rows), heads=heads, top_nodes=top_nodes, queue=queue))
        want = brute(seqs)
        assert len(got) == len(want) and set(got) == want


def test_turnless_and_empty(spark):
    rows = [(c, 0, "user", "x") for c in range(1, 40)]      # no base conversation: those with a head lose their only turn
    seqs = rebuilt(ordered(rows))
    assert any(not s for s in seqs.values())
    assert set(result(*trie.prefix_trie(frame(spark, rows), heads=trie.shared_heads))) == brute(seqs)
    nodes, ends = trie.prefix_trie(frame(spark, rows).limit(0), heads=trie.shared_heads)
    assert nodes.count() == ends.count() == 0


def test_nodes_give_their_texts(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "a"), (2, 1, None, None)]
    df = frame(spark, rows)
    nodes, _ = trie.prefix_trie(df)
    got = nodes.join(trie.turn_texts(df), "turn_id").select("depth", "role", "text", "n_convs").collect()
    assert sorted(tuple(r) for r in got) == [(1, "user", "a", 2), (2, "", "", 1), (2, "assistant", "b", 1)]


def test_many_ends_at_one_node(spark, monkeypatch):
    monkeypatch.setattr(trie, "ROWS", 7)
    seqs = {c: [("user", "same")] for c in range(-50, 300)} | {900: []}
    nodes, ends = trie.prefix_trie(frame(spark, [(c, 0, "user", "same") for c in range(-50, 300)]))
    assert set(result(nodes, ends.repartition(5))) == brute({c: s for c, s in seqs.items() if s})


def test_one_long_conversation(spark):
    rows = [(7, k, "user", f"t{k % 5}") for k in range(3000)] + [(8, 0, "user", "t0")]
    nodes, _ = trie.prefix_trie(frame(spark, rows), top_nodes=10, queue=16)
    deep = nodes.filter("conv_id = 7").agg({"depth": "max", "n_leaves": "sum"}).first()
    assert deep[0] == 3000 and nodes.count() == 3001


def test_queue_spills_in_order():
    rng = random.Random(4)
    q, keys = trie.SpillingQueue(room=20), [(rng.randint(-9, -1), bytes([rng.randint(0, 30)])) for _ in range(3000)]
    for n, k in enumerate(keys):
        q.push(k, (n,))
    assert len(q.heap) <= 20 and len(q.runs) <= trie.RUNS + 1
    for key in sorted(set(keys)):
        assert sorted(m[0] for m in q.take(key)) == [n for n, k in enumerate(keys) if k == key]
    assert not q.heap and not q.runs
