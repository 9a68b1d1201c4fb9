import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from homesense.llm.packing import Encoder, default_tokenizer, first_fit_decreasing, pack_documents
from homesense.llm.sharding import lpt, shard_documents, write_shards
from tests.llm.cases import empty, frame, texts


def test_pieces_round_trip(spark):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = pack_documents(frame(spark), length=64, group_docs=10).collect()
    want = sorted((-1 if i is None else i, len(ids := tok.encode(t or "", add_special_tokens=False).ids) + 1,
                   zlib.crc32(np.array(ids + [0], "<u4").tobytes())) for i, t in texts())
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    ids_of = defaultdict(list)
    for i, t in texts():
        ids_of[i].append(tok.encode(t or "", add_special_tokens=False).ids + [0])
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append((r.offset, r.length))
        assert any(zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32
                   and len(ids) == r.doc_tokens for ids in ids_of[r.doc_id])
    assert sum(r.length for r in rows) == sum(n for _, n, _ in want)
    assert set(by_doc) == {i for i, _ in texts()}
    for parts in by_seq.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= 64
    assert pack_documents(empty(spark)).count() == 0


def test_pieces_hold_their_ids_and_rows(spark, monkeypatch):
    from homesense.llm import packing
    monkeypatch.setattr(packing, "BATCH_IDS", 500)
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows, docs = pack_documents(frame(spark), length=64, group_docs=10).collect(), defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        docs[r.row].append(r)
    got = []
    for parts in docs.values():
        parts.sort(key=lambda r: r.start)
        assert len({(r.doc_id, r.row_id, r.doc_tokens) for r in parts}) == 1
        got.append((parts[0].doc_id or -1, b"".join(r.ids for r in parts)))
    assert sorted(got) == sorted((i or -1, np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes())
                                 for i, t in texts())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_first_fit_decreasing_is_first_fit(sizes):
    bins, offsets = first_fit_decreasing(sizes, 64)
    free = []
    for i in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        k = next((k for k, f in enumerate(free) if f >= sizes[i]), len(free))
        if k == len(free):
            free.append(64)
        assert (bins[i], offsets[i]) == (k, 64 - free[k])
        free[k] -= sizes[i]


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="aé 1.\n\t'sß好  ", max_size=60))
def test_encoder_equals_tokenizers(text):
    paths = default_tokenizer()
    tok = Tokenizer.from_file(paths[0])
    assert Encoder(*paths)(text) == np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_encoder_with_special_token_text():
    paths = default_tokenizer()
    tok, text = Tokenizer.from_file(paths[0]), "a <|endoftext|> b"
    assert Encoder(*paths)(text) == np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_encoder_takes_a_text_in_one_call(monkeypatch):
    encode, calls = Encoder(*default_tokenizer()), []
    plain = encode.fast.encode_ordinary
    monkeypatch.setattr(encode.fast, "encode_ordinary", lambda x: calls.append(x) or plain(x))
    text = " ".join(f"word{k}" for k in range(3000))
    assert np.frombuffer(encode(text), "<u4").tolist() == plain(text) and calls == [text]


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="aé 1.\n\t'sß好  \x1c\x85\u2028", max_size=200))
def test_long_texts_are_cut_without_changing_ids(text):
    from homesense.llm import packing
    paths, before = default_tokenizer(), packing.TEXT_CHARS
    try:
        packing.TEXT_CHARS = 5
        parts, got = list(packing._cut(text)), Encoder(*paths)(text)
    finally:
        packing.TEXT_CHARS = before
    assert "".join(parts) == text and all(x[0] == " " and len(x) > 5 for x in parts[1:-1])
    assert got == np.array(Tokenizer.from_file(paths[0]).encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_shards(spark):
    docs = frame(spark)
    rows = shard_documents(docs, n_shards=4, fine=64).collect()
    sizes = sorted((-1 if i is None else i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts())
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.size, r.text_crc32) for r in rows) == sizes
    together, slots = defaultdict(set), defaultdict(list)
    for r in rows:
        together[(r.size, r.text_crc32)].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in together.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(4))
    assert shard_documents(empty(spark)).count() == 0


def test_written_shards_hold_every_row_once(spark, scratch):
    docs = frame(spark, texts() + [(None, None), (None, "nameless words here"), (14, "a third one")])
    write_shards(docs, f"{scratch}/shards", n_shards=4, fine=64)
    got = spark.read.parquet(f"{scratch}/shards")

    def rows(df, shard):
        return sorted(map(repr, df.select(*[c for c in docs.columns if c != "shard"], shard).collect()))
    assert rows(got.withColumnRenamed("shard", "at").withColumnRenamed("document_shard", "shard"), "shard") == rows(docs, "shard")
    want = [(-1 if r.doc_id is None else r.doc_id, r.text_crc32, r.shard)
            for r in shard_documents(docs, n_shards=4, fine=64).collect()]
    assert sorted((-1 if r.doc_id is None else r.doc_id, zlib.crc32((r.text or "").encode()), r.shard)
                  for r in got.collect()) == sorted(want)
    slots = defaultdict(list)
    for r in got.collect():
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_are_level(spark):
    rows = shard_documents(frame(spark, [(i, "w" * (i % 97)) for i in range(2000)]), n_shards=5, fine=64)
    load = [r.b for r in rows.groupBy("shard").agg({"size": "sum"}).toDF("shard", "b").collect()]
    assert len(load) == 5 and max(load) - min(load) <= 0.15 * sum(load) / 5   # 97 groups of equal texts


def test_lpt_takes_the_least_loaded():
    assert lpt([(5, "a"), (4, "b"), (3, "c"), (3, "d")], 2) == [("a", 0), ("b", 1), ("c", 1), ("d", 0)]
