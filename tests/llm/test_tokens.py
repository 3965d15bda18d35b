"""Token operators against the libraries themselves, round trips and literal cases."""

import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from forgeline.llm import byte_bpe, packing, token_files, word_tokens

TEXTS = ["", None, "Hello, world.", "  two  spaces ", "tab\tand\nline\n\n end ", "it's we'll   x", "naïve İstanbul é́",
         "a" * 5000, "日本語 テキスト 123 45", "word, word. word; <|endoftext|> Word", "\x1c a \x85 b", "x  \n  y\r\n z", " .", ". . ...",
         "emoji 🙂🙂 ok", "don't DON'T", " lead", "trail ", "\n", " "]


def library_ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, part string")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", None) for i, t in enumerate(TEXTS)] + [(3, "again", None, "p"), (3, "again", None, "p"), (None, "no id", None, None)]
    return documents(spark, rows).repartition(3)


def test_word_encoder_matches_library(monkeypatch):
    got = word_tokens.WordEncoder(word_tokens.WORD_BPE).encode(TEXTS)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == library_ids(TEXTS)
    monkeypatch.setattr(word_tokens, "CACHED_CHUNKS", 4)     # the cache starts afresh all the time
    small = word_tokens.WordEncoder(word_tokens.WORD_BPE)
    assert [small.encode([t])[0] for t in TEXTS * 2] == got * 2


def test_word_encoder_keeps_words_without_their_marks():
    texts = ["one, two. one. two!? one", "Straße, straße; Ñandú... ñandú", "слово, 12, a1, (one) one) e.g., 日本, ,, $$$"] + TEXTS
    encoder = word_tokens.WordEncoder(word_tokens.WORD_BPE)
    ids, ends = encoder.encode_flat(texts)
    want = library_ids(texts)
    assert ids.tolist() == [i for ids in want for i in ids] and ends.tolist() == np.cumsum([len(w) for w in want]).tolist()
    assert {"one", "two", ".", "!?", "12,"} <= set(encoder.cache)
    assert not {"one,", "one.", "two.", "two!?", "Straße,"} & set(encoder.cache)
    assert encoder.encode([]) == [] and encoder.encode([None, ""]) == [b"", b""]


def test_token_files(spark, docs, tmp_path):
    path = str(tmp_path / "orc")
    token_files.write_token_files(docs, path)
    files = token_files.read_token_files(spark, path)
    rows = token_files.document_index(files).collect()
    ids = {i: v + [token_files.END_ID] for i, v in enumerate(library_ids(TEXTS))}
    at = 0
    order = sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.start))
    for r in order:
        assert r.start == at
        at += r.n_tokens
        if r.doc_id not in (None, 3):
            want = np.array(ids[r.doc_id], "<u4")
            assert (r.n_tokens, r.ids_crc32) == (len(want), zlib.crc32(want.tobytes()))
    assert len(rows) == docs.count()
    assert token_files.read_token_files(spark, path, [5]).collect()[0].ids == ids[5]
    token_files.write_token_files(docs.limit(0), path)
    assert token_files.document_index(token_files.read_token_files(spark, path)).count() == 0


@pytest.mark.parametrize("size,windows", [(8, 2), (64, 3), (4096, 16)])
def test_packing_places_each_id_once(spark, docs, size, windows):
    rows = packing.pack_documents(docs, size=size, windows=windows).collect()
    ids = {i: np.array(v + [packing.END_ID], "<u4") for i, v in enumerate(library_ids(TEXTS))}
    for i, v in ids.items():
        if i == 3:
            continue
        at = 0
        for p in sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start):
            assert p.start == at and p.doc_tokens == len(v)
            assert p.ids_crc32 == zlib.crc32(v[at:at + p.length].tobytes())
            at += p.length
        assert at == len(v)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    fills = []
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= size
        fills.append(at)
    assert sum(f < size for f in fills) <= 1          # one merge group: one part-filled sequence
    assert {r.doc_id for r in rows if r.doc_id is None} == {None}
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_packer_is_bounded_and_best_fit():
    p = packing.Packer(10, 2)
    ids = lambda n: bytes(4 * n)
    assert [list(p.place(0, ids(6))), list(p.place(1, ids(8)))] == [[], []]
    assert list(p.place(2, ids(2)))[0][1][0] == 2     # best fit: the window with room 2, now full
    assert list(p.place(3, ids(9))) == [] and p.room == [4, 1]
    full = list(p.place(4, ids(7)))                   # none fits: the fullest is topped up and leaves
    assert len(full) == 1 and sum(len(x[2]) for x in full[0]) == 40 and len(p.open) <= 2


@pytest.mark.parametrize("name", ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def test_byte_bpe_matches_library(name):
    import base64
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(name), "rb"))}
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    mine = byte_bpe.ByteBPE(P.path(name), P.PATTERN)
    assert all(mine.hash.get(t) == i for t, i in ranks.items()) and mine.hash.get(b"\x00no such token") is None
    assert sorted(i for i in mine.hash.ids) == sorted(ranks.values())
    for t in TEXTS + ["  a", "a  b", "\n a", "a \n b", " \t ", "a\n b", "x " * 50]:
        ids = lib.encode_ordinary(t or "")
        assert mine.encode(t or "") == ids, t
        assert mine.decode(ids) == (t or "").encode()
    assert byte_bpe.merge_bytes(b"abab", {b"a": 0, b"b": 1, b"ab": 2, b"abab": 3}) == [3]


def test_round_trip(spark, docs):
    rows = {r.doc_id: r for r in byte_bpe.round_trip(docs).collect()}
    for i, t in enumerate(TEXTS):
        if i != 3:
            assert rows[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert rows[0].n_tokens == rows[1].n_tokens == 0
    back = byte_bpe.decode_documents(byte_bpe.encode_documents(docs)).where("doc_id = 8").collect()
    assert bytes(back[0].data).decode() == TEXTS[8]
    assert byte_bpe.round_trip(docs.limit(0)).count() == 0
