import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from sluice.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [1]


def test_words_encode_as_texts_do():
    t = Tokenizer.from_file(PATH)
    texts = ["", " \n", "It's I'LL 'tis'd", "<|endoftext|> a<|startoftext|>b", "x\x1cy \x85 q\xa0r", "İ ẖ Σας", "日本 abc123 ½", "á ́x", "a,b!? 3.14", "A" * 300, "w " * 5000]
    got = packing.WordEncoder(PATH).encode(texts)
    assert got == [np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]


def test_a_full_store_is_emptied(monkeypatch):
    monkeypatch.setattr(packing, "WORDS_KEPT", 10)
    monkeypatch.setattr(packing, "BLOCK", 40)
    text = " ".join(f"word{i}" for i in range(60))
    t = Tokenizer.from_file(PATH)
    e = packing.WordEncoder(PATH)
    for x in (text, text[:30], text):
        assert e.encode([x]) == [np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes()]


def test_first_fit_decreasing_is_first_fit():
    r = np.random.default_rng(1)
    lengths = r.integers(1, 100, 300).tolist()
    bins, offsets = packing.first_fit_decreasing(lengths, 100)
    room, plain = [], {}
    for i in sorted(range(300), key=lambda i: -lengths[i]):
        b = next((b for b, x in enumerate(room) if x >= lengths[i]), len(room))
        room += [100] * (b == len(room))
        plain[i] = (b, 100 - room[b])
        room[b] -= lengths[i]
    assert [plain[i] for i in range(300)] == list(zip(bins, offsets))


def check(pieces, docs, payload):
    by_doc, by_seq = {}, {}
    for r in pieces:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for rows in by_seq.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 64
    for i, text in docs:
        ids, at = np.array(ids_of(text), "<u4"), 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            part = ids[at : at + r["length"]].tobytes()
            assert (r["start"], r["doc_tokens"]) == (at, len(ids)) and (bytes(r[payload]) == part if payload == "ids" else r[payload] == zlib.crc32(part))
            at += r["length"]
        assert at == len(ids)
    assert len(by_doc) == len(docs)


@pytest.mark.parametrize("payload", ["ids", "crc32"])
def test_every_id_is_packed_once(documents, corpus, clashing, payload):
    pieces = packing.pack_documents(clashing(documents), PATH, capacity=64, group_docs=20, payload=payload).collect()
    check(pieces, corpus, payload)
    spent = len({r["sequence_id"] for r in pieces}) * 64
    assert sum(r["length"] for r in pieces) / spent > 0.9


def test_sequences(spark):
    for texts in (["a b c", "d e", None], ["a b c d", "e", "f g h i j k l m n o p q"]):
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        out = packing.sequences(packing.pack_documents(docs, PATH, capacity=16), 16, pad_id=0).collect()
        for r in out:  # a power of two stays as it is
            assert len(r["ids"]) == 4 * (r["tokens"] if r["tokens"] in (1, 2, 4, 8, 16) else 16)
        assert sum(r["tokens"] for r in out) == sum(len(ids_of(t)) for t in texts)


def test_another_kind_of_tokenizer_is_refused(spark):
    import public_tokenizers

    with pytest.raises(ValueError, match="not a lower-casing word BPE"):
        packing.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))


def test_repeated_null_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, None)], "doc_id long, text string")
    pieces = packing.pack_documents(docs, PATH, payload="crc32").collect()
    assert len(pieces) == 4 and sum(r["length"] for r in pieces) == 7 and len({(r["sequence_id"], r["offset"]) for r in pieces}) == 4
    assert packing.pack_documents(docs.limit(0), PATH).count() == 0
