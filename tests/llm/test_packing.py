import random
import zlib

import numpy as np
from helpers import WORDS, clashing, documents, odd_rows, prose

from shiplabel.llm import packing


def test_ids_are_the_tokenizers():
    encode = packing.Encoder()
    rng = random.Random(5)
    parts = ["a", "The", "é", "ß", " ", "\n", "'s", "12", ".", ",", '"', "\t", "日", "🙂", "Ñ", "-", "²", "\r", "don't", "_", "\xa0", "%%%", "|", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    for text, together in zip(texts, encode.each(texts), strict=True):
        assert encode(text) == together == encode.by_tokenizer(text), text
    assert packing.Encoder(ranks=None)("The house, é") == encode("The house, é")


def test_long_texts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(packing, "TOGETHER", 50)
    encode = packing.Encoder()
    rng = random.Random(6)
    texts = ["", " a", "x" * 300, *(prose(rng, n, "en") for n in (1, 5, 9, 200, 3, 40)), "a\nb, c\n\nd " * 40 + "e"]
    assert list(encode.each(texts)) == [encode.by_tokenizer(t) for t in texts]


def test_distinct():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 500):
        ids = rng.integers(0, 50, n).astype(np.uint16)
        assert (packing.distinct(ids) == np.unique(ids)).all()


def test_every_token_once(spark):
    encode = packing.Encoder()
    rows = odd_rows()
    got = packing.packed(clashing(documents(spark, rows)), length=256).collect()
    want = sorted(((r[0], len(encode.by_tokenizer(r[1] or "")) // 2 + 1) for r in rows), key=repr)
    assert sum(r["length"] for r in got) == sum(n for _, n in want)
    unique = {r[0]: r[1] for r in rows if r[0] not in (3, None)}
    for key, text in unique.items():
        ids = np.append(np.frombuffer(encode.by_tokenizer(text or ""), np.uint16), 0).astype("<u4")
        at = 0
        for p in sorted((p for p in got if p["doc_id"] == key), key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    sequences = {}
    for p in got:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 256
    assert sum(sum(n for _, n in p) < 256 for p in sequences.values()) <= 1
    assert packing.packed(documents(spark, [])).count() == 0


def test_neighbours_share_windows(spark):
    """Short documents of two languages, mixed by id: windows should mostly hold one language."""
    rng = random.Random(9)
    rows = [(i, prose(rng, 30, "de" if i % 2 else "en")) for i in range(300)]
    sequences = {}
    for p in packing.packed(documents(spark, rows)).collect():
        sequences.setdefault(p["sequence_id"], []).append(p["doc_id"] % 2)
    pure = sum(max(x.count(0), x.count(1)) for x in sequences.values()) / sum(map(len, sequences.values()))
    assert pure > 0.9, pure


def test_bm25_against_formula():
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 40, n).astype(np.uint16) for n in (5, 30, 80, 12)]
    idf = np.zeros(1 << 16)
    idf[:40] = np.maximum(0, rng.normal(1, 1, 40))
    mean = 30.0
    query = np.unique(docs[1])
    query = query[idf[query] > 0]
    want = [
        sum(
            idf[t] * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * len(d) / mean))
            for t in query
            if (tf := int((d == t).sum()))
        )
        for d in docs
    ]
    assert np.allclose(packing.Shard(docs, idf, mean).scores(query), want)


def test_document_frequencies(spark):
    rows = [(i, " ".join(WORDS["en"][: i + 1])) for i in range(6)]
    tokens = packing.tokenised(documents(spark, rows).repartition(3))
    encode = packing.Encoder()
    want = np.zeros(1 << 16, int)
    for _, text in rows:
        want[np.unique(np.frombuffer(encode(text), np.uint16))] += 1
    assert (packing.document_frequencies(tokens) == want).all()
