"""Prefix-table encoding and packing against the libraries and brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from storelens.llm import packing, sentencepiece_bpe
from storelens.llm.queries import vocabulary
from tests.llm import frames

ODD = ["", " ", "  a  b ", "Ａﬁ x", "日本\U0001F600 ok", "<s>hi</s> [INST]", "\x00a\tb\nc", "▁x▁▁y", "a" * 3000,
       "é é ñ", "\n\n", "x\x1cy z\x85w \xa0q", "I'm we'll don't", "Ω ΑΣ ΑΣ. ΣΑΣ", "a <|endoftext|> b<|startoftext|>c",
       "end. Next,then! (so) \"q\" 12345 1,000.5", "İstanbul Straße ŒUVRE ǅ"]


def odd_texts():
    rng = random.Random(2)
    bits = ["the", "ing", " an", "tion", " ", "aa", "é", "日", ".", ",", "\n", "'s", "▁", "\U0001F600", "ß", "Q", "1", "\r", "İ"]
    return ODD + ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 30))) for _ in range(300)]


def test_encoding_equals_the_library(spark):
    import sentencepiece

    path = vocabulary("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [*odd_texts(), None]
    df = frames.docs(spark, list(enumerate(texts)))
    encoded = sentencepiece_bpe.sentencepiece_encode(df, path)
    ids = {r.doc_id: r.ids for r in encoded.collect()}
    decoded = {r.doc_id: r.text for r in sentencepiece_bpe.sentencepiece_decode(encoded, path).collect()}
    digest = {r.doc_id: r for r in sentencepiece_bpe.sentencepiece_digests(df, path).collect()}
    for i, text in enumerate(texts):
        want = [*library.encode(text or ""), library.eos_id()]
        assert ids[i] == want, repr(text)
        assert decoded[i] == library.decode(want), repr(text)
        assert (digest[i].n_tokens, digest[i].ids_sha256, digest[i].decoded_sha256) == (
            len(want), hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest(),
            hashlib.sha256(decoded[i].encode()).hexdigest())
    assert sentencepiece_bpe.sentencepiece_digests(frames.docs(spark, []), path).count() == 0


def test_word_ids_equal_the_library():
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = odd_texts()
    got = packing.word_encoder(path)(texts)
    for text, raw, want in zip(texts, got, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == want.ids, repr(text)


def brute_bins(lengths, capacity):
    """The least number of sequences, by trying everything (few pieces)."""
    best = [len(lengths)]

    def place(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + lengths[k] <= capacity and bins[i] not in bins[:i]:
                bins[i] += lengths[k]
                place(k + 1, bins)
                bins[i] -= lengths[k]
        bins.append(lengths[k])
        place(k + 1, bins)
        bins.pop()

    lengths = sorted(lengths, reverse=True)
    place(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(60))
def test_reduction_keeps_an_optimum(seed):
    """Fixed sets plus the best packing of the rest are as few as the best packing of all."""
    rng = random.Random(seed)
    lengths = [rng.randint(1, 20) for _ in range(rng.randint(1, 9))]
    counts = {n: lengths.count(n) for n in lengths}
    fixed, left = packing.dominance_reduction(counts, 20)
    rest = [n for n, c in left.items() for _ in range(c)]
    assert sum(t for _, t in fixed) + (brute_bins(rest, 20) if rest else 0) == brute_bins(lengths, 20)
    used = packing.best_fit(left, 20)
    assert all(sum(n * k for n, k in p) <= 20 for p, _ in fixed + used)
    placed = sorted(n for p, t in fixed + used for n, k in p for _ in range(k * t))
    assert placed == sorted(lengths)


def test_packed_pieces_are_whole_and_gapless(spark):
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = [*frames.corpus(7), (500, "word " * 5000)]
    got = packing.pack_documents(frames.docs(spark, rows), path, with_ids=True).collect()
    ids = {}
    for r in got:
        assert r.length * 4 == len(r.ids) and zlib.crc32(r.ids) == r.ids_crc32 and r.start == r.piece * 2048
        ids.setdefault(r.doc_id, {}).setdefault(r.piece, r.ids)
    for i, text in rows:
        if i is not None:
            whole = b"".join(ids[i][k] for k in sorted(ids[i]))
            want = [*library.encode(text or "", add_special_tokens=False).ids, 0]
            assert np.frombuffer(whole, "<u4").tolist() == want
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in got)
    assert -(-total // 2048) <= len(places) <= -(-total // 2048) + 2
    assert packing.pack_documents(frames.docs(spark, []), path).count() == 0


def test_common_length_in_many_buckets(spark, monkeypatch):
    """Ranks stay dense when one length is dealt to several buckets."""
    monkeypatch.setattr(packing, "BUCKET_ROWS", 100)
    pieces = spark.range(2000).selectExpr("id as uid", "cast(if(id % 3 = 0, 512, 1 + id % 50) as long) as length")
    got = packing.pack(pieces, 2048).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == 2000
    assert len({r.sequence_id for r in got}) <= -(-sum(r.length for r in got) // 2048) + 1
