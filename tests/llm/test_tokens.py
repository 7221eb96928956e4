import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quipyard.llm import bpe, token_shards

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = [
    None,
    "",
    " \t\n",
    "Hello  World's, I'VE 12345 naïve Straße ÀÉ.",
    "<|endoftext|>a<|StartOfText|><|startoftext|> b",
    "ᲉİΣͅ ﬁ é 　x y z",
    "日本語 \U0001f600\U0001f600 a" + "b" * 300,
    "Hello  World's",
    "thenbleing? " * 2000,
]


def expected(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("encode", [bpe.encode_batch, token_shards.encode_batch])
def test_batches_equal_the_library(encode):
    counts, ids = encode(PATH, pa.array(TEXTS, pa.string()))
    want = [expected(t) for t in TEXTS]
    assert counts.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]


@given(st.text(st.sampled_from("aAéßΣσ '’tsv.<|>endoft́\n1٣") | st.characters(codec="utf-8"), max_size=40))
@settings(max_examples=400, deadline=None)
def test_any_text_equals_the_library(text):
    want = expected(text)
    assert bpe.RankedBpe(PATH).encode(text) == want if len(text) == 40 else True
    for encode in (bpe.encode_batch, token_shards.encode_batch):
        assert encode(PATH, pa.array([text]))[1].tolist() == want


@given(st.text("aeinorst", min_size=2, max_size=120))
@settings(max_examples=200, deadline=None)
def test_both_ways_to_merge_agree(word):
    coder = bpe._coder(PATH)[0]
    parts = [coder.inner[c] for c in word]
    assert bpe._merge_short(list(parts), coder.merges) == bpe._merge_long(list(parts), coder.merges)


def test_unsupported_file_is_refused():
    with pytest.raises(ValueError):
        bpe.RankedBpe(public_tokenizers.path("byte_bpe_50k.json"))


def test_encode_decode(table):
    docs = table("doc_id BIGINT, text STRING, ids STRING, n_tokens INT", *[(i, t, "clash", 1) for i, t in enumerate(TEXTS)])
    rows = sorted(bpe.encode_decode(docs, PATH).collect())
    digests = sorted(bpe.encode_decode(docs, PATH, digests=True).collect())
    for text, row, digest in zip(TEXTS, rows, digests, strict=True):
        ids = expected(text)
        data = np.array(ids, "<u4").tobytes()
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        assert (row.n_tokens, bytes(row.ids), row.decoded) == (len(ids), data, decoded)
        assert digest.ids_sha256 == hashlib.sha256(data).hexdigest()
        assert digest.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe.encode_decode(docs.filter("false"), PATH).count() == 0


def test_wavelet_matrix():
    pick = random.Random(3)
    for n, most in [(0, 1), (1, 0), (700, 0), (3000, 5), (5000, 70_000)]:
        ids = np.array([pick.randint(0, most) for _ in range(n)], np.uint32)
        matrix = token_shards.WaveletMatrix.from_bytes(token_shards.WaveletMatrix.build(ids).to_bytes())
        assert matrix.tokens().tolist() == ids.tolist()
        for i in pick.sample(range(n), min(n, 40)):
            token = int(ids[i])
            before = int((ids[:i] == token).sum())
            assert matrix.access(i) == token and matrix.rank(token, i) == before
            assert matrix.select(token, before) == i
            assert matrix.count(token, i // 2, i) == int((ids[i // 2 : i] == token).sum())
        assert matrix.count(most + 1) == matrix.count(1 << 40) == 0
        with pytest.raises(IndexError):
            matrix.access(n)
        with pytest.raises(IndexError):
            matrix.select(0, n)


def test_an_access_opens_few_frames():
    n = 300_000
    ids = np.random.default_rng(5).zipf(1.3, n).clip(max=49_000).astype(np.uint32)
    lengths = np.array([100_000, 0, 200_000])
    data = token_shards.WaveletMatrix.build(ids, lengths).to_bytes()
    assert len(data) < 2 * n * 1.1
    for place in (0, 511, 512, 32_768, 123_456, n - 1):
        matrix = token_shards.WaveletMatrix.from_bytes(data)
        assert matrix.access(place) == ids[place]
        assert len(matrix._open) <= matrix.width and sum(map(len, matrix._open.values())) <= matrix.width * 4096
        before = int((ids[:place] == ids[place]).sum())
        assert matrix.rank(int(ids[place]), place) == before and matrix.select(int(ids[place]), before) == place
        assert len(matrix._open) <= token_shards._OPEN
    assert matrix.documents == 3 and matrix.lengths().tolist() == lengths.tolist()
    assert matrix.tokens().tolist() == ids.tolist()
    with pytest.raises(ValueError):
        token_shards.WaveletMatrix.from_bytes(b"QYWMAT01" + data[8:])


@pytest.mark.parametrize("shard_tokens", [1, 50, 1 << 20])
def test_shards_are_read_back(spark, table, shard_tokens):
    ids = [7, 3, None, 12, 5, 3, 100, -4, 50]
    docs = table("doc_id BIGINT, text STRING, part INT", *[(i, t, 9) for i, t in zip(ids, TEXTS)])
    folder = token_shards.write_shards(docs, PATH, shard_tokens=shard_tokens)
    rows = token_shards.read_documents(spark, folder).collect()
    rows.sort(key=lambda r: r.start)
    start = 0
    assert [r.doc_id for r in rows] == [None, -4, 3, 3, 5, 7, 12, 50, 100]
    texts = {(i, zlib.crc32(np.array([*expected(t), 1], "<u4").tobytes())) for i, t in zip(ids, TEXTS)}
    assert {(r.doc_id, r.ids_crc32) for r in rows} == texts
    for r in rows:
        assert r.start == start
        start += r.n_tokens
    every = [i for r in rows for i in next(
        [*expected(t), 1] for d, t in zip(ids, TEXTS)
        if d == r.doc_id and zlib.crc32(np.array([*expected(t), 1], "<u4").tobytes()) == r.ids_crc32)]
    places = sorted(r.place for r in token_shards.find_token(spark, folder, 1).collect())
    assert places == [i for i, token in enumerate(every) if token == 1]


def test_no_documents(spark, table):
    docs = table("doc_id BIGINT, text STRING")
    folder = token_shards.write_shards(docs, PATH)
    assert token_shards.read_documents(spark, folder).count() == 0


def test_ids_of_known_words_are_kept():
    asked = []

    def compute(words):
        asked.extend(words)
        return np.array([len(w) for w in words]), np.array([ord(c) for w in words for c in w], np.uint32)

    known = token_shards._Known(compute, most=4)
    for words in (["a", "bc", "", "a"], ["bc", "d"], [], ["x" * 300, "d"], ["e", "f"], ["bc", "d", "e"], ["x" * 300]):
        sizes, flat = known(pa.array(words, pa.large_string()))
        assert sizes.tolist() == [len(w) for w in words]
        assert "".join(map(chr, flat)) == "".join(words)
        assert len(known.words) == len(known.sizes) <= 4 and len(known.flat) == known.sizes.sum() < 256
    assert [asked.count(w) for w in ("a", "bc", "d", "e", "f", "x" * 300)] == [1, 2, 1, 1, 1, 2]
