"""Byte-pair encoding and decoding by merge ranks, equal to the tokenizers library.

A text is cut at the special tokens, then into words between whitespace; no rule of the supported
files looks across whitespace, so a batch encodes each of its distinct words once. A word is
normalised and cut by the file's own rules (the library's normaliser and pre-tokenizer, as their
Unicode tables decide), and each piece is merged here.

A piece is held as a contiguous array of parts with the rank of each adjacent pair. The least rank is
searched again and again, the boundary inside its pair is deleted and the ranks beside it are looked
up anew. This is the fastest way for short words, but quadratic; pieces of more than SHORT parts
keep their pairs in a heap instead and merge in the same order.

A null or blank text has no tokens and decodes to an empty text. Repeated rows are encoded each;
columns that are not carried are never read. Supported: BPE files with NFC, whitespace and lowercase
normalisers, a split pattern, byte-level symbols, added tokens without white space that are not
normalised, and no decoder; others raise a ValueError.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from quipyard.llm.words import Memo, gather, slices, split_words, sums

#: Most parts of a piece that is merged by scanning.
SHORT = 128
_NONE = (1 << 60, 0)


class RankedBpe:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        _check(spec)
        model, rules = spec["model"], Tokenizer.from_file(path)
        vocab: dict[str, int] = model["vocab"]
        self.normalise, self.cut = rules.normalizer.normalize_str, rules.pre_tokenizer.pre_tokenize_str
        #: (left id, right id) -> (rank, merged id)
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(model["merges"])}
        self.inner = {token: i for token, i in vocab.items() if len(token) == 1}
        suffix = model["end_of_word_suffix"] or ""
        self.last = {token: vocab[token + suffix] for token in self.inner}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.marks = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        names = {i: token for token, i in {**vocab, **self.special}.items()}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]

    def merge(self, parts: list[int]) -> list[int]:
        """Ids of one piece from the ids of its symbols."""
        return _merge_short(parts, self.merges) if len(parts) <= SHORT else _merge_long(parts, self.merges)

    def _piece(self, symbols: str) -> list[int]:
        parts = [self.inner[symbol] for symbol in symbols]
        parts[-1] = self.last[symbols[-1]]
        return self.merge(parts)

    def _plain(self, text: str) -> list[int]:
        if text.isascii() and text.isalpha():  # one piece, and its symbols are its letters
            return self._piece(text.lower())
        ids: list[int] = []
        for piece, _ in self.cut(self.normalise(text)):
            ids += self._piece(piece)
        return ids

    def encode(self, text: str) -> list[int]:
        if "<" not in text:
            return self._plain(text)
        ids, at = [], 0
        for match in self.marks.finditer(text):
            ids += self._plain(text[at : match.start()])
            ids.append(self.special[match.group()])
            at = match.end()
        return ids + self._plain(text[at:])

    def decode(self, ids) -> str:
        """Tokens of the ids, special ones too, with blanks between."""
        return " ".join(map(self.names.__getitem__, ids))


def _check(spec: dict) -> None:
    normal = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    steps = [p["type"] for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
    added = [t["normalized"] or t["single_word"] or len(t["content"].split()) != 1 for t in spec["added_tokens"]]
    if (
        spec["model"]["type"] != "BPE"
        or normal != ["NFC", "Replace", "Lowercase"]
        or steps != ["Split", "ByteLevel"]
        or spec["decoder"] is not None
        or any(added)
    ):
        raise ValueError("not a BPE file of the supported kind")


def _merge_short(parts: list[int], merges: dict) -> list[int]:
    get = merges.get
    pairs = [get(pair, _NONE) for pair in zip(parts, parts[1:])]
    while pairs:
        best = min(pairs)  # a rank belongs to one pair, so the first of equals is the leftmost
        if best is _NONE:
            break
        i = pairs.index(best)
        parts[i : i + 2] = [best[1]]
        del pairs[i]
        if i:
            pairs[i - 1] = get((parts[i - 1], parts[i]), _NONE)
        if i < len(pairs):
            pairs[i] = get((parts[i], parts[i + 1]), _NONE)
    return parts


def _merge_long(parts: list[int], merges: dict) -> list[int]:
    n, get = len(parts), merges.get
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(m[0], i, a, b, m[1]) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (m := get((a, b)))]
    heapq.heapify(heap)
    while heap:
        _, i, a, b, new = heapq.heappop(heap)
        j = after[i] if parts[i] == a else n
        if j >= n or parts[j] != b:
            continue  # one of the two has been merged meanwhile
        parts[i], parts[j], after[i] = new, -1, after[j]
        if after[i] < n:
            before[after[i]] = i
            if m := get((new, parts[after[i]])):
                heapq.heappush(heap, (m[0], i, new, parts[after[i]], m[1]))
        if (h := before[i]) >= 0 and (m := get((parts[h], new))):
            heapq.heappush(heap, (m[0], h, parts[h], new, m[1]))
    return [p for p in parts if p >= 0]


@lru_cache(maxsize=2)
def _coder(path: str) -> tuple[RankedBpe, Memo]:
    coder = RankedBpe(path)
    return coder, Memo(lambda words: [np.array(coder.encode(word), "<u4").tobytes() for word in words])


def encode_batch(path: str, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Number of tokens of each text, and all ids one after the other."""
    n_words, codes, distinct = split_words(texts)
    coded = _coder(path)[1](distinct.to_pylist())
    sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
    return sums(sizes[codes], n_words), gather(codes, sizes, np.frombuffer(b"".join(coded), "<u4"))


_ROWS = "n_tokens BIGINT, ids BINARY, decoded STRING"
_DIGESTS = "n_tokens BIGINT, ids_sha256 STRING, decoded_sha256 STRING"


def _rows(path: str, text: str, carry: list[str], digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(_coder(path)[0].names, dtype=object)
        for batch in slices(batches, text):
            counts, ids = encode_batch(path, batch.column(text))
            ends = np.cumsum(counts).tolist()
            tokens = names[ids].tolist()
            data = [ids[e - n : e].tobytes() for e, n in zip(ends, counts.tolist())]
            decoded = [" ".join(tokens[e - n : e]) for e, n in zip(ends, counts.tolist())]
            columns = [batch.column(name) for name in carry] + [pa.array(counts, pa.int64())]
            if digests:
                columns += [
                    pa.array([hashlib.sha256(x).hexdigest() for x in data], pa.string()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded], pa.string()),
                ]
            else:
                columns += [pa.array(data, pa.binary()), pa.array(decoded, pa.string())]
            fields = _DIGESTS if digests else _ROWS
            yield pa.RecordBatch.from_arrays(columns, carry + [f.split()[0] for f in fields.split(", ")])

    return run


def encode_decode(
    docs: DataFrame, path: str, text: str = "text", carry: tuple[str, ...] = ("doc_id",), digests: bool = False
) -> DataFrame:
    """`carry`, n_tokens, ids (little-endian unsigned 32-bit) and the decoded text of each row.

    With `digests`, SHA-256 of the two instead, ids_sha256 and decoded_sha256. A narrow step: no
    shuffle, a few megabytes of text in memory. `path` must be readable on every executor.
    """
    names = list(carry)
    source = docs.select(*names, text) if text not in names else docs.select(*names)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema]
    schema = ", ".join([*fields, _DIGESTS if digests else _ROWS])
    return source.mapInArrow(_rows(path, text, names, digests), schema)
