"""Token ids in shards, each a wavelet matrix: one compressed image that answers queries as it is.

Documents are encoded with the tokenizers library, an end id is added to each, and the ids of all
documents in ascending `doc_id` order (null first, repeated ids side by side in no fixed order) form
one long sequence, cut into shards of about SHARD_TOKENS at ends of documents. A shard is one row of a
Parquet table in the shared folder, written by Spark's committer, so a task that is run again leaves
nothing twice. Its image holds, per bit of an id, the stably sorted bits of all tokens with a rank
directory; access, rank, select and counting of a token need a step per bit and no decoding.

Image, little-endian: 8 bytes magic, 32-bit width, 64-bit numbers of tokens and documents; per plane,
most significant first, its number of zeros and its bytes (64 bits each); then the planes; then a zstd
frame of the documents' lengths (64 bits each). A plane holds the ones before each block of 512 bits
and before its end (32 bits each, not zipped), the ends of its frames (32 bits each), and per 32,768
bits a zstd frame of the packed bits, or the bits themselves where zipping gains nothing. So rank and
select read a few words of the directory and open one frame per plane.

A null or blank text has its end id only. A document longer than a shard makes a longer shard. An
empty table gives no shards.
"""

from __future__ import annotations

import json
import struct
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quipyard.llm.words import gather, slices, split_words, sums
from quipyard.session import scratch_path

#: Tokens after which a shard is closed.
SHARD_TOKENS = 1 << 20
END_ID = 1
#: Bytes of text whose words are looked up at once.
WORDS_BYTES = 8 << 20
MAGIC = b"QYWMAT02"
_HEAD = "<8sIQQ"
_HEAD_SIZE = struct.calcsize(_HEAD)
#: Bits to a rank word, bits to a frame, and frames that stay open.
_BLOCK = 512
_GROUP = 1 << 15
_OPEN = 64
#: Letters that normalise to one lowercase letter each, and stops that always part from them.
_LATIN, _STOPS = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$", ".,;:!?"


class WaveletMatrix:
    """Sequence of ids as bit planes in one image; a query opens the frames it touches, no others."""

    def __init__(self, image: bytes):
        self.image = memoryview(image)
        magic, self.width, self.n, self.documents = struct.unpack_from(_HEAD, image)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        sizes = np.frombuffer(image, "<u8", 2 * self.width, _HEAD_SIZE).reshape(self.width, 2)
        self.zeros = sizes[:, 0].tolist()
        self.starts = np.cumsum([_HEAD_SIZE + 16 * self.width, *sizes[:, 1].tolist()]).tolist()
        self.blocks, self.groups = -(-self.n // _BLOCK), -(-self.n // _GROUP)
        self._open: dict[tuple[int, int], bytes] = {}
        self._unzip = zstandard.ZstdDecompressor()

    @classmethod
    def build(cls, ids: np.ndarray, lengths: np.ndarray | None = None) -> WaveletMatrix:
        """Of the ids of documents of these lengths, or of one document."""
        lengths = np.array([len(ids)]) if lengths is None else lengths
        width = max(1, int(ids.max(initial=0)).bit_length())
        x = ids.astype(np.uint16 if width <= 16 else np.uint32)
        zeros, planes = [], []
        for bit in range(width - 1, -1, -1):
            ones = (x >> bit & 1).astype(bool)
            planes.append(cls._section(ones))
            low = np.compress(~ones, x)
            zeros.append(len(low))
            x = np.concatenate((low, np.compress(ones, x)))
        head = struct.pack(_HEAD, MAGIC, width, len(ids), len(lengths))
        table = b"".join(struct.pack("<QQ", z, len(p)) for z, p in zip(zeros, planes))
        ends = zstandard.ZstdCompressor(level=1).compress(lengths.astype("<u8").tobytes())
        return cls(b"".join((head, table, *planes, ends)))

    @staticmethod
    def _section(ones: np.ndarray) -> bytes:
        """A plane: ones before each block, ends of the frames, the frames."""
        packed = np.packbits(ones)
        words = np.zeros(-(-len(ones) // _BLOCK) * (_BLOCK // 64), "<u8")
        words.view(np.uint8)[: len(packed)] = packed
        counts = np.bitwise_count(words).reshape(-1, _BLOCK // 64).sum(axis=1, dtype=np.int64)
        ranks = np.concatenate(([0], np.cumsum(counts))).astype("<u4")
        press, data, frames = zstandard.ZstdCompressor(level=1), packed.tobytes(), []
        for start in range(0, len(data), _GROUP // 8):
            plain = data[start : start + _GROUP // 8]
            zipped = press.compress(plain)
            frames.append(zipped if len(zipped) < len(plain) else plain)
        ends = np.cumsum([len(f) for f in frames]).astype("<u4")
        return b"".join((ranks.tobytes(), ends.tobytes(), *frames))

    def to_bytes(self) -> bytes:
        return bytes(self.image)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        return cls(data)

    def lengths(self) -> np.ndarray:
        """Number of ids of each document."""
        return np.frombuffer(self._unzip.decompress(self.image[self.starts[-1] :]), "<u8").astype(np.int64)

    def _number(self, at: int) -> int:
        return int.from_bytes(self.image[at : at + 4], "little")

    def _before(self, plane: int, block: int) -> int:
        """Ones of a plane before a block, as the image holds them."""
        return self._number(self.starts[plane] + 4 * block)

    def _frame(self, plane: int, group: int) -> bytes:
        """Packed bits of a group of blocks."""
        ends = self.starts[plane] + 4 * (self.blocks + 1)
        first = self._number(ends + 4 * (group - 1)) if group else 0
        start = ends + 4 * self.groups
        data = self.image[start + first : start + self._number(ends + 4 * group)]
        size = (min(self.n - group * _GROUP, _GROUP) + 7) // 8
        return bytes(data) if len(data) == size else self._unzip.decompress(data)

    def _block(self, plane: int, block: int) -> np.ndarray:
        """Bits of a block."""
        group, inside = divmod(block, _GROUP // _BLOCK)
        if (plane, group) not in self._open:
            if len(self._open) >= _OPEN:
                self._open.pop(next(iter(self._open)))
            self._open[plane, group] = self._frame(plane, group)
        some = self._open[plane, group][inside * _BLOCK // 8 : (inside + 1) * _BLOCK // 8]
        return np.unpackbits(np.frombuffer(some, np.uint8), count=min(self.n - block * _BLOCK, _BLOCK)).view(bool)

    def _bits(self, plane: int) -> np.ndarray:
        packed = b"".join(self._frame(plane, group) for group in range(self.groups))
        return np.unpackbits(np.frombuffer(packed, np.uint8), count=self.n).view(bool)

    def _ones(self, plane: int, i: int) -> int:
        block, inside = divmod(i, _BLOCK)
        before = self._before(plane, block)
        return before + int(np.count_nonzero(self._block(plane, block)[:inside])) if inside else before

    def tokens(self) -> np.ndarray:
        """All ids in order: the planes undone from the last to the first."""
        x = np.zeros(self.n, np.uint16 if self.width <= 16 else np.uint32)
        for plane in range(self.width - 1, -1, -1):
            ones, zeros = self._bits(plane), self.zeros[plane]
            above = np.empty_like(x)
            above[np.flatnonzero(~ones)] = x[:zeros]
            above[np.flatnonzero(ones)] = x[zeros:] | (1 << (self.width - 1 - plane))
            x = above
        return x

    def access(self, i: int) -> int:
        """Id at a place."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for plane in range(self.width):
            bit, ones = bool(self._block(plane, i // _BLOCK)[i % _BLOCK]), self._ones(plane, i)
            value = value << 1 | bit
            i = self.zeros[plane] + ones if bit else i - ones
        return value

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        if token < 0 or token >> self.width:
            return 0, 0
        for plane in range(self.width):
            low, high = self._ones(plane, lo), self._ones(plane, hi)
            if token >> (self.width - 1 - plane) & 1:
                lo, hi = self.zeros[plane] + low, self.zeros[plane] + high
            else:
                lo, hi = lo - low, hi - high
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of an id in a range of places."""
        lo, hi = self._range(token, lo, self.n if hi is None else hi)
        return hi - lo

    def rank(self, token: int, i: int) -> int:
        """Occurrences of an id before a place."""
        return self.count(token, 0, i)

    def select(self, token: int, k: int) -> int:
        """Place of the k-th occurrence (from 0) of an id."""
        lo, hi = self._range(token, 0, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i = lo + k
        for plane in range(self.width - 1, -1, -1):
            one = bool(token >> (self.width - 1 - plane) & 1)
            nth = i - self.zeros[plane] if one else i

            def ahead(block: int) -> int:
                """Bits of the wanted kind before a block."""
                ones = self._before(plane, block)
                return ones if one else min(block * _BLOCK, self.n) - ones

            block = bisect_right(range(self.blocks), nth, key=ahead) - 1
            i = block * _BLOCK + int(np.flatnonzero(self._block(plane, block) == one)[nth - ahead(block)])
        return i


def _tails(words: pa.Array, heads: pa.Array) -> pa.Array:
    """What stands behind each head in its word."""
    data = words.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    starts = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, 8 * words.offset)
    skipped = pc.binary_length(heads).to_numpy()
    sizes = np.diff(starts) - skipped
    ends = np.concatenate(([0], np.cumsum(sizes)))
    places = np.repeat(starts[:-1] + skipped - ends[:-1], sizes) + np.arange(ends[-1])
    return pa.Array.from_buffers(pa.large_string(), len(words), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[places])])


class _Known:
    """Ids of words in arrays beside the words; of those asked for, only unknown ones are computed.

    Beyond `most` words, or 64 bytes for each, the half that was asked for last stays, without very long words.
    """

    def __init__(self, compute: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = 400_000):
        self.compute, self.most, self.round = compute, most, 0
        self.words = pa.array([], pa.large_string())
        self.sizes, self.flat, self.used = np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def __call__(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each word, and all ids."""
        at = _places(words, self.words)
        new = np.flatnonzero(at < 0)
        if len(new):
            wanted = words.take(pa.array(new))
            unknown = wanted.unique()
            at[new] = len(self.words) + _places(wanted, unknown)
            sizes, flat = self.compute(unknown.to_pylist())
            self.words = pa.concat_arrays([self.words, unknown])
            self.sizes, self.flat = np.concatenate([self.sizes, sizes]), np.concatenate([self.flat, flat])
            self.used = np.concatenate([self.used, np.zeros(len(unknown), np.int64)])
        self.round += 1
        self.used[at] = self.round
        found = self.sizes[at], gather(at, self.sizes, self.flat)
        if len(self.words) > self.most or self.words.nbytes > 72 * self.most:  # with offsets of 8 bytes
            self._forget()
        return found

    def _forget(self) -> None:
        kept = pc.binary_length(self.words).to_numpy() <= 64
        kept[np.argsort(-self.used, kind="stable")[self.most // 2 :]] = False
        places = np.flatnonzero(kept)
        self.flat = gather(places, self.sizes, self.flat)
        self.words, self.sizes, self.used = self.words.take(pa.array(places)), self.sizes[places], self.used[places]


def _places(words: pa.Array, known: pa.Array) -> np.ndarray:
    """Place of each word in `known`, -1 for others."""
    return pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)


class _Library:
    """The tokenizers library on words, many at a time.

    Latin words, with or without stops behind them, are encoded in long rows of words: each letter
    run is one piece there, so its ids end with the only token that has the end-of-word suffix.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            suffix = json.load(file)["model"]["end_of_word_suffix"]
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        for token, i in vocab.items():
            self.ends[i] = token.endswith(suffix)
        self.letters, self.stops, self.others = _Known(self._rows), _Known(self._single), _Known(self._single)

    def _single(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        coded = [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        return sizes, np.fromiter(chain.from_iterable(coded), np.uint32, int(sizes.sum()))

    def _rows(self, words: list[str], row: int = 2000) -> tuple[np.ndarray, np.ndarray]:
        found = []
        for start in range(0, len(words), row):
            some = words[start : start + row]
            [coded] = self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)
            ids = np.array(coded.ids, np.uint32)
            sizes = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
            found.append((sizes, ids) if len(sizes) == len(some) and sizes.sum() == len(ids) else self._single(some))
        return np.concatenate([n for n, _ in found]), np.concatenate([ids for _, ids in found])

    def __call__(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each word, and all ids."""
        heads = pc.utf8_rtrim(words, _STOPS)
        latin = pc.match_substring_regex(heads, _LATIN).to_numpy(zero_copy_only=False)
        plain, others = (pa.array(np.flatnonzero(m)) for m in (latin, ~latin))
        whole, heads = words.take(plain), heads.take(plain)
        parts = [self.letters(pc.utf8_lower(heads)), self.stops(_tails(whole, heads)), self.others(words.take(others))]
        sizes = np.concatenate([n for n, _ in parts])
        n = len(plain)
        first, second = np.empty(len(words), np.int64), np.full(len(words), len(sizes))
        first[latin], first[~latin] = np.arange(n), np.arange(2 * n, len(sizes))
        second[latin] = np.arange(n, 2 * n)
        sizes = np.append(sizes, 0)  # of words without stops
        flat = gather(np.stack([first, second], axis=1).ravel(), sizes, np.concatenate([ids for _, ids in parts]))
        return sizes[first] + sizes[second], flat


@lru_cache(maxsize=2)
def _library(path: str) -> _Library:
    return _Library(path)


def encode_batch(path: str, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Number of ids of each text and all ids; words between whitespace are encoded once a batch.

    This equals encoding whole texts for files whose rules drop whitespace, never look across it and
    ignore case, but for special tokens.
    """
    if not pc.any(pc.match_substring(texts, "<|")).as_py():
        texts = pc.ascii_lower(texts)
    n_words, codes, distinct = split_words(texts)
    sizes, flat = _library(path)(distinct)
    return sums(sizes[codes], n_words), gather(codes, sizes, flat)


_SHARD = "part INT, shard INT, n_docs BIGINT, n_tokens BIGINT, doc_ids ARRAY<BIGINT>, image BINARY"


def _writer(path: str, shard_tokens: int):
    def image(shard: int, part: int, docs: list, lengths: list, ids: list) -> pa.RecordBatch:
        doc_ids, counts, tokens = pa.concat_arrays(docs), np.concatenate(lengths), np.concatenate(ids)
        row = [part, shard, len(doc_ids), len(tokens), doc_ids.to_pylist()]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
        names = [field.split()[0] for field in _SHARD.split(", ")]
        row.append(WaveletMatrix.build(tokens, counts).to_bytes())
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, part, held, docs, lengths, ids = 0, 0, 0, [], [], []
        for batch in slices(batches, "text", WORDS_BYTES):
            part = batch.column("part")[0].as_py()
            counts, flat = encode_batch(path, batch.column("text"))
            ends = np.cumsum(counts)
            flat = np.insert(flat, ends, END_ID)  # behind each document
            counts, ends = counts + 1, np.cumsum(counts + 1)
            start = 0
            while start < len(counts):
                before = ends[start - 1] if start else 0
                stop = min(len(counts), int(np.searchsorted(ends, before + shard_tokens - held)) + 1)
                docs.append(batch.column("doc_id").slice(start, stop - start))
                lengths.append(counts[start:stop])
                ids.append(flat[before : ends[stop - 1]])
                held, start = held + int(ends[stop - 1] - before), stop
                if held >= shard_tokens:
                    yield image(shard, part, docs, lengths, ids)
                    shard, held, docs, lengths, ids = shard + 1, 0, [], [], []
        if docs:
            yield image(shard, part, docs, lengths, ids)

    return run


def write_shards(
    docs: DataFrame,
    tokenizer: str,
    folder: str | None = None,
    shard_tokens: int = SHARD_TOKENS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> str:
    """Encode and write the shards; returns their folder.

    One range shuffle of the texts by id. Encoding happens behind it, as documents stream into the
    shard that is being filled, so a task holds one shard.
    """
    folder = folder or scratch_path(docs.sparkSession, "token_shards")
    ordered = (
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id")
        .withColumn("part", F.spark_partition_id())
    )
    ordered.mapInArrow(_writer(tokenizer, shard_tokens), _SHARD).write.parquet(folder)
    return folder


def read_shards(spark, folder: str) -> DataFrame:
    """Shards with `start`, the number of ids before each."""
    shards = spark.read.schema(_SHARD).parquet(folder)
    # two small tables: a row per shard, and a row per part
    before = (Window.unboundedPreceding, -1)
    sizes = shards.select("part", "shard", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    base = parts.select("part", F.sum("tokens").over(Window.orderBy("part").rowsBetween(*before)).alias("base"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard").rowsBetween(*before))
    starts = sizes.withColumn("inside", inside).join(F.broadcast(base), "part")
    zero = F.lit(0).cast("long")
    starts = starts.select(
        "part", "shard", (F.coalesce("inside", zero) + F.coalesce("base", zero)).alias("start")
    )
    return shards.join(starts, ["part", "shard"])


_DOCUMENT = "doc_id BIGINT, start BIGINT, n_tokens BIGINT, ids_crc32 BIGINT, shard_start BIGINT"


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in _DOCUMENT.split(", ")]
    for batch in batches:
        for i in range(batch.num_rows):
            matrix = WaveletMatrix.from_bytes(batch.column("image")[i].as_py())
            tokens, lengths = matrix.tokens().astype("<u4"), matrix.lengths()
            ends = np.cumsum(lengths)
            data = memoryview(tokens.tobytes())
            sums = [zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
            start = batch.column("start")[i].as_py()
            columns = [
                batch.column("doc_ids")[i].values,
                pa.array(start + ends - lengths, pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(sums, pa.int64()),
                pa.array(np.full(len(lengths), start), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)


def read_documents(spark, folder: str) -> DataFrame:
    """Per document, from the files alone: doc_id, start, n_tokens, ids_crc32, shard_start."""
    needed = read_shards(spark, folder).select("doc_ids", "image", "start")
    return needed.mapInArrow(_reader, _DOCUMENT)


def find_token(spark, folder: str, token: int) -> DataFrame:
    """Global places of an id, by rank and select on the images."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                matrix = WaveletMatrix.from_bytes(batch.column("image")[i].as_py())
                start = batch.column("start")[i].as_py()
                places = [start + matrix.select(token, k) for k in range(matrix.count(token))]
                yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64())], ["place"])

    return read_shards(spark, folder).select("image", "start").mapInArrow(run, "place BIGINT")
