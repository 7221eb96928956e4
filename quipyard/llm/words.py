"""Words of Arrow batches as integer codes, a few megabytes of text at a time.

Words are what stands between ASCII whitespace, so a null or blank text has none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are split at once; one longer text is split alone.
SLICE_BYTES = 4 << 20


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in runs of rows whose texts take at most `most` bytes, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Number of words of each text, the code of each word, and the distinct words by code."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    codes, distinct = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    empty = pc.index(distinct, pa.scalar("", distinct.type)).as_py()
    if empty >= 0:  # at blank ends of a text
        full = codes != empty
        at = np.concatenate(([0], np.cumsum(full)))
        ends = np.cumsum(sizes)
        sizes = at[ends] - at[ends - sizes]
        codes = codes[full]
    return sizes, codes, distinct


def gather(codes: np.ndarray, sizes: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """Concatenation of the piece of `flat` that each code names; `sizes` are the pieces' lengths."""
    starts = np.cumsum(sizes) - sizes
    lengths = sizes[codes]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts[codes] - (ends - lengths), lengths) + np.arange(total)]


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of each run of `values`; `sizes` are the runs' lengths, 0 allowed."""
    ends = np.cumsum(sizes)
    total = np.concatenate(([0], np.cumsum(values)))
    return total[ends] - total[ends - sizes]


class Memo:
    """Results of a function of a word; what was not asked for lately is forgotten.

    Two generations of `most` words each: a full one becomes the old one, and words found in the
    old one move back.
    """

    def __init__(self, compute: Callable[[list[str]], list], most: int = 200_000):
        self.compute, self.most, self.new, self.old = compute, most, {}, {}

    def __call__(self, words: list[str]) -> list:
        if len(self.new) > self.most:
            self.new, self.old = {}, self.new
        new, old, unknown, found = self.new, self.old, [], []
        for word in words:
            value = new.get(word)
            if value is None:
                value = old.get(word)
                if value is None:
                    unknown.append(len(found))
                elif len(word) <= 64:
                    new[word] = value
            found.append(value)
        values = self.compute([words[i] for i in unknown])
        for i, value in zip(unknown, values):
            found[i] = value
            if len(words[i]) <= 64:  # very long words are not worth their memory
                new[words[i]] = value
        return found
