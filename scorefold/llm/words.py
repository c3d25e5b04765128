"""Helpers that run inside Arrow tasks: words, word hashes, and runs of words as 64-bit keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A worker forgets its remembered words beyond this many, which bounds its memory.
REMEMBERED = 400_000
#: Texts handled at once inside a task, in bytes; a single longer text is one slice of its own.
SLICE_BYTES = 4 << 20
NO_ID = -(1 << 63)

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD))
_SHIFT = np.uint64(32)


def utf8(column: str) -> Column:
    """A text column as its bytes; NULL is the empty text."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def sliced(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Each batch cut into slices of rows with at most ``limit`` bytes of text (one row at least)."""
    for batch in batches:
        begin = size = 0
        for i, n in enumerate(pc.binary_length(batch.column(text)).to_pylist()):
            if size and size + n > limit:
                yield batch.slice(begin, i - begin)
                begin, size = i, 0
            size += n
        if batch.num_rows:
            yield batch.slice(begin)


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """``sliced``, with the texts of each slice."""
    for part in sliced(batches, text, limit):
        yield part, part.column(text).to_pylist()


def map_texts(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(work, schema)


def batch_of(schema: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=schema)


class WordHashes(dict):
    """XXH64 of words, remembered while there are few."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def joined(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The words of all texts in one list, and how many each text has."""
    split = [t.split() for t in texts]
    counts = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
    return [w for words in split for w in words], counts


def kinds_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of texts with A-Z as a-z, the kind of each word, one text after the other, and how many words each text has."""
    # A view checks nothing: these functions work on bytes.
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    words = split.flatten().dictionary_encode()
    kinds, at = words.dictionary.view(pa.binary()), words.indices.to_numpy(zero_copy_only=False)
    n = np.diff(split.offsets.to_numpy()).astype(np.int64)
    # White space at the edges of a text, and a text without words, leave an empty word.
    if (empty := pc.index(kinds, pa.scalar(b"", pa.binary())).as_py()) >= 0:
        some = at != empty
        n, at = np.bincount(text_of_position(n), weights=some, minlength=len(n)).astype(np.int64), at[some]
    return kinds, at, n


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One key for each ordered pair of keys."""
    x = a * _A + (b ^ _C) * _B
    x ^= x >> _SHIFT
    x *= _C
    x ^= x >> np.uint64(29)
    return x


def run_keys(keys: np.ndarray, width: int) -> np.ndarray:
    """A key for every run of ``width`` consecutive keys, built by doubling."""
    n = len(keys) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, have, power, size = None, 0, keys, 1
    left = width
    while left:
        if left & 1:
            part = power[have:have + n]
            out = part if out is None else mixed(out, part)
            have += size
        left >>= 1
        if left:
            power = mixed(power[:-size], power[size:])
            size *= 2
    return out


def sliding(keys: np.ndarray, width: int, best: Callable) -> np.ndarray:
    """``best`` (np.minimum or np.maximum) over every ``width`` consecutive values."""
    size, out = 1, keys
    while size * 2 <= width:
        out = best(out[:-size], out[size:])
        size *= 2
    return out if size == width else best(out[:len(keys) - width + 1], out[width - size:])


def text_of_position(counts: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(counts)), counts)
