"""Words of many texts as numpy arrays, and bounded bitmaps of hashes.

Texts are read as UTF-8 bytes; which bytes belong to words is a table of 256
classes, so every separator must be an ASCII character.  A word's hash is a
polynomial over its bytes modulo 2^64, taken for all words at once from
running sums, then mixed.  Hashes only ever select candidates or serve as ids
whose collisions the caller detects.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Classes of bytes.
WORD, GAP, BREAK = 0, 1, 2
#: Bytes of texts that are hashed at a time.
BLOCK_BYTES = 1 << 20
#: Bits of a bitmap: at least 2^20, 16 for each entry, and at most 2^27
#: (16 MiB).  Each hash sets PROBES of them; they are gathered in buckets of
#: 2^15, as Spark's bitmap aggregate does.
LEAST_BITS, BITS_EACH, MOST_BITS, PROBES, BUCKET_BITS = 20, 16, 27, 4, 15

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def byte_classes(gaps: bytes, breaks: bytes = b"") -> np.ndarray:
    """Class of each byte: words, gaps between words, and breaks."""
    classes = np.full(256, WORD, np.uint8)
    classes[list(gaps)] = GAP
    classes[list(breaks)] = BREAK
    return classes


def lower_table() -> np.ndarray:
    """Bytes with A-Z lower-cased."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


_LOWER = lower_table()


def lowered(text: bytes) -> np.ndarray:
    """The bytes of a text with A-Z lower-cased."""
    return _LOWER[np.frombuffer(text, np.uint8)]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash, a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _base(seed: int) -> int:
    return (_BASES[seed % len(_BASES)] + 2 * (seed // len(_BASES)) * 0x5851F42D4C957F2D) % 2**64 | 1


@lru_cache(maxsize=4)
def _powers(seed: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and of its inverse, modulo 2^64."""
    out = []
    base = _base(seed)
    for factor in (base, pow(base, -1, 2**64)):
        table = np.full(size, factor, np.uint64)
        table[0] = 1
        out.append(np.multiply.accumulate(table))
    return out[0], out[1]


def _table_size(n: int) -> int:
    return max(BLOCK_BYTES + (1 << 16), 1 << int(n).bit_length() if n > BLOCK_BYTES + (1 << 16) else 0)


def segments(data: np.ndarray, classes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut bytes at separators into stretches of about BLOCK_BYTES, so that no
    word is cut."""
    at = 0
    while at < len(data):
        end = at + BLOCK_BYTES
        while end < len(data):
            gaps = np.flatnonzero(classes[data[end:end + BLOCK_BYTES]] != WORD)
            if len(gaps):
                end += int(gaps[0])
                break
            end += BLOCK_BYTES
        end = min(end, len(data))
        yield at, end
        at = end


def hash_words(data: np.ndarray, classes: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words in lower-cased bytes."""
    found = []
    for at, end in segments(data, classes):
        part = data[at:end]
        is_word = np.zeros(len(part) + 2, np.int8)
        is_word[1:-1] = classes[part] == WORD
        edge = np.diff(is_word)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        power, inverse = _powers(seed, _table_size(len(part)))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[:len(part)], out=sums[1:])
        h = (sums[ends] - sums[starts]) * inverse[starts]
        h += (ends - starts).astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
        found.append((starts + at, ends + at, mix(h)))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def hash_columns(columns: Sequence[np.ndarray]) -> np.ndarray:
    """Hash of each row of word hashes, given as one array a place."""
    total = np.full(len(columns[0]), len(columns), np.uint64)
    for i, words in enumerate(columns):
        total += words * np.uint64(pow(_base(1), i + 1, 2**64))
    return mix(total)


def hash_runs(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each position on; shorter by
    ``length`` - 1 than ``words``."""
    n = max(len(words) - length + 1, 0)
    return hash_columns([words[i:i + n] for i in range(length)])


def blocks(texts: Sequence[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Group neighbouring texts up to BLOCK_BYTES (a longer one by itself):
    first text, end, the lower-cased bytes joined by line ends, their starts."""
    first = 0
    while first < len(texts):
        end, size = first, 0
        while end < len(texts) and (end == first or size + len(texts[end]) <= BLOCK_BYTES):
            size += len(texts[end]) + 1
            end += 1
        lengths = np.array([len(t) + 1 for t in texts[first:end]], np.int64)
        data = np.frombuffer(b"\n".join(texts[first:end]), np.uint8)
        yield first, end, _LOWER[data], np.cumsum(lengths) - lengths
        first = end


def bitmap(table: DataFrame, hash_col: str) -> np.ndarray:
    """Bloom filter of 64-bit hashes as bytes, built in the cluster.

    It never has more than 2^MOST_BITS bits, so what reaches the driver and
    the executors stays below 16 MiB however long the table is; a fuller one
    only lets more false candidates through.
    """
    rows = table.count()
    log2 = min(MOST_BITS, max(LEAST_BITS, (BITS_EACH * rows).bit_length()))
    low = F.col(hash_col).bitwiseAND(F.lit(0xFFFFFFFF))
    step = F.shiftrightunsigned(hash_col, 32).bitwiseOR(F.lit(1))
    slots = F.array(*[(low + i * step).bitwiseAND(F.lit(2**log2 - 1)) for i in range(PROBES)])
    parts = (table.select(F.explode(slots).alias("slot"))
             .groupBy(F.shiftright("slot", BUCKET_BITS).alias("bucket"))
             .agg(F.bitmap_construct_agg(F.col("slot").bitwiseAND(F.lit(2**BUCKET_BITS - 1))).alias("bits")))
    out = np.zeros(2**log2 // 8, np.uint8)
    size = 2**BUCKET_BITS // 8
    for row in parts.collect():  # at most 2^(MOST_BITS - BUCKET_BITS) rows
        out[row.bucket * size:(row.bucket + 1) * size] = np.frombuffer(row.bits, np.uint8)
    return out


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be in the bitmap; none that is in it is missed."""
    found = np.zeros(len(hashes), bool)
    last = np.uint64(len(bits) * 8 - 1)
    at, rest = np.arange(len(hashes)), hashes
    for i in range(PROBES):  # each probe only looks at what passed the one before
        slot = ((rest & np.uint64(0xFFFFFFFF))
                + np.uint64(i) * ((rest >> np.uint64(32)) | np.uint64(1))) & last
        passed = np.flatnonzero((bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1)
        at, rest = at[passed], rest[passed]
    found[at] = True
    return found
