"""Byte-level BPE encoding and decoding over overlapping chunks.

A pre-token pattern without look-behind makes the rest of a tokenisation a
function of the position it continues from: two tokenisations of the same
text that share a boundary agree from there on, as far as both see the text.
So a long text is cut into chunks that overlap, every chunk is pre-tokenised
on its own, and the first boundary that two neighbours share in their overlap
is where the right one takes over (before it, the right one may have started
inside a pre-token).  The pre-tokens between two such boundaries are encoded
chunk by chunk and the ids are put together in order.  Texts with neighbours
that share no boundary (one pre-token longer than the overlap) are encoded as
one chunk.  Texts of one chunk need no stitching.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratesmith.session import cut_lineage

#: Characters of a chunk, and of its overlap to either side.
CHUNK_CHARS, OVERLAP_CHARS = 32768, 512
#: A boundary counts only if the chunk shows this many characters behind it:
#: the pattern looks no further ahead ("'re" from "'" needs two).
LOOKAHEAD = 2
#: Bytes of encoded pre-tokens that a worker remembers, and the longest kept.
CACHE_BYTES, CACHE_CHARS = 64 << 20, 64
#: Bytes that a remembered pre-token takes besides its ids, about: its text,
#: the ids' object and its place in the table.
_ENTRY_BYTES = 200
#: Characters and ids of the rows (one at least) worked on and handed on at a
#: time, so that a worker never holds a whole Arrow batch in several forms.
AT_ONCE = 1 << 20
#: Pre-tokens above this many bytes are merged with a heap.
HEAP_BYTES = 256
#: Ids whose bytes are gathered at a time.
IDS_AT_ONCE = 1 << 18


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and their ranks from a rank file (base64 and rank a line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Ids of one pre-token: merge the adjacent pair of lowest rank, the
    leftmost among equals, until no pair has a rank."""
    if (whole := ranks.get(piece)) is not None:
        return (whole,)
    if len(piece) > HEAP_BYTES:
        return _merge_long(piece, ranks)
    none = len(ranks)
    find = ranks.get
    parts = [piece[i:i + 1] for i in range(len(piece))]
    pairs = [find(piece[i:i + 2], none) for i in range(len(piece) - 1)]
    while pairs:
        low = min(pairs)
        if low == none:
            break
        at = pairs.index(low)
        parts[at] += parts.pop(at + 1)
        del pairs[at]
        if at < len(pairs):
            pairs[at] = find(parts[at] + parts[at + 1], none)
        if at:
            pairs[at - 1] = find(parts[at - 1] + parts[at], none)
    return tuple([ranks[p] for p in parts])


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The same merges from a heap over linked parts, n log n."""
    size = len(piece)
    stop = list(range(1, size + 1))
    before, after = list(range(-1, size - 1)), list(range(1, size + 1))
    alive = [True] * size
    heap: list[tuple[int, int, int]] = []

    def offer(left: int) -> None:
        right = after[left]
        if right < size and (rank := ranks.get(piece[left:stop[right]])) is not None:
            heapq.heappush(heap, (rank, left, stop[right]))

    for i in range(size - 1):
        offer(i)
    while heap:
        _, left, end = heapq.heappop(heap)
        right = after[left] if alive[left] else size
        if right >= size or stop[right] != end:
            continue
        stop[left], alive[right], after[left] = end, False, after[right]
        if after[left] < size:
            before[after[left]] = left
        offer(left)
        if before[left] >= 0:
            offer(before[left])
    return tuple([ranks[piece[i:stop[i]]] for i in range(size) if alive[i]])


class _Encoder(dict):
    """Pre-token -> ids as bytes of int32, filled on demand up to a bound."""

    def __init__(self, ranks_path: str, pattern: str):
        super().__init__()
        self.ranks, self.find, self.room = load_ranks(ranks_path), regex.compile(pattern), CACHE_BYTES

    def __missing__(self, piece: str) -> bytes:
        ids = array("i", merge(piece.encode("utf-8", "surrogatepass"), self.ranks)).tobytes()
        if len(piece) <= CACHE_CHARS:
            self.room -= _ENTRY_BYTES + len(ids)
            if self.room < 0:
                self.clear()
                self.room = CACHE_BYTES
            self[piece] = ids
        return ids

    def join(self, pieces: Iterable[str]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, pieces)), np.int32)

    def encode(self, text: str) -> np.ndarray:
        return self.join(self.find.findall(text))


@lru_cache(maxsize=1)
def encoder(ranks_path: str, pattern: str) -> _Encoder:
    return _Encoder(ranks_path, pattern)


def boundaries(text: str, start: int, last: bool, pattern: str) -> list[int]:
    """Pre-token boundaries of a chunk that begins at ``start`` of its text;
    those that the chunk's end may have shifted are left out."""
    known = len(text) if last else len(text) - LOOKAHEAD
    found = [start]
    for match in regex.compile(pattern).finditer(text):
        if match.end() > known:
            break
        found.append(start + match.end())
    return found


def _pieces(batches: Iterator[pa.RecordBatch], chunk: int, overlap: int) -> Iterator[pa.RecordBatch]:
    """(key, no, total, start, text) of each chunk with its overlaps."""
    for batch in batches:
        for key, text in zip(batch["key"].to_pylist(), batch["text"], strict=True):
            text = text.as_py()
            for no, at in enumerate(range(0, len(text), chunk)):
                start = max(0, at - overlap)
                yield pa.RecordBatch.from_pydict({
                    "key": [key], "no": pa.array([no], pa.int32()),
                    "total": pa.array([len(text)], pa.int32()),
                    "start": pa.array([start], pa.int32()),
                    "text": [text[start:at + chunk + overlap]]})


def _slices(batch: pa.RecordBatch, sizes: Iterable[int]) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose sizes add up to AT_ONCE at most, or of one row."""
    start, held = 0, 0
    for row, size in enumerate(sizes):
        if row > start and held + size > AT_ONCE:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if batch.num_rows:
        yield batch.slice(start)


def _by_length(batches: Iterator[pa.RecordBatch], col: str) -> Iterator[pa.RecordBatch]:
    """Slices of the batches by the lengths of a text or list column."""
    for batch in batches:
        data = batch[col]
        found = pc.list_value_length(data) if pa.types.is_list(data.type) else pc.utf8_length(data)
        yield from _slices(batch, found.to_pylist())


def _ids_batch(keys: pa.Array, ids: list[np.ndarray], name: str) -> pa.RecordBatch:
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    return pa.RecordBatch.from_arrays(
        [keys, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))],
        names=[name, "ids"])


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text", chunk_chars: int = CHUNK_CHARS,
           overlap_chars: int = OVERLAP_CHARS, decoded: bool = False) -> DataFrame:
    """Return doc_id and ids (array of int): one row per input row.

    ``ranks_path`` names a rank file that every executor has.  The pattern
    must match every character and have no look-behind, and its look-ahead
    must end within LOOKAHEAD characters.  Null and empty texts give an empty
    array; repeated rows and null ids are kept; other columns are ignored; an
    empty table gives an empty result.  Texts above ``chunk_chars`` are
    encoded once per distinct text.  With ``decoded`` the ids are decoded too,
    in the same task for texts of one chunk (see :func:`decode`).
    """
    if chunk_chars <= 2 * overlap_chars:
        raise ValueError("a chunk must be longer than both overlaps")
    source = docs.select(F.col(id_col).alias("doc_id"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = encoder(ranks_path, pattern).encode
        for some in _by_length(batches, "text"):
            ids = [run(t.as_py()) for t in some["text"]]
            out = _ids_batch(some[0], ids, some.schema.names[0])
            if decoded and some.schema.names[0] == "doc_id":
                out = out.append_column("decoded", pa.array(
                    [decode_ids(i, ranks_path) for i in ids], pa.binary()))
            yield out

    is_long = F.char_length("text") > chunk_chars
    short = source.filter(~is_long).mapInArrow(
        whole, f"doc_id {kind}, ids array<int>" + ", decoded binary" * decoded)

    keyed = source.filter(is_long).withColumn("key", F.sha2("text", 256))
    chunks = (keyed.select("key", "text")
              .mapInArrow(lambda batches: _pieces(batches, chunk_chars, overlap_chars),
                          "key string, no int, total int, start int, text string")
              .repartition("key", "no"))

    def zones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _by_length(batches, "text"):
            head, tail = [], []
            for no, total, start, text in zip(*(batch[c].to_pylist() for c in (
                    "no", "total", "start", "text")), strict=True):
                found = boundaries(text, start, start + len(text) == total, pattern)
                left, right = no * chunk_chars, (no + 1) * chunk_chars
                head.append([b for b in found if b <= left + overlap_chars])
                tail.append([b for b in found if b >= right - overlap_chars])
            yield pa.RecordBatch.from_arrays(
                [batch["key"], batch["no"], batch["total"], pa.array(head, pa.list_(pa.int32())),
                 pa.array(tail, pa.list_(pa.int32()))], names=["key", "no", "total", "head", "tail"])

    order = Window.partitionBy("key").orderBy("no")
    seams = (chunks.mapInArrow(
        zones, "key string, no int, total int, head array<int>, tail array<int>")
        .groupBy("key", "no").agg(*[F.first(c).alias(c) for c in ("total", "head", "tail")])
        .withColumn("shared", F.array_intersect(F.lag("tail").over(order), "head"))
        .withColumn("from", F.when(F.col("no") == 0, 0).otherwise(F.array_min("shared")))
        .withColumn("to", F.lead("from").over(order))
        .withColumn("to", F.when((F.col("no") + 1) * chunk_chars >= F.col("total"), F.col("total"))
                    .otherwise(F.col("to")))
        .withColumn("stitched", F.min(F.col("from").isNotNull()).over(Window.partitionBy("key"))))
    seams = cut_lineage(seams.select("key", "no", "from", "to", "stitched"))

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = encoder(ranks_path, pattern)
        for batch in _by_length(batches, "text"):
            ids = []
            for text, start, lo, hi in zip(*(batch[c].to_pylist() for c in (
                    "text", "start", "from", "to")), strict=True):
                # whole pre-tokens, so the cut at "to" changes no match but the
                # last, which the text behind it could have split: look past it
                pieces, at = [], lo - start
                for match in run.find.finditer(text, at):
                    if match.start() >= hi - start:
                        break
                    pieces.append(match[0])
                ids.append(run.join(pieces))
            out = _ids_batch(batch["key"], ids, "key")
            yield pa.RecordBatch.from_arrays([out["key"], batch["no"], out["ids"]],
                                             names=["key", "no", "ids"])

    parts = (chunks.join(seams.filter("stitched"), ["key", "no"])
             .mapInArrow(between, "key string, no int, ids array<int>")
             .groupBy("key", "no").agg(F.first("ids").alias("ids"))
             .groupBy("key").agg(F.sort_array(F.collect_list(F.struct("no", "ids"))).alias("parts"))
             .select("key", F.flatten("parts.ids").alias("ids")))
    unstitched = seams.filter(~F.col("stitched")).select("key").distinct()
    rest = (keyed.join(unstitched, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
            .mapInArrow(whole, "key string, ids array<int>"))
    long = keyed.select("doc_id", "key").join(parts.union(rest), "key").select("doc_id", "ids")
    return short.union(decode(long, ranks_path) if decoded else long)


@lru_cache(maxsize=2)
def _byte_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ranks = load_ranks(path)
    size = max(ranks.values(), default=-1) + 1
    pieces = [b""] * size
    for piece, rank in ranks.items():
        pieces[rank] = piece
    length = np.array([len(p) for p in pieces], np.int64)
    return np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(length) - length, length


def decode_ids(ids: np.ndarray, ranks_path: str) -> bytes:
    """The raw bytes of all ids, one after the other."""
    raw, start, length = _byte_table(ranks_path)
    if len(ids) and (ids.min() < 0 or ids.max() >= len(length)):
        raise ValueError("an id outside the vocabulary")
    out = []
    for at in range(0, len(ids), IDS_AT_ONCE):
        some = ids[at:at + IDS_AT_ONCE]
        n = length[some]
        where = np.repeat(start[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        out.append(raw[where].tobytes())
    return b"".join(out)


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """Return doc_id, ids and decoded (binary): one row per input row.

    Null and empty arrays decode to no bytes; an id outside the vocabulary is
    an error.  The bytes of arbitrary ids need not be valid UTF-8.
    """
    source = encoded.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(ids_col), F.expr("cast(array() as array<int>)")).alias("ids"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _by_length(batches, "ids"):
            out = [decode_ids(i.values.to_numpy(), ranks_path) for i in batch["ids"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["ids"], pa.array(out, pa.binary())],
                names=["doc_id", "ids", "decoded"])

    return source.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded binary")
