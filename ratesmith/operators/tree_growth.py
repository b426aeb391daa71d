"""Growing boosted regression trees from histograms of bin numbers (M3, M4).

The learner behind ``boosting`` and ``models``.  A row is a small array of bin
numbers, packed with its neighbours into chunks of numpy arrays.  A level of a
tree needs, for every open node, the sums of gradients and of rows by bin:
chunks add up their own, one of two siblings is what the other leaves of the
parent, and running sums give every cut's gain.

A model grows as a generator that asks for histograms (:func:`grow`).  Up to
``LOCAL_ROWS`` rows a task has all of them and answers itself, so a model of any
number of trees is one job and a search grows its models side by side, one task
each.  Beyond that the chunks are a kept RDD: an ask is one job over it, in which
each task sums its own chunks, and what comes back is bounded by ``CELLS``.

Gradients are whole numbers of a small quantum, so every sum, and so every tree,
is independent of the order of rows.
"""

from __future__ import annotations

import hashlib
import math
import os
import pickle
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ratesmith.session import ensure_checkpoint_dir, share_package

CHUNK = 1 << 18        # rows of a chunk
LOCAL_ROWS = 1 << 20   # rows that one task may grow a model on
TASK_ROWS = 1 << 17    # else, rows a task should have at least
CELLS = 1 << 20        # histogram cells of an ask
ALL_CELLS = 1 << 23    # cells of an ask, of all tasks
KEPT_CELLS = 1 << 22   # cells of a level that are kept for its children
PLACES = 1 << 27       # bytes of rows' places that a worker keeps between levels
MODELS = 16            # models that grow side by side beyond LOCAL_ROWS
CUT_EVERY = 20         # trees between lineage cuts
ROUNDING = 1e-10       # share of a gain that rounding may change
NO_FOLD = -(2**31)     # fold of a row in none
STAY = 32767           # a leaf's cut: no bin reaches it


@dataclass(frozen=True)
class Job:
    """What one model needs to grow: its size, penalties and bins.

    ``rate`` is that of every tree but the first, whose rate is ``first``.
    ``rows`` is the share drawn for each tree, ``columns`` that for each tree or,
    with ``by_node``, each node.  ``luts`` turn the table's bins of a feature
    into the model's; ``widths`` count the model's.
    """

    trees: int
    depth: int
    rate: float
    first: float
    base: float
    widths: tuple[int, ...]
    l1: float = 0.0
    l2: float = 0.0
    rows: float = 1.0
    columns: float = 1.0
    by_node: bool = False
    min_child: float = 1.0
    min_gain: float = 0.0
    seed: int = 0
    left_out: int = -1
    luts: tuple[np.ndarray, ...] | None = None


@dataclass
class Trees:
    """Trees as flat arrays: a node has its feature and cut (bins from the cut on go
    right), the place of its left child (the right one follows), or -1, and a
    value, the rate included.  A tree's nodes lie level by level."""

    roots: list[int] = field(default_factory=list)
    depths: list[int] = field(default_factory=list)
    feature: array = field(default_factory=lambda: array("i"))
    cut: array = field(default_factory=lambda: array("h"))
    left: array = field(default_factory=lambda: array("i"))
    value: array = field(default_factory=lambda: array("d"))

    def append(self, grown: Grown) -> None:
        at = len(self.left)
        self.roots.append(at)
        self.depths.append(grown.depth)
        left = np.where(grown.left < 0, -1, grown.left + at)
        for own, new in ((self.feature, grown.feature), (self.cut, grown.cut), (self.left, left),
                         (self.value, grown.value)):
            own.frombytes(new.astype(own.typecode).tobytes())


@dataclass
class Grown:
    """One tree; places count from its root."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    depth: int

    def __getstate__(self):
        # on its way to the driver a leaf is a cut of 0, and a value
        small = np.int16 if self.feature.max() < STAY else np.int32
        return self.feature.astype(small), self.cut, self.value[self.left < 0], self.depth

    def __setstate__(self, state) -> None:
        feature, self.cut, values, self.depth = state
        split = self.cut > 0
        self.feature, self.left, self.value = feature.astype(np.int32), np.full(len(split), -1, np.int32), np.zeros(len(split))
        self.left[split] = 1 + 2 * np.arange(split.sum())
        self.value[~split] = values

    def steps(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _steps(self.feature, self.cut, self.left)


@dataclass
class Ask:
    """Histograms wanted of the rows in some nodes of a tree that has ``steps`` levels.

    ``slots`` numbers the nodes (-1: not wanted), ``count`` of them; ``label_slots``
    those whose label sums are wanted.
    """

    model: int
    job: Job
    tree: int
    scale: float
    steps: int
    walk: tuple[np.ndarray, np.ndarray, np.ndarray]
    columns: list[int]
    slots: np.ndarray
    count: int
    label_slots: np.ndarray

    def cells(self) -> int:
        return self.count * (1 + sum(self.job.widths[c] for c in self.columns))


@dataclass
class Chunk:
    """Rows side by side: bins by feature, labels held as (row, label) entries."""

    start: int
    bins: np.ndarray
    y: np.ndarray
    fold: np.ndarray | None
    held: tuple[np.ndarray, np.ndarray] | None
    name: bytes = field(default_factory=partial(os.urandom, 8))
    preds: dict[int, np.ndarray] = field(default_factory=dict)
    #: (model, tree), levels, the rows' nodes, whether they are learnt from, gradients
    place: tuple | None = None


def _steps(feature: np.ndarray, cut: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Arrays by which a row moves down a level; in a leaf it stays."""
    leaf = left < 0
    return feature, np.where(leaf, STAY, cut).astype(np.int16), np.where(
        leaf, np.arange(len(left)), left).astype(np.int32)


def drawn(ids: np.ndarray, share: float, *salt) -> np.ndarray:
    """Whether each id is drawn at ``share``, by a hash with ``salt``."""
    return _hashed(ids, *salt) < np.uint64(round(share * (1 << 24)))


def _hashed(ids: np.ndarray, *salt) -> np.ndarray:
    key = hashlib.blake2b(repr(salt).encode(), digest_size=8).digest()
    x = ids.astype(np.uint64) ^ np.uint64(int.from_bytes(key, "little"))
    for by, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(by))) * np.uint64(times)
    return (x ^ (x >> np.uint64(31))) >> np.uint64(40)


def quantum(rows: int, most: float) -> float:
    """Gradients of at most ``most`` in number a unit: sums stay within 62 bits, those
    of a chunk exact in a double."""
    a_chunk = min(rows, 2 * CHUNK)
    return 2.0 ** math.floor(min(62 - math.log2(max(rows, 1) * most), 52 - math.log2(max(a_chunk, 1) * most)))


# -- rows in their nodes --------------------------------------------------------------

def _moved(chunk: Chunk, job: Job, node: np.ndarray, walk, widest: np.ndarray | None) -> np.ndarray:
    feature, cut, left = walk
    size, n = chunk.bins.shape
    f = feature[node]
    if size:
        known = f if chunk.held is None else np.minimum(f, size - 1)
        b = chunk.bins.reshape(-1)[known.astype(np.int64) * n + np.arange(n)]
        if widest is not None:
            b = widest[known, b]
        right = b >= cut[node]
    else:
        right = np.zeros(n, bool)
    if chunk.held is not None:
        at, label = chunk.held
        right[f >= size] = False
        cut_by = node[at]
        right[at[(feature[cut_by] == label + size) & (left[cut_by] != cut_by)]] = True
    return left[node] + right


def _widest(job: Job) -> np.ndarray | None:
    if job.luts is None:
        return None
    out = np.zeros((len(job.luts), max(len(x) for x in job.luts)), np.int16)
    for i, x in enumerate(job.luts):
        out[i, :len(x)] = x
    return out


def _ids(chunk: Chunk) -> np.ndarray:
    return np.arange(chunk.start, chunk.start + len(chunk.y), dtype=np.uint64)


def _placed(chunk: Chunk, ask: Ask) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows' nodes, whether the tree learns from them, and their gradients."""
    key, job = (ask.model, ask.tree), ask.job
    if chunk.place is None or chunk.place[0] != key or chunk.place[1] > ask.steps:
        learn = np.ones(len(chunk.y), bool) if chunk.fold is None else (
            (chunk.fold != job.left_out) & (chunk.fold != NO_FOLD))
        if job.rows < 1:
            learn &= drawn(_ids(chunk), job.rows, "rows", job.seed, ask.tree)
        pred = chunk.preds.get(ask.model, job.base)
        chunk.place = (key, 0, np.zeros(len(chunk.y), np.int32), learn, np.rint((pred - chunk.y) * ask.scale))
    _, done, node, learn, g = chunk.place
    for _ in range(done, ask.steps):
        node = _moved(chunk, job, node, ask.walk, _widest(job))
    chunk.place = (key, ask.steps, node, learn, g)
    return node, learn, g


def _sums(chunk: Chunk, ask: Ask, gs: np.ndarray, ns: np.ndarray) -> None:
    """Adds a chunk's sums by (node, bin) to ``gs`` and ``ns``; column 0 is the node's."""
    node, learn, g = _placed(chunk, ask)
    slot = ask.slots[node]
    at = np.flatnonzero((slot >= 0) & learn)
    if not len(at):
        return
    slot, g, k = slot[at].astype(np.int64), g[at], ask.count

    def add(column: int, width: int, key: np.ndarray) -> None:
        gs[:, column:column + width] += np.bincount(key, g, k * width).reshape(k, width).astype(np.int64)
        ns[:, column:column + width] += np.bincount(key, minlength=k * width).reshape(k, width)

    add(0, 1, slot)
    column = 1
    for f in ask.columns:
        b = chunk.bins[f][at]
        if ask.job.luts is not None:
            b = ask.job.luts[f][b]
        width = ask.job.widths[f]
        add(column, width, slot * width + b)
        column += width


def merged(keys: np.ndarray, g: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums by key, in the order of the keys."""
    if not len(keys):
        return keys, g, n
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(g[order], first), np.add.reduceat(n[order], first)


_NOTHING = (np.zeros(0, np.int64),) * 3


def _label_sums(chunk: Chunk, ask: Ask) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node's slot << 32 | label, gradients, rows) of the drawn labels that rows hold."""
    if chunk.held is None:
        return _NOTHING
    node, learn, g = _placed(chunk, ask)
    row, label = chunk.held
    slot = ask.label_slots[node[row]]
    wanted = (slot >= 0) & learn[row]
    if ask.job.columns < 1:
        wanted &= drawn(label, ask.job.columns, "labels", ask.job.seed, ask.tree)
    row, label, slot = row[wanted], label[wanted].astype(np.int64), slot[wanted].astype(np.int64)
    if not len(row):
        return _NOTHING
    width = int(label.max()) + 1
    if width * (int(slot.max()) + 1) > 8 * len(row) + 4096:
        return merged((slot << 32) | label, g[row].astype(np.int64), np.ones(len(row), np.int64))
    key = slot * width + label
    n = np.bincount(key)
    at = np.flatnonzero(n)
    return (at // width << 32) | (at % width), np.bincount(key, g[row])[at].astype(np.int64), n[at]


def answered(chunks: Iterable[Chunk], ask: Ask):
    """(gradients, rows) by (node, column) and the labels' sums, over the chunks."""
    shape = (ask.count, 1 + sum(ask.job.widths[c] for c in ask.columns))
    gs, ns, held = np.zeros(shape, np.int64), np.zeros(shape, np.int64), []
    for chunk in chunks:
        _sums(chunk, ask, gs, ns)
        held.append(_label_sums(chunk, ask))
    return gs, ns, merged(*(np.concatenate(x) for x in zip(*held))) if held else _NOTHING


def _advanced(chunk: Chunk, model: int, job: Job, tree: int, grown: Grown) -> None:
    """Adds the tree's values to the rows' predictions."""
    walk, widest = grown.steps(), _widest(job)
    if chunk.place is not None and chunk.place[0] == (model, tree):
        done, node = chunk.place[1:3]
    else:
        done, node = 0, np.zeros(len(chunk.y), np.int32)
    for _ in range(done, grown.depth):
        node = _moved(chunk, job, node, walk, widest)
    chunk.place = None
    chunk.preds[model] = chunk.preds.get(model, job.base) + grown.value[node]


def _loss(chunks: Iterable[Chunk], model: int, job: Job) -> tuple[float, int]:
    """Sum of squared errors, and rows, of the fold that the model left out."""
    total, n = 0.0, 0
    for c in chunks:
        if c.fold is not None:
            out = c.fold == job.left_out
            total += float(((c.preds.get(model, job.base) - c.y)[out] ** 2).sum())
            n += int(out.sum())
    return total, n


# -- a tree ---------------------------------------------------------------------------

def _score(g: np.ndarray, n: np.ndarray, job: Job, scale: float) -> np.ndarray:
    return np.maximum(np.abs(g) / scale - job.l1, 0.0) ** 2 / (n + job.l2)


def _gains(gl, nl, ga, na, job: Job, scale: float) -> np.ndarray:
    return (_score(gl, nl, job, scale) + _score(ga - gl, na - nl, job, scale) - _score(ga, na, job, scale)) / 2


def _first_best(row: np.ndarray, gain: np.ndarray) -> np.ndarray:
    """Place of each row's largest gain, the first among those that differ by rounding
    alone; rows in order."""
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    top = np.repeat(np.maximum.reduceat(gain, starts), np.diff(np.r_[starts, len(row)]))
    hit = np.flatnonzero(gain >= top - ROUNDING * np.abs(top))
    return hit[np.r_[True, row[hit][1:] != row[hit][:-1]]]


def _best_cuts(g: np.ndarray, n: np.ndarray, labels, job: Job, scale: float, columns: Sequence[int],
               allowed: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """For each node its best cut: gain (-inf: none), feature, cut, and the left sums."""
    size, count = len(job.widths), len(g)
    gain, feature, cut, gl, nl = (np.full(count, -np.inf), *(np.zeros(count, np.int64) for _ in range(4)))
    least = max(job.min_child, 1)
    widths = [job.widths[c] for c in columns]
    if columns:
        place = np.repeat(np.arange(len(columns)), widths)  # of a cell's feature among the drawn
        bin_no = np.concatenate([np.arange(w) for w in widths])
        # wraps around alike on both sides, and the difference fits
        left_n = np.cumsum(n[:, 1:], axis=1) - place * n[:, :1]
        fits = (n[:, 1:] > 0) & (left_n >= least) & (n[:, :1] - left_n >= least)
        if allowed is not None:
            fits &= allowed[:, place]
        row, cell = np.nonzero(fits)
        if len(row):
            left_g = (np.cumsum(g[:, 1:], axis=1) - place * g[:, :1])[row, cell]
            left_n = left_n[row, cell]
            found = _gains(left_g, left_n, g[row, 0], n[row, 0], job, scale)
            at = _first_best(row, found)
            to = row[at]
            gain[to], gl[to], nl[to] = found[at], left_g[at], left_n[at]
            feature[to], cut[to] = np.asarray(columns)[place[cell[at]]], bin_no[cell[at]] + 1
    keys, right_g, right_n = labels
    if len(keys):
        row, label = keys >> 32, keys & 0xFFFFFFFF
        left_g, left_n = g[row, 0] - right_g, n[row, 0] - right_n
        ok = np.flatnonzero((left_n >= least) & (right_n >= least))
        if len(ok):
            row, label, left_g, left_n = row[ok], label[ok], left_g[ok], left_n[ok]
            found = _gains(left_g, left_n, g[row, 0], n[row, 0], job, scale)
            at = _first_best(row, found)
            at = at[found[at] > gain[row[at]]]
            to = row[at]
            gain[to], gl[to], nl[to] = found[at], left_g[at], left_n[at]
            feature[to], cut[to] = label[at] + size, 1
    return gain, feature, cut, gl, nl


def _allowed(nodes: np.ndarray, job: Job, tree: int) -> np.ndarray | None:
    """The features drawn for each node."""
    size = len(job.widths)
    most = math.ceil(job.columns * size)
    if not job.by_node or most >= size:
        return None
    ids = nodes[:, None].astype(np.uint64) * np.uint64(size) + np.arange(size, dtype=np.uint64)
    order = np.argsort(_hashed(ids, "columns", job.seed, tree), axis=1, kind="stable")
    out = np.zeros((len(nodes), size), bool)
    np.put_along_axis(out, order[:, :most], True, axis=1)
    return out


def _columns(job: Job, tree: int) -> list[int]:
    """The features drawn for a tree."""
    size = len(job.widths)
    if job.by_node or job.columns >= 1 or not size:
        return list(range(size))
    most = min(size, max(1, round(job.columns * size)))
    order = np.argsort(_hashed(np.arange(size), "columns", job.seed, tree), kind="stable")
    return sorted(int(x) for x in order[:most])


def grow(job: Job, model: int, tree: int, scale: float, limit: int = CELLS):
    """One tree, level by level: yields :class:`Ask`, is sent what :func:`answered`
    gives, returns :class:`Grown`."""
    columns = _columns(job, tree)
    width = 1 + sum(job.widths[c] for c in columns)
    feature, cut, left = (np.zeros(1, np.int32), np.zeros(1, np.int16), np.full(1, -1, np.int32))
    sum_g, sum_n = np.zeros(1, np.int64), np.zeros(1, np.int64)
    level, first, kept = 0, None, None
    while True:
        # pairs of siblings: the smaller is summed, the other is what its parent has besides
        if level == 0:
            small, other = np.zeros(1, np.int64), None
        else:
            turned = sum_n[first] > sum_n[first + 1]
            small, other = np.where(turned, first + 1, first), np.where(turned, first, first + 1)
        at_once = max(1, limit // (2 * width))
        walk, found, parts = _steps(feature, cut, left), [], []
        for at in range(0, len(small), at_once):
            mine = slice(at, at + at_once)
            nodes = small[mine] if other is None else np.r_[small[mine], other[mine]]
            summed = small[mine] if kept is not None or other is None else nodes
            slots, label_slots = np.full((2, len(left)), -1, np.int32)
            slots[summed], label_slots[nodes] = np.arange(len(summed)), np.arange(len(nodes))
            g, n, labels = yield Ask(model, job, tree, scale, level, walk, columns, slots, len(summed), label_slots)
            if kept is not None:
                g, n = np.r_[g, kept[0][mine] - g], np.r_[n, kept[1][mine] - n]
            if level == 0:
                sum_g[0], sum_n[0] = g[0, 0], n[0, 0]
            if level < job.depth:
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain, *cuts = _best_cuts(g, n, labels, job, scale, columns, _allowed(nodes, job, tree))
                ok = np.flatnonzero(gain > job.min_gain)
                found.append((nodes[ok], *(x[ok] for x in cuts)))
                parts.append((g[ok], n[ok]))
        nodes, f, c, gl, nl = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 5
        if not len(nodes):
            break
        order = np.argsort(nodes)
        nodes, f, c, gl, nl = (x[order] for x in (nodes, f, c, gl, nl))
        children = len(left) + 2 * np.arange(len(nodes))
        feature[nodes], cut[nodes], left[nodes] = f, c, children
        new_g, new_n = np.empty(2 * len(nodes), np.int64), np.empty(2 * len(nodes), np.int64)
        new_g[::2], new_n[::2] = gl, nl
        new_g[1::2], new_n[1::2] = sum_g[nodes] - gl, sum_n[nodes] - nl
        blank = np.zeros(2 * len(nodes), np.int32)
        feature, cut = np.r_[feature, blank], np.r_[cut, blank.astype(np.int16)]
        left, sum_g, sum_n = np.r_[left, blank - 1], np.r_[sum_g, new_g], np.r_[sum_n, new_n]
        level += 1
        if level >= job.depth:
            break
        # a node of one row, or too few, has no cut
        open_ = np.maximum(new_n[::2], new_n[1::2]) >= max(2, 2 * job.min_child)
        if not open_.any():
            break
        first = children[open_]
        kept = None
        if open_.sum() * width <= KEPT_CELLS:
            which = order[open_]
            kept = tuple(np.concatenate([p[i] for p in parts])[which] for i in (0, 1))
    weight = np.maximum(np.abs(sum_g / scale) - job.l1, 0.0)
    whole = sum_n + job.l2
    leaf = (left < 0) & (whole > 0) & (sum_n > 0)
    value = np.zeros(len(left))
    rate = job.first if tree == 0 else job.rate
    value[leaf] = -rate * np.copysign(weight[leaf], sum_g[leaf]) / whole[leaf]
    return Grown(feature, cut, left, value, level)


# -- many trees -----------------------------------------------------------------------

def _grown_here(chunks: list[Chunk], jobs: Sequence[Job], mine: Sequence[int], scale: float, stages: frozenset[int]
                ) -> Iterator[tuple[int, Grown, tuple[float, int] | None]]:
    """Whole models, one after another, from all rows."""
    for m in mine:
        job = jobs[m]
        for tree in range(job.trees):
            asking = grow(job, m, tree, scale)
            ask = next(asking)
            while True:
                try:
                    ask = asking.send(answered(chunks, ask))
                except StopIteration as end:
                    grown = end.value
                    break
            for c in chunks:
                _advanced(c, m, job, tree, grown)
            yield m, grown, _loss(chunks, m, job) if tree + 1 in stages else None
        for c in chunks:
            c.preds.pop(m, None)


def _task_models(jobs, groups: int, scale: float, stages, part: int, chunks: Iterator[Chunk]):
    mine = range(part, len(jobs), groups)
    return _grown_here(list(chunks), jobs, mine, scale, stages) if mine else iter(())


class _Places:
    """Where a worker left the rows of a tree: often it gets the same chunks for the
    next level, and need not walk them down from the root again."""

    def __init__(self):
        self.tree, self.size, self.of = -1, 0, {}

    def put(self, chunk: Chunk, ask: Ask) -> None:
        if ask.tree != self.tree:
            self.tree, self.size, self.of = ask.tree, 0, {}
        chunk.place = self.of.get((chunk.name, ask.model))

    def keep(self, chunk: Chunk, ask: Ask) -> None:
        key, size = (chunk.name, ask.model), sum(x.nbytes for x in chunk.place[2:])
        if key in self.of or self.size + size <= PLACES:
            self.size += 0 if key in self.of else size
            self.of[key] = chunk.place


_PLACES = _Places()


def _answers(asks: list[Ask], chunks: Iterator[Chunk]):
    """One task's sums for each ask."""

    def answer(chunk: Chunk, ask: Ask):
        _PLACES.put(chunk, ask)
        found = answered([chunk], ask)
        _PLACES.keep(chunk, ask)
        return found

    total = None
    for chunk in chunks:
        each = [answer(chunk, ask) for ask in asks]
        total = each if total is None else [_added(a, b) for a, b in zip(total, each)]
    if total is not None:
        yield [(g, n.astype(np.int32), labels) for g, n, labels in total]


def _added(a, b):
    return a[0] + b[0], a[1] + b[1], merged(*(np.concatenate(x) for x in zip(a[2], b[2])))


def _next_rows(jobs: dict[int, Job], tree: int, grown: dict[int, Grown], chunk: Chunk) -> Chunk:
    for m, found in grown.items():
        _advanced(chunk, m, jobs[m], tree, found)
    return chunk


def _losses(jobs: dict[int, Job], chunks: Iterator[Chunk]):
    chunks = list(chunks)
    yield {m: _loss(chunks, m, job) for m, job in jobs.items()}


def _grown_apart(rows: RDD, jobs: dict[int, Job], scale: float, stages: frozenset[int], tasks: int
                 ) -> Iterator[tuple[int, Grown, tuple[float, int] | None]]:
    """Models side by side, from rows that lie in many tasks: one job an ask."""
    sc, state, old, cuts = rows.context, rows, None, []
    limit = max(1 << 12, min(CELLS, ALL_CELLS // tasks))
    try:
        for tree in range(max((j.trees for j in jobs.values()), default=0)):
            asking = {m: grow(j, m, tree, scale, limit) for m, j in jobs.items() if tree < j.trees}
            asks, grown = {m: next(a) for m, a in asking.items()}, {}
            while asks:
                batch: list[Ask] = []
                for ask in asks.values():
                    if not batch or sum(a.cells() for a in batch) + ask.cells() <= limit:
                        batch.append(ask)
                total = None
                for part in sc.runJob(state, partial(_answers, batch)):
                    total = part if total is None else [_added(a, b) for a, b in zip(total, part)]
                if old is not None:
                    old.unpersist()
                    old = None
                for i, ask in enumerate(batch):
                    g, n, labels = total[i] if total else answered([], ask)
                    try:
                        asks[ask.model] = asking[ask.model].send((g, n.astype(np.int64), labels))
                    except StopIteration as end:
                        grown[ask.model] = end.value
                        del asks[ask.model]
            old = None if state is rows else state
            state = state.map(partial(_next_rows, jobs, tree, grown)).persist(StorageLevel.MEMORY_AND_DISK)
            if (tree + 1) % CUT_EVERY == 0:
                state.checkpoint()
                state.count()
                cuts.append(state)
                if len(cuts) > 1:
                    _forget(cuts.pop(0))
            losses: dict[int, list] = {m: [0.0, 0] for m in grown}
            if tree + 1 in stages:
                for part in sc.runJob(state, partial(_losses, {m: jobs[m] for m in grown})):
                    for m, (loss, n) in part.items():
                        losses[m][0] += loss
                        losses[m][1] += n
            for m in sorted(grown):
                yield m, grown[m], tuple(losses[m]) if tree + 1 in stages else None
    finally:
        for x in (state, old):
            if x is not None and x is not rows:
                x.unpersist()
        for x in cuts:
            _forget(x)


def _forget(cut: RDD) -> None:
    """Deletes the checkpoint of rows that are not read again."""
    path = cut.getCheckpointFile()
    if path:
        target = cut.context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(cut.context._jsc.hadoopConfiguration()).delete(target, True)


def _packed(kind: str, to_bins: Callable[[np.ndarray], np.ndarray] | None, size: int, batches: Iterator[pa.RecordBatch]
            ) -> Iterator[pa.RecordBatch]:
    """Chunks, pickled, of rows (_cells, _y[, _fold][, _held])."""
    from pyspark import TaskContext
    start = TaskContext.get().partitionId() << 36
    held: list[pa.RecordBatch] = []
    count = 0

    def chunk() -> pa.RecordBatch:
        nonlocal start
        table = pa.Table.from_batches(held).combine_chunks()
        column = {c: table.column(c).combine_chunks() for c in table.column_names}
        cells = column["_cells"].flatten().to_numpy(zero_copy_only=False).reshape(count, size)
        bins = np.ascontiguousarray((to_bins(cells) if to_bins else cells).T.astype(kind))
        fold = labels = None
        if "_fold" in column:
            fold = column["_fold"].fill_null(NO_FOLD).to_numpy(zero_copy_only=False).astype(np.int32)
        if "_held" in column:
            lists = column["_held"]
            sizes = np.diff(lists.offsets.to_numpy())
            labels = (np.repeat(np.arange(count, dtype=np.int32), sizes),
                      lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32))
        made = Chunk(start, bins, column["_y"].to_numpy(zero_copy_only=False).astype(np.float64), fold, labels)
        start += count
        return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(made, 5)], pa.binary())], ["chunk"])

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            count += batch.num_rows
        if count >= CHUNK:
            yield chunk()
            held, count = [], 0
    if count:
        yield chunk()


def grow_models(table: DataFrame, jobs: Sequence[Job], rows: int, scale: float, widest: int,
                to_bins: Callable[[np.ndarray], np.ndarray] | None = None, stages: Sequence[int] = ()
                ) -> tuple[list[Trees], dict[int, list[float]]]:
    """Grow a model for every job; returns them, and their losses by stage.

    ``table`` has ``rows`` rows (_cells, _y[, _fold][, _held]): bin numbers below
    ``widest``, or what ``to_bins`` turns into them, the value to learn, the fold
    and the labels held.  A model's loss is its mean squared error on the fold it
    left out, after every number of trees in ``stages``.
    """
    spark = table.sparkSession
    share_package(spark)
    ensure_checkpoint_dir(spark)
    sc, size, at = spark.sparkContext, len(jobs[0].widths), frozenset(stages)
    tasks = 1 if rows <= LOCAL_ROWS else max(2, min(sc.defaultParallelism, -(-rows // TASK_ROWS)))
    parts = table.rdd.getNumPartitions()
    dealt = table.coalesce(tasks) if parts >= tasks else table.repartition(tasks)
    kind = "uint8" if widest <= 256 else "uint16"
    chunks = (dealt.mapInArrow(partial(_packed, kind, to_bins, size), T.StructType([T.StructField("chunk", T.BinaryType())]))
              .rdd.map(_opened).persist(StorageLevel.MEMORY_AND_DISK))
    trees = [Trees() for _ in jobs]
    losses: dict[int, list[float]] = {t: [float("nan")] * len(jobs) for t in stages}

    def take(found) -> None:
        for m, grown, loss in found:
            trees[m].append(grown)
            if loss is not None and loss[1]:
                losses[len(trees[m].roots)][m] = loss[0] / loss[1]

    try:
        if tasks == 1:
            groups = max(1, min(sc.defaultParallelism, len(jobs)))
            if groups > 1:
                chunks.count()  # once, before the groups read it
            each = sc.union([chunks] * groups) if groups > 1 else chunks
            ran = each.mapPartitionsWithIndex(partial(_task_models, list(jobs), groups, scale, at))
            take(sc.runJob(ran, _all))
        else:
            for start in range(0, len(jobs), MODELS):
                some = {m: jobs[m] for m in range(start, min(start + MODELS, len(jobs)))}
                take(_grown_apart(chunks, some, scale, at, tasks))
    finally:
        chunks.unpersist()
    return trees, losses


def _all(found):
    return found


def _opened(row) -> Chunk:
    return pickle.loads(bytes(row[0]))


# -- predictions ----------------------------------------------------------------------

def scores(trees: Trees, base: float, table: DataFrame, cells: str, size: int, keep: Sequence[str],
           to_bins: Callable[[np.ndarray], np.ndarray] | None = None, held: str | None = None) -> DataFrame:
    """``keep`` and ``prediction`` for every row, from its bins or what becomes them."""
    spark = table.sparkSession
    share_package(spark)
    feature, cut, left = (np.frombuffer(x, x.typecode) if len(x) else np.zeros(0, x.typecode)
                          for x in (trees.feature, trees.cut, trees.left))
    value = np.frombuffer(trees.value, "d") if len(trees.value) else np.zeros(0)
    # labels that no tree asks for need no column
    used = np.unique(feature[(feature >= size) & (left >= 0)])
    if len(used):
        feature = np.where(feature >= size, size + np.searchsorted(used, feature), feature)
    feature, cut, left = _steps(feature.astype(np.int16 if size + len(used) < STAY else np.int32), cut, left)
    shared = spark.sparkContext.broadcast((feature, cut, left, value, trees.roots, trees.depths, used - size))
    schema = T.StructType([*(table.schema[c] for c in keep), T.StructField("prediction", T.DoubleType())])
    needed = table.select(*keep, *dict.fromkeys(c for c in (cells, held) if c and c not in keep))
    return needed.mapInArrow(partial(_scored, shared, base, cells, size, tuple(keep), to_bins, held), schema)


def _scored(shared, base: float, cells: str, size: int, keep: tuple[str, ...], to_bins, held: str | None,
            batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    feature, cut, left, value, roots, depths, used = shared.value
    most = max(1, (1 << 24) // max(1, size + len(used)))
    for whole in batches:
        for at in range(0, whole.num_rows, most):
            batch = whole.slice(at, most)
            n = batch.num_rows
            x = batch.column(cells).flatten().to_numpy(zero_copy_only=False).reshape(n, size)
            bins = np.zeros((n, size + len(used)), np.int16)
            bins[:, :size] = to_bins(x) if to_bins else x
            if held and len(used):
                lists = batch.column(held)
                row = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
                label = lists.flatten().to_numpy(zero_copy_only=False)
                place = np.minimum(np.searchsorted(used, label), len(used) - 1)
                hit = used[place] == label
                bins[row[hit], size + place[hit]] = 1
            flat, start = bins.reshape(-1), np.arange(n) * bins.shape[1]
            total = np.full(n, base)
            for root, depth in zip(roots, depths):
                node = np.full(n, root, np.int32)
                for _ in range(depth):
                    node = left[node] + (flat[start + feature[node]] >= cut[node])
                total += value[node]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(total)],
                                             [*keep, "prediction"])
