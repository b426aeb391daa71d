"""Numpy union-find over the links found inside one task."""

from __future__ import annotations

import numpy as np


def join_links(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Merge the sets of ``left[i]`` and ``right[i]``; ``label`` (node -> root,
    roots map to themselves) is updated in place and left flat."""
    while True:
        ra, rb = label[left], label[right]
        open_ = ra != rb
        if not open_.any():
            return
        left, right, ra, rb = left[open_], right[open_], ra[open_], rb[open_]
        np.minimum.at(label, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up
