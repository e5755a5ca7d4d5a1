"""Binary features of corners and their matches: what finds a camera's place again when tracking fails."""

from __future__ import annotations

import numpy as np

from .motion import Motion, corners, robust_similarity
from .pixels import gaussian

#: Pixel pairs that are compared around a corner, the reach of a patch, and rows of distances held at a time.
_REACH, _ROWS = 12, 256
_PAIRS = np.clip(np.rint(np.random.default_rng(7).normal(0, 5, (256, 2, 2))), -_REACH, _REACH)
_BORDER = 18


def describe(image: np.ndarray, mask: np.ndarray | None, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Corners (x, y) and 256 bits of each, in four words: which pixel of a pair is brighter, pairs turned by the patch's direction."""
    points = corners(image, mask, most, distance=3)
    height, width = image.shape
    inside = (points >= _BORDER).all(1) & (points[:, 0] < width - _BORDER) & (points[:, 1] < height - _BORDER) if len(points) else np.zeros(0, bool)
    points = points[inside]
    if not len(points):
        return points, np.zeros((0, 4), np.uint64)
    smooth, at = gaussian(image, 5), np.rint(points).astype(int)
    oy, ox = np.mgrid[-7:8, -7:8]
    patch = image[at[:, 1, None, None] + oy, at[:, 0, None, None] + ox].astype(np.float64)
    angle = np.arctan2((patch * oy).sum((1, 2)), (patch * ox).sum((1, 2)))
    c, s = np.cos(angle)[:, None], np.sin(angle)[:, None]
    value = []
    for p in (_PAIRS[:, 0], _PAIRS[:, 1]):
        x, y = np.rint(c * p[:, 0] - s * p[:, 1]).astype(int), np.rint(s * p[:, 0] + c * p[:, 1]).astype(int)
        value.append(smooth[at[:, 1, None] + y, at[:, 0, None] + x])
    return points, np.packbits(value[0] < value[1], axis=1).view(np.uint64)


def match(a: np.ndarray, b: np.ndarray, ratio: float = 0.75) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and b whose bits differ clearly less than those of the second nearest."""
    if len(b) < 2:
        return np.zeros(0, int), np.zeros(0, int)
    left, right = [], []
    for k in range(0, len(a), _ROWS):
        d = np.bitwise_count(a[k : k + _ROWS, None] ^ b[None]).sum(2, dtype=np.int64)
        near = np.argpartition(d, 1, axis=1)[:, :2]
        two = np.take_along_axis(d, near, 1)
        order = np.argsort(two, axis=1, kind="stable")
        near, two = np.take_along_axis(near, order, 1), np.take_along_axis(two, order, 1)
        clear = two[:, 0] < ratio * two[:, 1]
        left.append(k + np.flatnonzero(clear))
        right.append(near[clear, 0])
    return np.concatenate(left) if left else np.zeros(0, int), np.concatenate(right) if right else np.zeros(0, int)


def matched_motion(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], least: int = 8, ratio: float = 0.75, rounds: int = 4000) -> Motion:
    """Motion from one description to another."""
    i, j = match(a[1], b[1], ratio)
    if len(i) < least:
        return Motion(None, len(i), 0)
    h, near = robust_similarity(a[0][i], b[0][j], 4.0, rounds)
    return Motion(h, len(i), int(near.sum()))
