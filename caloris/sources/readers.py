"""Readers of label pictures: engines plug in by name, behind one call that gives a text and how sure the engine is."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from typing import Protocol

import numpy as np

# Dot-matrix glyphs of what a temperature label holds, seven rows of up to five dots.
GLYPHS = {
    "0": (".###.", "#...#", "#..##", "#.#.#", "##..#", "#...#", ".###."),
    "1": (".#.", "##.", ".#.", ".#.", ".#.", ".#.", "###"),
    "2": (".###.", "#...#", "....#", "...#.", "..#..", ".#...", "#####"),
    "3": ("#####", "...#.", "..#..", "...#.", "....#", "#...#", ".###."),
    "4": ("...#.", "..##.", ".#.#.", "#..#.", "#####", "...#.", "...#."),
    "5": ("#####", "#....", "####.", "....#", "....#", "#...#", ".###."),
    "6": ("..##.", ".#...", "#....", "####.", "#...#", "#...#", ".###."),
    "7": ("#####", "....#", "...#.", "..#..", ".#...", ".#...", ".#..."),
    "8": (".###.", "#...#", "#...#", ".###.", "#...#", "#...#", ".###."),
    "9": (".###.", "#...#", "#...#", ".####", "....#", "...#.", ".##.."),
    ".": (".", ".", ".", ".", ".", ".", "#"),
    "-": ("....", "....", "....", "####", "....", "....", "...."),
}


class Reader(Protocol):
    """picture: dark on bright. mode: how an engine is to lay out what it sees. Gives the texts found, with a confidence each."""

    def read(self, picture: np.ndarray, mode: int) -> list[tuple[str, float]]: ...


def _dots(glyph: str) -> np.ndarray:
    return np.array([[c == "#" for c in row] for row in GLYPHS[glyph]])


class GlyphReader:
    """Reads labels drawn with GLYPHS: each run of inked columns is the glyph whose dots differ least."""

    def read(self, picture: np.ndarray, mode: int) -> list[tuple[str, float]]:
        ink = picture < 128
        rows = np.flatnonzero(ink.any(1))
        if not len(rows):
            return []
        ink = ink[rows[0] : rows[-1] + 1]
        unit = len(ink) / 7
        edges = np.flatnonzero(np.diff(np.r_[0, ink.any(0).astype(np.int8), 0])).reshape(-1, 2)
        text, sure = "", 1.0
        for a, b in edges.tolist():
            best = min((self._apart(ink[:, a:b], _dots(g), unit), g) for g in GLYPHS)
            text, sure = text + best[1], min(sure, max(0.0, 1 - best[0]))
        return [(text, sure)]

    @staticmethod
    def _apart(ink: np.ndarray, dots: np.ndarray, unit: float) -> float:
        height, width = dots.shape
        y = np.minimum((np.arange(height) + 0.5) * len(ink) / height, len(ink) - 1).astype(int)
        x = np.minimum((np.arange(width) + 0.5) * ink.shape[1] / width, ink.shape[1] - 1).astype(int)
        return float((ink[np.ix_(y, x)] != dots).mean()) + abs(ink.shape[1] / unit - width) / 5


class TesseractReader:
    """By pytesseract, which must be installed where tasks run."""

    def read(self, picture: np.ndarray, mode: int) -> list[tuple[str, float]]:
        import pytesseract

        text = pytesseract.image_to_string(picture, config=f"--psm {mode} -c tessedit_char_whitelist=0123456789.-")
        return [(text.strip(), 1.0)] if text.strip() else []


class RapidReader:
    """By rapidocr, which must be installed where tasks run; one engine a process."""

    @staticmethod
    @lru_cache(1)
    def _engine():
        import rapidocr_openvino

        return rapidocr_openvino.RapidOCR()

    def read(self, picture: np.ndarray, mode: int) -> list[tuple[str, float]]:
        found, _ = self._engine()(picture)
        return [(str(text), float(sure)) for _, text, sure in found or []]


READERS: dict[str, Callable[[], Reader]] = {"glyphs": GlyphReader, "tesseract": TesseractReader, "rapidocr": RapidReader}


def reader(name: str) -> Reader:
    if name not in READERS:
        raise ValueError(f"unknown reader {name!r}; known are {sorted(READERS)}")
    return READERS[name]()


def draw(image: np.ndarray, x: int, y: int, text: str, dot: int = 3, colour: tuple[int, int, int] = (40, 220, 40)) -> None:
    """Draw a label with GLYPHS, a dot apart, its top left at (x, y)."""
    for c in text:
        dots = np.kron(_dots(c), np.ones((dot, dot), bool))
        image[y : y + dots.shape[0], x : x + dots.shape[1]][dots] = colour
        x += dots.shape[1] + dot
