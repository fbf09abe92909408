"""Pixel measures of page rasters; arrays inside Arrow batches, never a row at a time in the JVM."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: Weights of red, green and blue, and what makes a dark region a redaction.
LUMINANCE = (0.2126, 0.587, 0.0722)
DARK, LEAST_AREA, LEAST_FILL = 85, 300, 0.4


def luminance(rgb) -> float:
    return float(np.dot(np.asarray(rgb, float), LUMINANCE))


def brightened(image: np.ndarray, brightness: int = 30, contrast: int = 30) -> np.ndarray:
    """Contrast stretched about its own amount, brightness added, cut to 0..255."""
    return np.clip(image.astype(float) * (contrast / 127 + 1) - contrast + brightness, 0, 255).astype(np.uint8)


def text_and_background(pixels: np.ndarray, rounds: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """The darker and the lighter of the two mean colours of the pixels around a token.

    Two means, started from the darkest and lightest pixel; one colour only gives it twice.
    """
    flat = pixels.reshape(-1, 3).astype(float)
    light = flat @ np.asarray(LUMINANCE)
    centres = np.stack([flat[light.argmin()], flat[light.argmax()]])
    for _ in range(rounds):
        near = ((flat[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        new = np.stack([flat[near == k].mean(axis=0) if (near == k).any() else centres[k] for k in (0, 1)])
        if np.allclose(new, centres):
            break
        centres = new
    order = np.argsort([luminance(c) for c in centres])
    return centres[order[0]], centres[order[1]]


def dark_boxes(gray: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(x, y, width, height) of connected dark regions that are large and fill most of their box,
    the whole page excepted. Regions are joined from the dark runs of neighbouring rows."""
    parent: list[int] = []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    runs: list[tuple[int, int, int]] = []
    above: list[int] = []
    for y, row in enumerate(gray <= DARK):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], row.astype(np.int8), [0]])))
        here = []
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            parent.append(len(runs))
            for k in above:
                if runs[k][1] < b and a < runs[k][2]:
                    parent[root(k)] = root(len(runs))
            here.append(len(runs))
            runs.append((y, a, b))
        above = here
    regions: dict[int, list[int]] = {}
    for i in range(len(runs)):
        regions.setdefault(root(i), []).append(i)
    out = []
    for members in regions.values():
        ys, xs, xe = [runs[i][0] for i in members], [runs[i][1] for i in members], [runs[i][2] for i in members]
        area, w, h = sum(b - a for a, b in zip(xs, xe)), max(xe) - min(xs), max(ys) - min(ys) + 1
        if area >= LEAST_AREA and area >= LEAST_FILL * w * h and (h, w) != gray.shape:
            out.append((min(xs), min(ys), w, h))
    return sorted(out)


def redaction_blocks(pages: DataFrame) -> DataFrame:
    """page_num, coords ('x,y,width,height') of the redactions of gray rasters.

    ``pages`` has page_num, content (one byte a pixel), width, height; rasters whose size doesn't
    fit their content give none.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for page, content, w, h in zip(batch["page_num"], batch["content"], batch["width"], batch["height"]):
                if content is not None and len(content) == w * h:
                    gray = np.frombuffer(content, np.uint8).reshape(h, w)
                    rows += [(page, ",".join(map(str, box))) for box in dark_boxes(gray)]
            yield pd.DataFrame(rows, columns=["page_num", "coords"])

    return pages.select("page_num", "content", "width", "height").mapInPandas(run, "page_num int, coords string")
