"""Colours of pixel arrays, in Arrow batches: text colour, palette, and the colour and unrest of the border.

Pixels are a row-major array of red, green and blue numbers from 0 to 255, with the picture's width. Null, empty or ragged
arrays have no colours.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

#: Colours of a palette, Lloyd steps, and the share of a picture's sides that is its border.
CLUSTERS, STEPS, BORDER = 3, 20, 0.10


def picture(values, width) -> np.ndarray | None:
    """Height by width by 3, or None."""
    if values is None or width is None or pd.isna(width) or width < 1 or not len(values) or len(values) % (3 * int(width)):
        return None
    return np.asarray(values, dtype=np.uint8).reshape(-1, int(width), 3)


def hex_of(colour: np.ndarray) -> str:
    return "#" + "".join(f"{int(v):02X}" for v in np.rint(colour))


def otsu_level(grey: np.ndarray) -> int:
    """The first grey level whose split has the greatest variance between; 127 without a split."""
    n = np.bincount(grey.ravel(), minlength=256).astype(float)
    below, part = n.cumsum(), (n * np.arange(256)).cumsum()
    over = below[-1] - below
    split = (below > 0) & (over > 0)
    if not split.any():
        return 127
    gap = np.divide(part, below, where=split, out=np.zeros(256)) - np.divide(part[-1] - part, over, where=split, out=np.zeros(256))
    return int(np.argmax(np.where(split, below * over * gap**2, -1.0)))


def text_colour(p: np.ndarray) -> str | None:
    """Mean colour of the smaller of the two classes that Otsu's level parts; the darker of equals."""
    grey = p.mean(axis=2).astype(np.uint8)
    dark = grey <= otsu_level(grey)
    chosen = p[dark if 2 * dark.sum() <= dark.size else ~dark]
    return hex_of(chosen.mean(axis=0)) if len(chosen) else None


def palette(p: np.ndarray, k: int = CLUSTERS, steps: int = STEPS) -> list[str]:
    """Up to k colours, most frequent first: Lloyd's steps from the mean colour's farthest pixels, equal pixels counted once with their number."""
    colours, n = np.unique(p.reshape(-1, 3), axis=0, return_counts=True)
    colours = colours.astype(float)
    away = ((colours - (colours * n[:, None]).sum(axis=0) / n.sum()) ** 2).sum(axis=1)
    centres = [colours[away.argmax()]]
    while len(centres) < min(k, len(colours)):
        away = np.min([((colours - c) ** 2).sum(axis=1) for c in centres], axis=0)
        centres.append(colours[away.argmax()])
    centres = np.array(centres)
    for _ in range(steps):
        nearest = ((colours[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        weight = np.bincount(nearest, weights=n, minlength=len(centres))
        new = np.array([np.bincount(nearest, weights=n * colours[:, c], minlength=len(centres)) for c in range(3)]).T
        new = np.where(weight[:, None] > 0, new / np.maximum(weight, 1)[:, None], centres)
        if np.allclose(new, centres):
            break
        centres = new
    nearest = ((colours[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
    weight = np.bincount(nearest, weights=n, minlength=len(centres))
    return [hex_of(centres[i]) for i in np.lexsort((np.arange(len(centres)), -weight)) if weight[i]]


def border(p: np.ndarray, share: float = BORDER) -> np.ndarray:
    """The pixels of the outermost share of each side, one row or column at least; a corner's count on both of its sides."""
    high, wide = (max(1, int(n * share)) for n in p.shape[:2])
    return np.vstack([side.reshape(-1, 3) for side in (p[:high], p[-high:], p[:, :wide], p[:, -wide:])])


def _colours(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for pixels, widths in batches:
        rows = []
        for values, width in zip(pixels, widths):
            p = picture(values, width)
            if p is None:
                rows.append((None, None, None, None))
                continue
            edge = border(p)
            rows.append((text_colour(p), palette(p), hex_of(edge.mean(axis=0)), float(edge.std(axis=0).mean())))
        yield pd.DataFrame(rows, columns=["text_color", "palette", "border_color", "border_deviation"])


def colours(pixels: Column, width: Column) -> Column:
    """Struct of text_color, palette, border_color and border_deviation (for color.background_style)."""
    return F.pandas_udf(_colours, "text_color string, palette array<string>, border_color string, border_deviation double")(pixels, width)
