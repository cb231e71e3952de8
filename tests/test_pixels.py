"""Pixel colours against plain loops."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from admill.functions import color, pixels


def plain(values, width):
    rows = [values[i : i + 3 * width] for i in range(0, len(values), 3 * width)]
    grid = [[tuple(r[j : j + 3]) for j in range(0, len(r), 3)] for r in rows]
    flat = [p for r in grid for p in r]
    grey = [int(sum(p) / 3) for p in flat]
    best, level = -1.0, 127
    for t in range(256):
        low, high = [g for g in grey if g <= t], [g for g in grey if g > t]
        if low and high:
            between = len(low) * len(high) * (sum(low) / len(low) - sum(high) / len(high)) ** 2
            if between > best * (1 + 1e-12):
                best, level = between, t
    dark = [p for p, g in zip(flat, grey) if g <= level]
    light = [p for p, g in zip(flat, grey) if g > level]
    text = dark if len(dark) <= len(light) else light
    name = lambda ps: "#" + "".join(f"{round(sum(p[c] for p in ps) / len(ps)):02X}" for c in range(3)) if ps else None
    high, wide = max(1, int(len(grid) * 0.1)), max(1, int(width * 0.1))
    times = lambda y, x: (y < high) + (y >= len(grid) - high) + (x < wide) + (x >= width - wide)
    edge = [p for y, r in enumerate(grid) for x, p in enumerate(r) for _ in range(times(y, x))]
    mean = [sum(p[c] for p in edge) / len(edge) for c in range(3)]
    deviation = sum(math.sqrt(sum((p[c] - mean[c]) ** 2 for p in edge) / len(edge)) for c in range(3)) / 3
    return name(text), name(edge), deviation


def test_against_plain_loops(spark, tiny):
    """Components of embeddings stand for pixels."""
    vectors = spark.read.parquet(f"{tiny}/embeddings.parquet").limit(40).collect()
    rows = [(r["vec_id"], [int(abs(v) * 700) % 256 for v in list(r["embedding"])[:60]], 5) for r in vectors]
    found = {r["id"]: r["c"] for r in spark.createDataFrame(rows, "id long, p array<int>, w int").select("id", pixels.colours(F.col("p"), F.col("w")).alias("c")).collect()}
    for i, values, width in rows:
        text, edge, deviation = plain(values, width)
        assert (found[i]["text_color"], found[i]["border_color"]) == (text, edge) and found[i]["border_deviation"] == pytest.approx(deviation)
        assert 1 <= len(found[i]["palette"]) <= 3


def test_palette_and_text_of_a_sign(spark):
    p = np.full((20, 30, 3), (250, 250, 240), dtype=np.uint8)
    p[5:9, 5:20] = (200, 30, 40)
    p[12:14, 5:12] = (10, 20, 30)
    rows = [(p.ravel().tolist(), 30), ([], 3), (None, 3), ([1, 2, 3, 4], 1), ([7, 8, 9], 1), ([1, 2, 3], None)]
    got = [r[0] for r in spark.createDataFrame(rows, "p array<int>, w int").coalesce(1).select(pixels.colours(F.col("p"), F.col("w"))).collect()]
    assert got[0]["palette"] == ["#FAFAF0", "#C81E28", "#0A141E"] and got[0]["border_color"] == "#FAFAF0" and got[0]["border_deviation"] == 0
    assert got[0]["text_color"] not in ("#FAFAF0", None) and got[4]["palette"] == ["#070809"]
    assert all(g is None or g["palette"] is None for g in (got[1], got[2], got[3], got[5]))
    style = spark.createDataFrame([(0.0,), (20.0,), (None,)], "d double").select(color.background_style(F.col("d"))).collect()
    assert [r[0] for r in style] == ["Studio", "Gradient", ""]
