"""Columns over boxes and canvases."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Named aspect ratios.
RATIOS = {"1:1": 1.0, "4:5": 0.8, "9:16": 0.5625, "16:9": 16 / 9, "4:3": 4 / 3, "3:4": 0.75, "2:3": 2 / 3, "3:2": 1.5}


def zone(y: Column) -> Column:
    """Third of the canvas that a normalised centre falls in."""
    return F.when(y < 1 / 3, "top").when(y < 2 / 3, "middle").otherwise("bottom")


#: Places are compared in billionths, so that sums are exact and a mean doesn't hang on the order of its terms.
UNITS = 1_000_000_000


def _units(x: Column) -> Column:
    return F.round(x * UNITS).cast("long")


def _aligned(n: Column, total: Column, farthest: Column) -> Column:
    middle, left, right = (int(v * UNITS + 0.5) for v in (0.12, 0.4, 0.6))
    return F.when(n == 0, "").when(farthest < middle, "center").when(total < n * left, "left").when(total > n * right, "right").otherwise("mixed")


def alignment(centers: Column) -> Column:
    """Of an array of normalised x centres: center if all lie within 0.12 of the middle, else by a mean under 0.4 or over 0.6, in billionths."""
    places = F.transform(centers, _units)
    farthest = F.array_max(F.transform(places, lambda x: F.abs(x - UNITS // 2)))
    return _aligned(F.size(centers).cast("long"), F.aggregate(places, F.lit(0).cast("long"), lambda acc, x: acc + x), farthest)


def group_alignment(center: Column) -> Column:
    """The same of a group's rows, as an aggregate."""
    return _aligned(F.count(center), F.sum(_units(center)), F.max(F.abs(_units(center) - UNITS // 2)))


def gcd(a: Column, b: Column) -> Column:
    """Greatest common divisor of positive whole numbers up to 2**31 (Euclid, unrolled as a fold)."""
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    step = lambda s, _: F.when(s["b"] == 0, s).otherwise(F.struct(s["b"].alias("a"), F.try_mod(s["a"], s["b"]).alias("b")))
    return F.aggregate(F.sequence(F.lit(1), F.lit(46)), start, step, lambda s: s["a"])


def aspect_label(width: Column, height: Column, tolerance: float = 0.03) -> Column:
    """A named ratio within the tolerance, else the reduced fraction; empty for an empty canvas."""
    ratio = F.try_divide(width.cast("double"), height.cast("double"))
    out = F.when((width <= 0) | (height <= 0) | ratio.isNull(), "")
    for name, value in RATIOS.items():
        out = out.when(F.abs(ratio - value) / value <= tolerance, name)
    d = gcd(width, height)
    return out.otherwise(F.concat_ws(":", F.try_divide(width, d).cast("long").cast("string"), F.try_divide(height, d).cast("long").cast("string")))


def box_metrics(box: Column, width: Column, height: Column) -> Column:
    """box: struct of x0, y0, x1, y1. Centre, size and coverage, all as shares of the canvas."""
    w, h = box["x1"] - box["x0"], box["y1"] - box["y0"]
    return F.struct(
        ((box["x0"] + box["x1"]) / 2 / width).alias("x_center"),
        ((box["y0"] + box["y1"]) / 2 / height).alias("y_center"),
        (w / width).alias("width"),
        (h / height).alias("height"),
        (w * h / (width * height)).alias("coverage"),
    )


def scaled(box: Column, sx: Column, sy: Column) -> Column:
    return F.struct((box["x0"] * sx).alias("x0"), (box["y0"] * sy).alias("y0"), (box["x1"] * sx).alias("x1"), (box["y1"] * sy).alias("y1"))


def overlap(a: Column, b: Column) -> Column:
    """Intersection over union of two boxes."""
    w = F.greatest(F.lit(0), F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]))
    h = F.greatest(F.lit(0), F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]))
    area = lambda x: (x["x1"] - x["x0"]) * (x["y1"] - x["y0"])
    return F.coalesce(F.try_divide(w * h, area(a) + area(b) - w * h), F.lit(0.0))


# Margins and shares of an ad's layout, as shares of the canvas.
MARGIN, GAP, LEAST_REGION, WIDE, LEAST_CORNER = 0.03, 0.01, 0.15, 0.7, 0.15
HEIGHTS = {"headline": 0.4, "secondary_copy": 0.4, "cta": 0.2}


def _box(x: Column, y: Column, w: Column, h: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"), w.cast("double").alias("width"), h.cast("double").alias("height"))


def free_region(x: Column, y: Column, w: Column, h: Column) -> Column:
    """The part of the canvas opposite a product's box: a band above or below a wide one, else the strip beside it."""
    zero, one = F.lit(0.0), F.lit(1.0)
    right, low = x + w, y + h
    under = _box(zero, F.least(one, low + MARGIN), one, F.greatest(zero, one - F.least(one, low + MARGIN)))
    over = _box(zero, zero, one, F.greatest(zero, y - MARGIN))
    beside = _box(F.least(one, right + MARGIN), zero, F.greatest(zero, one - F.least(one, right + MARGIN)), one)
    before = _box(zero, zero, F.greatest(zero, x - MARGIN), one)
    return F.when(w > WIDE, F.when(one - low >= y, under).otherwise(over)).when(x + w / 2 < 0.5, beside).otherwise(before)


def layout(x: Column, y: Column, w: Column, h: Column, headline_first: Column, price_offer: Column) -> Column:
    """Struct of boxes for headline, secondary_copy, cta and price_offer (null where it has no place) around a product's box; null if the free region is too small."""
    region = free_region(x, y, w, h)
    rh = region["height"]
    tall = {k: v * rh for k, v in HEIGHTS.items()}
    top = region["y"] + GAP
    place = {
        "headline": F.when(headline_first, top).otherwise(top + tall["cta"] + tall["secondary_copy"]),
        "secondary_copy": F.when(headline_first, top + tall["headline"]).otherwise(top + tall["cta"]),
        "cta": F.when(headline_first, top + tall["headline"] + tall["secondary_copy"]).otherwise(top),
    }
    boxes = [_box(region["x"] + GAP, place[k], F.greatest(F.lit(0.0), region["width"] - 2 * GAP), F.greatest(F.lit(0.0), tall[k] - GAP)).alias(k) for k in HEIGHTS]
    corner = F.least(F.lit(1.0), y + h + MARGIN)
    room = F.greatest(F.lit(0.0), 1.0 - corner)
    offer = F.when(price_offer & (region["width"] < 1) & (room >= LEAST_CORNER), _box(x, corner, w, room))
    return F.when(region["width"] * rh >= LEAST_REGION, F.struct(*boxes, offer.alias("price_offer")))
