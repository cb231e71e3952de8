"""Columns over hex colours: buckets, luminance, contrast, saturation. Invalid colours have defined fallbacks."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def packed(hex_color: Column) -> Column:
    """A colour as one whole number, red highest; null if the text isn't a colour."""
    return F.conv(F.regexp_extract(hex_color, "^#*([0-9A-Fa-f]{6})", 1), 16, 10).cast("int")  # no digits, no number


def _channel(number: Column, i: int) -> Column:
    return F.shiftright(number, 16 - 8 * i).bitwiseAND(F.lit(255))


def channel(hex_color: Column, i: int) -> Column:
    """Red, green or blue (i from 0) as 0 to 255; null if the text isn't a colour."""
    return _channel(packed(hex_color), i)


def channels(hex_color: Column) -> tuple[Column, Column, Column]:
    return channel(hex_color, 0), channel(hex_color, 1), channel(hex_color, 2)


def _parts(palette: Column) -> Column:
    """Array of r, g, b of a palette's colours: each text is read once, however often its parts are used."""
    return F.transform(F.transform(palette, packed), lambda v: F.struct(*[_channel(v, i).alias(c) for i, c in enumerate("rgb")]))


def _ends(palette: Column) -> Column:
    return F.transform(_parts(palette), lambda c: c.withField("high", F.greatest(c["r"], c["g"], c["b"])).withField("low", F.least(c["r"], c["g"], c["b"])))


def bucket(hex_color: Column) -> Column:
    def name(c: Column) -> Column:
        gray = F.when(c["high"] > 200, "white").when(c["high"] < 50, "black").otherwise("gray")
        named = F.when(c["r"] == c["high"], "red").when(c["g"] == c["high"], "green").otherwise("blue")
        return F.when(c["high"].isNull(), "unknown").when(c["high"] - c["low"] < 30, gray).otherwise(named)

    return F.get(F.transform(_ends(F.array(hex_color)), name), F.lit(0))


def luminance(hex_color: Column) -> Column:
    """Relative luminance from 0 to 1; 0.5 where the colour is unknown."""

    def linear(c: Column) -> Column:
        x = c / 255.0
        return F.when(x <= 0.03928, x / 12.92).otherwise(F.pow((x + 0.055) / 1.055, F.lit(2.4)))

    r, g, b = channels(hex_color)
    return F.coalesce(0.2126 * linear(r) + 0.7152 * linear(g) + 0.0722 * linear(b), F.lit(0.5))


def contrast(front: Column, back: Column) -> Column:
    """Contrast ratio from 1 to 21; 1 where either colour is missing."""
    a, b = luminance(front), luminance(back)
    missing = F.coalesce(front, F.lit("")).eqNullSafe("") | F.coalesce(back, F.lit("")).eqNullSafe("")
    return F.when(missing, F.lit(1.0)).otherwise((F.greatest(a, b) + 0.05) / (F.least(a, b) + 0.05))


def is_warm(hex_color: Column) -> Column:
    r, _, b = channels(hex_color)
    return F.coalesce((r > 150) & (b < 150), F.lit(False))


def saturations(palette: Column) -> Column:
    """Of each colour of a palette; null where the text isn't a colour."""
    return F.transform(_ends(palette), lambda c: F.when(c["high"] == 0, F.lit(0.0)).otherwise((c["high"] - c["low"]) / c["high"]))


def saturation(hex_color: Column) -> Column:
    return F.get(saturations(F.array(hex_color)), F.lit(0))


def vibrancy(palette: Column) -> Column:
    """Sample deviation of the saturations of a palette's valid colours; null with fewer than two. One pass, each colour read once; equal saturations deviate by exactly 0."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("squares"))

    def step(acc: Column, s: Column) -> Column:
        n, off = acc["n"] + 1, s - acc["mean"]
        mean = acc["mean"] + off / n
        return F.when(s.isNull(), acc).otherwise(F.struct(n.alias("n"), mean.alias("mean"), (acc["squares"] + off * (s - mean)).alias("squares")))

    return F.aggregate(saturations(palette), start, step, lambda acc: F.when(acc["n"] >= 2, F.sqrt(acc["squares"] / (acc["n"] - 1))))


def group_vibrancy(hex_color: Column) -> Column:
    """The same of a group's rows, as an aggregate: palettes of any size, none of them collected."""
    return F.stddev_samp(saturation(hex_color))


def vibrancy_or_default(palette: Column) -> Column:
    """A vibrancy of zero counts as missing, like none at all."""
    return F.coalesce(F.nullif(vibrancy(palette), F.lit(0.0)), F.lit(0.5))


def contrast_class(luminances: Column) -> Column:
    """From 0 to 255 each: a spread of 140 is high, up to 50 low."""
    spread = F.array_max(luminances) - F.array_min(luminances)
    return F.when(spread >= 140, "High").when(spread <= 50, "Low").otherwise("Medium")


def legible(requested: Column, back: Column, least: float = 4.5) -> Column:
    """The requested colour if its contrast suffices, else black or white, whichever contrasts more."""
    plain = F.when(contrast(F.lit("#000000"), back) >= contrast(F.lit("#ffffff"), back), "#000000").otherwise("#ffffff")
    return F.when(contrast(requested, back) >= least, requested).otherwise(plain)


def otsu_threshold(histogram: Column) -> Column:
    """Otsu's threshold of an array of counts by grey level: the first level whose split has the greatest variance between; 127 without a split."""
    total = F.aggregate(histogram, F.lit(0.0), lambda acc, n: acc + n)
    weighted = F.aggregate(F.transform(histogram, lambda n, i: n * i.cast("double")), F.lit(0.0), lambda acc, v: acc + v)
    start = F.struct(F.lit(0).alias("level"), F.lit(0.0).alias("below"), F.lit(0.0).alias("sum"), F.lit(-1.0).alias("best"), F.lit(127).alias("at"))

    def step(acc: Column, n: Column) -> Column:
        below, part = acc["below"] + n, acc["sum"] + n * acc["level"]
        over = acc["all"] - below
        split = (below > 0) & (over > 0)
        gap = F.try_divide(part, below) - F.try_divide(acc["whole"] - part, over)
        better = split & (below * over * gap * gap > acc["best"])
        return F.struct(
            (acc["level"] + 1).alias("level"), below.alias("below"), part.alias("sum"), F.when(better, below * over * gap * gap).otherwise(acc["best"]).alias("best"),
            F.when(better, acc["level"]).otherwise(acc["at"]).alias("at"), acc["all"].alias("all"), acc["whole"].alias("whole"),
        )

    first = start.withField("all", total).withField("whole", weighted)
    return F.aggregate(histogram, first, step, lambda acc: acc["at"])


def background_style(deviation: Column) -> Column:
    """By the mean deviation of a background's channels: Studio, Gradient or Busy; empty without pixels."""
    return F.when(deviation.isNull(), "").when(deviation < 12, "Studio").when(deviation < 40, "Gradient").otherwise("Busy")
