"""Scalar column functions: scores, rectangles, colours, text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lit(x: float | Column) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def once(x: Column, f) -> Column:
    """``f`` of ``x``, which is computed once however often ``f`` names it."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def rounded(x: Column, digits: int = 4) -> Column:
    """Half-up rounding by way of floor; both engines of the tests compute it alike."""
    scale = float(10**digits)
    return F.floor(x * scale + 0.5) / scale


def clamp(x: Column, lower: float = 0.0, upper: float = 100.0) -> Column:
    """``x`` within bounds; NaN and infinities become the lower bound, null stays null."""
    odd = F.isnan(x) | (F.abs(x) == float("inf"))
    return F.when(odd, F.lit(float(lower))).when(x.isNotNull(), F.greatest(lit(lower), F.least(lit(upper), x)))


def gaussian_score(x: Column, mean: float | Column, sigma: float) -> Column:
    if sigma <= 0:
        return F.when(x.isNotNull(), F.lit(0.0))
    return clamp(100.0 * F.exp(-((x - mean) * (x - mean)) / (2.0 * sigma * sigma)))


def sigmoid_score(x: Column, target: float, k: float) -> Column:
    return clamp(100.0 / (1.0 + F.exp(-k * (x - target))))


def band_score(x: Column, lower: float, upper: float, sigma_low: float, sigma_high: float) -> Column:
    """100 within the band, a Gaussian flank on either side."""
    return (
        F.when(x.between(lower, upper), F.lit(100.0)).when(x < lower, gaussian_score(x, lower, sigma_low)).otherwise(gaussian_score(x, upper, sigma_high))
    )


def variation(total: Column, squares: Column, n: Column) -> Column:
    """Coefficient of variation (population) from a sum, a sum of squares and a count."""
    mean = total / n
    return F.when((n < 2) | (F.abs(mean) < 1e-9), F.lit(0.0)).otherwise(F.abs(F.sqrt(F.greatest(squares / n - mean * mean, F.lit(0.0))) / mean))


def intersection(ax: Column, ay: Column, aw: Column, ah: Column, bx: Column, by: Column, bw: Column, bh: Column) -> Column:
    zero = F.lit(0.0)
    return F.greatest(zero, F.least(ax + aw, bx + bw) - F.greatest(ax, bx)) * F.greatest(zero, F.least(ay + ah, by + bh) - F.greatest(ay, by))


def iou(ax: Column, ay: Column, aw: Column, ah: Column, bx: Column, by: Column, bw: Column, bh: Column) -> Column:
    shared = intersection(ax, ay, aw, ah, bx, by, bw, bh)
    union = aw * ah + bw * bh - shared
    return F.when(union > 0, shared / union).otherwise(0.0)


def contains(ox: Column, oy: Column, ow: Column, oh: Column, ix: Column, iy: Column, iw: Column, ih: Column, tolerance: float) -> Column:
    return (ix >= ox - tolerance) & (iy >= oy - tolerance) & (ix + iw <= ox + ow + tolerance) & (iy + ih <= oy + oh + tolerance)


def normalize_text(x: Column) -> Column:
    """Lower case without white space and punctuation; null counts as empty."""
    return F.regexp_replace(F.lower(F.trim(F.coalesce(x, F.lit("")))), r"[\s,，。.!！?？:：;；·\-_/\\|]+", "")


def number_of(text: Column, pattern: str) -> Column:
    """The number in the first group of ``pattern``, which matches a text as a whole; null where it doesn't.

    Nothing is cast there: a cast that fails makes an exception, even where it gives null.
    """
    return F.get(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(0)).try_cast("double")


def channel(color: Column, at: int) -> Column:
    """The two hex digits at ``at`` (from 1) as a number from 0 to 1."""
    return F.conv(F.substring(color, at, 2), 16, 10).cast("double") / 255.0


def parse_color(color: Column) -> Column:
    """#RRGGBB or #AARRGGBB to struct(r, g, b, a) from 0 to 1; null for anything else. Its digits are read as one number."""
    long = F.length(color) == 9
    digits = F.when(long, F.substring(color, 2, 8)).otherwise(F.substring(color, 2, 6))

    def channels(n: Column) -> Column:
        byte = lambda at: F.shiftright(n, at).bitwiseAND(F.lit(255)).cast("double") / 255.0
        return F.struct(byte(16).alias("r"), byte(8).alias("g"), byte(0).alias("b"), F.when(long, byte(24)).otherwise(1.0).alias("a"))

    return F.when(color.rlike("^#([0-9A-Fa-f]{6}|[0-9A-Fa-f]{8})$"), once(F.conv(digits, 16, 10).cast("long"), channels))


def composite(top: Column, bottom: Column) -> Column:
    """``top`` over ``bottom``, both struct(r, g, b, a)."""
    a = top["a"] + bottom["a"] * (1.0 - top["a"])

    def mix(c: str) -> Column:
        return F.when(a > 0, (top[c] * top["a"] + bottom[c] * bottom["a"] * (1.0 - top["a"])) / a).otherwise(0.0).alias(c)

    return F.struct(mix("r"), mix("g"), mix("b"), a.alias("a"))


def luminance(color: Column, knee: float = 0.04045) -> Column:
    def linear(c: Column) -> Column:
        return F.when(c <= knee, c / 12.92).otherwise(F.pow((c + 0.055) / 1.055, F.lit(2.4)))

    return once(color, lambda c: 0.2126 * linear(c["r"]) + 0.7152 * linear(c["g"]) + 0.0722 * linear(c["b"]))


def contrast_of(a: Column, b: Column) -> Column:
    """The contrast ratio of two luminances."""
    return (F.greatest(a, b) + 0.05) / (F.least(a, b) + 0.05)


def contrast_ratio(a: Column, b: Column, knee: float = 0.04045) -> Column:
    return once(F.struct(luminance(a, knee).alias("a"), luminance(b, knee).alias("b")), lambda p: contrast_of(p["a"], p["b"]))


def hue_degrees(color: Column) -> Column:
    """Hue of a chromatic colour; null for one that is grey, nearly black or white, or transparent."""

    def hue(c: Column) -> Column:
        hi, lo = F.greatest(c["r"], c["g"], c["b"]), F.least(c["r"], c["g"], c["b"])
        span = hi - lo
        found = (
            F.when(hi == c["r"], F.pmod((c["g"] - c["b"]) / span, F.lit(6.0)))
            .when(hi == c["g"], (c["b"] - c["r"]) / span + 2.0)
            .otherwise((c["r"] - c["g"]) / span + 4.0)
            * 60.0
        )
        return F.when((c["a"] >= 0.2) & (span >= 0.12), found)

    return once(color, hue)


def text_width(x: Column, size: Column, space: float, wide: float, alnum: float, other: float) -> Column:
    """Estimated width of one line: em shares of four classes of characters."""
    n = F.length(x)
    spaces = n - F.length(F.regexp_replace(x, r"[ \t\n\r\x0b\f]", ""))
    wides = n - F.length(F.regexp_replace(x, "[⺀-\U0010ffff]", ""))
    alnums = n - F.length(F.regexp_replace(x, "[A-Za-z0-9]", ""))
    return size * (spaces * space + wides * wide + alnums * alnum + (n - spaces - wides - alnums) * other)


def has_cjk(x: Column) -> Column:
    return x.rlike("[㐀-鿿豈-﫿]")


def grade(score: Column) -> Column:
    """Fixed thresholds: S 95, A+ 90, A 85, B+ 80, B 70, C 60, else D."""
    out = F.lit("D")
    for name, least in (("C", 60), ("B", 70), ("B+", 80), ("A", 85), ("A+", 90), ("S", 95)):
        out = F.when(score >= least, name).otherwise(out)
    return out


def calibrate(score: Column, a: float = 0.830716, b: float = 11.831671) -> Column:
    """Linear calibration, clamped, to the nearest half."""
    return F.floor(clamp(a * score + b) * 2.0 + 0.5) / 2.0


def bin_of(score: Column) -> Column:
    """Histogram bin, each [low, high): 90+, 80, 75, 70, 60, <60."""
    return (
        F.when(score >= 90, "90+").when(score >= 80, "80-90").when(score >= 75, "75-80").when(score >= 70, "70-75").when(score >= 60, "60-70").otherwise("<60")
    )


def safe_name(x: Column) -> Column:
    """A file name: runs of other characters become one underscore, outer dots and underscores go."""
    out = F.regexp_replace(F.regexp_replace(x, r"[^A-Za-z0-9._-]+", "_"), r"^[._]+|[._]+$", "")
    return F.when(out == "", "item").otherwise(out)


def pointer_get(json: Column, pointer: str) -> Column:
    """The value at an RFC 6901 pointer of JSON text, as text; the whole text for "" and "/"."""
    if pointer in ("", "/"):
        return json
    path = "$"
    for part in pointer.strip("/").split("/"):
        part = part.replace("~1", "/").replace("~0", "~")
        path += f"[{part}]" if part.isdigit() else f"['{part}']"
    return F.get_json_object(json, path)
