"""Per-cell arithmetic. NULL is NoData and always stays NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sensor range kept by the composite, and the display range.
DN_MIN, DN_MAX = 4000, 15176
OUT_MIN, OUT_MAX = 0, 255

# Tone chain.
BRIGHTNESS, GAMMA, CONTRAST = 15, 0.8, 30.0

# Fixed value: colour of NoData in a classified image (opaque white, RGBA).
NODATA_COLOUR = 0xFFFFFFFF


def clamp(dn: Column, lo: int = DN_MIN, hi: int = DN_MAX) -> Column:
    """Limit to [lo, hi]. The guard is needed: least/greatest skip NULLs."""
    return F.when(dn.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), dn)))


def normalize(
    dn: Column, lo: int = DN_MIN, hi: int = DN_MAX, out_lo: int = OUT_MIN, out_hi: int = OUT_MAX
) -> Column:
    """Map [lo, hi] linearly onto [out_lo, out_hi] with integer division."""
    if hi <= lo or out_hi <= out_lo:
        raise ValueError("normalize needs lo < hi and out_lo < out_hi")
    scaled = F.call_function("div", (dn.cast("bigint") - lo) * (out_hi - out_lo), F.lit(hi - lo))
    return (scaled + out_lo).cast("int")


def clamp_normalize(dn: Column, lo: int = DN_MIN, hi: int = DN_MAX) -> Column:
    return normalize(clamp(dn, lo, hi), lo, hi)


def stretch(dn: Column, p_low: Column, p_high: Column) -> Column:
    """Linear contrast stretch to 0..255, saturating at both ends.

    Cells <= 0 are fill and become NULL; a flat band (p_high = p_low) becomes 0.
    """
    scaled = F.floor((dn - p_low) / F.nullif(p_high - p_low, F.lit(0.0)) * OUT_MAX)
    saturated = F.greatest(F.lit(OUT_MIN), F.least(F.lit(OUT_MAX), scaled)).cast("int")
    return F.when(dn > 0, F.when(p_high == p_low, F.lit(0)).otherwise(saturated))


def pack_rgb(r: Column, g: Column, b: Column) -> Column:
    """RGBA in one BIGINT; a missing channel counts as 0, an all-zero cell is transparent 0."""
    r, g, b = (F.coalesce(c.cast("bigint"), F.lit(0)) for c in (r, g, b))
    opaque = r * 16777216 + g * 65536 + b * 256 + 255
    return F.when((r == 0) & (g == 0) & (b == 0), F.lit(0).cast("bigint")).otherwise(opaque)


def tone_table(
    brightness: int = BRIGHTNESS, gamma: float = GAMMA, contrast: float = CONTRAST
) -> list[int]:
    """Result of the tone chain for each of the 256 possible inputs.

    Brightness is added to non-zero values, then gamma, then contrast about
    mid-grey; every step truncates and saturates.
    """

    def saturate(v: float) -> int:
        return max(OUT_MIN, min(OUT_MAX, int(v)))

    slope = 259 * (contrast + 255) / (255 * (259 - contrast))
    table = []
    for v in range(256):
        lit = saturate(v + brightness) if v else 0
        curved = saturate(255 * (lit / 255.0) ** (1 / gamma))
        table.append(saturate(slope * (curved - 128) + 128))
    return table


def tone_adjust(v: Column, table: list[int] | None = None) -> Column:
    """Tone chain as a lookup: one array literal, no floating point per cell.

    The guard is needed: Spark takes element_at of an array without NULLs for
    non-NULL even where the index is NULL.
    """
    return F.when(v.isNotNull(), F.element_at(F.lit(table or tone_table()), v + 1))
