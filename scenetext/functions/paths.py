"""Names of scene folders and band files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Channels r, g, b of the composite, in that order.
BANDS = ("B2", "B3", "B5")

BAND_FILE = r"^B[0-9A-Z]+\.TIF$"


def band_glob(bands=BANDS) -> str:
    """Reader option that prunes files by name before any of them is opened."""
    return "{" + ",".join(f"*_{b}.TIF" for b in bands) + "}"


def scene_id(path: Column) -> Column:
    """Name of the folder that holds the file."""
    return F.try_element_at(F.split(path, "/"), F.lit(-2))


def band_name(path: Column) -> Column:
    """``B2`` of ``..._B2.TIF``; NULL when the name has no band part."""
    last = F.substring_index(path, "_", -1)
    return F.when(last.rlike(BAND_FILE) & path.contains("_"), F.substring_index(last, ".", 1))


def has_band(path: Column, bands=BANDS) -> Column:
    """Whether the file name ends in one of the bands; no regular expression."""
    last = F.substring_index(path, "_", -1)
    return last.isin(*(f"{b}.TIF" for b in bands)) & path.contains("_")


def band_index(band: Column, bands=BANDS) -> Column:
    """Channel number of a band, NULL for a band outside ``bands``."""
    return F.coalesce(*(F.when(band == name, F.lit(i)) for i, name in enumerate(bands)))


def product_fields(line: Column) -> dict[str, Column]:
    """Fields of one index line ``root,scene path,file name``.

    The file name is ``<sensor>_<level>_<path><row>_<acquired>_<processed>_
    <collection>_<tier>_<band>.TIF``.
    """
    field = F.split(line, ",")
    name = F.try_element_at(field, F.lit(3))
    part = F.split(F.regexp_replace(name, r"\.TIF$", ""), "_")

    def at(i: int) -> Column:
        return F.try_element_at(part, F.lit(i))

    return {
        "root": F.try_element_at(field, F.lit(1)),
        "scene_path": F.try_element_at(field, F.lit(2)),
        "file_name": name,
        "sensor": at(1),
        "level": at(2),
        "wrs_path": F.substring(at(3), 1, 3),
        "wrs_row": F.substring(at(3), 4, 3),
        "acquired": F.try_to_date(at(4), "yyyyMMdd"),
        "processed": F.try_to_date(at(5), "yyyyMMdd"),
        "collection": at(6),
        "tier": at(7),
        "band": at(8),
    }
