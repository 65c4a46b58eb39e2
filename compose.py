"""Composes every scene of an archive: ``spark-submit compose.py <input> <output>``.

Exits with 1 if anything had to be left out (the composite is written all the
same), unless ``--allow-missing`` says that this is expected.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import Observation, SparkSession

from scenetext.functions.paths import BANDS
from scenetext.plans.archive import archive_errors, archive_headers, compose_archive, write_archive
from scenetext.sources import rasters

# Rows of the report that are printed; the table itself is whole.
SHOWN = 20


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("input", help="folder with <scene>/<name>_<band>.TIF files at any depth")
    args.add_argument("output", help="folder for the result")
    args.add_argument("--bands", nargs=3, default=list(BANDS), help="red, green, blue")
    args.add_argument("--stretch", action="store_true", help="percentile stretch per band")
    args.add_argument("--image", choices=("png", "tif"), help="image files instead of a table")
    args.add_argument("--whole", action="store_true", help="read headers through Spark, whole files")
    args.add_argument("--errors", help="folder for a table of what was left out")
    args.add_argument("--allow-missing", action="store_true", help="exit with 0 even so")
    a = args.parse_args()
    spark = SparkSession.builder.appName("compose").getOrCreate()
    headers = archive_headers(spark, a.input, a.bands, not a.whole)
    errors = archive_errors(headers, a.bands)
    readable = headers.where("error IS NULL")
    damaged = Observation()
    composite = compose_archive(
        spark, a.input, a.bands, a.stretch, headers=headers, damaged=damaged
    )
    write_archive(composite, a.output, a.image)
    unread = headers.where("error IS NOT NULL").count()
    if not readable.isEmpty() and damaged.get["files"] > unread:
        # headers are fine but cells are not: name the files, at the price of one more read
        errors = archive_errors(rasters.scan_rasters(spark, a.input, a.bands), a.bands)
    if a.errors:
        errors.write.mode("overwrite").parquet(a.errors)
        errors = spark.read.parquet(a.errors)
    n = errors.count()
    print(f"left out: {n}")
    errors.orderBy("scene_id", "band", "path").show(SHOWN, truncate=False)
    spark.stop()
    sys.exit(1 if n and not a.allow_missing else 0)


if __name__ == "__main__":
    main()
