"""Real files: listing, decoding, damaged input, image files."""

import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, In
from pyspark.sql.types import StructType

from scenetext.operators import raster as R
from scenetext.operators import tiles as T
from scenetext.plans.archive import archive_errors, archive_headers, compose_archive, write_archive
from scenetext.sinks import scenes as K
from scenetext.sinks.folders import shared_folder
from scenetext.sources import rasters as S
from scenetext.sources.cells import SLICE_CELLS, slices
from scenetext.sources.stores import qualified
from scenetext.sources.tiff import read_band, read_header, write_image
from scenetext.sources.windows import WindowReader, scan_windows

EXTENT = (100.0, 200.0, 140.0, 230.0)


def image(seed, shape=(30, 40), low=0, high=20000):
    return np.random.default_rng(seed).integers(low, high, shape).astype(np.uint16)


def save(root, scene, band, data):
    folder = root / "190" / "026" / scene
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{scene}_{band}.TIF").write_bytes(data)


@pytest.fixture
def archive(tmp_path):
    for k, scene in enumerate(("SC1", "SC2")):
        for j, band in enumerate(("B1", "B2", "B3", "B5", "B12", "BQA")):
            data = write_image(
                image(10 * k + j)[None], EXTENT, 32633, nodata=0, deflate=bool(j % 2), tile=16 if k else None
            )
            save(tmp_path, scene, band, data)
    return tmp_path


@pytest.mark.parametrize("dtype", [np.uint8, np.uint16])
@pytest.mark.parametrize("bands", [1, 3])
@pytest.mark.parametrize("deflate", [False, True])
@pytest.mark.parametrize("tile", [None, 16])
def test_image_round_trip(dtype, bands, deflate, tile):
    data = image(1, (bands, 30, 40), high=250).astype(dtype)
    raw = write_image(data, EXTENT, 32633, 7, deflate, tile)
    head = read_header(raw)
    assert tuple(head["extent"].values()) == EXTENT
    assert (head["cols"], head["rows"], head["bands"], head["crs"], head["nodata"]) == (40, 30, bands, "EPSG:32633", 7)
    assert all((read_band(raw, head, b) == data[b]).all() for b in range(bands))


def test_big_endian_strips_and_predictor():
    """A file built by hand: two strips, horizontal differencing, no georeference."""
    data = image(2, (4, 5))
    strips = [np.diff(s, axis=1, prepend=np.uint16(0)).astype(">u2").tobytes() for s in (data[:3], data[3:])]
    packed = [zlib.compress(s) for s in strips]
    start = 8 + sum(map(len, packed))
    start += start % 2
    at = [8, 8 + len(packed[0])]
    tags = [(256, 3, [5]), (257, 3, [4]), (258, 3, [16]), (259, 3, [8]), (277, 3, [1]), (278, 3, [3]), (317, 3, [2])]
    extra = start + 2 + 12 * (len(tags) + 2) + 4
    table = struct.pack(">H", len(tags) + 2)
    for tag, kind, (v,) in tags[:4]:
        table += struct.pack(">HHIHH", tag, kind, 1, v, 0)
    table += struct.pack(">HHII", 273, 4, 2, extra)
    for tag, kind, (v,) in tags[4:6]:
        table += struct.pack(">HHIHH", tag, kind, 1, v, 0)
    table += struct.pack(">HHII", 279, 4, 2, extra + 8)
    table += struct.pack(">HHIHH", 317, 3, 1, 2, 0) + struct.pack(">I", 0)
    lists = struct.pack(">4I", *at, *map(len, packed))
    raw = b"MM\0*" + struct.pack(">I", start) + b"".join(packed).ljust(start - 8, b"\0") + table + lists
    head = read_header(raw)
    assert tuple(head["extent"].values()) == (0.0, 0.0, 5.0, 4.0) and head["crs"] is None
    assert (read_band(raw, head) == data).all()


def test_listing_prunes_other_bands(spark, archive, rows):
    catalog = S.scene_catalog(S.raster_files(spark, str(archive)).select("path", "length"))
    want = [(s, b, i) for s in ("SC1", "SC2") for i, b in enumerate(("B2", "B3", "B5"))]
    assert rows(catalog, "scene_id", "band", "band_index") == want
    assert rows(S.scene_band_counts(catalog)) == [("SC1", 3, True), ("SC2", 3, True)]


def test_catalog_of_paths(spark, rows):
    names = ["B2", "B3", "B5", "B1", "B12", "BQA"]
    paths = spark.createDataFrame([(f"/d/1985/190/026/SC1/SC1_{b}.TIF",) for b in names], "path STRING")
    odd = spark.createDataFrame([("/d/SC1/xB2.TIF",), ("SC1_B2.TIF",), ("/d/SC1/readme.txt",)], "path STRING")
    got = rows(S.scene_catalog(paths.union(odd)), "scene_id", "band", "band_index")
    assert got == [("SC1", "B2", 0), ("SC1", "B3", 1), ("SC1", "B5", 2), (None, "B2", 0)]


def test_index_line(spark):
    name = "LC08_L1GT_001003_20170921_20170921_01_RT"
    df = spark.createDataFrame([(f"http://h/c1/L8,001/003/{name},{name}_B10.TIF",), ("broken",)], "line STRING")
    got = S.scene_index(df).collect()
    good = [r for r in got if r["band"]][0]
    assert (good["wrs_path"], good["wrs_row"], str(good["acquired"]), good["band"]) == ("001", "003", "2017-09-21", "B10")
    assert good["scene_path"] == f"001/003/{name}" and len(got) == 2


def test_scan_equals_the_written_images(spark, archive):
    got = S.scan_rasters(spark, str(archive)).collect()
    assert len(got) == 6 and all(r["error"] is None and r["crs"] == "EPSG:32633" for r in got)
    for r in got:
        seed = 10 * ("SC1", "SC2").index(r["scene_id"]) + ("B1", "B2", "B3", "B5").index(r["band"])
        want = [int(v) or None for v in image(seed).reshape(-1)]
        assert r["cells"] == want and (r["cols"], r["rows"]) == (40, 30)
        assert (r["xmin"], r["ymin"], r["xmax"], r["ymax"]) == EXTENT


def test_windows_cover_the_file(spark, archive, rows):
    whole = S.scan_rasters(spark, str(archive))
    cut = S.scan_rasters(spark, str(archive), window=16)
    assert cut.count() == 6 * 6

    def placed(tiles):
        px = S.raster_pixels(tiles)
        return px.select("path", F.col("x") + F.col("xmin"), F.col("ymax") - F.col("y"), "dn")

    assert rows(placed(cut)) == rows(placed(whole))


def test_unreadable_files_become_error_rows(spark, archive):
    good = write_image(image(0)[None])
    save(archive, "BAD", "B2", good[: len(good) // 2])
    save(archive, "BAD", "B3", b"not an image")
    save(archive, "BAD", "B5", good.replace(struct.pack("<HHII", 259, 3, 1, 8), struct.pack("<HHII", 259, 3, 1, 5)))
    info = {r["path"].rsplit("/", 1)[1]: r for r in S.raster_info(spark, str(archive)).collect()}
    assert len(info) == 9 and info["BAD_B3.TIF"]["error"] and info["BAD_B2.TIF"]["error"]
    fine = info["SC1_B2.TIF"]
    assert (fine["format"], fine["cols"], fine["rows"], fine["bands"], fine["error"]) == ("GTiff", 40, 30, 1, None)
    scan = S.scan_rasters(spark, str(archive)).where("scene_id = 'BAD'").collect()
    assert len(scan) == 3 and all(r["error"] and r["cells"] is None for r in scan)
    assert any("compression 5" in r["error"] for r in scan)


def test_what_is_left_out_is_reported(spark, archive, rows):
    assert rows(archive_errors(archive_headers(spark, str(archive)))) == []
    good = write_image(image(0)[None], EXTENT, 32633)
    save(archive, "BAD", "B2", good)
    save(archive, "BAD", "B3", b"not an image")
    got = rows(archive_errors(archive_headers(spark, str(archive))), "scene_id", "band", F.col("path").isNull())
    assert got == [("BAD", "B3", False), ("BAD", "B3", True), ("BAD", "B5", True)]


def test_damage_behind_a_good_header_is_counted(spark, archive, rows):
    good = write_image(image(0)[None], EXTENT, 32633)
    save(archive, "BAD", "B2", good[: len(good) // 2])
    for band in ("B3", "B5"):
        save(archive, "BAD", band, good)
    seen = Observation()
    compose_archive(spark, str(archive), tile=16, damaged=seen).collect()
    assert seen.get == {"files": 1}
    got = rows(archive_errors(S.scan_rasters(spark, str(archive))), "scene_id", "band", F.col("path").isNull())
    assert got == [("BAD", "B2", False), ("BAD", "B2", True)]


def test_reference_systems_and_cell_sizes_stay_apart(spark, tmp_path, rows):
    for k, (name, crs) in enumerate((("a", 32631), ("b", 32632))):
        for band in ("B2", "B3", "B5"):
            folder = tmp_path / name / "SC1"
            folder.mkdir(parents=True, exist_ok=True)
            (folder / f"SC1_{band}.TIF").write_bytes(write_image(image(k)[None], EXTENT, crs))
            wide = (100.0, 200.0, 140.0, 230.0 + 30 * k)
            save(tmp_path / name, "SC2", band, write_image(image(k)[None], wide, 32633))
    headers = archive_headers(spark, str(tmp_path))
    assert rows(archive_errors(headers)) == [(None, "SC2", None, "cell sizes differ in EPSG:32633")]
    made = compose_archive(spark, str(tmp_path), tile=64, headers=headers)
    assert rows(made, "scene_id", "crs") == [("SC1", "EPSG:32631"), ("SC1", "EPSG:32632")]
    cells = {r["crs"]: r["r"] for r in made.collect()}
    assert cells["EPSG:32631"] != cells["EPSG:32632"]


@pytest.mark.parametrize("stretch", [False, True])
def test_files_are_read_once(spark, archive, stretch, monkeypatch):
    reads = spark.sparkContext.accumulator(0)
    scan = S.scan_rasters

    def counted(*args):
        def count(batches):
            for b in batches:
                reads.add(b.num_rows)
                yield b

        tiles = scan(*args)
        return tiles.mapInArrow(count, tiles.schema)

    monkeypatch.setattr(S, "scan_rasters", counted)
    compose_archive(spark, str(archive), stretch=stretch, tile=16).collect()
    assert reads.value == 6 * (2 if stretch else 1)


def test_ranged_headers_equal_whole_reads(spark, archive, rows):
    save(archive, "BAD", "B3", b"not an image")
    save(archive, "BAD", "B2", write_image(image(0)[None])[:5000])
    whole = S.raster_info(spark, str(archive))
    ranged = S.raster_info(spark, str(archive), ranged=True)
    assert rows(ranged, *whole.columns[:-1]) == rows(whole, *whole.columns[:-1])
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


@pytest.mark.parametrize("ranged", [False, True])
def test_archive_to_table(spark, archive, tmp_path_factory, rows, ranged):
    out = str(tmp_path_factory.mktemp("table"))
    made = compose_archive(spark, str(archive), ranged=ranged, tile=16)
    write_archive(made, out)
    assert rows(spark.read.parquet(out), *made.columns) == rows(composite(spark, archive)[1])


def test_archive_stretched(spark, archive, rows):
    made = compose_archive(spark, str(archive), stretch=True, tile=16)
    tiles = S.scan_rasters(spark, str(archive))
    px = S.raster_pixels(tiles)
    want = R.stretch_stack(px, ["path"], ("B2", "B3", "B5"))
    assert rows(T.to_pixels(made, 16)) == rows(want.dropna("all", subset=["r", "g", "b"]))


def test_missing_file_header_fields_do_not_stop_the_job(spark, archive):
    save(archive, "BAD", "B2", b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", 0) + b"\0" * 4)
    save(archive, "BAD", "B3", b"II*\0" + struct.pack("<I", 10**9))
    scan = S.scan_rasters(spark, str(archive)).where("scene_id = 'BAD'").collect()
    assert len(scan) == 2 and all(r["error"] for r in scan)


def composite(spark, archive):
    tiles = S.scan_rasters(spark, str(archive), window=16).withColumn("source", F.col("path"))
    headers = S.raster_info(spark, str(archive))
    headers = S.scene_catalog(headers).withColumn("source", F.col("path"))
    return tiles, T.composite(tiles, headers, tile=16)


def test_files_to_composite(spark, archive, rows):
    tiles, made = composite(spark, archive)
    px = S.raster_pixels(tiles).withColumns(
        {"x": (F.col("x") + F.col("xmin") - 100).cast("int"), "y": (F.col("y") + 230 - F.col("ymax")).cast("int")}
    )
    want = R.band_stack(R.clamp_normalize(px), ["path"])
    got = T.to_pixels(made, 16)
    assert rows(got) == rows(want.dropna("all", subset=["r", "g", "b"]))
    assert made.count() == 2 * 3 * 2


def test_png(spark, archive):
    _, made = composite(spark, archive)
    tile = made.where("scene_id = 'SC1' AND layout_col = 2 AND layout_row = 1")
    png = K.render_tiles(tile).first()["image"]
    wide, tall = struct.unpack(">II", png[16:24])
    assert png[:8] == b"\x89PNG\r\n\x1a\n" and (wide, tall) == (8, 14)
    size = struct.unpack(">I", png[33:37])[0]
    lines = np.frombuffer(zlib.decompress(png[41 : 41 + size]), np.uint8).reshape(tall, 1 + 3 * wide)
    want = [v or 0 for v in tile.first()["r"]]
    assert lines[:, 1::3].reshape(-1).tolist() == want and not lines[:, 0].any()


def test_pixels_gather_into_the_same_tiles(spark, archive, rows):
    _, made = composite(spark, archive)
    rgb = T.to_pixels(made, 16).fillna(0)
    tiles = K.pixels_to_tiles(R.tile_layout(rgb, 16))
    filled = made.selectExpr(
        "scene_id", "layout_col", "layout_row", "cols", "rows",
        *(f"transform({c}, v -> coalesce(v, 0)) AS {c}" for c in "rgb"),
    )
    assert rows(tiles) == rows(filled)


@pytest.mark.parametrize("kind", ["png", "tif"])
def test_image_files_by_executors(spark, archive, tmp_path_factory, kind):
    out = tmp_path_factory.mktemp("images")
    _, made = composite(spark, archive)
    images = K.render_tiles(made, kind)
    for _ in range(2):  # a second run replaces the files
        K.write_images(images, f"file://{out}", kind)
    cells = [f"EPSG-32633_{row}_{col}.{kind}" for row in (0, 1) for col in (0, 1, 2)]
    assert files(out) == sorted(f"SC{s}/{c}" for s in (1, 2) for c in cells)
    first = images.where("scene_id = 'SC1' AND layout_col = 0 AND layout_row = 0").first()["image"]
    assert (out / f"SC1/{cells[0]}").read_bytes() == bytes(first)
    # a smaller run replaces the scene it has and leaves the other alone
    K.write_images(images.where("scene_id = 'SC1' AND layout_row = 1"), f"file://{out}", kind)
    assert files(out) == sorted([f"SC1/{c}" for c in cells[3:]] + [f"SC2/{c}" for c in cells])
    manifest = next(p for p in out.glob("SC1/_manifest")).read_text()
    assert manifest.splitlines() == cells[3:]


def files(out):
    """Published files: relative names, without hidden ones. No draft may be left."""
    names = sorted(str(p.relative_to(out)) for p in out.rglob("*") if p.is_file())
    assert not [n for n in names if "_staging" in n or n.endswith(".new")]
    return [n for n in names if not n.rsplit("/", 1)[-1].startswith(("_", "."))]


def test_failed_task_leaves_no_file(spark, tmp_path):
    good = spark.createDataFrame([("SC1/0.png", b"old")], "name STRING, image BINARY")
    K.write_files(good, str(tmp_path))
    broken = spark.range(4).selectExpr(
        "concat('SC1/', id, '.png') AS name", "CASE WHEN id < 3 THEN X'00' ELSE CAST(raise_error('stop') AS BINARY) END AS image"
    )
    with pytest.raises(Exception, match="stop"):
        K.write_files(broken, str(tmp_path))
    assert files(tmp_path) == ["SC1/0.png"] and (tmp_path / "SC1/0.png").read_bytes() == b"old"


def test_grids_with_and_without_reference_system_do_not_meet(spark, tmp_path):
    images = spark.createDataFrame(
        [("S", None, 0, 0, b"a"), ("S", "EPSG:1", 0, 0, b"b")], "scene_id STRING, crs STRING, layout_row INT, layout_col INT, image BINARY"
    )
    K.write_images(images, str(tmp_path))
    assert files(tmp_path) == ["S/EPSG-1_0_0.png", "S/unknown_0_0.png"]


def test_paths_follow_the_default_file_system(spark, tmp_path):
    conf = spark._jsc.hadoopConfiguration()
    assert qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    before = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "viewfs://store/")
    conf.set("fs.viewfs.mounttable.store.link./in", f"file://{tmp_path}")
    try:
        assert qualified(spark, "/in/x") == "viewfs://store/in/x"
        assert qualified(spark, f"file://{tmp_path}") == f"file:{tmp_path}"
    finally:
        conf.set("fs.defaultFS", before)


@pytest.fixture
def large(tmp_path):
    """One large file of blocks, and another band that no one can read."""
    data = image(5, (200, 150))
    save(tmp_path, "SC1", "B2", write_image(data[None], EXTENT, 32633, nodata=0, deflate=False, tile=16))
    save(tmp_path, "SC1", "B3", b"not an image")
    save(tmp_path, "SC2", "B2", b"not an image")
    return tmp_path, data


def test_one_file_is_read_by_several_tasks(spark, large, rows):
    root, data = large
    tiles = scan_windows(spark, str(root), split_bytes=10_000, window=32).where("band = 'B2' AND scene_id = 'SC1'")
    assert tiles.rdd.getNumPartitions() == 7  # 66 KB and no other file
    got = tiles.collect()
    assert not [r for r in got if r["error"]]
    seen = np.zeros(data.shape, int)
    for r in got:
        part = np.s_[r["top"] : r["top"] + r["rows"], r["left"] : r["left"] + r["cols"]]
        assert [v or 0 for v in r["cells"]] == data[part].reshape(-1).tolist()
        seen[part] += 1
        assert r["ymax"] == pytest.approx(230 - r["top"] * 30 / 200) and r["xmin"] == pytest.approx(100 + r["left"] * 40 / 150)
    assert (seen == 1).all()


def test_pushed_filters_leave_other_files_closed(spark, large):
    root, _ = large
    every = scan_windows(spark, str(root), split_bytes=10_000)
    assert sorted((r["scene_id"], r["band"]) for r in every.where("error IS NOT NULL").collect()) == [("SC1", "B3"), ("SC2", "B2")]
    picked = every.where("scene_id = 'SC1' AND band = 'B2'")
    assert picked.where("error IS NOT NULL").count() == 0
    reader = WindowReader(StructType(), str(root), 10_000, 512, [0])
    left = list(reader.pushFilters([EqualTo(("band",), "B2"), In(("scene_id",), ("SC1",)), EqualTo(("top",), 0)]))
    assert left == [EqualTo(("top",), 0)]
    assert {p.path.rsplit("/", 1)[1] for group in reader.partitions() for p in group.parts} == {"SC1_B2.TIF"}


def test_small_files_share_a_task(spark, archive):
    tiles = scan_windows(spark, str(archive))
    assert tiles.rdd.getNumPartitions() == 1 and tiles.count() == 6
    whole = S.scan_rasters(spark, str(archive)).select("scene_id", "band", "cells", "xmin", "ymax")
    assert tiles.select("scene_id", "band", "cells", "xmin", "ymax").exceptAll(whole).isEmpty()


def test_shared_folder_is_the_session_s(spark):
    root = f"{spark.conf.get('spark.checkpoint.dir')}/scenetext-{spark.sparkContext.applicationId}"
    assert shared_folder(spark, "a").startswith(root + "/a-")
    assert shared_folder(spark, "a") != shared_folder(spark, "a")


def test_shared_folder_without_scheme_is_written_by_the_tasks_of_a_cluster(spark, tmp_path):
    class Context:
        master = "spark://host:7077"
        applicationId = spark.sparkContext.applicationId

    class Cluster:
        sparkContext, _jvm, _jsc = Context, spark._jvm, spark._jsc
        conf = {"spark.checkpoint.dir": str(tmp_path)}

    folder = shared_folder(Cluster, "images")
    assert folder.startswith(f"file:{tmp_path}/scenetext-{Context.applicationId}/images-")
    assert qualified(Cluster, folder) == folder
    with pytest.raises(ValueError, match="own disk"):  # any other folder must say where it is
        qualified(Cluster, str(tmp_path))
    # the same folder for Spark and for Python
    K.write_files(spark.createDataFrame([("SC1/0.png", b"x")], "name STRING, image BINARY"), folder)
    assert spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.png").load(folder).count() == 1


def test_many_small_shares_take_few_tasks(spark, tmp_path):
    data = image(5, (16, 16))
    for k in range(40):
        save(tmp_path, f"SC{k}", "B2", write_image(data[None], EXTENT, 32633, nodata=0, deflate=False, tile=16))
    reader = WindowReader(StructType(), str(tmp_path), 100, 512, [0], 8)
    groups = reader.partitions()
    assert len(groups) <= 16
    shares = [(p.path, p.number, p.of) for g in groups for p in g.parts]
    alone = WindowReader(StructType(), str(tmp_path), 100, 512, [0]).partitions()
    assert len(alone) == len(shares) > 100  # files are cut as without a bound
    assert shares == [(p.path, p.number, p.of) for g in alone for p in g.parts]


def test_images_are_rendered_few_cells_at_a_time():
    values = [[k] * 64 for k in range(5000)] + [None, [], [7] * 600_000]
    batch = pa.RecordBatch.from_arrays([pa.array(values, pa.list_(pa.int32()))] * 2, ["r", "g"])
    parts = list(slices([batch, batch.slice(0, 0)], "r", "g"))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
    assert all(sum(len(v or ()) for v in p.column("r").to_pylist()) * 2 <= SLICE_CELLS + 2 * 64 for p in parts[:-1])


def test_a_full_batch_of_tiles_gives_the_same_images(spark, monkeypatch):
    tile = "transform(sequence(0, 63), v -> CAST((v * 7 + id) % 256 AS INT))"
    tiles = spark.range(0, 300, 1, 1).selectExpr("id AS scene_id", "8 AS rows", "8 AS cols", *(f"{tile} AS {c}" for c in "rgb"))
    whole = K.render_tiles(tiles, "tif").collect()
    monkeypatch.setattr(K, "slices", lambda batches, *columns: slices(batches, *columns, most=100))
    assert K.render_tiles(tiles, "tif").collect() == whole and len(whole) == 300
