"""The same queries as SQL text for DuckDB, written from the rules and not from the Spark plans."""

from __future__ import annotations

from scenetext.functions.words import PUNCTUATION

LO, HI = 4000, 15176


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


PIX = """pix AS (
  SELECT CAST(l_suppkey % 4 AS INT) AS scene_id,
         CASE l_linenumber % 3 WHEN 0 THEN 'B2' WHEN 1 THEN 'B3' ELSE 'B5' END AS band,
         CAST(l_partkey % 64 AS INT) AS x, CAST(l_orderkey % 64 AS INT) AS y,
         CASE WHEN l_discount = 0.0 THEN NULL ELSE CAST(floor(l_extendedprice / 5) AS INT) END AS dn,
         (l_orderkey * 8 + l_linenumber) * 1048576 + CAST(floor(l_extendedprice / 5) AS BIGINT) AS src
  FROM lineitem)"""

TILE = """tile AS (
  SELECT *, CAST(place % 4 * 4 AS INT) AS tile_left, CAST(place // 4 * 8 AS INT) AS tile_top
  FROM (SELECT CAST(vec_id // 3 % 5 AS INT) AS scene_id,
               CASE vec_id % 3 WHEN 0 THEN 'B2' WHEN 1 THEN 'B3' ELSE 'B5' END AS band,
               CAST(vec_id // 3 AS INT) AS tile_no, vec_id // 3 // 5 AS place, vec_id, embedding
        FROM embeddings) t)"""

TILE_PX = f"""{TILE},
tile_px AS (
  SELECT scene_id, band, tile_no, vec_id, tile_left, tile_top,
         CAST((p - 1) % 8 AS INT) AS x, CAST((p - 1) // 8 AS INT) AS y,
         CAST(floor(CAST(embedding[p] AS DOUBLE) * 40000 + 9588) AS INT) AS dn
  FROM tile, unnest(range(1, len(embedding) + 1)) u(p))"""


def _scaled(dn: str) -> str:
    return (
        f"CAST(CASE WHEN {dn} IS NOT NULL THEN "
        f"(greatest({LO}, least({HI}, {dn})) - {LO}) * 255 // ({HI} - {LO}) END AS INT)"
    )


def _merged(source: str, value: str = "dn", keys: str = "scene_id, band, x, y") -> str:
    """First source with data per cell."""
    return f"""(
  SELECT {keys}, v FROM (
    SELECT {keys}, {value} AS v, row_number() OVER (
      PARTITION BY {keys} ORDER BY ({value} IS NULL), src) AS k FROM {source}) t
  WHERE k = 1)"""


def _stacked(source: str, cell: str = "x, y") -> str:
    channels = ", ".join(
        f"max(CASE WHEN band = '{band}' THEN v END) AS {name}"
        for band, name in (("B2", "r"), ("B3", "g"), ("B5", "b"))
    )
    return f"SELECT scene_id, {cell}, {channels} FROM {source} m GROUP BY scene_id, {cell}"


MERGED = _merged("pix")
STACK = _stacked(_merged("pix"))
RGB = (
    "SELECT scene_id, x, y, coalesce(r, 0) AS r, coalesce(g, 0) AS g, coalesce(b, 0) AS b "
    f"FROM ({_stacked(_merged('pix', _scaled('dn')))}) s"
)

BOUNDS = """bounds AS (
  SELECT scene_id, band, round(quantile_cont(dn, 0.02) FILTER (WHERE dn > 0), 6) AS p_low,
         round(quantile_cont(dn, 0.98) FILTER (WHERE dn > 0), 6) AS p_high, count(*) AS n
  FROM pix GROUP BY scene_id, band)"""

STRETCHED = f"""{PIX}, {BOUNDS}, stretched AS (
  SELECT pix.scene_id, pix.band, x, y, src,
         CAST(CASE WHEN dn > 0 THEN CASE WHEN p_high = p_low THEN 0 ELSE
           greatest(0, least(255, floor((dn - p_low) / (p_high - p_low) * 255))) END END AS INT) AS v
  FROM pix JOIN bounds USING (scene_id, band))"""

# Tone chain by formula; the Spark side uses a table of its 256 results.
_LIT = "CASE WHEN {c} > 0 THEN least(255, {c} + 15) ELSE 0 END"
_CURVED = f"trunc(255 * pow({_LIT} / 255.0::DOUBLE, 1 / 0.8::DOUBLE))"
TONE = f"""CAST(greatest(0, least(255, trunc(
  (259 * (30.0::DOUBLE + 255)) / (255 * (259 - 30.0::DOUBLE)) * ({_CURVED} - 128) + 128))) AS INT)"""

CLASSES = f"""{PIX}, classes AS (
  SELECT scene_id, band, dn, n, CAST(least(255,
           sum(n) OVER (PARTITION BY scene_id, band ORDER BY dn) * 256
           // sum(n) OVER (PARTITION BY scene_id, band)) AS INT) AS class_id
  FROM (SELECT scene_id, band, dn, count(*) AS n FROM pix WHERE dn IS NOT NULL GROUP BY ALL) t)"""

LINES = f"""{PIX}, merged AS {MERGED},
ext AS (SELECT scene_id, min(x) AS xmin, max(x) AS xmax FROM merged GROUP BY scene_id),
used AS (SELECT DISTINCT scene_id, band, y, CAST((x - xmin) // 24 AS INT) AS segment, xmin, xmax
         FROM merged JOIN ext USING (scene_id)),
grid AS (SELECT scene_id, band, y, segment, xmin + segment * 24 AS x_from,
                unnest(range(xmin + segment * 24, least(xmin + segment * 24 + 23, xmax) + 1)) AS x
         FROM used)"""

TILE_GRID = f"""{TILE_PX},
placed AS (SELECT scene_id, band, vec_id, tile_left + x AS x, tile_top + y AS y,
                  {_scaled('dn')} AS v FROM tile_px),
tile_merged AS (
  SELECT scene_id, band, x, y, v FROM (
    SELECT *, row_number() OVER (PARTITION BY scene_id, band, x, y ORDER BY vec_id) AS k
    FROM placed) t WHERE k = 1),
tile_rgb AS ({_stacked('tile_merged')})"""

FILES = f"""{TILE_PX},
files AS (
  SELECT *, concat('/data/SC', scene_id, '/', tile_no, '/SC', scene_id, '_', tile_no, '_', band, '.TIF')
         AS path, CAST(tile_left AS DOUBLE) AS xmin, CAST(-tile_top - 8 AS DOUBLE) AS ymin,
         CAST(tile_left + 8 AS DOUBLE) AS xmax, CAST(-tile_top AS DOUBLE) AS ymax FROM tile)"""

ASSET = """asset AS (
  SELECT DISTINCT l_suppkey % 10 + 190 AS p, concat('SC', l_suppkey) AS scene_id,
         concat('B', l_linenumber) AS band FROM lineitem),
catalog AS (
  SELECT concat('/data/scenes/1985/', p, '/026/', scene_id, '/', scene_id, '_', band, '.TIF') AS path,
         scene_id, band, CASE band WHEN 'B2' THEN 0 WHEN 'B3' THEN 1 ELSE 2 END AS band_index
  FROM asset WHERE band IN ('B2', 'B3', 'B5'))"""

FLAT = r"""flat AS (
  SELECT conv_id, turn, CAST(i - 1 AS INT) AS pos, ws[i] AS w
  FROM (SELECT conv_id, turn, list_filter(regexp_split_to_array(text, '\s+'), lambda s: s <> '') AS ws
        FROM conversations) c, unnest(range(1, len(ws) + 1)) u(i))"""

CLEAN = f"lower(translate(text, {_quoted(PUNCTUATION)}, ''))"
WORDS = rf"""words AS (
  SELECT w FROM (SELECT unnest(regexp_split_to_array({CLEAN}, '\s+')) AS w FROM documents) t
  WHERE w <> '')"""

# Tokens by a pattern without lookaround. Equal marks are shortened one kind of mark after another, and references
# are decoded by name, the ampersand last, so that what it makes is not decoded again.
_W, _L = r"[\p{L}\p{M}\p{N}_]", r"[\p{L}\p{M}]"
_URL_END = r"""[^\s()\[\]{}<>`!;:'".,?«»“”‘’]"""
_TOKEN = "(" + "|".join((
    rf"(?i:https?:(?:/{{1,3}}|[a-z0-9%])|[a-z0-9.\-]+\.[a-z]{{2,13}}/)(?:(?:[^\s()<>{{}}\[\]]|\([^\s()]*\))*(?:\([^\s()]*\)|{_URL_END}))?",
    r"(?:\+?[01][ *\-.)]*)?(?:\(?\d{3}[ *\-.)]*)?\d{3}[ *\-.)]*\d{4}",
    r"[<>]?[:;=8][\-o*']?[)\](\[dDpP/:}{@|\\]|[)\](\[dDpP/:}{@|\\][\-o*']?[:;=8][<>]?|<3",
    r"<[^>\s]+>|<?-+>|<-+>?",
    rf"@{_W}+|#+{_W}(?:{_W}|['\-]+{_W})+",
    r"[\p{L}\p{M}\p{N}_.+\-]+@[\p{L}\p{M}\p{N}_\-]+\.[\p{L}\p{M}\p{N}_.\-]*[\p{L}\p{M}\p{N}_]",
    r"(?i:[a-z0-9]+(?:[.\-][a-z0-9]+)*\.[a-z]{2,13})\b/?",
    rf"{_L}(?:{_L}|['\-_])*{_L}",
    rf"[+\-]?\d+[,/.:\-]\d+[+\-]?|{_W}+",
    r"\.(?:\s*\.)+|\S",
)) + ")"
_MARKS = [*PUNCTUATION, *map(chr, range(0xC0, 0x100))]


def _shortened(text: str) -> str:
    for mark in _MARKS:
        one = mark if ord(mark) > 127 else "\\" + mark
        text = f"regexp_replace({text}, {_quoted(one + '{4,}')}, {_quoted(mark * 3 if mark != chr(92) else one * 3)}, 'g')"
    return text


def _found(text: str) -> str:
    return f"regexp_extract_all({_shortened(text)}, {_quoted(_TOKEN)}, 1)"


TOKENS = f"""tokens AS (SELECT unnest({_found('text')}) AS tok FROM documents)"""
PAGE_TEXT = "html"
for _name, _mark in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
    PAGE_TEXT = f"replace({PAGE_TEXT}, '&{_name};', '{_mark}')"

TWEET = """to_json({'lang': lang, 'text': text, 'entities': {'hashtags': [{'text': source}]},
  'user': {'name': concat('User ', doc_id), 'screen_name': concat('u', doc_id),
           'followers_count': n_chars, 'description': source}})"""

# Messages with fields that not all of them have; some lines are cut off.
MESSAGE = f"""message AS (
  SELECT doc_id, CASE WHEN doc_id % 37 = 5 THEN left(value, length(value) - 1) ELSE value END AS value FROM (
    SELECT doc_id, concat(left(j, length(j) - 1), ',"zzz":{{"b":[1,2.5,{{"y":true,"x":null}}],"a":', doc_id, '}}',
      CASE WHEN doc_id % 3 = 0 THEN ',"Place":{{"k":[[],{{}}],"deep":[[["é",-7]]]}}' ELSE '' END, ',"id":', doc_id, '}}') AS value
    FROM (SELECT doc_id, CAST({TWEET} AS VARCHAR) AS j FROM documents) r) m)"""

# Every node of a document gets a place that sorts before its children's and those before its end;
# the text is put together from the nodes in that order, without knowing any field.
_ASCII = r"""list_aggregate(list_transform(string_split({}, ''), lambda c: CASE
  WHEN unicode(c) < 128 THEN c WHEN unicode(c) < 65536 THEN printf('\u%04x', unicode(c))
  ELSE printf('\u%04x\u%04x', 55296 + (unicode(c) - 65536) // 1024, 56320 + unicode(c) % 1024) END), 'string_agg', '')"""
DOCUMENTS = rf"""WITH RECURSIVE {MESSAGE},
node AS (
  SELECT doc_id, t.id, t.parent, t.key, t.type, CAST(t.atom AS VARCHAR) AS atom
  FROM (SELECT doc_id, CAST(value AS JSON) AS j FROM message WHERE json_valid(value)) g, json_tree(g.j) t),
way AS (
  SELECT doc_id, id, type, atom, CAST(NULL AS VARCHAR) AS name, 0 AS depth, '' AS place, CAST(NULL AS UBIGINT) AS parent FROM node WHERE parent IS NULL
  UNION ALL
  SELECT n.doc_id, n.id, n.type, n.atom, CASE WHEN way.type = 'OBJECT' THEN n.key END, depth + 1,
         place || chr(1) || CASE WHEN way.type = 'ARRAY' THEN lpad(n.key, 9, '0') ELSE n.key END, n.parent
  FROM node n JOIN way ON n.doc_id = way.doc_id AND n.parent = way.id),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, parent ORDER BY place) AS nth,
         id IN (SELECT parent FROM node x WHERE x.doc_id = way.doc_id) AS filled FROM way),
piece AS (
  SELECT doc_id, place, concat(
    CASE WHEN depth > 0 THEN concat(CASE WHEN nth > 1 THEN ',' ELSE '' END, chr(10), repeat('  ', depth)) ELSE '' END,
    CASE WHEN name IS NOT NULL THEN concat({_ASCII.format('CAST(to_json(name) AS VARCHAR)')}, ': ') ELSE '' END,
    CASE type WHEN 'OBJECT' THEN '{{' WHEN 'ARRAY' THEN '[' ELSE {_ASCII.format("coalesce(atom, 'null')")} END) AS p FROM numbered
  UNION ALL
  SELECT doc_id, place || chr(2), concat(CASE WHEN filled THEN concat(chr(10), repeat('  ', depth)) ELSE '' END,
    CASE type WHEN 'OBJECT' THEN '}}' ELSE ']' END) FROM numbered WHERE type IN ('OBJECT', 'ARRAY'))
SELECT string_agg(p, '' ORDER BY place) AS json, CAST(NULL AS VARCHAR) AS broken FROM piece GROUP BY doc_id
UNION ALL SELECT NULL, value FROM message WHERE NOT json_valid(value)"""

COLUMNS = "scene_id, band, x, y, src"

ORACLE: dict[str, str] = {
    "clamp": f"""WITH {PIX} SELECT {COLUMNS},
        CASE WHEN dn IS NOT NULL THEN greatest({LO}, least({HI}, dn)) END AS dn FROM pix""",
    "clamp_normalize": f"WITH {PIX} SELECT {COLUMNS}, {_scaled('dn')} AS dn FROM pix",
    "raster_pixels": f"WITH {TILE_PX} SELECT scene_id, band, tile_no, x, y, dn FROM tile_px",
    "band_union": f"""WITH {PIX}, {TILE_PX}
        SELECT scene_id, band, x, y, dn, CAST(NULL AS INT) AS tile_no FROM pix
        UNION ALL SELECT scene_id, band, x, y, dn, tile_no FROM tile_px""",
    "merge_overlaps": f"WITH {PIX} SELECT scene_id, band, x, y, v AS dn FROM {MERGED} m",
    "band_stack": f"WITH {PIX} {STACK}",
    "complete_band_stack": f"""WITH {PIX} SELECT * FROM ({STACK}) s
        WHERE r IS NOT NULL AND g IS NOT NULL AND b IS NOT NULL""",
    "stack_by_center": f"""WITH {PIX}, centred AS (
        SELECT *, round(x * 30 + 15.25::DOUBLE + (src % 8 - 4) * 1e-7, 5) AS cx,
                  round(y * 30 + 15.75::DOUBLE - (src % 8 - 4) * 1e-7, 5) AS cy FROM pix)
        {_stacked(_merged('centred', keys='scene_id, band, cx, cy'), 'cx, cy')}""",
    "rgb_composite": f"WITH {PIX} {RGB}",
    "rgb_packed": f"""WITH {PIX} SELECT scene_id, x, y, CASE WHEN r = 0 AND g = 0 AND b = 0 THEN 0
        ELSE CAST(r AS BIGINT) * 16777216 + g * 65536 + b * 256 + 255 END AS rgba FROM ({RGB}) c""",
    "tone_adjust": f"""WITH {PIX} SELECT scene_id, x, y,
        {", ".join(f"{TONE.format(c=c)} AS {c}" for c in "rgb")} FROM ({RGB}) c""",
    "layer_metadata": f"""WITH {PIX} SELECT *, xmax - xmin + 1 AS cols, ymax - ymin + 1 AS rows,
        CAST(ceil((xmax - xmin + 1) / 16) AS INT) AS layout_cols,
        CAST(ceil((ymax - ymin + 1) / 16) AS INT) AS layout_rows
        FROM (SELECT scene_id, min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax,
                     count(*) AS n FROM pix GROUP BY scene_id) e""",
    "tile_layout": f"""WITH {PIX}, merged AS {MERGED},
        ext AS (SELECT scene_id, min(x) AS x0, min(y) AS y0, max(x) - min(x) + 1 AS w,
                       max(y) - min(y) + 1 AS h FROM merged GROUP BY scene_id),
        grid AS (SELECT *, CAST((x - x0) // 16 AS INT) AS layout_col, CAST((y - y0) // 16 AS INT)
                 AS layout_row FROM merged JOIN ext USING (scene_id))
        SELECT scene_id, band, x, y, v AS dn, layout_col, layout_row,
               CAST((x - x0) % 16 AS INT) AS tile_x, CAST((y - y0) % 16 AS INT) AS tile_y,
               least(16, w - layout_col * 16) AS tile_cols, least(16, h - layout_row * 16) AS tile_rows
        FROM grid""",
    "stitch_lines": f"""WITH {LINES}
        SELECT scene_id, band, y, segment, x_from, CAST(count(*) AS INT) AS n,
               string_agg(coalesce(CAST(v AS VARCHAR), ''), ',' ORDER BY x) AS line
        FROM grid LEFT JOIN merged USING (scene_id, band, y, x) GROUP BY ALL""",
    "value_histogram": f"WITH {PIX} SELECT scene_id, band, dn, count(*) AS n FROM pix GROUP BY ALL",
    "percentile_bounds": f"""WITH {PIX}, {BOUNDS}
        SELECT scene_id, band, p_low, p_high, n FROM bounds""",
    "percentile_stretch": f"WITH {STRETCHED} SELECT {COLUMNS}, v AS dn FROM stretched",
    "stretch_stack": f"WITH {STRETCHED} {_stacked(_merged('stretched', 'v'))}",
    "percentile_sketch": """WITH v AS (
        SELECT CAST(l_suppkey % 4 AS INT) AS scene_id, CAST(l_linenumber % 3 AS INT) AS band, l_extendedprice AS v FROM lineitem),
        q AS (SELECT scene_id, band, quantile_cont(v, 0.02) AS a, quantile_cont(v, 0.98) AS b FROM v GROUP BY ALL)
        SELECT scene_id, band, count(*) AS n, CAST(round(100 * avg(CAST(v <= a AS INT))) AS INT) AS low,
               CAST(round(100 * avg(CAST(v <= b AS INT))) AS INT) AS high
        FROM v JOIN q USING (scene_id, band) GROUP BY scene_id, band""",
    "quantile_breaks": f"WITH {CLASSES} SELECT * FROM classes",
    "quantile_colours": f"""WITH {CLASSES}
        SELECT pix.scene_id, pix.band, x, y, pix.dn, CASE WHEN pix.dn IS NULL THEN 4294967295 ELSE
          CAST(255 - class_id AS BIGINT) * 16777216 + class_id * 256 + 255 END AS rgba
        FROM pix LEFT JOIN classes USING (scene_id, band, dn)""",
    "tile_clamp_normalize": f"""WITH {TILE_PX}
        SELECT scene_id, band, tile_no, x, y, {_scaled('dn')} AS dn FROM tile_px""",
    "tile_percentile_stretch": f"""WITH {TILE_PX}, bounds AS (
        SELECT scene_id, band, round(quantile_cont(dn, 0.02), 6) AS lo,
               round(quantile_cont(dn, 0.98), 6) AS hi
        FROM tile_px WHERE dn > 0 GROUP BY scene_id, band)
        SELECT scene_id, band, tile_no, x, y, CAST(CASE WHEN dn > 0 THEN
          greatest(0, least(255, floor((dn - lo) / (hi - lo) * 255))) END AS INT) AS dn
        FROM tile_px JOIN bounds USING (scene_id, band)""",
    "tile_layer_metadata": f"""WITH {TILE}
        SELECT *, CAST(ceil(layer_cols / 16) AS INT) AS layout_cols,
               CAST(ceil(layer_rows / 16) AS INT) AS layout_rows
        FROM (SELECT scene_id, CAST(min(tile_left) AS DOUBLE) AS layer_xmin,
                     CAST(-max(tile_top) - 8 AS DOUBLE) AS layer_ymin,
                     CAST(max(tile_left) + 8 AS DOUBLE) AS layer_xmax,
                     CAST(-min(tile_top) AS DOUBLE) AS layer_ymax,
                     CAST(1 AS DOUBLE) AS cell_width, CAST(1 AS DOUBLE) AS cell_height, count(*) AS n,
                     max(tile_left) + 8 - min(tile_left) AS layer_cols,
                     max(tile_top) + 8 - min(tile_top) AS layer_rows
              FROM tile GROUP BY scene_id) m""",
    "tile_layer_zones": f"""WITH {TILE}
        SELECT *, CAST(ceil(layer_cols / 16) AS INT) AS layout_cols,
               CAST(ceil(layer_rows / 16) AS INT) AS layout_rows
        FROM (SELECT scene_id, concat('EPSG:3263', tile_no % 2 + 1) AS crs, CAST(min(tile_left) AS DOUBLE) AS layer_xmin,
                     CAST(-max(tile_top) - 8 AS DOUBLE) AS layer_ymin,
                     CAST(max(tile_left) + 8 AS DOUBLE) AS layer_xmax,
                     CAST(-min(tile_top) AS DOUBLE) AS layer_ymax,
                     CAST(1 AS DOUBLE) AS cell_width, CAST(1 AS DOUBLE) AS cell_height, count(*) AS n,
                     max(tile_left) + 8 - min(tile_left) AS layer_cols,
                     max(tile_top) + 8 - min(tile_top) AS layer_rows
              FROM tile GROUP BY ALL) m""",
    "tile_composite": f"WITH {TILE_GRID} SELECT * FROM tile_rgb",
    "scan_rasters": f"""WITH {FILES}
        SELECT path, CAST(f.tile_no AS VARCHAR) AS scene_id, f.band, xmin, ymin, xmax, ymax,
               CAST(NULL AS VARCHAR) AS crs, CAST(NULL AS VARCHAR) AS error, x, y,
               CASE WHEN dn > 0 THEN dn END AS dn
        FROM files f JOIN tile_px USING (vec_id)""",
    "raster_info": f"""WITH {FILES}
        SELECT path, 'GTiff' AS format, 8 AS cols, 8 AS rows, 1 AS bands, xmin, ymin, xmax, ymax,
               CAST(NULL AS VARCHAR) AS crs, CAST(NULL AS VARCHAR) AS error FROM files""",
    "raster_listing": f"""WITH {FILES}
        SELECT substr(path, 7) AS path, CAST(tile_no AS VARCHAR) AS scene_id, band,
               CASE band WHEN 'B2' THEN 0 WHEN 'B3' THEN 1 ELSE 2 END AS band_index FROM files""",
    "split_scan": f"""WITH {FILES}
        SELECT substr(path, 7) AS path, CAST(f.tile_no AS VARCHAR) AS scene_id, f.band, CAST(NULL AS VARCHAR) AS error,
               x, y, CASE WHEN dn > 0 THEN dn END AS dn
        FROM files f JOIN tile_px USING (vec_id) WHERE f.band <> 'B5'""",
    "composite_errors": f"""WITH {FILES},
        damaged AS (SELECT * FROM files WHERE tile_no % 7 = 0 AND band = 'B3'),
        gap AS (SELECT tile_no, band FROM (SELECT DISTINCT tile_no FROM files) t,
                       (VALUES ('B2'), ('B3'), ('B5')) b(band)
                EXCEPT (SELECT tile_no, band FROM files EXCEPT SELECT tile_no, band FROM damaged))
        SELECT path, CAST(tile_no AS VARCHAR) AS scene_id, band, 'unreadable' AS error FROM damaged
        UNION ALL
        SELECT NULL, CAST(tile_no AS VARCHAR), band, 'no readable file' FROM gap""",
    "render_tiles": f"""WITH {TILE_GRID},
        ext AS (SELECT scene_id, max(x) + 1 AS w, max(y) + 1 AS h FROM tile_rgb GROUP BY scene_id),
        used AS (SELECT DISTINCT scene_id, x // 16 AS c, y // 16 AS r FROM tile_rgb),
        cell AS (SELECT scene_id, c, r, i, j FROM used JOIN ext USING (scene_id),
                 unnest(range(16)) u(i), unnest(range(16)) t(j)
                 WHERE c * 16 + i < w AND r * 16 + j < h)
        SELECT concat(cell.scene_id, '/', c, '_', cell.r, '.tif') AS path, CAST(k AS INT) AS channel,
               CAST(i AS INT) AS x, CAST(j AS INT) AS y,
               coalesce(CASE k WHEN 0 THEN p.r WHEN 1 THEN p.g ELSE p.b END, 0) AS dn
        FROM cell LEFT JOIN tile_rgb p
          ON p.scene_id = cell.scene_id AND p.x = c * 16 + i AND p.y = cell.r * 16 + j,
        unnest(range(3)) v(k)""",
    "image_files": f"""WITH {TILE_GRID},
        ext AS (SELECT scene_id, max(x) + 1 AS w, max(y) + 1 AS h FROM tile_rgb GROUP BY scene_id),
        used AS (SELECT DISTINCT scene_id, x // 16 AS c, y // 16 AS r FROM tile_rgb),
        cell AS (SELECT scene_id, c, r, i, j FROM used JOIN ext USING (scene_id),
                 unnest(range(16)) u(i), unnest(range(16)) t(j)
                 WHERE c * 16 + i < w AND r * 16 + j < h)
        SELECT concat(cell.scene_id, '/', cell.r, '_', c, '.tif') AS path, CAST(k AS INT) AS channel,
               CAST(i AS INT) AS x, CAST(j AS INT) AS y,
               coalesce(CASE k WHEN 0 THEN p.r WHEN 1 THEN p.g ELSE p.b END, 0) AS dn
        FROM cell LEFT JOIN tile_rgb p
          ON p.scene_id = cell.scene_id AND p.x = c * 16 + i AND p.y = cell.r * 16 + j,
        unnest(range(3)) v(k)
        WHERE NOT (cell.scene_id < 2 AND cell.r > 0)""",
    "write_scenes": f"WITH {PIX} {RGB}",
    "scene_catalog": f"WITH {ASSET} SELECT * FROM catalog",
    "scene_band_counts": f"""WITH {ASSET} SELECT scene_id, count(*) AS files,
        count(DISTINCT band) = 3 AS complete FROM catalog GROUP BY scene_id""",
    "scene_index": """WITH t AS (
        SELECT o_orderkey % 11 + 1 AS k, strftime(o_orderdate, '%Y%m%d') AS d,
               strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders),
        p AS (SELECT *, concat('LC08_L1GT_190026_', d, '_', d, '_01_RT') AS product FROM t)
        SELECT 'http://host.example/c1/L8' AS root, concat('190/026/', product) AS scene_path,
               concat(product, '_B', k, '.TIF') AS file_name, 'LC08' AS sensor, 'L1GT' AS level,
               '190' AS wrs_path, '026' AS wrs_row, day AS acquired, day AS processed,
               '01' AS collection, 'RT' AS tier, concat('B', k) AS band FROM p""",
    "place_points": """
        SELECT s.s_suppkey AS code, p.lon, p.lat, s.s_nationkey AS value,
               concat(s.s_suppkey, ' : ', s.s_nationkey) AS label
        FROM supplier s JOIN (
          SELECT n_nationkey, CAST(n_nationkey * 1.5 - 10 AS DOUBLE) AS lon,
                 CAST(45 + n_nationkey * 0.5 AS DOUBLE) AS lat FROM nation WHERE n_nationkey < 20) p
        ON s.s_nationkey = p.n_nationkey""",
    "strip_punctuation": f"""
        SELECT doc_id, translate(text, {_quoted(PUNCTUATION)}, '') AS text FROM documents""",
    "sentence_words": f"""WITH {FLAT}
        SELECT conv_id, turn, coalesce(words, '') AS words, CAST(coalesce(k, 0) AS INT) AS n
        FROM conversations LEFT JOIN (
          SELECT conv_id, turn, string_agg(w, ' ' ORDER BY pos) AS words, count(*) AS k
          FROM flat GROUP BY conv_id, turn) f USING (conv_id, turn)""",
    "words_flat": f"WITH {FLAT} SELECT * FROM flat",
    "word_plural": f"WITH {FLAT} SELECT *, concat(w, 's') AS plural FROM flat",
    "word_lengths": f"WITH {FLAT} SELECT *, length(w) AS n FROM flat",
    "words_longer_than": f"WITH {FLAT} SELECT * FROM flat WHERE length(w) > 3",
    "word_total": f"WITH {WORDS} SELECT count(*) AS n FROM words",
    "first_words": rf"""
        SELECT doc_id, CAST(i - 1 AS INT) AS pos, ws[i] AS w FROM (
          SELECT doc_id, list_filter(regexp_split_to_array({CLEAN}, '\s+'), lambda s: s <> '') AS ws
          FROM documents) d, unnest(range(1, len(ws) + 1)) u(i) ORDER BY doc_id, i LIMIT 5""",
    "word_count": f"WITH {WORDS} SELECT w, count(*) AS n FROM words GROUP BY w",
    "word_sum": f"WITH {WORDS} SELECT w, CAST(sum(1) AS BIGINT) AS n FROM words GROUP BY w",
    "top_words": f"""WITH {WORDS}
        SELECT w, count(*) AS n FROM words GROUP BY w ORDER BY n DESC, w LIMIT 10""",
    "char_counts": """
        SELECT c, count(*) AS n FROM (SELECT unnest(string_split(text, '')) AS c FROM documents) t
        WHERE c <> '' GROUP BY c""",
    "text_lines": f"SELECT CAST({TWEET} AS VARCHAR) AS value FROM documents",
    "nonempty_lines": f"SELECT CAST({TWEET} AS VARCHAR) AS value FROM documents",
    "tweet_fields": """
        SELECT lang, source AS hashtags, concat('User ', doc_id) AS name,
               concat('u', doc_id) AS screen_name, n_chars AS followers_count, source AS description
        FROM documents""",
    "tweet_text": "SELECT text FROM documents",
    "tweet_to_json": DOCUMENTS,
    "page_tokens": f"""SELECT page_id, CAST(i - 1 AS INT) AS pos, ts[i] AS tok
        FROM (SELECT page_id, {_found(PAGE_TEXT)} AS ts FROM pages) p, unnest(range(1, len(ts) + 1)) u(i)""",
    "tweet_tokens": f"WITH {TOKENS} SELECT tok FROM tokens",
    "first_tokens": f"""
        SELECT doc_id, CAST(i - 1 AS INT) AS pos, ts[i] AS tok FROM (
          SELECT doc_id, {_found('text')} AS ts
          FROM documents) d, unnest(range(1, len(ts) + 1)) u(i) ORDER BY doc_id, i LIMIT 10""",
    "tokens_by_freq_top15": f"""WITH {TOKENS} SELECT tok, count(*) AS n FROM tokens
        WHERE length(tok) > 2 GROUP BY tok ORDER BY n DESC, tok LIMIT 15""",
    "frequent_tokens": f"""WITH {TOKENS} SELECT tok, count(*) AS n FROM tokens
        WHERE length(tok) > 2 GROUP BY tok ORDER BY n DESC, tok LIMIT 15""",
    "packed_turns": r"""WITH RECURSIVE s AS (
        SELECT conv_id, turn, n, row_number() OVER (PARTITION BY conv_id ORDER BY turn, i) AS k FROM (
          SELECT conv_id, turn, i, len(list_filter(regexp_split_to_array(ss[i], '\s+'), lambda w: w <> '')) AS n
          FROM (SELECT conv_id, turn, regexp_extract_all(text, '[^.!?]+[.!?]*') AS ss FROM conversations) c,
               unnest(range(1, len(ss) + 1)) u(i)) t WHERE n > 0),
        walk AS (
          SELECT conv_id, turn, n, k, 0 AS block, n AS used FROM s WHERE k = 1
          UNION ALL
          SELECT s.conv_id, s.turn, s.n, s.k, CASE WHEN used + s.n > 40 THEN block + 1 ELSE block END,
                 CASE WHEN used + s.n > 40 THEN s.n ELSE used + s.n END
          FROM walk JOIN s ON s.conv_id = walk.conv_id AND s.k = walk.k + 1)
        SELECT conv_id, CAST(block AS INT) AS block, min(turn) AS first, max(turn) AS last,
               CAST(count(*) AS INT) AS sentences, CAST(sum(n) AS BIGINT) AS words
        FROM walk GROUP BY conv_id, block""",
    "tokens_by_length_top10": f"""WITH {TOKENS} SELECT tok, length(tok) AS n FROM tokens
        WHERE length(tok) > 2 ORDER BY n DESC, tok LIMIT 10""",
    "event_props": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
    "user_map_plural": f"WITH {FLAT} SELECT *, concat(w, 's') AS plural FROM flat",
    "user_filter_longer": f"WITH {FLAT} SELECT * FROM flat WHERE length(w) > 3",
    "user_flat_map_words": f"WITH {FLAT} SELECT conv_id, turn, w FROM flat",
    "user_reduce_sum": f"WITH {WORDS} SELECT w, count(*) AS n FROM words GROUP BY w",
}
