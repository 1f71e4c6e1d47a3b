"""The same answers in SQL for DuckDB, written apart from the operators."""

from __future__ import annotations

TILES = """tiles AS (SELECT o_orderkey AS tile_id, o_orderkey % 6 AS source, 5120.0::DOUBLE * ((37 * o_orderkey) % 61) AS xmin, 5120.0::DOUBLE * ((o_orderkey * o_orderkey + 17 * o_orderkey) % 2003) AS ymin,
 xmin + 6400 AS xmax, ymin + 6400 AS ymax, CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE 1 END AS is_negative FROM orders)"""
CANDS = """cands AS (SELECT event_id AS cand_id, event_id % 6 AS source, (event_id // 2) % 50 AS image, 200.0::DOUBLE * ((17 * user_id + event_id % 13) % 150) AS xmin, 40.0::DOUBLE * ((event_id * event_id + 7 * event_id) % 997) AS ymin,
 200.0::DOUBLE + 20 * (event_id % 5) AS side, xmin + side AS xmax, ymin + side AS ymax, side * side AS area, ((7919 * event_id) % 10000)::DOUBLE / 10000 AS confidence, event_id % 2 AS is_edge FROM events)"""
PIXELS = "px AS (SELECT l_returnflag AS scene, l_linenumber AS band, l_extendedprice AS value FROM lineitem WHERE l_discount > 0)"
SPLIT = f"""{TILES}, ranked AS (SELECT *, row_number() OVER (ORDER BY md5(tile_id::VARCHAR || ':42'), tile_id) AS r, count(*) OVER () AS n FROM tiles),
rs AS (SELECT * EXCLUDE (r, n), CASE WHEN r <= greatest(1, round_even(n * 0.2, 0)) THEN 'val' ELSE 'train' END AS split FROM ranked)"""
REGROUP = f"""{SPLIT}, im AS (SELECT DISTINCT l_orderkey AS tile, CASE WHEN l_quantity < 25 THEN 'train' ELSE 'val' END AS split FROM lineitem),
lb AS (SELECT DISTINCT event_id AS tile, CASE WHEN event_id % 3 = 0 THEN 'train' ELSE 'val' END AS split FROM events),
asgn AS (SELECT tile_id AS tile, split, CASE WHEN is_negative = 0 THEN 'train' ELSE 'val' END AS old, CASE WHEN is_negative = 0 THEN 'val' ELSE 'train' END AS alt FROM rs),
fr AS (SELECT tile, split, CASE WHEN (tile, old) IN (SELECT (tile, split) FROM im) THEN old WHEN (tile, alt) IN (SELECT (tile, split) FROM im) THEN alt END AS image_from,
 CASE WHEN (tile, old) IN (SELECT (tile, split) FROM lb) THEN old WHEN (tile, alt) IN (SELECT (tile, split) FROM lb) THEN alt END AS label_from FROM asgn),
st AS (SELECT *, CASE WHEN image_from IS NULL AND label_from IS NULL THEN 'missing_both' WHEN image_from IS NULL THEN 'missing_image' WHEN label_from IS NULL THEN 'missing_label' ELSE 'copied' END AS status FROM fr)"""
CUTS = f"""{TILES}, cen AS (SELECT (xmin + xmax) / 2 AS c, any_value((xmax - xmin) / 2) AS hw, count(*) AS n, count(*) FILTER (is_negative = 0) AS pos FROM tiles GROUP BY 1),
k AS (SELECT c, row_number() OVER (ORDER BY c) - 1 AS k, count(*) OVER () AS m FROM cen),
cut AS (SELECT a.k AS k1, b.k AS k2, a.c AS c1, b.c AS c2 FROM k a JOIN k b ON b.k >= a.k + 2 WHERE a.k >= 1 AND a.k < a.m - 3 AND b.k < a.m - 1),
band AS (SELECT cut.*, cen.*, (c - hw < c1 AND c + hw > c1) OR (c - hw < c2 AND c + hw > c2) AS d, CASE WHEN c < c1 THEN 0 WHEN c < c2 THEN 1 ELSE 2 END AS b FROM cut, cen),
st AS (SELECT k1, k2, c1, c2, coalesce(sum(n) FILTER (NOT d AND b = 0), 0)::BIGINT AS n0, coalesce(sum(n) FILTER (NOT d AND b = 1), 0)::BIGINT AS n1, coalesce(sum(n) FILTER (NOT d AND b = 2), 0)::BIGINT AS n2,
 coalesce(sum(pos) FILTER (NOT d AND b = 1), 0) AS p1, coalesce(sum(pos) FILTER (NOT d AND b = 2), 0) AS p2, coalesce(sum(n) FILTER (d), 0)::BIGINT AS dropped, sum(n) AS n FROM band GROUP BY ALL),
best AS (SELECT *, 0.0::DOUBLE + abs(n0::DOUBLE / (n0 + n1 + n2) - 0.6) + abs(n1::DOUBLE / (n0 + n1 + n2) - 0.2) + abs(n2::DOUBLE / (n0 + n1 + n2) - 0.2) + 0.002::DOUBLE * dropped / n AS score FROM st
 WHERE p1 > 0 AND p2 > 0 AND n0 > 0 AND n1 > 0 AND n2 > 0 ORDER BY score, k1, k2 LIMIT 1),
asg AS (SELECT tiles.*, CASE WHEN (xmin < c1 AND xmax > c1) OR (xmin < c2 AND xmax > c2) THEN 'DROPPED_BUFFER' WHEN (xmin + xmax) / 2 < c1 THEN 'train' WHEN (xmin + xmax) / 2 < c2 THEN 'val' ELSE 'test' END AS split FROM tiles, best)"""
INTER = "greatest(least(a.xmax, b.xmax) - greatest(a.xmin, b.xmin), 0) * greatest(least(a.ymax, b.ymax) - greatest(a.ymin, b.ymin), 0)"
MEET = "a.xmin < b.xmax AND b.xmin < a.xmax AND a.ymin < b.ymax AND b.ymin < a.ymax"
AREA = "(a.xmax - a.xmin) * (a.ymax - a.ymin) + (b.xmax - b.xmin) * (b.ymax - b.ymin)"
IOU = f"{INTER} / ({AREA} - {INTER})"
SCENES = "scenes AS (SELECT s_suppkey AS scene, 400 + 97 * (s_suppkey % 40) AS height, 500 + 61 * (s_suppkey % 50) AS width FROM supplier)"
HIST = f"""{PIXELS}, rng AS (SELECT scene, band, min(value) AS lo, CASE WHEN max(value) - min(value) < 1e-6 THEN min(value) + 1 ELSE max(value) END AS hi FROM px GROUP BY ALL),
h AS (SELECT scene, band, lo, hi, least(floor((value - lo) * 2048 / (hi - lo)), 2047)::INTEGER AS bin, count(*) AS count FROM px JOIN rng USING (scene, band) GROUP BY ALL)"""
PARAMS = f"""{HIST}, cum AS (SELECT *, sum(count) OVER (PARTITION BY scene, band ORDER BY bin) / sum(count) OVER (PARTITION BY scene, band) AS cum FROM h),
q AS (SELECT scene, band, lo, hi, min(bin) FILTER (cum >= 0.02) AS a, min(bin) FILTER (cum >= 0.98) AS b0, CASE WHEN b0 <= a THEN least(a + 1, 2047) ELSE b0 END AS b FROM cum GROUP BY ALL),
par AS (SELECT scene, band, lo + a * (hi - lo) / 2048 AS p_lo, lo + b * (hi - lo) / 2048 AS p_hi FROM q)"""


VALID = """px AS (SELECT l_orderkey % 7 AS scene, l_orderkey % 211 AS "window", l_orderkey // 211 AS pixel, bool_and(l_discount > 0.01) AS valid FROM lineitem GROUP BY ALL), w AS (SELECT scene, "window", avg(valid::INTEGER) AS share FROM px GROUP BY ALL)"""


def _utm() -> str:
    """Boxes of degrees in metres of the zone around 105 degrees, sides in 22 steps; hyperbolic functions by ln and exp."""
    n = 1 / 298.257223563 / (2 - 1 / 298.257223563)
    radius, e = 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64), 2 * n**0.5 / (1 + n)
    x, y = "eta", "xi"
    for j, a in enumerate((n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240), 1):
        x += f" + {a!r}::DOUBLE * cos({2 * j} * xi) * (exp({2 * j} * eta) - exp(-{2 * j} * eta)) / 2"
        y += f" + {a!r}::DOUBLE * sin({2 * j} * xi) * (exp({2 * j} * eta) + exp(-{2 * j} * eta)) / 2"
    return f"""WITH b AS (SELECT s_suppkey AS scene, 104.0::DOUBLE + (s_suppkey % 100) / 50.0::DOUBLE AS west, 36.0::DOUBLE + (s_suppkey % 70) / 35.0::DOUBLE AS south FROM supplier),
f AS (SELECT unnest(range(23)) / 22.0::DOUBLE AS f),
pts AS (SELECT scene, west + 0.5 * f AS lon, south AS lat FROM b, f UNION ALL SELECT scene, west + 0.5 * f, south + 0.25 FROM b, f UNION ALL SELECT scene, west, south + 0.25 * f FROM b, f UNION ALL SELECT scene, west + 0.5, south + 0.25 * f FROM b, f),
s AS (SELECT scene, radians(lon - 105) AS d, sin(radians(lat)) AS s FROM pts),
q AS (SELECT scene, d, 0.5 * ln((1 + s) / (1 - s)) - {e!r}::DOUBLE * 0.5 * ln((1 + {e!r}::DOUBLE * s) / (1 - {e!r}::DOUBLE * s)) AS z FROM s),
t AS (SELECT scene, d, (exp(z) - exp(-z)) / 2 AS t FROM q),
k AS (SELECT scene, atan2(t, cos(d)) AS xi, 0.5 * ln((1 + sin(d) / sqrt(1 + t * t)) / (1 - sin(d) / sqrt(1 + t * t))) AS eta FROM t),
m AS (SELECT scene, 500000 + 0.9996 * {radius!r}::DOUBLE * ({x}) AS x, 0.9996 * {radius!r}::DOUBLE * ({y}) AS y FROM k)
SELECT scene, round(min(x), 3) AS xmin, round(min(y), 3) AS ymin, round(max(x), 3) AS xmax, round(max(y), 3) AS ymax FROM m GROUP BY scene"""


UTM = _utm()


def _digits(n: int) -> str:
    return f"('0.' || lpad((event_id * {n} % 80)::VARCHAR, 2, '0'))"


_A, _B = _digits(7), _digits(11)
_GOOD = f"{_A} || ' ' || {_B} || ' ' || {_A} || '5 ' || {_B} || ' ' || {_A} || '5 ' || {_B} || '7'"
LINES = f"""lines AS (SELECT event_id % 200 AS file, event_id AS line_no, CASE event_id % 9 WHEN 0 THEN '0 ' || {_GOOD} WHEN 1 THEN '  ' WHEN 2 THEN '1 ' || {_GOOD}
 WHEN 3 THEN '0 ' || {_A} || ' ' || {_B} || ' ' || {_A} || ' ' || {_B} || ' ' || {_A} WHEN 4 THEN '0 ' || {_GOOD} || ' 0.9' WHEN 5 THEN '0 ' || {_A} || ' ' || {_B} || ' 0.91 ' || {_B} || ' 0.95 1.5'
 WHEN 6 THEN '0 nan ' || {_B} || ' ' || {_A} || ' ' || {_A} || ' ' || {_B} || ' ' || {_B} WHEN 7 THEN '0 ' || {_A} || ' ' || {_B} || ' ' || {_A} || ' ' || {_B} || ' ' || {_A} || ' ' || {_B}
 ELSE '0 a ' || {_B} || ' ' || {_A} || ' ' || {_A} || ' ' || {_B} || ' ' || {_B} END AS text FROM events),
tok AS (SELECT file, line_no, list_filter(string_split_regex(text, '\\s+'), lambda x : x <> '') AS tk FROM lines),
par AS (SELECT file, line_no, tk[1] AS cls, len(tk) - 1 AS n, list_transform(tk[2:], lambda x : TRY_CAST(x AS DOUBLE)) AS v FROM tok WHERE len(tk) > 0),
p AS (SELECT *, len(list_filter(v, lambda x : x IS NULL)) = 0 AS num, len(list_filter(v, lambda x : NOT isfinite(x))) = 0 AS fin,
 len(list_filter(v, lambda x : NOT isnan(x) AND (x < 0 OR x > 1))) > 0 AS outside FROM par)"""
OK_QC = "n >= 6 AND n % 2 = 0 AND num"




def _reach(axis: str) -> str:
    """Length that two diamonds share along an axis, given by the boxes' centres along it."""
    a, b = axis.replace("$", "a"), axis.replace("$", "b")
    return f"greatest(least({a} + a.side / 2, {b} + b.side / 2) - greatest({a} - a.side / 2, {b} - b.side / 2), 0)"


_DU, _DV = _reach("($.xmin + $.ymin + $.side)"), _reach("($.xmin - $.ymin)")
#: IoU of the diamonds in two boxes: boxes in x + y and x - y, twice as large.
DIAMOND = f"round(({_DU} * {_DV} / 2) / (a.side * a.side / 2 + b.side * b.side / 2 - {_DU} * {_DV} / 2), 9)"


def _greedy(pairs: str, with_: str) -> str:
    """Kept items by a scan in rank order; `pairs` gives (late, early) ranks, kept ranks end in kept(r)."""
    return f"""{with_}, pairs AS ({pairs}),
node AS (SELECT late, list(early) AS earlies FROM pairs GROUP BY late),
numbered AS (SELECT *, row_number() OVER (ORDER BY late) AS i FROM node),
walk AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS gone UNION ALL SELECT w.i + 1, CASE WHEN len(list_filter(n.earlies, lambda e : NOT list_contains(w.gone, e))) > 0 THEN list_append(w.gone, n.late) ELSE w.gone END FROM walk w JOIN numbered n ON n.i = w.i + 1),
gone AS (SELECT unnest(arg_max(gone, i)) AS r FROM walk)"""


def _nms(hit: str, edge: str, order: str, scope: str = "true") -> str:
    pairs = f"""SELECT a.r AS late, b.r AS early, CASE WHEN {hit} THEN 'nms_dropped' ELSE 'edge_dropped' END AS kind
 FROM r a JOIN r b ON b.r < a.r AND {MEET} AND {scope} WHERE {hit} OR {edge}"""
    with_ = f"{CANDS}, r AS (SELECT *, row_number() OVER (ORDER BY {order}) AS r FROM cands)"
    return f"""WITH RECURSIVE {_greedy(pairs, with_)},
why AS (SELECT late, arg_min(kind, early) AS kind FROM pairs WHERE early NOT IN (SELECT r FROM gone) GROUP BY late),
res AS (SELECT r.*, coalesce(why.kind, 'kept') AS status FROM r LEFT JOIN why ON why.late = r.r)"""


_V3 = ("is_edge, confidence DESC, area DESC, cand_id", f"{IOU} >= 0.7", f"(a.is_edge = 1 AND b.is_edge = 0 AND {IOU} >= 0.5)")
NMS = _nms(_V3[1], _V3[2], _V3[0])
DECIDED = f"""{TILES}, {CANDS}, j AS (SELECT a.tile_id, {INTER} AS inter, {INTER} / b.area AS visible FROM tiles a JOIN cands b ON {MEET}),
per AS (SELECT tile_id, bool_or(visible < 0.7) AS partial, count(*) FILTER (inter / 100 >= 4) AS n_labels, bool_or(inter / 100 < 4) AS small FROM j GROUP BY 1),
dec AS (SELECT t.tile_id, t.source, coalesce(n_labels, 0) AS n_labels, CASE WHEN partial THEN 'skip_partial' WHEN n_labels > 0 THEN 'positive' WHEN small THEN 'skip_small' WHEN md5(t.tile_id::VARCHAR || ':neg') < '1999' THEN 'negative' ELSE 'skip_negative' END AS decision FROM tiles t LEFT JOIN per USING (tile_id))"""
THRESHOLDS = "th AS (SELECT unnest([0.35, 0.5, 0.65, 0.75]::DOUBLE[]) AS threshold)"
QUALITY = f"{CANDS}, q AS (SELECT *, CASE WHEN confidence < $ THEN 'low_conf' WHEN area * (cand_id % 17) < 10000 THEN 'too_small' WHEN area * (cand_id % 17) > 600000 THEN 'too_large' WHEN (cand_id % 10) / 10.0 < 0.35 THEN 'low_compactness' END AS reason FROM cands)"
MATCH = f"""{CANDS}, m AS (SELECT a.image, a.cand_id AS p, b.cand_id AS g, a.confidence, {IOU} AS iou FROM cands a JOIN cands b ON a.image = b.image AND a.cand_id % 2 = 0 AND b.cand_id % 2 = 1 AND {MEET} WHERE {IOU} >= $)"""


def _matched(threshold: float) -> str:
    with_ = MATCH.replace("$", "0.1") + f", r AS (SELECT *, row_number() OVER (ORDER BY iou DESC, p, g) AS r FROM m WHERE confidence >= {threshold})"
    return "WITH RECURSIVE " + _greedy("SELECT a.r AS late, b.r AS early FROM r a JOIN r b ON b.r < a.r AND a.image = b.image AND (a.p = b.p OR a.g = b.g)", with_)


def _bins(c: str = "confidence") -> str:
    e = ["0.35", "0.5", "0.65", "0.75", "1.01"]
    return ", ".join(f"count(*) FILTER ({c} >= {a} AND {c} < {b}) AS b{round(float(a) * 100)}" for a, b in zip(e, e[1:], strict=False))


def _grid(clamped: bool) -> str:
    at = "unnest(list_distinct(list_transform(range(0, {0}, 512), lambda r : least(r, {0} - 640))))" if clamped else "unnest(range(0, {0} - 639, 512))"
    return f"WITH {SCENES}, rows_ AS (SELECT scene, width, {at.format('height')} AS row FROM scenes WHERE height >= 640 AND width >= 640) SELECT scene, row, {at.format('width')} AS col FROM rows_"


def _prf() -> str:
    parts = [f"SELECT {x}::DOUBLE AS threshold, (SELECT count(*) FROM ({_matched(x)} SELECT r FROM r WHERE r NOT IN (SELECT r FROM gone))) AS tp, (SELECT count(*) FROM c WHERE cand_id % 2 = 0 AND confidence >= {x}) AS np" for x in (0.35, 0.5, 0.65, 0.75)]
    return f"""WITH c AS (WITH {CANDS} SELECT * FROM cands), s AS ({' UNION ALL '.join(parts)}), f AS (SELECT threshold, tp, np - tp AS fp, (SELECT count(*) FROM c WHERE cand_id % 2 = 1) - tp AS fn FROM s),
 g AS (SELECT *, tp::DOUBLE / greatest(1, tp + fp) AS precision, tp::DOUBLE / greatest(1, tp + fn) AS recall FROM f) SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM g"""


def oracle_sql() -> dict[str, str]:
    stats = "SELECT source, count(*) AS n, count(*) FILTER (is_negative = 0) AS positives, count(*) FILTER (is_negative = 1) AS negatives, min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax FROM tiles GROUP BY source"
    return {
        "source_stats": f"WITH {TILES} {stats}",
        "scene_overlap_pairs": f"WITH {TILES}, s AS ({stats}) SELECT a.source AS a, b.source AS b, {INTER} / 1e6 AS km2 FROM s a JOIN s b ON a.source < b.source WHERE {INTER} > 1",
        "scene_components": """WITH RECURSIVE l AS (SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND abs(a.s_suppkey - b.s_suppkey) <= 7),
 w AS (SELECT a AS node, b FROM l UNION SELECT w.node, l.b FROM w JOIN l ON w.b = l.a) SELECT node, min(b) AS component FROM w GROUP BY node""",
        "cross_source_overlap": f"WITH {TILES} SELECT a.tile_id AS a, b.tile_id AS b, {INTER} AS area FROM tiles a JOIN tiles b ON a.tile_id < b.tile_id AND a.source <> b.source AND {MEET} WHERE {INTER} > 1",
        "uneven_overlap_pairs": f"""WITH {TILES}, u AS (SELECT tile_id, source, xmin, ymin, xmin + 1280.0::DOUBLE * pow(2, source) AS xmax, ymin + 1280.0::DOUBLE * pow(2, source) AS ymax FROM tiles)
 SELECT a.tile_id AS a, b.tile_id AS b, {INTER} AS area FROM u a JOIN u b ON a.tile_id < b.tile_id AND a.source <> b.source AND {MEET}""",
        "pair_regroup": f"WITH {REGROUP} SELECT tile, split, image_from, label_from, status FROM st",
        "pair_regroup_report": f"""WITH {REGROUP} SELECT split, count(*) AS n, count(*) FILTER (status = 'copied') AS copied, count(*) FILTER (status = 'missing_image') AS missing_image, count(*) FILTER (status = 'missing_label') AS missing_label,
 count(*) FILTER (status = 'missing_both') AS missing_both, count(*) FILTER (status = 'copied' AND image_from <> label_from) AS mixed FROM st GROUP BY ROLLUP (split)""",
        "random_split": f"WITH {SPLIT} SELECT tile_id, split FROM rs",
        "source_split": f"""WITH {TILES}, s AS (SELECT source, count(*) FILTER (is_negative = 0) AS positives FROM tiles GROUP BY source), r AS (SELECT *, row_number() OVER (PARTITION BY positives > 0 ORDER BY md5(source::VARCHAR || ':42')) AS k FROM s)
 SELECT source, positives, CASE WHEN positives > 0 AND k = 1 THEN 'val' WHEN positives > 0 AND k = 2 THEN 'test' ELSE 'train' END AS split FROM r""",
        "band_cut_search": f"WITH {CUTS} SELECT k1, k2, c1, c2, n0, n1, n2, dropped, round(score, 9) AS score FROM best",
        "band_assign": f"WITH {CUTS} SELECT tile_id, split FROM asg",
        "split_audit": f"WITH {CUTS} SELECT split, count(*) AS rows, count(*) FILTER (is_negative = 0) AS positives, count(*) FILTER (is_negative = 1) AS negatives, count(DISTINCT source) AS sources FROM asg GROUP BY split",
        "split_report": f"""WITH {CUTS}, ss AS (SELECT source, list_sort(list(DISTINCT split)) AS sp, count(*) AS n FROM asg WHERE split <> 'DROPPED_BUFFER' GROUP BY source),
 lk AS (SELECT count(*) AS n FROM asg a JOIN asg b ON a.tile_id < b.tile_id AND a.split <> b.split AND a.split <> 'DROPPED_BUFFER' AND b.split <> 'DROPPED_BUFFER' AND {MEET} WHERE {INTER} > 1),
 ct AS (SELECT k, s, count(tile_id) AS n, count(*) FILTER (is_negative = 0) AS p, count(*) FILTER (is_negative = 1) AS q FROM (VALUES (0, 'train'), (1, 'val'), (2, 'test')) v(k, s) LEFT JOIN asg ON split = s GROUP BY k, s)
 SELECT 0 AS section, k::VARCHAR AS item, printf('  %-5s: rows %4d | positives %4d | negatives %4d', s, n, p, q) AS line FROM ct UNION ALL SELECT 1, '', '  buffer: ' || count(*) FROM asg WHERE split = 'DROPPED_BUFFER'
 UNION ALL SELECT 2, source::VARCHAR, '  ' || source || ': ' || array_to_string(sp, ',') || ' (' || n || ')' FROM ss UNION ALL SELECT 3, '', '  train and val share: ' || count(*) FROM ss WHERE list_has_all(sp, ['train', 'val'])
 UNION ALL SELECT 4, '', '  train and test share: ' || count(*) FROM ss WHERE list_has_all(sp, ['train', 'test']) UNION ALL SELECT 5, '', '  val and test share: ' || count(*) FROM ss WHERE list_has_all(sp, ['val', 'test'])
 UNION ALL SELECT 6, '', '  overlapping pairs across sets: ' || n FROM lk UNION ALL SELECT 7, '', CASE WHEN n = 0 THEN '  PASS' ELSE '  FAIL' END FROM lk""",
        "leakage_report": f"""WITH {SPLIT}, sc AS (SELECT source, bool_or(split = 'train') AS t, bool_or(split = 'val') AS v FROM rs GROUP BY source),
 du AS (SELECT count(*) AS n FROM (SELECT tile_id % 60 AS name FROM rs WHERE split = 'train' INTERSECT SELECT tile_id % 60 FROM rs WHERE split = 'val')),
 ov AS (SELECT count(DISTINCT a.tile_id) AS n FROM rs a JOIN rs b ON a.split = 'val' AND b.split = 'train' AND {MEET.replace('<', '<=')}), sh AS (SELECT count(*) AS n FROM sc WHERE t AND v)
 SELECT 0 AS section, '' AS item, 'train source_tif: ' || count(*) AS line FROM sc WHERE t UNION ALL SELECT 1, source::VARCHAR, '  ' || source FROM sc WHERE t UNION ALL SELECT 2, '', 'val source_tif: ' || count(*) FROM sc WHERE v UNION ALL SELECT 3, source::VARCHAR, '  ' || source FROM sc WHERE v
 UNION ALL SELECT 4, '', 'shared source_tif: ' || n FROM sh UNION ALL SELECT 5, source::VARCHAR, '  ' || source FROM sc WHERE t AND v UNION ALL SELECT 6, '', 'dup tile_name count: ' || n FROM du
 UNION ALL SELECT 7, '', 'val tiles overlapping train: ' || n || '/' || (SELECT count(*) FROM rs WHERE split = 'val') FROM ov
 UNION ALL SELECT 8, '', CASE WHEN sh.n + du.n + ov.n > 0 THEN 'DATA LEAKAGE RISK: YES' ELSE 'DATA LEAKAGE RISK: NO' END FROM sh, du, ov""",
        "evaluation_report": f"""WITH e AS ({_prf()}), l AS (SELECT threshold, 0 AS line_no, 'conf >= ' || printf('%.2f', threshold) AS line FROM e UNION ALL SELECT threshold, 1, 'TP / FP / FN: ' || tp || ' / ' || fp || ' / ' || fn FROM e
 UNION ALL SELECT threshold, 2, '  Precision : ' || printf('%.3f', precision) FROM e UNION ALL SELECT threshold, 3, '  Recall    : ' || printf('%.3f', recall) FROM e UNION ALL SELECT threshold, 4, '  F1        : ' || printf('%.3f', f1) FROM e) SELECT * FROM l""",
        "split_sources": f"WITH {CUTS} SELECT source, array_to_string(list_sort(list(DISTINCT split)), ',') AS splits, count(*) AS n FROM asg WHERE split <> 'DROPPED_BUFFER' GROUP BY source",
        "leak_pairs": f"WITH {SPLIT} SELECT a.tile_id AS a, b.tile_id AS b, {INTER} AS area FROM rs a JOIN rs b ON a.tile_id < b.tile_id AND a.split <> b.split AND {MEET} WHERE {INTER} > 1",
        "leak_gate": f"WITH {CUTS} SELECT count(*) AS leaks FROM asg a JOIN asg b ON a.tile_id < b.tile_id AND a.split <> b.split AND a.split <> 'DROPPED_BUFFER' AND b.split <> 'DROPPED_BUFFER' AND {MEET} WHERE {INTER} > 1",
        "leak_val_train": f"WITH {SPLIT} SELECT a.tile_id, count(*) AS n_train, sum({INTER}) AS area, min(b.tile_id) AS first_train FROM rs a JOIN rs b ON a.split = 'val' AND b.split = 'train' AND {MEET.replace('<', '<=')} GROUP BY a.tile_id",
        "pair_missing_label": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
        "pair_missing_image": "SELECT doc_id FROM labels WHERE doc_id NOT IN (SELECT s_suppkey FROM supplier)",
        "pair_status": "SELECT CASE WHEN d.doc_id IS NULL THEN 'no_image' WHEN l.doc_id IS NULL THEN 'no_label' ELSE 'paired' END AS state, count(*) AS n FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1",
        "shared_keys": f"WITH {CUTS} SELECT source FROM asg WHERE split = 'train' INTERSECT SELECT source FROM asg WHERE split = 'val'",
        "tile_grid_clamped": _grid(True),
        "tile_grid_truncated": _grid(False),
        "grid_centre_out": f"""WITH g AS ({_grid(False)}), d AS (SELECT DISTINCT scene, 'row' AS axis, row AS place FROM g UNION ALL SELECT DISTINCT scene, 'col' AS axis, col AS place FROM g),
 o AS (SELECT *, row_number() OVER (PARTITION BY scene, axis ORDER BY place) - 1 AS k, count(*) OVER (PARTITION BY scene, axis) AS n FROM d),
 m AS (SELECT scene, axis, place AS middle FROM o WHERE k = n // 2)
 SELECT d.scene, d.axis, d.place, row_number() OVER (PARTITION BY d.scene, d.axis ORDER BY abs(d.place - middle), d.place) AS rank FROM d JOIN m USING (scene, axis) QUALIFY rank <= 60""",
        "tile_polygon_join": f"WITH {TILES}, {CANDS} SELECT a.tile_id, b.cand_id, {INTER} AS inter, {INTER} / b.area AS visible FROM tiles a JOIN cands b ON {MEET}",
        "tile_decision": f"WITH {DECIDED} SELECT tile_id, n_labels, decision FROM dec",
        "tile_quota": f"WITH {TILES} SELECT tile_id, source, row_number() OVER (PARTITION BY source ORDER BY is_negative, ymin, xmin, tile_id) AS rank FROM tiles QUALIFY rank <= 40",
        "band_minmax": f"WITH {PIXELS} SELECT scene, band, min(value) AS lo, max(value) AS hi, count(*) AS n FROM px GROUP BY ALL",
        "band_histogram": f"WITH {HIST} SELECT scene, band, bin, count FROM h",
        "stretch_params": f"WITH {PARAMS} SELECT scene, band, round(p_lo, 6) AS p_lo, round(p_hi, 6) AS p_hi FROM par",
        "stretch_apply": f"""WITH {PARAMS}, v AS (SELECT px.scene, px.band, CASE WHEN p_hi - p_lo < 1e-6 THEN 0 ELSE floor(least(greatest((value - p_lo) / (p_hi - p_lo) * 255.0, 0.0), 255.0)) END AS v8 FROM px JOIN par USING (scene, band))
 SELECT scene, band, count(*) AS n, sum(v8)::BIGINT AS total, count(*) FILTER (v8 = 255) AS top FROM v GROUP BY ALL""",
        "labels_strict": f"WITH {LINES} SELECT file, line_no, CASE WHEN n < 6 THEN 'too_few' WHEN cls <> '0' THEN 'class' WHEN n % 2 <> 0 THEN 'odd' WHEN NOT num THEN 'non_numeric' WHEN NOT fin THEN 'nan' WHEN outside THEN 'range' ELSE 'ok' END AS code FROM p",
        "labels_train": f"""WITH {LINES}, u AS (SELECT *, len(list_distinct(list_transform(range(0, n // 2), lambda i : {{'x': v[2 * i + 1], 'y': v[2 * i + 2]}}))) AS k FROM p)
 SELECT file, line_no, CASE WHEN TRY_CAST(cls AS INTEGER) IS NULL THEN 'bad_class' WHEN TRY_CAST(cls AS INTEGER) <> 0 THEN 'class' WHEN n < 6 THEN 'too_few' WHEN n % 2 <> 0 THEN 'odd' WHEN NOT num THEN 'non_numeric' WHEN NOT fin THEN 'nan' WHEN outside THEN 'range' WHEN k < 3 THEN 'few_vertices' ELSE 'ok' END AS code FROM u""",
        "labels_lenient": f"WITH {LINES} SELECT file, line_no, CASE WHEN n < 6 OR NOT num OR n % 2 <> 0 OR NOT fin THEN 'skipped' ELSE 'ok' END AS code FROM p",
        "labels_range4": f"WITH {LINES} SELECT file, line_no, CASE WHEN n < 4 THEN 'ignored' WHEN len(list_filter(v[1:4], lambda x : x IS NULL)) > 0 THEN 'raises' WHEN len(list_filter(v[1:4], lambda x : NOT isnan(x) AND (x < 0 OR x > 1))) > 0 THEN 'range' ELSE 'ok' END AS code FROM p",
        "labels_qc": f"WITH {LINES} SELECT file, line_no, CASE WHEN {OK_QC} THEN 'ok' ELSE 'bad_line' END AS code FROM p",
        "label_vertex_stats": f"WITH {LINES}, i AS (SELECT (n // 2)::INTEGER AS k FROM p WHERE {OK_QC}) SELECT count(*) AS n, min(k) AS least, max(k) AS most, avg(k) AS mean, median(k) AS median, avg((k = 4)::INTEGER) AS share4, avg((k >= 8)::INTEGER) AS share8 FROM i",
        "label_empty_ratio": f"WITH {LINES}, e AS (SELECT line_no % 1000 AS file, bool_and(trim(text) = '') AS empty FROM lines GROUP BY 1) SELECT count(*) AS files, count(*) FILTER (empty) AS empty, count(*) FILTER (empty) / count(*) AS share FROM e",
        "label_qc_record": f"""WITH {LINES}, f AS (SELECT DISTINCT file FROM lines), g AS (SELECT file, count(*) FILTER ({OK_QC}) AS n_inst, count(*) FILTER ({OK_QC} AND n // 2 = 4) AS n_rect4, count(*) FILTER ({OK_QC} AND n // 2 >= 8) AS n_8p,
 coalesce(sum(n // 2) FILTER ({OK_QC} AND outside), 0)::BIGINT AS oob, count(*) FILTER (NOT ({OK_QC})) AS bad_lines FROM p GROUP BY file) SELECT f.file, coalesce(n_inst, 0) AS n_inst, coalesce(n_rect4, 0) AS n_rect4, coalesce(n_8p, 0) AS n_8p, coalesce(oob, 0) AS oob, coalesce(bad_lines, 0) AS bad_lines FROM f LEFT JOIN g USING (file)""",
        "duplicate_instances": f"WITH {CANDS} SELECT a.image, count(*) AS n_dup FROM cands a JOIN cands b ON a.image = b.image AND a.cand_id < b.cand_id AND {MEET} WHERE {IOU} > 0.9 GROUP BY a.image",
        "border_flags": f"WITH {CANDS}, q AS (SELECT cand_id, xmin % 641 AS x, ymin % 641 AS y, side / 10 AS s FROM cands) SELECT cand_id, x < 10 OR y < 10 OR x + s > 630 OR y + s > 630 AS is_edge, x <= 3 OR y <= 3 OR x + s >= 637 OR y + s >= 637 AS touches FROM q",
        "shape_metrics": f"WITH {CANDS} SELECT cand_id, side * side AS area, 4 * side AS perimeter, round(4 * pi() * (side * side) / (4 * side * 4 * side), 9) AS compactness FROM cands",
        "affine_roundtrip": f"WITH {CANDS} SELECT cand_id, 500000.0::DOUBLE + 10 * xmin AS gx, 4400000.0::DOUBLE - 10 * ymin AS gy, true AS same FROM cands",
        "label_format": f"""WITH {CANDS}, q AS (SELECT cand_id, printf('%.6f', least(xmin / 640, 1)) AS a, printf('%.6f', least(ymin / 640, 1)) AS b, printf('%.6f', least(xmax / 640, 1)) AS c, printf('%.6f', least(ymax / 640, 1)) AS d FROM cands)
 SELECT cand_id, concat_ws(' ', '0', a, b, c, b, c, d, a, d) AS text FROM q""",
        "quality_filter_reasons": f"WITH {QUALITY.replace('$', '0.65')} SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM q GROUP BY 1",
        "quality_filter_v2": f"WITH {QUALITY.replace('$', '0.35')} SELECT cand_id FROM q WHERE reason IS NULL",
        "quality_filter_v3": f"WITH {QUALITY.replace('$', '0.65')} SELECT cand_id FROM q WHERE reason IS NULL",
        "dedup_v1": _nms(f"{IOU} > 0.5", "false", "confidence DESC, cand_id") + " SELECT cand_id, status FROM res",
        "nms_per_source": _nms(_V3[1], _V3[2], _V3[0], "a.source = b.source") + " SELECT cand_id, status FROM res",
        "nms_global": NMS + " SELECT cand_id, status FROM res",
        "nms_drop_reasons": NMS + " SELECT status, count(*) AS n FROM res GROUP BY status",
        "survivors_by_source": NMS + " SELECT source, count(*) AS kept, count(*) FILTER (confidence >= 0.65) AS filtered FROM res WHERE status = 'kept' GROUP BY source",
        "skip_totals": f"WITH {DECIDED} SELECT source, count(*) AS n, count(*) FILTER (decision = 'skip_partial') AS skip_partial, count(*) FILTER (decision = 'skip_small') AS skip_small, count(*) FILTER (decision = 'skip_negative') AS skip_negative FROM dec GROUP BY ROLLUP (source)",
        "threshold_counts": f"WITH {CANDS}, {THRESHOLDS} SELECT threshold, count(*) AS n, {_bins()} FROM cands JOIN th ON confidence >= threshold GROUP BY threshold",
        "threshold_summary": f"WITH {CANDS}, {THRESHOLDS} SELECT threshold, count(*) AS n, min(area) AS min_area, max(area) AS max_area, median(area) AS median_area, median(confidence) AS median_confidence, round(avg(area), 6) AS mean_area FROM cands JOIN th ON confidence >= threshold GROUP BY threshold",
        "summary_distribution": f"WITH {CANDS} SELECT count(*) AS n, min(area) AS min_area, max(area) AS max_area, median(area) AS median_area, min(confidence) AS min_confidence, max(confidence) AS max_confidence, median(confidence) AS median_confidence, avg(is_edge) AS edge_share FROM cands",
        "per_image_counts": f"WITH {CANDS}, {THRESHOLDS}, g AS (SELECT range AS image, threshold FROM range(60), th), c AS (SELECT g.threshold, g.image, count(cand_id) AS c FROM g LEFT JOIN cands ON cands.image = g.image AND confidence >= threshold GROUP BY ALL) SELECT threshold, avg(c) AS mean, median(c) AS median, max(c) AS most FROM c GROUP BY threshold",
        "iou_pairs": f"WITH {MATCH.replace('$', '0.5')} SELECT image, p, g, round(iou, 9) AS iou FROM m",
        "greedy_match": _matched(0) + " SELECT image, p, g FROM r WHERE r NOT IN (SELECT r FROM gone)",
        "eval_prf": _prf(),
        "polygon_iou": f"WITH {MATCH.replace('$', '-1')} SELECT p, g, round(iou, 6) AS iou, 1.0::DOUBLE AS aspect FROM m",
        "infer_stub": f"WITH g AS ({_grid(False)}), k AS (SELECT *, ((row // 512 * 31 + col // 512 * 17) % 100)::DOUBLE AS k FROM g) SELECT scene::VARCHAR AS scene, row::INTEGER AS row, col::INTEGER AS col, k / 100 AS confidence, 10 + k AS xmin, 20 + k AS ymin, 110 + k AS xmax, 100 + k AS ymax FROM k",
        "attribute_projection": f"WITH {CANDS}, q AS (SELECT *, printf('%.4f', round(4 * pi() * area / (16 * side * side), 4)) AS c FROM cands) SELECT cand_id, round(confidence, 4) AS confidence, round(area, 2) AS area_m2, round(4 * side, 2) AS perimeter, c AS compactness, c AS circularity, 4 AS vertex_count, is_edge::INTEGER AS is_edge FROM q",
        "least_area": f"WITH {CANDS} SELECT count(*) FILTER (area / 1000 >= 100) AS v1, count(*) FILTER (area / 1000 >= 1) AS v2 FROM cands",
        "surrogate_ids": f"WITH {CANDS} SELECT row_number() OVER (ORDER BY confidence, cand_id) - 1 AS id, cand_id FROM cands",
        "utm_check": f"WITH {TILES} SELECT xmin > 1e5 AND xmin < 1.5e6 AND ymin > 0 AND ymin < 1e7 AS plausible, count(*) AS n FROM tiles GROUP BY 1",
        "valid_pixel_share": f"WITH {VALID} SELECT scene, \"window\", share, share >= 0.2 AS used FROM w",
        "scene_pixel_totals": f"""WITH {VALID}, m AS (SELECT o_orderkey % 7 AS scene, o_orderkey % 211 AS "window", count(*) FILTER (o_orderkey % 3 = 0) AS n FROM orders GROUP BY ALL)
 SELECT scene, count(*) AS windows, count(*) FILTER (share >= 0.2) AS valid, count(*) FILTER (share >= 0.2 AND coalesce(n, 0) > 0) AS with_masks, coalesce(sum(n) FILTER (share >= 0.2), 0)::BIGINT AS candidates FROM w LEFT JOIN m USING (scene, "window") GROUP BY scene""",
        "window_bounds": f"WITH g AS ({_grid(True)}), b AS (SELECT *, 500000.0::DOUBLE + 5120 * scene + 10 * col AS xmin, 4400000.0::DOUBLE - 5120 * scene - 10 * row AS ymax FROM g) SELECT scene, row, col, xmin, ymax - 6400 AS ymin, xmin + 6400 AS xmax, ymax FROM b",
        "tile_names": f"WITH g AS ({_grid(True)}) SELECT scene, row, col, printf('t%02d_scene-%d_r%05d_c%05d', scene % 100, scene, row, col) AS name FROM g",
        "first_per_source": f"WITH {TILES} SELECT tile_id, source, row_number() OVER (PARTITION BY source ORDER BY tile_id) AS rank FROM tiles QUALIFY rank <= 5",
        "qc_sample": f"WITH {SPLIT} SELECT split, tile_id AS image, row_number() OVER (PARTITION BY split ORDER BY md5(tile_id::VARCHAR || ':42'), tile_id) AS rank FROM rs WHERE is_negative = 0 QUALIFY rank <= CASE split WHEN 'train' THEN 20 ELSE 15 END",
        "yield_stop": f"""WITH g AS ({_grid(False)}), h AS (SELECT *, (row + col) % 1024 = 0 AS has_mask FROM g),
 b AS (SELECT *, coalesce(sum(has_mask::INTEGER) OVER (PARTITION BY scene ORDER BY row, col ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM h) SELECT scene, row, col, has_mask FROM b WHERE before < 5""",
        "vertex_thinning": f"WITH {CANDS}, k AS (SELECT cand_id, cand_id % 40 + 3 AS n FROM cands) SELECT cand_id, least(n, 12)::INTEGER AS n, array_to_string(CASE WHEN n > 12 THEN list_transform(range(12), lambda i : i * (n - 1) // 11) ELSE range(n) END, ' ') AS points FROM k",
        "shape_parts": f"""WITH {CANDS}, p AS (SELECT *, 0 AS part, 0.0::DOUBLE AS shift FROM cands WHERE cand_id % 7 <> 0 UNION ALL SELECT *, 1 AS part, 1000.0::DOUBLE AS shift FROM cands WHERE cand_id % 3 = 0)
 SELECT cand_id AS shape_id, part, 4 AS n_points, area, xmin + shift + side / 2 AS cx, ymin + side / 2 AS cy FROM p""",
        "conservation": f"WITH {SPLIT} SELECT count(*) FILTER (split = 'train') AS n_train, count(*) FILTER (split = 'val') AS n_val, count(*) AS n_rows, count(DISTINCT tile_id) AS n_tiles, (SELECT count(*) FROM orders) AS n_total, true AS whole FROM rs",
        "paired_audit": """WITH i AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'val' ELSE 'train' END AS split, doc_id AS a FROM documents), l AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'val' ELSE 'train' END AS split, doc_id AS b FROM labels),
 n AS (SELECT split, count(a) AS images, count(b) AS labels, count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS paired FROM i FULL JOIN l USING (doc_id, split) GROUP BY split) SELECT *, CASE WHEN images = paired AND labels = paired THEN 'PASS' ELSE 'FAIL' END AS verdict FROM n""",
        "split_mode": f"""WITH {TILES}, s AS ({stats}), x AS (SELECT (SELECT count(*) FROM s a JOIN s b ON a.source < b.source WHERE {INTER} > 1) AS scene_pairs, (SELECT count(*) FROM tiles a JOIN tiles b ON a.tile_id < b.tile_id AND a.source <> b.source AND {MEET} WHERE {INTER} > 1) AS tile_pairs)
 SELECT *, CASE WHEN scene_pairs > 0 OR tile_pairs > 0 THEN 'SPATIAL' ELSE 'BY_TIF' END AS mode FROM x""",
        "set_bounds": f"WITH {TILES} SELECT min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax FROM tiles",
        "layer_union": f"WITH {CANDS} SELECT CASE WHEN cand_id % 2 = 0 THEN 'first' ELSE 'second' END AS layer, cand_id, area, CASE WHEN cand_id % 2 = 1 THEN confidence END AS confidence FROM cands",
        "threshold_report": f"""WITH {CANDS}, {THRESHOLDS}, d AS (SELECT threshold, count(*) AS n, min(area) AS lo, max(area) AS hi, median(confidence) AS m FROM cands JOIN th ON confidence >= threshold GROUP BY threshold),
 l AS (SELECT threshold, 0 AS line_no, 'threshold=' || printf('%.2f', threshold) AS line FROM d UNION ALL SELECT threshold, 1, 'instances=' || n FROM d UNION ALL SELECT threshold, 2, printf('area min=%.2f max=%.2f', lo, hi) FROM d UNION ALL SELECT threshold, 3, 'median confidence=' || printf('%.5f', m) FROM d) SELECT * FROM l""",
        "shared_tile_names": f"WITH {CUTS}, a AS (SELECT split, printf('tile_%02d', tile_id % 60) AS name FROM asg) SELECT name FROM a WHERE split = 'train' INTERSECT SELECT name FROM a WHERE split = 'val'",
        "leak_examples": f"WITH {SPLIT} SELECT a.tile_id AS val, b.tile_id AS train, row_number() OVER (PARTITION BY a.tile_id ORDER BY b.tile_id) AS rank FROM rs a JOIN rs b ON a.split = 'val' AND b.split = 'train' AND {MEET.replace('<', '<=')} QUALIFY rank <= 5",
        "nms_polygons": _nms(f"{DIAMOND} >= 0.7", f"(a.is_edge = 1 AND b.is_edge = 0 AND {DIAMOND} >= 0.5)", _V3[0]) + " SELECT cand_id, status FROM res",
        "greedy_match_polygons": _matched(0).replace(IOU, DIAMOND) + " SELECT image, p, g FROM r WHERE r NOT IN (SELECT r FROM gone)",
        "mask_candidates": f"""WITH {CANDS} SELECT cand_id % 7 AS scene, 512 * (cand_id % 5) AS window_row, 512 * (cand_id % 3) AS window_col, cand_id AS k, CASE WHEN cand_id % 4 <> 0 THEN round(confidence, 4) ELSE 0.0::DOUBLE END AS confidence, area AS area_m2, 4 * side AS perimeter,
 0.7854::DOUBLE AS compactness, 0.7854::DOUBLE AS circularity, 4 AS vertex_count, CASE WHEN xmin % 600 < 10 OR ymin % 600 < 10 OR xmin % 600 + side / 10 > 630 OR ymin % 600 + side / 10 > 630 THEN 1 ELSE 0 END AS is_edge FROM cands WHERE cand_id % 5 <> 0""",
        "window_outcomes": f"""WITH {CANDS}, w AS (SELECT cand_id % 7 AS scene, cand_id % 5 AS r, cand_id % 3 AS c, count(*) FILTER (cand_id % 5 <> 0) AS n FROM cands GROUP BY ALL)
 SELECT scene, count(*) FILTER (n > 0) AS with_masks, count(*) FILTER (n = 0) AS no_mask, sum(n)::BIGINT AS candidates FROM w GROUP BY scene""",
        "scene_bounds_utm": UTM,
        "shapefile_roundtrip": f"WITH {CANDS} SELECT source::VARCHAR AS layer, count(*) AS n, 4 * count(*) AS points, sum(area / 2) AS area FROM cands GROUP BY source",
        "png_roundtrip": "SELECT o_orderkey::VARCHAR AS name, 4 AS height, 4 AS width, 3 AS channels, md5(array_to_string(list_transform(range(48), lambda i : printf('%02X', (o_orderkey * 7 + i * 13) % 256)), '')) AS digest FROM orders",
        "shape_repair": f"""WITH {CANDS}, k AS (SELECT *, cand_id % 5 AS kind FROM cands WHERE cand_id % 101 <> 0 AND cand_id % 103 <> 0),
 r AS (SELECT cand_id, CASE WHEN kind IN (1, 3) THEN 2 ELSE 1 END AS n_parts, CASE kind WHEN 1 THEN area / 2 WHEN 3 THEN area / 2 WHEN 4 THEN area * 3 / 4 ELSE area END AS area FROM k) SELECT *, area / n_parts AS largest FROM r""",
        "shape_parts_rings": f"""WITH {CANDS}, k AS (SELECT *, cand_id % 5 AS kind FROM cands WHERE cand_id % 101 <> 0 AND cand_id % 103 <> 0)
 SELECT cand_id, part, CASE kind WHEN 1 THEN area / 4 WHEN 3 THEN area / 4 WHEN 4 THEN area * 3 / 4 ELSE area END AS area, CASE kind WHEN 4 THEN 2 ELSE 1 END AS n_rings, CASE kind WHEN 1 THEN 3 WHEN 4 THEN 8 ELSE 4 END AS n_points
 FROM k, (SELECT unnest([0, 1]) AS part) WHERE part = 0 OR kind IN (1, 3)""",
        "layer_cleaning": f"""WITH {CANDS}, k AS (SELECT cand_id % 5 AS kind, cand_id % 101 = 0 OR cand_id % 103 = 0 AS none FROM cands)
 SELECT count(*) AS n, count(*) FILTER (none) AS empty, count(*) FILTER (NOT none AND kind IN (1, 2, 3)) AS invalid, count(*) FILTER (NOT none AND kind IN (1, 2, 3)) AS mended, 0 AS lost, count(*) FILTER (NOT none) AS kept FROM k""",
        "tile_shapes_exact": f"""WITH {TILES}, {CANDS}, b AS (SELECT cand_id, area, xmin, ymin, xmax, ymax, 1 AS sign FROM cands UNION ALL SELECT cand_id, area, xmin + side / 4, ymin + side / 4, xmax - side / 4, ymax - side / 4, -1 FROM cands UNION ALL SELECT cand_id, area, xmin + 1000, ymin, xmax + 1000, ymax, 1 FROM cands),
 i AS (SELECT a.tile_id, b.cand_id, any_value(b.area) AS area, sum(sign * {INTER}) AS inter FROM tiles a JOIN b ON {MEET} GROUP BY ALL) SELECT tile_id, cand_id, round(inter, 6) AS inter, round(inter / (area * 7 / 4), 6) AS visible FROM i WHERE inter > 0""",
        "iou_concave": f"""WITH {CANDS}, u AS (SELECT unnest([0, 1, 0, 1]) AS ux, unnest([0, 0, 1, 1]) AS uy), c AS (SELECT cand_id, image, area, side / 2 AS h, xmin AS x, ymin AS y FROM cands),
 q AS (SELECT cand_id, image, area, x + ux * h AS xmin, y + uy * h AS ymin, x + ux * h + h AS xmax, y + uy * h + h AS ymax, ux + uy AS s FROM c, u),
 i AS (SELECT a.cand_id AS p, b.cand_id AS g, any_value(a.area) AS area_a, any_value(b.area) AS area_b, sum({INTER}) AS inter FROM q a JOIN q b ON a.image = b.image AND a.cand_id % 2 = 0 AND b.cand_id % 2 = 1 AND a.s < 2 AND b.s > 0 AND {MEET} GROUP BY ALL)
 SELECT p, g, inter, round(inter / (0.75 * area_a + 0.75 * area_b - inter), 9) AS iou FROM i""",
        "window_read": """WITH px AS (SELECT o_orderkey % 3 AS scene, o_orderkey // 192 AS r, (o_orderkey // 3) % 64 AS c, CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice::DOUBLE END AS b2, o_custkey AS b3 FROM orders),
 w AS (SELECT DISTINCT s_suppkey % 3 AS scene, 20 * (s_suppkey % 97) AS row, 20 * (s_suppkey % 4) AS col FROM supplier)
 SELECT w.scene, w.row, w.col, count(px.scene) AS n, count(*) FILTER (b2 IS NOT NULL AND b3 IS NOT NULL) AS n_valid, count(*) FILTER (b2 IS NOT NULL AND b3 IS NOT NULL) / 576.0::DOUBLE >= 0.2 AS used, coalesce(sum(round(b2 * 100)::BIGINT) FILTER (b3 IS NOT NULL), 0)::BIGINT AS cents
 FROM w LEFT JOIN px ON px.scene = w.scene AND r >= w.row AND r < w.row + 24 AND c >= w.col AND c < w.col + 24 GROUP BY ALL""",
        "assigned_by_mode": f"WITH {CUTS} SELECT tile_id, split FROM asg",
        "assigned_by_mode_apart": f"""WITH {TILES}, s AS (SELECT source, count(*) FILTER (is_negative = 0) > 0 AS good, md5(source::VARCHAR || ':42') AS h FROM tiles GROUP BY source), r AS (SELECT source, good, row_number() OVER (PARTITION BY good ORDER BY h) AS r FROM s)
 SELECT tile_id, CASE WHEN good AND r = 1 THEN 'val' WHEN good AND r = 2 THEN 'test' ELSE 'train' END AS split FROM tiles JOIN r USING (source)""",
        "shape_distribution": f"""WITH {CANDS}, c AS (SELECT *, round(16 * area / ((4 * side + 10 * (cand_id % 9)) * (4 * side + 10 * (cand_id % 9))), 9) AS compactness FROM cands)
 SELECT source, count(*) AS n, median(area) AS median_area, median(confidence) AS median_confidence, min(compactness) AS min_compactness, max(compactness) AS max_compactness, median(compactness) AS median_compactness FROM c GROUP BY source""",
        "confidence_windows": f"WITH c AS (SELECT ts, ((7919 * event_id) % 10000)::DOUBLE / 10000 AS confidence FROM events) SELECT date_trunc('day', ts)::TIMESTAMP AS start, count(*) AS n, {_bins()} FROM c GROUP BY 1",
    }
