"""SQL twins of the queries, for another engine to check them on the same tables."""

from __future__ import annotations

from ..functions import fixed as K

ORACLE_SQL: dict[str, str] = {}


def _r(e: str) -> str:
    return f"(round({e}, 6) + 0)"


_MASKED = ", ".join(map(str, K.ORDER_SORTING + K.NO_SIGNAL))
_PX = "px AS (SELECT (vec_id // 25 + 0.5)::DOUBLE AS y, (vec_id % 25 + 0.5)::DOUBLE AS x, embedding FROM embeddings)"
_C = f"{_PX}, c AS (SELECT y, x, b::INT AS band, embedding[b]::DOUBLE AS v FROM px, range(1, 65) r(b))"
_LIT = f"{_C}, l AS (SELECT y, x, band, (abs(v) + 0.01::DOUBLE) * 10 AS v FROM c)"
_HOLED = f"{_C}, h AS (SELECT y, x, band, CASE WHEN abs(v) >= 0.05::DOUBLE AND band NOT BETWEEN 20 AND 29 AND band NOT BETWEEN 40 AND 50 THEN v END AS v FROM c)"
_LUT = "lut AS (SELECT (p_partkey // 25 + 1)::INT AS band, (p_partkey % 25 + 0.5)::DOUBLE AS x, p_retailprice / 1e5::DOUBLE AS gain, p_size / 100::DOUBLE AS off FROM part)"
_LINES = "lines AS (SELECT DISTINCT y, 20 + (y / 2::DOUBLE) % 60 AS inc, (y * 3) % 360 AS iaz, -30 + y / 10::DOUBLE AS lat FROM px)"
_WL = "((4000 + 13 * band) * 1e-9::DOUBLE)"
_FLUX = "((100 + 3 * band)::DOUBLE * 10 / pi())"
_C1, _C2 = f"{2 * K.PLANCK * K.LIGHT**2!r}::DOUBLE", f"{K.PLANCK * K.LIGHT / K.BOLTZMANN!r}::DOUBLE"
_BT = f"({_C2} / ({_WL} * ln({K.EMISSIVITY * 2 * K.PLANCK * K.LIGHT**2 * 1e-6!r}::DOUBLE / (v * pow({_WL}, 5)) + 1)))"
_HEAT = f"({K.EMISSIVITY}::DOUBLE * {1e-6 * 2 * K.PLANCK * K.LIGHT**2!r}::DOUBLE / (pow({_WL}, 5) * (exp({_C2} / ({_WL} * t)) - 1)))"
_GEO = "geo AS (SELECT s_suppkey % 6 * 50::DOUBLE AS px, s_suppkey // 6 * 50::DOUBLE AS sc, (150 + s_suppkey % 6 * 8 + s_suppkey // 6 * 0.5::DOUBLE) AS lon, -20 + s_suppkey // 6 * 0.9::DOUBLE + s_suppkey % 6 * 0.1::DOUBLE AS lat FROM supplier), g AS (SELECT px, sc, (((lon + 180) % 360) + 360) % 360 - 180 AS lon, lat FROM geo)"
_SPM = """e AS (SELECT epoch_us(ts) / 1e6::DOUBLE AS ts, value % 60 AS elev, value % 360 AS az FROM events),
    k AS (SELECT ts, avg(elev) AS elev, avg(az) AS az FROM e GROUP BY ts),
    s AS (SELECT ts AS t0, lead(ts) OVER w AS t1, elev AS e0, lead(elev) OVER w AS e1, az AS a0, lead(az) OVER w AS a1, row_number() OVER w AS n, lead(ts, 2) OVER w AS t2 FROM k WINDOW w AS (ORDER BY ts)),
    seg AS (SELECT *, CASE WHEN n > 1 THEN t0 END AS lo, CASE WHEN t2 IS NOT NULL THEN t1 END AS hi FROM s WHERE t1 IS NOT NULL),
    clock AS (SELECT DISTINCT vec_id // 25 AS line, (vec_id // 25 + 0.5)::DOUBLE AS y, (SELECT min(epoch_us(ts)) FROM events) / 1e6::DOUBLE - 1800 + 60.0::DOUBLE * (vec_id // 25) AS t FROM embeddings),
    sun AS (SELECT line, y, e0 + (t - t0) * (e1 - e0) / (t1 - t0) AS elev, a0 + (t - t0) * (a1 - a0) / (t1 - t0) AS az FROM clock JOIN seg ON (lo IS NULL OR t >= lo) AND (hi IS NULL OR t < hi))"""


def _filled(src: str, gap: str) -> str:
    """CTE ``f``: ``src`` with holes filled linearly under the condition ``gap`` on pb and nb."""
    return f"""a AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN band END IGNORE NULLS) OVER p AS pb, last_value(v IGNORE NULLS) OVER p AS pv,
        first_value(CASE WHEN v IS NOT NULL THEN band END IGNORE NULLS) OVER n AS nb, first_value(v IGNORE NULLS) OVER n AS nv FROM {src}
        WINDOW p AS (PARTITION BY y, x ORDER BY band ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), n AS (PARTITION BY y, x ORDER BY band ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
        f AS (SELECT y, x, band, v AS orig, CASE WHEN v IS NOT NULL THEN v WHEN {gap} THEN pv + (nv - pv) * (band - pb) / (nb - pb) END AS v FROM a)"""


def _box(src: str, before: int, after: int, least: float) -> str:
    return f"SELECT band, y, x, CASE WHEN count(v) OVER w >= {least} THEN {_r('avg(v) OVER w')} END AS value FROM {src} WINDOW w AS (PARTITION BY y, x ORDER BY band ROWS BETWEEN {before} PRECEDING AND {after} FOLLOWING)"


def _add(name: str, sql: str) -> None:
    ORACLE_SQL[name] = sql


_plain = lambda ctes, src, e="v": f"WITH {ctes} SELECT band, y, x, {_r(e)} AS value FROM {src}"

_add("cube_long", _plain(_C, "c"))
_add("cube_spectral", f"WITH {_C} SELECT y, x, 64::BIGINT AS bands, count(*) FILTER (v > 0) AS present, {_r('max(v) FILTER (band = 7 AND v > 0)')} AS band_7 FROM c GROUP BY y, x HAVING count(*) FILTER (v > 0) > 0")
_add("crop_xy", f"WITH {_C} SELECT y, x, {_r('v')} AS band_1 FROM c WHERE band = 1 AND x BETWEEN 5 AND 8 AND y <= 12")
_add("crop_padded", f"WITH {_PX} SELECT y, x FROM px WHERE x BETWEEN 4.5 AND 8.5 AND y BETWEEN 1.5 AND 9.5")
_add("crop_bands", f"WITH {_C} SELECT band, count(*) AS n, {_r('avg(v)')} AS mean FROM c WHERE band BETWEEN 10 AND 12 GROUP BY band")
_add("line_slice", "SELECT DISTINCT vec_id // 25 AS line, (vec_id // 25 + 0.5)::DOUBLE AS y FROM embeddings WHERE vec_id // 25 IN (2, 3, 4)")
_add("flip_descending", f"WITH {_PX} SELECT min(y) OVER () - y AS y, x FROM px")
_add("preview_stride", f"WITH {_C}, n AS (SELECT y, row_number() OVER (ORDER BY y) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT y FROM px)) SELECT band, y, x, {_r('v')} AS value FROM c JOIN n USING (y) WHERE band = 30 AND i % (CASE WHEN n > 10 THEN n // 5 ELSE 1 END) = 0")
_add("median_spectrum", f"WITH {_C} SELECT band, {_r('median(v)')} AS median_value FROM c GROUP BY band")
_add("dn_to_radiance", _plain(f"{_C}, {_LUT}", "c JOIN lut USING (band, x)", "10 * v * gain + off"))
_add("mask_osf_invalid", _plain(_C, "c", f"CASE WHEN band NOT IN ({_MASKED}) THEN v END"))
_add("mask_bad_bands", _plain(_C, "c", "CASE WHEN band % 9 <> 0 THEN v END"))
_add("mask_saturation", _plain(_C, "c", "CASE WHEN v < 0.3::DOUBLE + 0.001::DOUBLE * band THEN v END"))
_add("low_signal_mask", _plain(_LIT, "l", "CASE WHEN max(CASE WHEN band = 10 THEN v END) OVER (PARTITION BY y, x) > 0.5 THEN v END"))
_add("max_refl", _plain(_C, "c", "CASE WHEN v <= 0.1::DOUBLE THEN v END"))
_add("cosinc_mask", f"WITH {_PX}, {_LINES} SELECT y, {_r('CASE WHEN c > 0.03::DOUBLE AND c < 0.999::DOUBLE THEN c END')} AS cos_inc FROM (SELECT y, cos(radians(inc * 1.2::DOUBLE)) AS c FROM lines)")
_add("interp_bands_maxgap", _plain(f"{_HOLED}, {_filled('h', 'nb - pb <= 11')}", "f"))
_add("bad_band_buffer", "SELECT p_partkey // 256 AS block, (p_partkey % 256 + 1)::INT AS band, bool_or(p_size > 45) OVER (PARTITION BY p_partkey // 256 ORDER BY p_partkey ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS bad FROM part")
_add("lut_denoise", f"""WITH lut AS (SELECT p_partkey // 1600 AS lut, (p_partkey // 25 % 64 + 1)::INT AS band, (p_partkey % 25 + 0.5)::DOUBLE AS x, p_retailprice / 1e5::DOUBLE AS gain, p_size / 100::DOUBLE AS off FROM part),
    r AS (SELECT *, gain - median(gain) OVER w AS gr, off - median(off) OVER w AS orr FROM lut WINDOW w AS (PARTITION BY lut, band ORDER BY x ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)),
    s AS (SELECT *, stddev_pop(gr) OVER (PARTITION BY lut) AS gs, stddev_pop(orr) OVER (PARTITION BY lut) AS os FROM r)
    SELECT lut, band, x, {_r('CASE WHEN abs(gr / nullif(gs, 0)) < 1 THEN gain END')} AS gain, {_r('CASE WHEN abs(orr / nullif(os, 0)) < 0.5 THEN off END')} AS offset FROM s""")
_STRIPES = f"""WITH {_C}, n AS (SELECT *, coalesce(lag(v) OVER w, v) AS a, coalesce(lead(v) OVER w, v) AS b FROM c WINDOW w AS (PARTITION BY band, y ORDER BY x)),
    s AS (SELECT band, x, count(*) FILTER ((v < a AND v < b) OR (v > a AND v > b)) AS n_off, count(*) AS lines FROM n GROUP BY band, x)"""
_add("stripe_counts", f"{_STRIPES} SELECT band, x, n_off FROM s")
_add("stripe_flags", f"{_STRIPES} SELECT band, x, n_off > 0.6826894921370859::DOUBLE * lines AS is_stripe FROM s")
_add("line_times", f"SELECT i AS line, {_r('1600000000 + 0.0248::DOUBLE * i')} AS t FROM range(500) r(i)")
_add("sun_incidence", f"WITH {_SPM} SELECT line, {_r('90 - abs(elev)')} AS inc, {_r('az - 180')} AS iaz FROM sun")
_add("solar_flux", f"SELECT b::INT AS band, {_r('(100 + 3 * b)::DOUBLE * 10 / (pi() * 0.9855::DOUBLE * 0.9855::DOUBLE)')} AS flux, {_r('round_even((100 + 3 * b)::DOUBLE * 10 / 3.14::DOUBLE, 4)')} AS flux_rounded FROM range(1, 65) r(b)")
_add("reflectance", f"WITH {_LIT}, {_SPM} SELECT band, l.y, x, {_r(f'v / (cos(radians(90 - abs(elev))) * {_FLUX})')} AS value FROM l LEFT JOIN sun ON l.y = sun.y")
_add("brightness_temp", _plain(_LIT, "l", _BT))
_T = f"t AS (SELECT y, x, avg({_BT}) AS t FROM l WHERE band BETWEEN 41 AND 60 GROUP BY y, x)"
_add("mean_temperature", f"WITH {_LIT}, {_T} SELECT y, x, {_r('t')} AS t FROM t")
_add("thermal_radiance", _plain(f"{_LIT}, {_T}", "l JOIN t USING (y, x)", _HEAT))
_add("boxcar_w3", f"WITH {_HOLED} {_box('h', 1, 1, 1.5)}")
_add("boxcar_w4", f"WITH {_HOLED} {_box('h', 2, 1, 2)}")
_add("boxcar_strict", f"WITH {_HOLED} {_box('h', 1, 1, 3)}")
_W = f"(exp(-0.5::DOUBLE) / (1 + 2 * exp(-0.5::DOUBLE)))"
_add("gaussian_w3", f"WITH {_HOLED}, {_filled('h', 'pb IS NOT NULL AND nb IS NOT NULL')} SELECT band, y, x, {_r(f'CASE WHEN orig IS NOT NULL THEN {_W} * lag(v) OVER w + v / (1 + 2 * exp(-0.5::DOUBLE)) + {_W} * lead(v) OVER w END')} AS value FROM f WINDOW w AS (PARTITION BY y, x ORDER BY band)")
_add("polish", _plain(_C, "c", "CASE WHEN band BETWEEN 8 AND 40 THEN v / (1 + 0.001::DOUBLE * band) ELSE v END"))
_DEM = f"""{_PX}, d AS (SELECT y, x, embedding[12]::DOUBLE * 100 AS z FROM px),
    a AS (SELECT *, coalesce(lag(z) OVER w, z) AS zl, coalesce(lead(z) OVER w, z) AS zr FROM d WINDOW w AS (PARTITION BY y ORDER BY x)),
    b AS (SELECT *, zl - zr AS dx, zl + 2 * z + zr AS sx FROM a),
    g AS (SELECT y, x, coalesce(lag(dx) OVER w, dx) + 2 * dx + coalesce(lead(dx) OVER w, dx) AS gx, coalesce(lead(sx) OVER w, sx) - coalesce(lag(sx) OVER w, sx) AS gy FROM b WINDOW w AS (PARTITION BY x ORDER BY y))"""
_add("dem_gradient", f"WITH {_DEM} SELECT y, x, {_r('gx / 16')} AS dz_dx, {_r('gy / 24')} AS dz_dy FROM g")
_COS = f"""{_DEM}, {_LINES}, q AS (SELECT g.y, x, gx / 8 AS p, gy / 8 AS q, radians(inc) AS i, radians(iaz) AS a, radians(lat) AS f FROM g JOIN lines USING (y)),
    n AS (SELECT y, x, (-p * sin(i) * sin(a) - q * (sin(i) * cos(a) * cos(f) - cos(i) * sin(f)) + (sin(i) * cos(a) * sin(f) + cos(i) * cos(f))) / sqrt(p * p + q * q + 1) AS c FROM q)"""
_add("dem_cos_inc", f"WITH {_COS} SELECT y, x, {_r('c')} AS cos_inc FROM n")
_add("illumination_report", f"WITH {_COS} SELECT bool_or(c IS NULL) AS has_missing, {_r('min(c)')} AS least, min(c) < 0 AS any_negative FROM n")
_add("dem_regrid", f"""WITH {_PX}, d AS (SELECT y, x, embedding[12]::DOUBLE * 100 AS z FROM px), e AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM d),
    xs AS (SELECT u FROM (SELECT x1, x0 + 0.25::DOUBLE + unnest(range((x1 - x0)::BIGINT + 1)) AS u FROM e) WHERE u <= x1), ys AS (SELECT w FROM (SELECT y1, y0 + 0.5::DOUBLE + 1.5::DOUBLE * unnest(range((y1 - y0)::BIGINT + 1)) AS w FROM e) WHERE w <= y1),
    p AS (SELECT u, w, sum(z * greatest(0, 1 - abs(x - u)) * greatest(0, 1 - abs(y - w))) AS z FROM xs, ys, d WHERE abs(x - u) < 1 AND abs(y - w) < 1 GROUP BY u, w)
    SELECT w AS y, u AS x, {_r('z')} AS z FROM p""")
_add("lon_wrap", f"SELECT c_custkey, {_r('((c_acctbal + 180) % 360 + 360) % 360 - 180')} AS lon FROM customer")
_add("geom_points", f"WITH {_GEO} SELECT px + 0.5 AS Pixel, sc + 0.5 AS Scan, {_r('lon')} AS Longitude, {_r('lat')} AS Latitude FROM g WHERE lon BETWEEN 149 AND 181 AND lat BETWEEN -21 AND 6")
_add("geom_extent", f"WITH {_GEO} SELECT min(px) AS min_pixel, max(px) AS max_pixel, min(sc) AS min_scan, max(sc) AS max_scan FROM g WHERE lon BETWEEN 154.5 AND 178.5 AND lat BETWEEN -19.5 AND 90.5")
_add("geom_corners", f"WITH {_GEO}, b AS (SELECT * FROM g WHERE lon BETWEEN 155 AND 178 AND lat BETWEEN -19.5 AND 90), e AS (SELECT min(px) AS a, max(px) AS b, min(sc) AS c, max(sc) AS d FROM b) SELECT sc AS row, px AS col, {_r('lon')} AS x, {_r('lat')} AS y FROM b, e WHERE px IN (e.a, e.b) AND sc IN (e.c, e.d)")
_add("latlon_pivot", f"WITH {_GEO} SELECT sc + 1 AS y, {', '.join(f'''{_r(f'max(lat) FILTER (px = {50 * k})')} AS x_{50 * k}''' for k in range(6))} FROM g GROUP BY sc")
# longitude and latitude of the geometry grid are affine in Pixel and Scan, and a thin-plate spline gives affine values back everywhere
_add("tps_grid", f"WITH {_PX} SELECT x, y, {_r('150 + x / 50 * 8 + y / 50 * 0.5::DOUBLE')} AS lon, {_r('-20 + y / 50 * 0.9::DOUBLE + x / 50 * 0.1::DOUBLE')} AS lat FROM px")
_add("regular_grid", f"""WITH {_PX}, p AS (SELECT x * 1.1::DOUBLE + y * 0.2::DOUBLE AS lon, y * 0.9::DOUBLE - x * 0.1::DOUBLE AS lat, embedding[1]::DOUBLE AS v FROM px),
    e AS (SELECT min(lon) AS lon0, max(lon) AS lon1, min(lat) AS lat0, max(lat) AS lat1 FROM p),
    q AS (SELECT v, least(floor((lon - lon0) / (lon1 - lon0) * 12), 11) AS i, least(floor((lat - lat0) / (lat1 - lat0) * 10), 9) AS j, e.* FROM p, e)
    SELECT {_r('lon0 + (i + 0.5::DOUBLE) * (lon1 - lon0) / 12')} AS lon, {_r('lat0 + (j + 0.5::DOUBLE) * (lat1 - lat0) / 10')} AS lat, {_r('avg(v)')} AS value FROM q GROUP BY i, j, lon0, lon1, lat0, lat1""")
_MADE = "coalesce('sat_img_nci_' || lpad(p_partkey::VARCHAR, 8, '2') || CASE WHEN p_partkey % 3 > 0 THEN 'T' END || lpad((p_partkey * 7)::VARCHAR, 10, '1') || '_g_grd_d32.csv', p_name)"
_add("basename", f"WITH m AS (SELECT p_partkey, {_MADE} AS f FROM part) SELECT p_partkey, nullif(regexp_extract(f, '\\d{{8}}T\\d{{10}}'), '') AS basename, string_split(regexp_replace(f, '\\.[^.]*$', ''), '_')[4] AS token FROM m")
_add("exp_gain_key", "SELECT p_partkey, lower('E' || (p_size % 4 + 1) || 'G2') AS exp_gain FROM part")
_WKT = "CASE n_nationkey % 3 " + " ".join(f"WHEN {k} THEN '{K.PROJECTIONS[n][:40]}'" for k, n in enumerate(("equatorial", "polarstereographicsouthpole", "polarstereographicnorthpole"))) + " END"
_add("proj_lookup", f"SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'equatorial' WHEN 1 THEN 'polarstereographicsouthpole' ELSE 'polarstereographicnorthpole' END AS key, {_WKT} AS wkt FROM nation")
_add("solar_distance", "SELECT p_partkey, CASE p_partkey % 8 " + " ".join(f"WHEN {k} THEN {v}::DOUBLE" for k, v in enumerate(K.SOLAR_DISTANCE.values())) + " ELSE 1::DOUBLE END AS au FROM part")
_add("md5_verify", "SELECT doc_id, md5(coalesce(text, '')) AS md5, doc_id % 10 <> 0 AS ok FROM documents")
_add("label_metaget", """SELECT page_id, 'e' || (page_id % 4 + 1) || 'g2' AS exp_gain, CASE WHEN page_id % 2 = 0 THEN 'Equatorial' END AS area, 1624363200 + page_id % 60 * 60 + 56.344::DOUBLE AS start, page_id AS lines,
    (page_id + 0.5::DOUBLE)::VARCHAR || ' nm; ' || (page_id + 17.25::DOUBLE)::VARCHAR || ' nm' AS labels FROM pages""")
_add("catalog_files", """WITH p AS (SELECT page_id AS k, 'sat_img_nci_' || page_id || '_d_img_d32' AS s FROM pages)
    SELECT CASE k % 7 WHEN 1 THEN 'qub' WHEN 2 THEN 'spm' WHEN 3 THEN e WHEN 4 THEN e WHEN 5 THEN e ELSE 'hdr' END AS ext, k::VARCHAR AS basename,
        CASE k % 7 WHEN 1 THEN '/archive/data/calibrated/20210622/' || s || '.qub' WHEN 2 THEN '/archive/miscellaneous/calibrated/x/' || s || '.spm' WHEN 3 THEN '/archive/geometry/calibrated/' || s || '.csv'
            WHEN 4 THEN '/archive/data/calibrated/' || s || '.xml' WHEN 5 THEN '/archive/browse/calibrated/' || s || '.png' ELSE '/archive/data/calibrated/' || s || '.hdr' END AS path
    FROM p, (VALUES ('csv', 3), ('xml', 4), ('png', 5), ('x', 1), ('x', 2), ('x', 6)) x(e, m) WHERE k % 7 = m""")
_STAMP = _r("epoch(date_trunc('second', ts)) + event_id % 1000 / 1000::DOUBLE")
_add("spm_records", f"SELECT event_id AS row, year(ts)::VARCHAR AS year, {_STAMP} AS timestamp, (event_id % 360)::DOUBLE AS sun_az, -0.25::DOUBLE * event_id AS sun_elev FROM events")
_HOT = f"h AS (SELECT y, x, avg({_BT}) AS t FROM l WHERE band BETWEEN 41 AND 60 GROUP BY y, x)"
_FR = "round_even((100 + 3 * band)::DOUBLE * 10 / 3.14::DOUBLE, 4)"
_add("verma_pipeline", f"""WITH {_LIT}, {_LINES}, {_HOT}, r AS (SELECT l.y, x, band, (v - {_HEAT}) / {_FR} AS v FROM l JOIN h USING (y, x)),
    p AS (SELECT r.y, x, band, CASE WHEN band BETWEEN 8 AND 63 THEN (CASE WHEN v < 0 THEN 0 ELSE v END) / (1 + 0.001::DOUBLE * band) / cos(radians(inc)) END AS v FROM r JOIN lines USING (y)) {_box('p', 1, 1, 3)}""")
_add("l0_to_rad", _plain(f"""{_C}, {_LUT}, sx AS (SELECT DISTINCT x FROM lut), m AS (SELECT c.y, c.x, c.band, 10 * v * gain + off AS v FROM c JOIN sx USING (x) LEFT JOIN lut ON c.band = lut.band AND c.x = lut.x),
    h AS (SELECT y, x, band, CASE WHEN band NOT IN ({_MASKED}) AND v < 0.3::DOUBLE + 0.001::DOUBLE * band THEN v END AS v FROM m), {_filled('h', 'nb - pb <= 11')}""", "f"))
_add("l1_to_refl", f"WITH {_LIT}, {_LINES}, {_HOT} SELECT band, l.y, x, {_r(f'(v - {_HEAT}) / (cos(radians(inc)) * {_FLUX})')} AS value FROM l JOIN h USING (y, x) JOIN lines USING (y)")
_add("full_refl", f"""WITH {_LIT.replace('l AS (', 'l0 AS (')}, l1 AS (SELECT y, x, band, CASE WHEN band % 9 <> 0 THEN v END AS v FROM l0),
    l AS (SELECT y, x, band, CASE WHEN max(CASE WHEN band = 10 THEN v END) OVER (PARTITION BY y, x) > 0.5 THEN v END AS v FROM l1), {_LINES}, {_HOT},
    k AS (SELECT y, CASE WHEN c > 0.03::DOUBLE AND c < 0.999::DOUBLE THEN c END AS c FROM (SELECT y, cos(radians(inc)) AS c FROM lines)),
    r AS (SELECT l.y, x, band, (v - {_HEAT}) / (c * {_FLUX}) AS v FROM l LEFT JOIN h USING (y, x) LEFT JOIN k USING (y)),
    p AS (SELECT y, x, band, CASE WHEN v <= 0.005::DOUBLE THEN CASE WHEN band BETWEEN 8 AND 63 THEN v / (1 + 0.001::DOUBLE * band) ELSE v END END AS v FROM r) {_box('p', 1, 1, 1.5)}""")
_add("fourier_destripe_default", f"""WITH {_C}, n AS (SELECT y, x, band, v, y - 0.5 AS i, count(*) OVER (PARTITION BY band, x) AS ny FROM c), m AS (SELECT band, x, avg(v) AS m FROM c GROUP BY band, x),
    k AS (SELECT d, sum(cos(2 * pi() * u * d / 25)) / 25 AS w FROM range(-24, 25) a(d), range(-12, 13) b(u) WHERE abs(u) >= 2 GROUP BY d),
    hp AS (SELECT a.band, a.x, sum(b.m * w) AS hp FROM m a JOIN m b ON a.band = b.band JOIN k ON d = (a.x - b.x)::BIGINT GROUP BY a.band, a.x),
    b AS (SELECT band, avg(v * CASE WHEN i % 2 = 0 THEN 1 ELSE -1 END) AS a FROM n GROUP BY band)
    SELECT n.band, y, n.x, {_r('CASE WHEN v = 0 THEN 0 ELSE abs(v - hp - a * CASE WHEN i % 2 = 0 THEN 1 ELSE -1 END) END')} AS value FROM n JOIN hp ON n.band = hp.band AND n.x = hp.x JOIN b ON n.band = b.band""")
# readers
ORACLE_SQL["qub_long"], ORACLE_SQL["qub_to_rad"] = ORACLE_SQL["cube_long"], ORACLE_SQL["l0_to_rad"]
_add("gain_offset_file", f"SELECT 'e3g2' AS exp_gain, (p_partkey // 25 + 1)::INT AS band, (p_partkey % 25 + 0.5)::DOUBLE AS x, {_r('p_retailprice / 1e5::DOUBLE')} AS gain, {_r('p_size / 100::DOUBLE')} AS offset FROM part")
_add("saturation_file", f"SELECT 'e4g2' AS exp_gain, (p_partkey + 1)::INT AS band, CASE WHEN p_partkey % 7 > 1 THEN {_r('p_retailprice * 0.01::DOUBLE')} END AS range, {_r('p_size * 0.01::DOUBLE')} AS saturation FROM part")
_add("validity_file", "SELECT 'e2g2' AS exp_gain, (p_partkey + 1)::INT AS band, bool_or(p_size > 45) OVER (ORDER BY p_partkey ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS bad FROM part")
_add("polish_file", f"SELECT (p_partkey + 8)::INT AS band, {_r('1 + p_size / 1000::DOUBLE')} AS polish FROM part")
_add("solar_flux_file", f"SELECT (p_partkey + 1)::INT AS band, round(800.1234::DOUBLE + 17.25::DOUBLE * p_partkey, 3) AS wl, {_r('p_retailprice / 10::DOUBLE * 10 / (pi() * 0.9855::DOUBLE * 0.9855::DOUBLE)')} AS flux FROM part")
_add("geometry_file", f"WITH {_GEO} SELECT px + 0.5::DOUBLE AS \"Pixel\", sc + 0.5::DOUBLE AS \"Scan\", {_r('lon')} AS \"Longitude\", {_r('lat')} AS \"Latitude\" FROM g")
_add("points_file", f"WITH {_GEO} SELECT sc AS row, px AS col, {_r('lon')} AS x, {_r('lat')} AS y, 'SOME WKT' AS crs FROM geo")
