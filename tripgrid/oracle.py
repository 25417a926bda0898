"""DuckDB SQL oracles for the registered queries.

Written independently of the Spark plans, in the shape of the original
program (window-function dedupe, left joins on taxi and on cell), over the
``lineitem`` view. Type rules learned from probes: integer division is ``//``;
DuckDB reads bare decimals as DECIMAL, so grid arithmetic casts to DOUBLE;
``sum`` of BIGINT is HUGEINT, so sums are cast back to BIGINT.
"""

from __future__ import annotations

import datetime as _dt

# Raw trip log derived from lineitem (FIXTURES.md section 6) -> cleaned -> enriched.
TRIPS_CTE = """
li AS (
  SELECT l_orderkey * 1000003 + l_partkey * 8191 + l_suppkey * 131 + l_linenumber AS k,
         l_suppkey, l_partkey
  FROM lineitem
),
wide AS (SELECT *, (k // 11) % 5 = 0 AS w FROM li),
gen AS (
  SELECT *,
    CASE WHEN w THEN (k // 13) % 300 + 1 ELSE 150 + least((k // 13) % 5, (k // 37) % 5, (k // 483) % 5) END AS ca,
    CASE WHEN w THEN (k // 17) % 300 + 1 ELSE 155 + least((k // 17) % 5, (k // 41) % 5, (k // 699) % 5) END AS cb,
    CASE WHEN w THEN (k // 29) % 300 + 1 ELSE 150 + least((k // 29) % 5, (k // 43) % 5, (k // 1249) % 5) END AS cc,
    CASE WHEN w THEN (k // 31) % 300 + 1 ELSE 155 + least((k // 31) % 5, (k // 47) % 5, (k // 1459) % 5) END AS cd,
    ((k // 8) % 84) * 86400
      + CASE WHEN (k // 5) % 4 = 0 THEN (k // 672) % 86400 ELSE 33300 + (k // 672) % 3600 END AS start_s,
    CAST((k // 7) % 900 AS INTEGER) AS dur,
    250 + (k // 19) % 5000 AS fare_c,
    (k // 23) % 1000 AS tip_c
  FROM wide
),
raw AS (
  SELECT
    CASE WHEN k % 97 = 0 THEN '' WHEN k % 89 <> 0 THEN 'T' || CAST(l_suppkey AS VARCHAR) END AS medallon,
    CASE WHEN k % 83 = 0 THEN '' ELSE 'L' || CAST(l_partkey AS VARCHAR) END AS licencia,
    TIMESTAMP '2013-01-01 00:00:00' + to_seconds(start_s) AS hora_subida,
    CASE WHEN k % 103 <> 0 THEN TIMESTAMP '2013-01-01 00:00:00' + to_seconds(start_s + dur) END AS hora_bajada,
    dur AS duracion_viaje_seg,
    CASE WHEN k % 53 = 0 THEN CAST(0 AS DECIMAL(18,14))
         WHEN k % 61 = 0 THEN CAST(-73.120778 AS DECIMAL(18,14))
         ELSE CAST(-74.916578 + (CAST(ca AS DECIMAL(20,0)) - 0.5) * 0.005986 AS DECIMAL(18,14)) END
      AS longitud_subida,
    CASE WHEN k % 71 = 0 THEN CAST(40.129715978 AS DECIMAL(18,14))
         ELSE CAST(41.477182778 - (CAST(cb AS DECIMAL(20,0)) - 0.5) * 0.004491556 AS DECIMAL(18,14)) END
      AS latitud_subida,
    CASE WHEN k % 73 = 0 THEN CAST(-74.916578 AS DECIMAL(18,14))
         ELSE CAST(-74.916578 + (CAST(cc AS DECIMAL(20,0)) - 0.5) * 0.005986 AS DECIMAL(18,14)) END
      AS longitud_bajada,
    CASE WHEN k % 67 = 0 THEN CAST(41.477182778 AS DECIMAL(18,14))
         ELSE CAST(41.477182778 - (CAST(cd AS DECIMAL(20,0)) - 0.5) * 0.004491556 AS DECIMAL(18,14)) END
      AS latitud_bajada,
    CASE WHEN k % 79 = 0 THEN NULL WHEN k % 10 = 0 THEN 'UNK' WHEN k % 10 < 5 THEN 'CSH' ELSE 'CRD' END AS tipo_pago,
    CAST(CAST(fare_c AS DECIMAL(18,0)) / 100 AS DECIMAL(10,2)) AS tarifa,
    CAST(CAST(tip_c AS DECIMAL(18,0)) / 100 AS DECIMAL(10,2)) AS propina,
    CAST(CAST(CASE WHEN k % 101 = 0 THEN 0 ELSE fare_c + tip_c END AS DECIMAL(18,0)) / 100 AS DECIMAL(10,2)) AS cantidad_total,
    k
  FROM gen
),
placed AS (
  SELECT *,
    CAST(floor((CAST(41.477182778 AS DOUBLE) - CAST(latitud_subida AS DOUBLE)) / CAST(0.004491556 AS DOUBLE)) AS BIGINT) + 1
      AS cuad_latitud_subida,
    CAST(floor(abs(CAST(-74.916578 AS DOUBLE) - CAST(longitud_subida AS DOUBLE)) / CAST(0.005986 AS DOUBLE)) AS BIGINT) + 1
      AS cuad_longitud_subida,
    CAST(floor((CAST(41.477182778 AS DOUBLE) - CAST(latitud_bajada AS DOUBLE)) / CAST(0.004491556 AS DOUBLE)) AS BIGINT) + 1
      AS cuad_latitud_bajada,
    CAST(floor(abs(CAST(-74.916578 AS DOUBLE) - CAST(longitud_bajada AS DOUBLE)) / CAST(0.005986 AS DOUBLE)) AS BIGINT) + 1
      AS cuad_longitud_bajada
  FROM raw
),
checks AS (
  SELECT *,
    coalesce(cuad_latitud_subida BETWEEN 1 AND 300 AND cuad_longitud_subida BETWEEN 1 AND 300
      AND cuad_latitud_bajada BETWEEN 1 AND 300 AND cuad_longitud_bajada BETWEEN 1 AND 300, false) AS ok_grid,
    coalesce(medallon <> '' AND licencia <> '', false) AS ok_ids,
    coalesce(hora_subida <> hora_bajada, false) AS ok_times,
    coalesce(duracion_viaje_seg > 0 AND cantidad_total > 0, false) AS ok_positive,
    coalesce(longitud_subida <> longitud_bajada AND latitud_subida <> latitud_bajada, false) AS ok_moved,
    coalesce(tipo_pago IN ('CSH', 'CRD'), false) AS ok_payment,
    coalesce(
      CAST(longitud_subida AS DOUBLE) >= CAST(-74.916578 AS DOUBLE)
      AND CAST(longitud_subida AS DOUBLE) <= CAST(-73.120778 AS DOUBLE)
      AND CAST(latitud_subida AS DOUBLE) >= CAST(40.129715978 AS DOUBLE)
      AND CAST(latitud_subida AS DOUBLE) <= CAST(41.477182778 AS DOUBLE)
      AND CAST(longitud_bajada AS DOUBLE) >= CAST(-74.916578 AS DOUBLE)
      AND CAST(longitud_bajada AS DOUBLE) <= CAST(-73.120778 AS DOUBLE)
      AND CAST(latitud_bajada AS DOUBLE) >= CAST(40.129715978 AS DOUBLE)
      AND CAST(latitud_bajada AS DOUBLE) <= CAST(41.477182778 AS DOUBLE), false) AS ok_box
  FROM placed
),
cells AS (
  SELECT medallon, licencia, hora_subida, hora_bajada, duracion_viaje_seg,
    longitud_subida, latitud_subida, longitud_bajada, latitud_bajada, tipo_pago,
    tarifa, propina, cantidad_total, k,
    cuad_latitud_subida, cuad_longitud_subida, cuad_latitud_bajada, cuad_longitud_bajada,
    CAST(isodow(hora_subida) - 1 AS INTEGER) AS dia_semana
  FROM checks
  WHERE ok_ids AND ok_times AND ok_positive AND ok_moved AND ok_payment AND ok_box
),
trips AS (
  SELECT * FROM cells
  WHERE cuad_latitud_subida BETWEEN 1 AND 300 AND cuad_longitud_subida BETWEEN 1 AND 300
    AND cuad_latitud_bajada BETWEEN 1 AND 300 AND cuad_longitud_bajada BETWEEN 1 AND 300
)"""

ROUTE = "cuad_longitud_subida, cuad_latitud_subida, cuad_longitud_bajada, cuad_latitud_bajada"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([TRIPS_CTE.strip(), *[c.strip() for c in ctes]])


def _ranked(source: str, metric: str, keys: str, k: int = 10) -> str:
    order = f"{metric} DESC NULLS LAST, " + ", ".join(f"{x} ASC NULLS LAST" for x in keys.split(", "))
    return (
        f"SELECT CAST(row_number() OVER (ORDER BY {order}) - 1 AS INTEGER) AS rank, * "
        f"FROM {source} ORDER BY {order} LIMIT {k}"
    )


# --- Q1 ---------------------------------------------------------------------

_D = _dt.datetime


def _ts(t: _dt.datetime) -> str:
    return f"TIMESTAMP '{t.isoformat(sep=' ')}'"


def _tm(t: _dt.time) -> str:
    return f"TIME '{t.isoformat()}'"


def _q1(at: _dt.datetime = _D(2013, 3, 19, 10), p: str = "q1") -> str:
    lo = at - _dt.timedelta(minutes=30)
    return f"""
{p}_routes AS (
  SELECT {ROUTE}, count(*) AS viajes FROM trips
  WHERE hora_subida BETWEEN {_ts(lo)} AND {_ts(at)}
    AND hora_bajada BETWEEN {_ts(lo)} AND {_ts(at)}
  GROUP BY {ROUTE}
),
{p} AS ({_ranked(f"{p}_routes", "viajes", ROUTE)})"""


Q1_ROUTES = _q1()

def _band(col: str, lo: _dt.time, hi: _dt.time, wrap: bool = False) -> str:
    if wrap and lo > hi:
        return f"(CAST({col} AS TIME) >= {_tm(lo)} OR CAST({col} AS TIME) <= {_tm(hi)})"
    return f"CAST({col} AS TIME) BETWEEN {_tm(lo)} AND {_tm(hi)}"


def _day(col: str, lo: _dt.time, hi: _dt.time, compat: bool) -> str:
    """Weekday of an event: of its pickup, or of the date on which a band across midnight ends."""
    return "dia_semana" if compat or lo <= hi else f"isodow({_occurrence(col, hi)}) - 1"


# --- Q1S --------------------------------------------------------------------


def _q1s(compat: bool, ref: _dt.datetime = _D(2013, 1, 1, 10), weekday: int = 1, p: str | None = None) -> str:
    lo, hi = (ref - _dt.timedelta(minutes=30)).time(), ref.time()
    band = "" if compat else f"AND {_band('hora_subida', lo, hi, True)} AND {_band('hora_bajada', lo, hi, True)} "
    day = _day("hora_subida", lo, hi, compat)
    name = p or ("q1s_compat" if compat else "q1s")
    return f"""
{name}_routes AS (
  SELECT {ROUTE},
    CAST(sum(CASE WHEN hora_subida > {_ts(ref)} - INTERVAL 30 DAY
                   AND hora_subida < {_ts(ref)} + INTERVAL 30 DAY
              THEN 2 ELSE 1 END) AS BIGINT) AS frecuencia
  FROM trips WHERE {day} = {weekday} {band}
  GROUP BY {ROUTE}
),
{name} AS ({_ranked(f"{name}_routes", "frecuencia", ROUTE)})"""


# --- Q2 ---------------------------------------------------------------------


def _q2_parts(at: _dt.datetime = _D(2013, 3, 19, 10), p: str = "q2") -> str:
    t30, t15 = _ts(at - _dt.timedelta(minutes=30)), _ts(at - _dt.timedelta(minutes=15))
    t = _ts(at)
    return f"""
{p}_down AS (
  SELECT * FROM trips WHERE hora_bajada > {t30} AND hora_bajada <= {t}
),
{p}_up AS (
  SELECT * FROM trips WHERE hora_subida > {t30} AND hora_subida <= {t}
),
{p}_last_down AS (
  SELECT medallon, hora_bajada, cuad_latitud_bajada, cuad_longitud_bajada FROM (
    SELECT *, row_number() OVER (PARTITION BY medallon ORDER BY hora_bajada DESC, k DESC, licencia DESC,
                                 cuad_latitud_bajada DESC, cuad_longitud_bajada DESC) AS rn
    FROM {p}_down) WHERE rn = 1
),
{p}_last_up AS (
  SELECT medallon AS taxi, max(hora_subida) AS hora_subida FROM {p}_up GROUP BY medallon
),
{p}_state AS (
  SELECT d.medallon, d.hora_bajada, d.cuad_latitud_bajada, d.cuad_longitud_bajada, u.hora_subida,
         CAST(CASE WHEN u.hora_subida > d.hora_bajada THEN 1 ELSE 0 END AS INTEGER) AS taxi_ocupado,
         CAST(CASE WHEN u.hora_subida < {t} THEN 1 ELSE 0 END AS INTEGER) AS taxi_en_uso
  FROM {p}_last_down d LEFT JOIN {p}_last_up u ON d.medallon = u.taxi
),
{p}_free AS (
  SELECT cuad_latitud_bajada, cuad_longitud_bajada, count(*) AS taxis_libres
  FROM {p}_state WHERE taxi_ocupado = 0 GROUP BY cuad_latitud_bajada, cuad_longitud_bajada
),
{p}_benefit AS (
  SELECT cuad_latitud_subida AS cuad_latitud, cuad_longitud_subida AS cuad_longitud,
    CAST(sum(CAST(tarifa * 100 AS BIGINT)) AS DOUBLE) / count(tarifa)
      + CAST(sum(CAST(propina * 100 AS BIGINT)) AS DOUBLE) / count(propina) AS beneficios
  FROM trips WHERE hora_bajada > {t15} AND hora_bajada <= {t}
  GROUP BY cuad_latitud_subida, cuad_longitud_subida
),
{p}_profit AS (
  SELECT b.cuad_latitud, b.cuad_longitud, b.beneficios,
    CAST(coalesce(f.taxis_libres, 0) AS BIGINT) AS taxis_libres,
    b.beneficios / CAST(CASE WHEN f.taxis_libres > 0 THEN f.taxis_libres + 1 ELSE 1 END AS DOUBLE) AS beneficio
  FROM {p}_benefit b LEFT JOIN {p}_free f
    ON b.cuad_latitud = f.cuad_latitud_bajada AND b.cuad_longitud = f.cuad_longitud_bajada
),
{p} AS ({_ranked(f"{p}_profit", "beneficio", "cuad_latitud, cuad_longitud")})"""


Q2_PARTS = _q2_parts()

# --- Q2S --------------------------------------------------------------------


def _influence(col: str, compat: bool, ref: _dt.datetime) -> str:
    tiers = [(7, "1.0"), (14, "0.75"), (21, "0.5")] + ([] if compat else [(28, "0.25")])
    whens = " ".join(
        f"WHEN {col} > {_ts(ref)} - INTERVAL {d} DAY AND {col} < {_ts(ref)} + INTERVAL {d} DAY "
        f"THEN CAST({w} AS DOUBLE)"
        for d, w in tiers
    )
    other = "CAST(NULL AS DOUBLE)" if compat else "CAST(0.0 AS DOUBLE)"
    return f"CASE {whens} ELSE {other} END"




def _occurrence(col: str, end: _dt.time) -> str:
    return f"CASE WHEN CAST({col} AS TIME) <= {_tm(end)} THEN CAST({col} AS DATE) ELSE CAST({col} AS DATE) + 1 END"


def _q2s(compat: bool, ref: _dt.datetime = _D(2013, 3, 19, 10), weekday: int = 1, p: str | None = None) -> str:
    """Seasonal areas."""
    p = p or ("q2sc" if compat else "q2s")
    end = ref.time()
    lo30 = (ref - _dt.timedelta(minutes=30)).time()
    lo15 = (ref - _dt.timedelta(minutes=15)).time()
    occ_down = "" if compat else f", {_occurrence('hora_bajada', end)} AS occ"
    occ_up = "" if compat else f", {_occurrence('hora_subida', end)} AS occ"
    part = "medallon" if compat else "medallon, occ"
    join_on = "d.medallon = u.taxi" + ("" if compat else " AND d.occ = u.occ")
    up_select = "medallon AS taxi" + ("" if compat else ", occ")
    day_down, day_up = _day("hora_bajada", lo30, end, compat), _day("hora_subida", lo30, end, compat)
    wrap = not compat
    profit = (
        "b.beneficios / NULLIF(w.proporcion_taxis_libres, 0)"
        if compat
        else "b.beneficios / (coalesce(w.proporcion_taxis_libres, 0) + 1)"
    )
    return f"""
{p}_down AS (
  SELECT *{occ_down} FROM trips WHERE {day_down} = {weekday} AND {_band('hora_bajada', lo30, end, wrap)}
),
{p}_up AS (
  SELECT *{occ_up} FROM trips WHERE {day_up} = {weekday} AND {_band('hora_subida', lo30, end, wrap)}
),
{p}_last_down AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY hora_bajada DESC, k DESC, licencia DESC,
                                 cuad_latitud_bajada DESC, cuad_longitud_bajada DESC) AS rn
    FROM {p}_down) WHERE rn = 1
),
{p}_last_up AS (
  SELECT {up_select}, max(hora_subida) AS hora_subida FROM {p}_up GROUP BY {part}
),
{p}_free AS (
  SELECT d.cuad_latitud_bajada, d.cuad_longitud_bajada, {_influence('d.hora_bajada', compat, ref)} AS influencia
  FROM {p}_last_down d LEFT JOIN {p}_last_up u ON {join_on}
  WHERE NOT coalesce(u.hora_subida > d.hora_bajada, false)
),
{p}_weighted AS (
  SELECT cuad_latitud_bajada, cuad_longitud_bajada, count(*) AS taxis_libres, avg(influencia) AS influencia,
         round(count(*) * avg(influencia)) AS proporcion_taxis_libres
  FROM {p}_free GROUP BY cuad_latitud_bajada, cuad_longitud_bajada
),
{p}_benefit AS (
  SELECT cuad_latitud_subida AS cuad_latitud, cuad_longitud_subida AS cuad_longitud,
    (CAST(sum(CAST(tarifa * 100 AS BIGINT)) AS DOUBLE) / count(tarifa)
      + CAST(sum(CAST(propina * 100 AS BIGINT)) AS DOUBLE) / count(propina))
      * avg({_influence('hora_bajada', compat, ref)}) AS beneficios
  FROM trips WHERE {day_down} = {weekday} AND {_band('hora_bajada', lo15, end, wrap)}
  GROUP BY cuad_latitud_subida, cuad_longitud_subida
),
{p}_benefit_split AS (
  SELECT cuad_latitud_subida AS cuad_latitud, cuad_longitud_subida AS cuad_longitud,
    CAST(sum(CAST(tarifa * 100 AS BIGINT)) AS DOUBLE) / count(tarifa)
      + CAST(sum(CAST(propina * 100 AS BIGINT)) AS DOUBLE) / count(propina) AS beneficios,
    avg({_influence('hora_bajada', compat, ref)}) AS influencia
  FROM trips WHERE {day_down} = {weekday} AND {_band('hora_bajada', lo15, end, wrap)}
  GROUP BY cuad_latitud_subida, cuad_longitud_subida
),
{p}_profit AS (
  SELECT b.cuad_latitud, b.cuad_longitud, b.beneficios, w.proporcion_taxis_libres,
         {profit} AS beneficio
  FROM {p}_benefit b LEFT JOIN {p}_weighted w
    ON b.cuad_latitud = w.cuad_latitud_bajada AND b.cuad_longitud = w.cuad_longitud_bajada
),
{p} AS ({_ranked(f"{p}_profit", "beneficio", "cuad_latitud, cuad_longitud")})"""


# --- result lines -------------------------------------------------------------


def _route_line(name: str, source: str, start: str, end: str) -> str:
    return (
        f"SELECT '{name}' AS consulta, '{start}, {end}, ' || coalesce(string_agg("
        f"format('{{}}: ({{}}, {{}}) ({{}}, {{}}), ', rank, cuad_longitud_subida, cuad_latitud_subida, "
        f"cuad_longitud_bajada, cuad_latitud_bajada), '' ORDER BY rank), '') AS linea FROM {source}"
    )


def _area_line(name: str, source: str, start: str, end: str) -> str:
    return (
        f"SELECT '{name}' AS consulta, '{start}, {end}, ' || coalesce(string_agg("
        f"format('{{}}: ({{}}, {{}}) ', rank, cuad_latitud, cuad_longitud), '' ORDER BY rank), '') AS linea "
        f"FROM {source}"
    )


def oracle_sql() -> dict[str, str]:
    q = {}
    q["raw_trips_profile"] = _with() + """
SELECT count(*) AS n_raw,
  count(*) FILTER (WHERE medallon = '') AS n_sin_medallon,
  count(*) FILTER (WHERE tipo_pago = 'CSH') AS n_csh,
  count(*) FILTER (WHERE tipo_pago = 'CRD') AS n_crd,
  count(*) FILTER (WHERE tipo_pago = 'UNK') AS n_unk,
  CAST(sum(duracion_viaje_seg) AS BIGINT) AS sum_duracion,
  CAST(sum(CAST(tarifa * 100 AS BIGINT)) AS BIGINT) AS sum_tarifa_c,
  CAST(sum(CAST(propina * 100 AS BIGINT)) AS BIGINT) AS sum_propina_c,
  CAST(sum(k) AS BIGINT) AS sum_k,
  min(hora_subida) AS min_subida,
  max(hora_bajada) AS max_bajada
FROM raw"""
    q["clean_trips"] = _with() + """
SELECT k, medallon, licencia, hora_subida, hora_bajada, duracion_viaje_seg,
  CAST(longitud_subida * 100000000000000 AS BIGINT) AS lon_subida_e14,
  CAST(latitud_subida * 100000000000000 AS BIGINT) AS lat_subida_e14,
  CAST(longitud_bajada * 100000000000000 AS BIGINT) AS lon_bajada_e14,
  CAST(latitud_bajada * 100000000000000 AS BIGINT) AS lat_bajada_e14,
  tipo_pago,
  CAST(tarifa * 100 AS BIGINT) AS tarifa_c,
  CAST(propina * 100 AS BIGINT) AS propina_c,
  CAST(cantidad_total * 100 AS BIGINT) AS total_c
FROM trips"""
    q["clean_report"] = _with() + """
SELECT count(*) AS n_raw,
  count(*) FILTER (WHERE NOT ok_ids) AS fail_ids,
  count(*) FILTER (WHERE NOT ok_times) AS fail_times,
  count(*) FILTER (WHERE NOT ok_positive) AS fail_positive,
  count(*) FILTER (WHERE NOT ok_moved) AS fail_moved,
  count(*) FILTER (WHERE NOT ok_payment) AS fail_payment,
  count(*) FILTER (WHERE NOT ok_box) AS fail_box,
  count(*) FILTER (WHERE NOT ok_grid) AS fail_grid,
  count(*) FILTER (WHERE ok_ids AND ok_times AND ok_positive AND ok_moved AND ok_payment AND ok_box AND ok_grid) AS n_clean
FROM checks"""
    q["clean_report_compat"] = q["clean_report"].replace(" AND ok_grid) AS n_clean", ") AS n_clean")
    q["clean_report_any_differs"] = _with() + """
, loose AS (
  SELECT *, coalesce(longitud_subida <> longitud_bajada OR latitud_subida <> latitud_bajada, false) AS ok_moved_any
  FROM checks
)
SELECT count(*) AS n_raw,
  count(*) FILTER (WHERE NOT ok_ids) AS fail_ids,
  count(*) FILTER (WHERE NOT ok_times) AS fail_times,
  count(*) FILTER (WHERE NOT ok_positive) AS fail_positive,
  count(*) FILTER (WHERE NOT ok_moved_any) AS fail_moved,
  count(*) FILTER (WHERE NOT ok_payment) AS fail_payment,
  count(*) FILTER (WHERE NOT ok_box) AS fail_box,
  count(*) FILTER (WHERE NOT ok_grid) AS fail_grid,
  count(*) FILTER (WHERE ok_ids AND ok_times AND ok_positive AND ok_moved_any AND ok_payment AND ok_box AND ok_grid)
    AS n_clean
FROM loose"""
    q["trip_cells"] = _with() + """
SELECT k, cuad_latitud_subida, cuad_longitud_subida, cuad_latitud_bajada, cuad_longitud_bajada, dia_semana
FROM trips"""
    q["grid_cells"] = _with() + """
SELECT X, Y,
  CAST(41.477182778 AS DOUBLE) - CAST(Y - 1 AS DOUBLE) * CAST(0.004491556 AS DOUBLE) AS LATITUD,
  CAST(-74.916578 AS DOUBLE) + CAST(X - 1 AS DOUBLE) * CAST(0.005986 AS DOUBLE) AS LONGITUD,
  (SELECT count(*) FROM trips WHERE cuad_longitud_subida = X AND cuad_latitud_subida = Y) AS viajes
FROM range(1, 301) AS a(X), range(1, 301) AS b(Y)"""
    q["process_csv"] = _with() + """
SELECT medallon, licencia, hora_subida, hora_bajada, duracion_viaje_seg,
  CAST(longitud_subida * 100000000000000 AS BIGINT) AS lon_subida_e14,
  CAST(latitud_bajada * 100000000000000 AS BIGINT) AS lat_bajada_e14, tipo_pago,
  CAST(tarifa * 100 AS BIGINT) AS tarifa_c, CAST(propina * 100 AS BIGINT) AS propina_c,
  CAST(cantidad_total * 100 AS BIGINT) AS total_c,
  cuad_latitud_subida, cuad_longitud_subida, cuad_latitud_bajada, cuad_longitud_bajada, dia_semana
FROM trips"""
    q["scan_benchmark"] = _with() + """
SELECT formato, (SELECT count(*) FROM raw) AS filas FROM (VALUES ('csv'), ('parquet')) AS f(formato)"""
    q["prefix_sample_large"] = _with() + """
SELECT k, medallon, hora_subida FROM raw
ORDER BY hora_subida, k, medallon, licencia LIMIT (SELECT count(*) * 9 // 10 FROM raw)"""
    q["prefix_sample"] = _with() + """
SELECT k, medallon, hora_subida, hora_bajada, tipo_pago FROM raw
ORDER BY hora_subida, k, medallon, licencia LIMIT 5000"""
    q["size_ladder"] = _with() + """
, ranked AS (
  SELECT hora_subida, row_number() OVER (ORDER BY hora_subida, k, medallon, licencia) - 1 AS pos FROM raw
),
sizes AS (
  SELECT CAST((SELECT count(*) FROM raw) * num // den AS BIGINT) AS tamano
  FROM (VALUES (1, 1000), (1, 500), (1, 50), (1, 10), (2, 10), (3, 10), (4, 10), (5, 10),
               (6, 10), (7, 10), (8, 10), (9, 10), (1, 1)) AS f(num, den)
)
SELECT s.tamano, count(r.pos) AS filas, max(r.hora_subida) AS max_subida
FROM sizes s LEFT JOIN ranked r ON r.pos < s.tamano
GROUP BY s.tamano"""
    q["frequent_routes"] = _with(Q1_ROUTES) + "\nSELECT * FROM q1"
    q["route_counts"] = _with() + f"\nSELECT {ROUTE}, count(*) AS viajes FROM trips GROUP BY {ROUTE}"
    q["frequent_routes_seasonal"] = _with(_q1s(False)) + "\nSELECT * FROM q1s"
    q["frequent_routes_seasonal_compat"] = _with(_q1s(True)) + "\nSELECT * FROM q1s_compat"
    q["time_of_day_wrap"] = _with() + """
SELECT dia_semana,
  count(*) FILTER (WHERE CAST(hora_subida AS TIME) BETWEEN TIME '09:40:00' AND TIME '09:50:00') AS n_banda,
  count(*) FILTER (WHERE CAST(hora_subida AS TIME) >= TIME '09:50:00'
                      OR CAST(hora_subida AS TIME) <= TIME '09:40:00') AS n_banda_envuelta,
  CAST(0 AS BIGINT) AS n_banda_sin_envolver,
  count(*) AS n
FROM trips GROUP BY dia_semana"""
    q["frequent_routes_by_instant"] = _with() + f"""
, grid AS (
  SELECT unnest(generate_series(
    time_bucket(INTERVAL 5 MINUTE, (SELECT min(least(hora_subida, hora_bajada)) FROM trips)),
    (SELECT max(greatest(hora_subida, hora_bajada)) FROM trips) + INTERVAL 30 MINUTE,
    INTERVAL 5 MINUTE)) AS instante
),
counted AS (
  SELECT g.instante, {ROUTE}, count(*) AS viajes
  FROM grid g JOIN trips t
    ON t.hora_subida BETWEEN g.instante - INTERVAL 30 MINUTE AND g.instante
   AND t.hora_bajada BETWEEN g.instante - INTERVAL 30 MINUTE AND g.instante
  GROUP BY g.instante, {ROUTE}
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY instante ORDER BY viajes DESC, {ROUTE}) - 1 AS INTEGER) AS rank
  FROM counted
)
SELECT instante, rank, {ROUTE}, viajes FROM ranked WHERE rank < 10"""
    q["last_dropoff_per_taxi"] = _with() + """
SELECT medallon, hora_bajada, k, licencia, cuad_latitud_bajada, cuad_longitud_bajada FROM (
  SELECT *, row_number() OVER (PARTITION BY medallon ORDER BY hora_bajada DESC, k DESC, licencia DESC,
                               cuad_latitud_bajada DESC, cuad_longitud_bajada DESC) AS rn
  FROM trips) WHERE rn = 1"""
    q["taxi_state"] = _with(Q2_PARTS) + "\nSELECT * FROM q2_state"
    q["free_taxis_per_cell"] = _with(Q2_PARTS) + "\nSELECT * FROM q2_free"
    q["area_benefit"] = _with(Q2_PARTS) + "\nSELECT * FROM q2_benefit"
    q["profitable_areas"] = _with(Q2_PARTS) + "\nSELECT * FROM q2"
    q["weighted_free_taxis"] = _with(_q2s(False)) + "\nSELECT * FROM q2s_weighted"
    q["seasonal_area_benefit"] = _with(_q2s(False)) + "\nSELECT * FROM q2s_benefit"
    q["seasonal_area_benefit_split"] = _with(_q2s(False)) + "\nSELECT * FROM q2s_benefit_split"
    q["profitable_areas_seasonal"] = _with(_q2s(False)) + "\nSELECT * FROM q2s"
    q["profitable_areas_seasonal_compat"] = _with(_q2s(True)) + "\nSELECT * FROM q2sc"
    # Second parameter set (see catalog.AT_B, SEASON_B, AT_AREA_B, AREA_B).
    q["frequent_routes_b"] = _with(_q1(_D(2013, 2, 5, 9, 45), "q1b")) + "\nSELECT * FROM q1b"
    q["frequent_routes_seasonal_b"] = _with(_q1s(False, _D(2013, 3, 1, 9, 50), 4, "q1sb")) + "\nSELECT * FROM q1sb"
    q["profitable_areas_b"] = _with(_q2_parts(_D(2013, 1, 22, 9, 50), "q2b")) + "\nSELECT * FROM q2b"
    q["profitable_areas_seasonal_b"] = _with(_q2s(False, _D(2013, 2, 15, 9, 55), 4, "q2sb")) + "\nSELECT * FROM q2sb"
    q["profitable_areas_seasonal_b_compat"] = (
        _with(_q2s(True, _D(2013, 2, 15, 9, 55), 4, "q2scb")) + "\nSELECT * FROM q2scb"
    )
    midnight = _D(2013, 3, 1, 0, 15), 1
    q["frequent_routes_seasonal_midnight"] = _with(_q1s(False, *midnight, "m")) + "\nSELECT * FROM m"
    q["frequent_routes_seasonal_midnight_compat"] = _with(_q1s(True, *midnight, "m")) + "\nSELECT * FROM m"
    q["profitable_areas_seasonal_midnight"] = _with(_q2s(False, *midnight, "m")) + "\nSELECT * FROM m"
    q["profitable_areas_seasonal_midnight_compat"] = _with(_q2s(True, *midnight, "m")) + "\nSELECT * FROM m"
    for name in (
        "frequent_routes",
        "frequent_routes_seasonal",
        "profitable_areas",
        "profitable_areas_seasonal",
        "frequent_routes_seasonal_midnight",
        "profitable_areas_seasonal_midnight",
    ):
        q[f"stored_{name}"] = q[name]
    q["result_line"] = _with(Q1_ROUTES, _q1s(False), Q2_PARTS, _q2s(False)) + "\n" + "\nUNION ALL\n".join(
        [
            _route_line("frequent_routes", "q1", "2013-03-19 09:30:00", "2013-03-19 10:00:00"),
            _route_line("frequent_routes_seasonal", "q1s", "09:30:00", "10:00:00"),
            _area_line("profitable_areas", "q2", "2013-03-19 09:30:00", "2013-03-19 10:00:00"),
            _area_line("profitable_areas_seasonal", "q2s", "2013-03-19 09:30:00", "2013-03-19 10:00:00"),
        ]
    )
    summary = """
SELECT count(*) AS n, CAST(sum(k) AS BIGINT) AS sum_k,
  CAST(sum(CAST(tarifa * 100 AS BIGINT)) AS BIGINT) AS sum_tarifa_c,
  CAST(sum(cuad_latitud_subida) AS BIGINT) AS sum_cuad_latitud_subida,
  CAST(sum(cuad_longitud_bajada) AS BIGINT) AS sum_cuad_longitud_bajada,
  CAST(sum(dia_semana) AS BIGINT) AS sum_dia_semana,
  max(hora_bajada) AS max_bajada
FROM trips"""
    q["roundtrip_parquet"] = _with() + summary
    q["roundtrip_csv"] = _with() + summary
    q["compacted_trips"] = _with() + summary
    q["file_index"] = _with() + """
SELECT CAST(hora_subida AS DATE) AS fecha_subida, count(*) AS viajes, min(hora_subida) AS primera, max(hora_bajada) AS ultima
FROM trips GROUP BY CAST(hora_subida AS DATE)"""
    # Without tie-break columns the last drop-off's ties go to the greatest cell.
    for name, source in (
        ("profitable_areas_packed", "profitable_areas"),
        ("profitable_areas_seasonal_packed", "profitable_areas_seasonal"),
        ("stored_profitable_areas_seasonal_midnight_packed", "profitable_areas_seasonal_midnight"),
    ):
        q[name] = q[source].replace("hora_bajada DESC, k DESC, licencia DESC,", "hora_bajada DESC,")
    q["route_rollup"] = _with() + f"""
SELECT CAST(hora_subida AS DATE) AS fecha,
  CAST((hour(hora_subida) * 3600 + minute(hora_subida) * 60 + second(hora_subida)) // 900 AS INTEGER) AS franja_subida,
  CAST((hour(hora_bajada) * 3600 + minute(hora_bajada) * 60 + second(hora_bajada)) // 900 AS INTEGER) AS franja_bajada,
  {ROUTE}, count(*) AS viajes, CAST(isodow(hora_subida) - 1 AS INTEGER) AS dia_semana
FROM trips GROUP BY ALL"""
    q["rollup_frequent_routes_seasonal"] = q["frequent_routes_seasonal"]
    q["rollup_frequent_routes_seasonal_b"] = q["frequent_routes_seasonal_b"]
    q["rollup_frequent_routes_seasonal_midnight"] = q["frequent_routes_seasonal_midnight"]
    # Records with a field that cannot be read, or with too few or too many fields.
    broken = "(k % 211 = 0 OR k % 223 = 0 OR k % 233 = 0 OR k % 227 = 0 OR k % 229 = 0)"
    good = "ok_ids AND ok_times AND ok_positive AND ok_moved AND ok_payment AND ok_box AND ok_grid"
    fails = ",\n  ".join(
        f"count(*) FILTER (WHERE NOT {broken} AND NOT ok_{rule}) AS fail_{rule}"
        for rule in ("ids", "times", "positive", "moved", "payment", "box", "grid")
    )
    q["quarantine_report"] = _with() + f"""
SELECT count(*) AS n_raw,
  count(*) FILTER (WHERE {broken}) AS n_malformed,
  count(*) FILTER (WHERE NOT {broken} AND NOT ({good})) AS n_rejected,
  {fails},
  count(*) FILTER (WHERE NOT {broken} AND {good}) AS n_clean
FROM checks"""
    q["quarantine_fields"] = _with() + """
SELECT campo, count(*) AS registros FROM (
  SELECT 'duracion_viaje_seg' AS campo FROM raw WHERE k % 211 = 0
  UNION ALL SELECT 'hora_bajada' FROM raw WHERE k % 223 = 0
  UNION ALL SELECT 'tarifa' FROM raw WHERE k % 233 = 0
  UNION ALL SELECT 'numero_de_campos' FROM raw WHERE k % 227 = 0 OR k % 229 = 0
  UNION ALL SELECT 'cantidad_total' FROM raw WHERE k % 227 = 0 AND k % 229 = 0
) GROUP BY campo"""
    q["quarantine_process"] = _with() + f"""
SELECT medallon, licencia, hora_subida, hora_bajada, duracion_viaje_seg, tipo_pago,
  cuad_latitud_subida, cuad_longitud_subida, cuad_latitud_bajada, cuad_longitud_bajada, dia_semana,
  CAST(tarifa * 100 AS BIGINT) AS tarifa_c
FROM trips WHERE NOT {broken}"""
    q["prefix_null_tail"] = _with() + """
, holed AS (SELECT k, medallon, licencia, CASE WHEN k % 5 > 1 THEN hora_subida END AS hora_subida FROM raw)
SELECT k, medallon, hora_subida FROM holed
ORDER BY hora_subida, k, medallon, licencia LIMIT (SELECT count(*) * 9 // 10 FROM raw)"""
    q["prefix_hot_second"] = _with() + """
, hot AS (
  SELECT k, medallon, licencia, tipo_pago,
    CASE WHEN k % 3 = 0 THEN TIMESTAMP '2013-01-05 08:00:00' ELSE hora_subida END AS hora_subida FROM raw)
SELECT k, medallon, hora_subida FROM hot
ORDER BY hora_subida, tipo_pago, licencia, k, medallon LIMIT (SELECT count(*) // 4 FROM raw)"""
    return q
