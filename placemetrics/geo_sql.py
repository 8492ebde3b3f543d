"""DuckDB SQL of the polygon queries: edges of the test world, covering cells, containment, written apart from the Spark code."""

from __future__ import annotations

import math

from placemetrics.operators import cells
from placemetrics.plans.world import HIGH, ROUND, SOUTH, WEST, WIDE

_R, _C, _ROOT = cells.RADIUS, cells._COS, 3.0**0.5


def _d(x: float) -> str:
    return f"{x!r}::DOUBLE"


def _ring(*points: tuple[str, str]) -> str:
    return "[" + ", ".join(f"({v})::DOUBLE" for p in points for v in p) + "]"


def _box(x0: str, y0: str, x1: str, y1: str) -> str:
    return _ring((x0, y0), (x1, y0), (x1, y1), (x0, y1))


def _plus(x: str, by: float) -> str:
    return f"{x} + {_d(by)}"


_T = f"""tt AS (SELECT n_nationkey AS n, {_d(WEST)} + (n_nationkey % 5) * {_d(WIDE)} AS x0, {_d(SOUTH)} + (n_nationkey // 5) * {_d(HIGH)} AS y0,
  {_d(WEST)} + (n_nationkey % 5 + 1) * {_d(WIDE)} AS x1, {_d(SOUTH)} + (n_nationkey // 5 + 1) * {_d(HIGH)} AS y1 FROM nation)"""
_WORLD = f"""SELECT 'nation' AS boundary_set, n::VARCHAR AS boundary_id, 0 AS poly, 0 AS ring, {_box("x0", "y0", "x1", "y1")} AS v FROM tt WHERE n NOT IN (0, 24)
  UNION ALL SELECT 'nation', n::VARCHAR, 0, 0, {_box("x0", "y0", _plus("x0", 0.06), "y1")} FROM tt WHERE n = 0
  UNION ALL SELECT 'nation', n::VARCHAR, 1, 0, {_box(_plus("x0", 0.12), "y0", "x1", "y1")} FROM tt WHERE n = 0
  UNION ALL SELECT 'nation', n::VARCHAR, 0, 1, {_box(_plus("x0", 0.05), _plus("y0", 0.02), _plus("x0", 0.1), _plus("y0", 0.04))} FROM tt WHERE n = 12
  UNION ALL SELECT 'nation', n::VARCHAR, 0, 0, {_ring(("x0", "y0"), ("x1", "y0"), ("x1", _plus("y0", 0.03)), (_plus("x0", 0.09), _plus("y0", 0.03)), (_plus("x0", 0.09), "y1"), ("x0", "y1"))} FROM tt WHERE n = 24
  UNION ALL SELECT 'region', r_regionkey::VARCHAR, 0, 0, {_box(_d(WEST), f"{_d(SOUTH)} + r_regionkey * {_d(HIGH)}", f"{_d(WEST)} + 5 * {_d(WIDE)}", f"{_d(SOUTH)} + (r_regionkey + 1) * {_d(HIGH)}")} FROM region"""


def _edges(rings: str) -> str:
    after = "((nth + 1) % (len(v) // 2))"
    return f"""SELECT boundary_set, boundary_id, poly, ring, nth, v[2 * nth + 1] AS x1, v[2 * nth + 2] AS y1, v[2 * {after} + 1] AS x2, v[2 * {after} + 2] AS y2
  FROM (SELECT *, unnest(range(len(v) // 2)) AS nth FROM ({rings}))"""


#: Nations and regions; suppliers' rings. Both as CTE e.
EDGES = f"{_T}, e AS ({_edges(_WORLD)})"
_AT = f"""SELECT s_suppkey AS k, {_d(WEST + 0.02)} + (s_suppkey % 40) * {_d(0.022)} AS x, {_d(SOUTH + 0.01)} + (s_suppkey // 40 % 25) * {_d(0.0128)} AS y,
  CASE WHEN s_suppkey % 10 = 0 THEN {_d(0.0002)} ELSE {_d(0.006)} END AS size FROM supplier"""


def _round_ring(part: float) -> str:
    return "[" + ", ".join(f"round(x + size * {_d(part)} * {_d(a)}, 6), round(y + size * {_d(part)} * {_d(b)}, 6)" for a, b in ROUND) + "]"


_RINGS = f"""SELECT 'ring' || (k // 1000) AS boundary_set, k::VARCHAR AS boundary_id, 0 AS poly, 0 AS ring, {_round_ring(1.0)} AS v FROM ({_AT})
  UNION ALL SELECT 'ring' || (k // 1000), k::VARCHAR, 0, 1, {_round_ring(0.5)} FROM ({_AT}) WHERE k % 7 = 0"""
RING_EDGES = f"e AS ({_edges(_RINGS)})"

#: Areas of nations and regions as CTE areas; it brings its own edges.
AREAS = f"""{_T}, ae AS ({_edges(_WORLD)}), areas AS (SELECT boundary_set, boundary_id, sum(CASE ring WHEN 0 THEN a ELSE -a END) AS area_sq_km FROM (
  SELECT boundary_set, boundary_id, poly, ring, abs(sum(radians(x2 - x1) * (sin(radians(y1)) + sin(radians(y2))))) * {_d(_R**2 / 2.0)} AS a FROM ae GROUP BY 1, 2, 3, 4) GROUP BY 1, 2)"""


def center_lon(q: str, r: str, res: int) -> str:
    return f"degrees(({q} + {r} / 2.0::DOUBLE) * {_d(_ROOT * cells.side(res))} / {_d(_R * _C)})"


def center_lat(r: str, res: int) -> str:
    return f"degrees(asin({r} * {_d(1.5 * cells.side(res))} * {_d(_C / _R)}))"


def packed(q: str, r: str, res: int) -> str:
    return f"({res}::BIGINT * {1 << 58}::BIGINT + ({q}::BIGINT + {1 << 27}) * {1 << 29}::BIGINT + ({r}::BIGINT + {1 << 27}))::BIGINT"


def cell_of(rows: str, lon: str, lat: str, res: int, name: str) -> str:
    """CTE of the rows' columns with q and r of the cell that holds (lon, lat)."""
    s = cells.side(res)
    return f"""{name} AS (SELECT * EXCLUDE (fx, fy, fq, fr, gq, gr, gt, dq, dr, dt), (CASE WHEN dq > dr AND dq > dt THEN -gr - gt ELSE gq END)::BIGINT AS q, (CASE WHEN NOT (dq > dr AND dq > dt) AND dr > dt THEN -gq - gt ELSE gr END)::BIGINT AS r
  FROM (SELECT *, abs(gq - fq) AS dq, abs(gr - fr) AS dr, abs(gt + fq + fr) AS dt FROM (SELECT *, floor(fq + 0.5) AS gq, floor(fr + 0.5) AS gr, floor(-fq - fr + 0.5) AS gt
  FROM (SELECT *, ({_d(_ROOT / 3.0)} * fx - fy / 3.0::DOUBLE) / {_d(s)} AS fq, ({_d(2.0 / 3.0)} * fy) / {_d(s)} AS fr FROM (SELECT *, {_d(_R * _C)} * radians({lon}) AS fx, {_d(_R / _C)} * sin(radians({lat})) AS fy FROM {rows} any_))))) """


def inside(rows: str, edges: str, point: list[str], lon: str, lat: str, on: str = "true", where: str = "true") -> str:
    """Query of (point, boundary_set, boundary_id) for the rows' points that lie inside, by counting crossings."""
    of = ", ".join(f"p.{c}" for c in point)
    names = ", ".join(point)
    return f"""SELECT DISTINCT {names}, boundary_set, boundary_id FROM (SELECT {names}, boundary_set, boundary_id, poly FROM (
    SELECT {of}, g.boundary_set, g.boundary_id, g.poly, g.ring, count(*) % 2 AS odd FROM (SELECT * FROM {rows} WHERE {where}) p JOIN {edges} g ON {on} AND (g.y1 > p.{lat}) <> (g.y2 > p.{lat})
      AND p.{lon} < g.x1 + (p.{lat} - g.y1) * (g.x2 - g.x1) / nullif(g.y2 - g.y1, 0) GROUP BY ALL)
    GROUP BY ALL HAVING max(odd) FILTER (ring = 0) = 1 AND coalesce(max(odd) FILTER (ring > 0), 0) = 0)"""


_SAME = "g.boundary_set = p.boundary_set AND g.boundary_id = p.boundary_id"


def _grid(rows: str, res: int) -> str:
    """Rows with lon0, lat0, lon1, lat1 by the cells around their boxes."""
    s = cells.side(res)
    x, y = lambda c: f"{_d(_R * _C)} * radians({c})", lambda c: f"{_d(_R / _C)} * sin(radians({c}))"
    return f"""SELECT *, unnest(range(floor({x("lon0")} / {_d(_ROOT * s)} - r / 2.0::DOUBLE)::BIGINT - 1, ceil({x("lon1")} / {_d(_ROOT * s)} - r / 2.0::DOUBLE)::BIGINT + 2)) AS q
  FROM (SELECT *, unnest(range(floor({y("lat0")} / {_d(1.5 * s)})::BIGINT - 1, ceil({y("lat1")} / {_d(1.5 * s)})::BIGINT + 2)) AS r FROM ({rows}))"""


def _cover(edges: str, res: int) -> str:
    s, n = cells.side(res), f"_{res}"
    at = [(1.001 * s * math.cos(math.radians(30 + 60 * k)), 1.001 * s * math.sin(math.radians(30 + 60 * k))) for k in range(6)]
    sides = ", ".join(f"({_d(a)}, {_d(b)}, {_d(c)}, {_d(d)})" for (a, b), (c, d) in zip(at, [*at[1:], at[0]], strict=True))
    x, y = f"(q + r / 2.0::DOUBLE) * {_d(_ROOT * s)}", f"r * {_d(1.5 * s)}"
    lon, lat = lambda v: f"degrees(({v}) / {_d(_R * _C)})", lambda v: f"degrees(asin(({v}) * {_d(_C / _R)}))"
    box = f"SELECT boundary_set, boundary_id, min(least(x1, x2)) AS lon0, min(least(y1, y2)) AS lat0, max(greatest(x1, x2)) AS lon1, max(greatest(y1, y2)) AS lat1 FROM {edges} GROUP BY 1, 2"
    own = f"SELECT *, least(x1, x2) AS lon0, least(y1, y2) AS lat0, greatest(x1, x2) AS lon1, greatest(y1, y2) AS lat1 FROM {edges} WHERE x1 <> x2 OR y1 <> y2"
    return f"""mid{n} AS (SELECT boundary_set, boundary_id, q, r, {center_lon("q", "r", res)} AS lon, {center_lat("r", res)} AS lat FROM ({_grid(box, res)})),
ctr{n} AS (SELECT q, r, boundary_set, boundary_id FROM ({inside(f"mid{n}", edges, ["q", "r"], "lon", "lat", _SAME)})),
tch{n} AS (SELECT DISTINCT boundary_set, boundary_id, q, r FROM (
  SELECT boundary_set, boundary_id, poly, ring, nth, q, r, max(CASE WHEN den > 0 THEN -num / den WHEN den = 0 AND num < 0 THEN 2 END) AS low, min(CASE WHEN den < 0 THEN -num / den END) AS high FROM (
    SELECT *, (bx - ax) * (y1 - ay) - (by_ - ay) * (x1 - ax) AS num, (bx - ax) * (y2 - y1) - (by_ - ay) * (x2 - x1) AS den FROM (
      SELECT c.*, {lon(x + " + s.px")} AS ax, {lat(y + " + s.py")} AS ay, {lon(x + " + s.qx")} AS bx, {lat(y + " + s.qy")} AS by_ FROM ({_grid(own, res)}) c, (VALUES {sides}) s(px, py, qx, qy)))
  GROUP BY ALL) WHERE coalesce(greatest(0, low), 0) <= coalesce(least(1, high), 1)),
cov{n} AS (SELECT boundary_set, boundary_id, q, r, c.hit IS NOT NULL AS is_center, t.hit IS NOT NULL AS is_touched
  FROM (SELECT *, 1 AS hit FROM ctr{n}) c FULL JOIN (SELECT *, 1 AS hit FROM tch{n}) t USING (boundary_set, boundary_id, q, r))"""


def representative(edges: str) -> str:
    """CTE rep: a point inside each boundary of the edges."""
    return f"""shells AS (SELECT boundary_set, boundary_id, poly, abs(sum(x1 * y2 - x2 * y1)) AS size, avg(x1) AS mx, avg(y1) AS my, min(x1) AS sx0, max(x1) AS sx1, min(y1) AS sy0, max(y1) AS sy1 FROM {edges} WHERE ring = 0 GROUP BY 1, 2, 3),
shell AS (SELECT * FROM shells QUALIFY row_number() OVER (PARTITION BY boundary_set, boundary_id ORDER BY size DESC, poly) = 1),
tries AS (SELECT boundary_set, boundary_id, k, CASE k WHEN 0 THEN mx ELSE sx0 + ((k - 1) % 15 + 0.5::DOUBLE) * (sx1 - sx0) / 15 END AS longitude, CASE k WHEN 0 THEN my ELSE sy0 + ((k - 1) // 15 + 0.5::DOUBLE) * (sy1 - sy0) / 15 END AS latitude
  FROM (SELECT *, unnest(range(226)) AS k FROM shell)),
rep AS (SELECT boundary_set, boundary_id, arg_min(longitude, k) AS longitude, arg_min(latitude, k) AS latitude FROM ({inside("tries", edges, ["k", "longitude", "latitude"], "longitude", "latitude", _SAME)}) GROUP BY 1, 2)"""


def bridge(edges: str, resolutions: tuple[int, ...]) -> str:
    """CTE bridge: covering cells with owners."""
    tiny = [cell_of(f"(SELECT * FROM rep WHERE NOT EXISTS (FROM ctr_{r} c WHERE c.boundary_set = rep.boundary_set AND c.boundary_id = rep.boundary_id))", "longitude", "latitude", r, f"tiny_{r}") for r in resolutions]
    parts = [f"""SELECT boundary_set, boundary_id, {r} AS resolution, {packed("q", "r", r)} AS h3_cell, is_center, is_center AND NOT is_touched AS is_interior FROM cov_{r}
  UNION ALL SELECT boundary_set, boundary_id, {r}, {packed("q", "r", r)}, true, false FROM tiny_{r}""" for r in resolutions]
    return f"""{", ".join(_cover(edges, r) for r in resolutions)}, {representative(edges)}, {", ".join(tiny)},
united AS (SELECT boundary_set, boundary_id, resolution, h3_cell, max(is_center) AS is_allocation_cell, max(is_interior) AS is_interior FROM ({" UNION ALL ".join(parts)}) GROUP BY 1, 2, 3, 4),
bridge AS (SELECT boundary_set, boundary_id, resolution, h3_cell, is_interior, is_allocation_cell AND boundary_id = min(boundary_id) FILTER (is_allocation_cell) OVER (PARTITION BY boundary_set, resolution, h3_cell) AS is_primary, is_allocation_cell FROM united)"""


def centers_of(_place: str, res: int) -> str:
    """CTE mine: the cells (q, r) whose centres nation n holds, by boxes alone."""
    box = f"SELECT n, x0, y0, x1, y1, x0 AS lon0, y0 AS lat0, x1 AS lon1, y1 AS lat1 FROM (SELECT n_nationkey AS n, {_d(WEST)} + (n_nationkey % 5) * {_d(WIDE)} AS x0, {_d(SOUTH)} + (n_nationkey // 5) * {_d(HIGH)} AS y0, {_d(WEST)} + (n_nationkey % 5 + 1) * {_d(WIDE)} AS x1, {_d(SOUTH)} + (n_nationkey // 5 + 1) * {_d(HIGH)} AS y1 FROM nation)"
    return f"""mine AS (SELECT n, q, r FROM (SELECT *, {center_lon("q", "r", res)} AS lo, {center_lat("r", res)} AS la FROM ({_grid(box, res)}))
  WHERE lo >= x0 AND lo < x1 AND la >= y0 AND la < y1 AND NOT (n = 0 AND lo >= {_plus("x0", 0.06)} AND lo < {_plus("x0", 0.12)}) AND NOT (n = 24 AND lo >= {_plus("x0", 0.09)} AND la >= {_plus("y0", 0.03)})
    AND NOT (n = 12 AND lo >= {_plus("x0", 0.05)} AND lo < {_plus("x0", 0.1)} AND la >= {_plus("y0", 0.02)} AND la < {_plus("y0", 0.04)}))"""
