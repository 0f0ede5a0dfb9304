"""Checked queries for resampling, gradients and the gridded products.

Survey rows J8, J9, W1, W2, W5, A18 and products Q1-Q6.
"""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from .. import functions as tf
from ..operators import columns as C
from ..operators import grid as G
from ..operators import lines as LN
from ..operators import resample as RS
from ..operators import store
from ..operators import temporal as T
from ..operators import terrain as TR
from ..operators.lineage import materialize
from .registry import register, report

BBOX = tf.DEFAULT_BBOX
#: Keys of the stored layers.
CELL, STRIP = ["lat_idx", "lon_idx"], list(LN.KEYS)
H_KM_05 = 0.5 * tf.KM_PER_DEG
H_KM_01 = 0.1 * tf.KM_PER_DEG
H_M_05 = 0.5 * TR.M_PER_DEG
H_M_01 = 0.1 * TR.M_PER_DEG


def grid_sql(name: str, res: float, n: int) -> str:
    return (f"{name} as (select cast(id // {n} as int) as lat_idx, cast(id % {n} as int) as lon_idx, "
            f"25.0 + cast(id // {n} as double) * {res!r} as lat, -130.0 + cast(id % {n} as double) * {res!r} as lon "
            f"from range(0, {n} * {n}) t(id))")


def linear_map_sql(prefix: str, src: str, coord: str, grid: str, idx: str) -> str:
    """Axis map CTEs ``{prefix}m(idx, s, w)`` for linear interpolation."""
    return (
        f"{prefix}s as (select s, lead(s) over (order by s) as s_next, row_number() over (order by s) as k "
        f"from (select distinct {coord} as s from {src}) q), "
        f"{prefix}t as (select distinct {idx} as idx, {coord} as t from {grid}), "
        f"{prefix}b as (select t.idx, t.t, b.s as lo, b.s_next as hi from {prefix}t t join {prefix}s b on "
        f"b.s_next is not null and ((t.t > b.s and t.t <= b.s_next) or (b.k = 1 and t.t = b.s))), "
        f"{prefix}m as (select idx, lo as s, 1.0 - (t - lo) / (hi - lo) as w from {prefix}b union all "
        f"select idx, hi as s, (t - lo) / (hi - lo) as w from {prefix}b)")


def nearest_map_sql(prefix: str, src: str, coord: str, grid: str, idx: str) -> str:
    return (
        f"{prefix}s as (select distinct {coord} as s from {src}), "
        f"{prefix}t as (select distinct {idx} as idx, {coord} as t from {grid}), "
        f"{prefix}m as (select idx, s from (select t.idx, s.s, row_number() over (partition by t.idx "
        f"order by abs(t.t - s.s), s.s) as rn from {prefix}t t, {prefix}s s where t.t >= (select min(s) from {prefix}s) "
        f"and t.t <= (select max(s) from {prefix}s)) q where rn = 1)")


def bilinear_sql(src: str, values, keys=()) -> str:
    """Select of bilinear results from src(lat, lon, values..) via lat_m/lon_m."""
    kk = "".join(f"{k}, " for k in keys)
    parts = []
    for v in values:
        parts.append(f"case when count({v}) = 4 then sum(la.w * lo.w * {v}) end as {v}")
    return (f"select {kk}la.idx as lat_idx, lo.idx as lon_idx, {', '.join(parts)} from {src} "
            f"join lat_m la on {src}.lat = la.s join lon_m lo on {src}.lon = lo.s "
            f"group by {kk}la.idx, lo.idx")


def _surface_grid(spark):
    """The 0.5-degree grid that v_surface lives on (size from the data)."""
    b = spark.table("v_surface").agg(F.max("lat_idx").alias("a"), F.max("lon_idx").alias("o")).first()
    n_lat, n_lon = int(b["a"]) + 1, int(b["o"]) + 1
    bbox = {"min_lon": -130.0, "max_lon": -130.0 + (n_lon - 1) * 0.5,
            "min_lat": 25.0, "max_lat": 25.0 + (n_lat - 1) * 0.5}
    return G.target_grid(spark, bbox, 0.5), n_lat, n_lon


SURFACE_GRID_SQL = (
    "sn as (select max(lat_idx) + 1 as n_lat, max(lon_idx) + 1 as n_lon from v_surface), "
    "sgrid as (select cast(id // n_lon as int) as lat_idx, cast(id % n_lon as int) as lon_idx, n_lat, n_lon "
    "from sn, (select unnest(range(0, (select n_lat * n_lon from sn))) as id) r)")


def _gradient_sql(value_expr: str, h: float, out: str, deg: bool) -> str:
    mag = "sqrt(dx * dx + dy * dy)"
    if deg:
        mag = f"degrees(atan({mag}))"
    return (
        f"with {SURFACE_GRID_SQL}, d as (select g.lat_idx, g.lon_idx, g.n_lat, g.n_lon, {value_expr} as v "
        "from sgrid g left join v_surface s on g.lat_idx = s.lat_idx and g.lon_idx = s.lon_idx), "
        "dd as (select lat_idx, lon_idx, v, "
        f"case when lon_idx = 0 then (lead(v) over wr - v) / {h!r} when lon_idx = n_lon - 1 then "
        f"(v - lag(v) over wr) / {h!r} else (lead(v) over wr - lag(v) over wr) / {2.0 * h!r} end as dx, "
        f"case when lat_idx = 0 then (lead(v) over wc - v) / {h!r} when lat_idx = n_lat - 1 then "
        f"(v - lag(v) over wc) / {h!r} else (lead(v) over wc - lag(v) over wc) / {2.0 * h!r} end as dy "
        "from d window wr as (partition by lat_idx order by lon_idx), wc as (partition by lon_idx order by lat_idx)) "
        f"select lat_idx, lon_idx, round({mag}, 9) + 0.0 as {out} from dd")


@register("gradient_magnitude", ["v_surface"],
          _gradient_sql("s.sst", H_KM_05, "sst_grad", False))
def q_gradient(spark, sf):
    """W1 on the 0.5-degree surface SST (with gaps), densified to the full grid."""
    grid, n_lat, n_lon = _surface_grid(spark)
    dense = TR.densify(spark.table("v_surface").select(F.col("lat_idx").cast("int"),
                                                       F.col("lon_idx").cast("int"), "sst"), grid)
    return report(TR.gradient_magnitude(dense, "sst", 0.5, n_lat, n_lon, out="sst_grad")
                  .select("lat_idx", "lon_idx", "sst_grad"))


@register("slope_degrees", ["v_surface"],
          _gradient_sql("case when s.elevation < 0 then -s.elevation else 0.0 end", H_M_05, "Slope_deg", True))
def q_slope(spark, sf):
    """W2 (with P18) on the 0.5-degree surface: slope of depth, land/missing = 0."""
    grid, n_lat, n_lon = _surface_grid(spark)
    dense = TR.densify(spark.table("v_surface").select(F.col("lat_idx").cast("int"),
                                                       F.col("lon_idx").cast("int"), "elevation"), grid)
    dense = dense.withColumn("depth", tf.elevation_to_depth("elevation"))
    return report(TR.slope_degrees(dense, "depth", 0.5, n_lat, n_lon).select("lat_idx", "lon_idx", "Slope_deg"))


GRID01 = grid_sql("grid", 0.1, 201)
GRID05 = grid_sql("grid", 0.5, 41)


@register("resample_nearest", ["v_surface"],
          f"with {GRID01}, {nearest_map_sql('lat_', 'v_surface', 'lat', 'grid', 'lat_idx')}, "
          f"{nearest_map_sql('lon_', 'v_surface', 'lon', 'grid', 'lon_idx')} "
          "select g.lat_idx, g.lon_idx, round(s.sst, 9) + 0.0 as sst from grid g "
          "left join lat_m la on g.lat_idx = la.idx left join lon_m lo on g.lon_idx = lo.idx "
          "left join v_surface s on s.lat = la.s and s.lon = lo.s")
def q_nearest(spark, sf):
    """Surface SST onto the 0.1-degree grid by nearest source cell."""
    grid = G.target_grid(spark, BBOX, 0.1)
    return report(RS.resample(spark.table("v_surface"), grid, ["sst"], "nearest"))


@register("resample_bilinear", ["v_surface"],
          f"with {GRID01}, {linear_map_sql('lat_', 'v_surface', 'lat', 'grid', 'lat_idx')}, "
          f"{linear_map_sql('lon_', 'v_surface', 'lon', 'grid', 'lon_idx')}, "
          f"r as ({bilinear_sql('v_surface', ['elevation', 'sst'])}) "
          "select g.lat_idx, g.lon_idx, round(r.elevation, 9) + 0.0 as elevation, round(r.sst, 9) + 0.0 as sst "
          "from grid g left join r on g.lat_idx = r.lat_idx and g.lon_idx = r.lon_idx")
def q_bilinear(spark, sf):
    """Surface elevation and SST onto the 0.1-degree grid, separable linear."""
    grid = G.target_grid(spark, BBOX, 0.1)
    return report(RS.resample(spark.table("v_surface"), grid, ["elevation", "sst"], "bilinear"))


@register("product_bathymetry", ["v_surface"],
          f"with {GRID01}, {linear_map_sql('lat_', 'v_surface', 'lat', 'grid', 'lat_idx')}, "
          f"{linear_map_sql('lon_', 'v_surface', 'lon', 'grid', 'lon_idx')}, "
          f"r as ({bilinear_sql('v_surface', ['elevation'])}), "
          "d as (select g.lat_idx, g.lon_idx, case when r.elevation < 0 then -r.elevation else 0.0 end as v "
          "from grid g left join r on g.lat_idx = r.lat_idx and g.lon_idx = r.lon_idx), "
          "dd as (select lat_idx, lon_idx, v, "
          f"case when lon_idx = 0 then (lead(v) over wr - v) / {H_M_01!r} when lon_idx = 200 then "
          f"(v - lag(v) over wr) / {H_M_01!r} else (lead(v) over wr - lag(v) over wr) / {2.0 * H_M_01!r} end as dx, "
          f"case when lat_idx = 0 then (lead(v) over wc - v) / {H_M_01!r} when lat_idx = 200 then "
          f"(v - lag(v) over wc) / {H_M_01!r} else (lead(v) over wc - lag(v) over wc) / {2.0 * H_M_01!r} end as dy "
          "from d window wr as (partition by lat_idx order by lon_idx), wc as (partition by lon_idx order by lat_idx)) "
          "select lat_idx, lon_idx, round(v, 9) + 0.0 as Depth_m, "
          "round(degrees(atan(sqrt(dx * dx + dy * dy))), 9) + 0.0 as Slope_deg from dd")
def q_bathymetry(spark, sf):
    """Q6: J9 elevation -> P18 depth (missing = 0) -> W2 slope, 0.1-degree grid."""
    return report(bathymetry_layer(spark, sf))


def bathymetry_layer(spark, sf):
    def build():
        grid = G.target_grid(spark, BBOX, 0.1)
        elev = RS.resample(spark.table("v_surface"), grid, ["elevation"], "bilinear")
        n_lat, n_lon = G.grid_shape(BBOX, 0.1)
        out = TR.slope_degrees(elev.withColumn("Depth_m", tf.elevation_to_depth("elevation")), "Depth_m", 0.1, n_lat, n_lon)
        return out.select("lat_idx", "lon_idx", "Depth_m", "Slope_deg")

    return store.layer(spark, sf, "bathymetry", CELL, build)


def _cube_weekly_sql(out: str, with_gradient: bool, grid: str = GRID05, h: float = H_KM_05, last: int = 40,
                     src: str = "v_cube", before: str = "", exact: bool = False) -> str:
    rnd = (lambda x: x) if exact else (lambda x: f"round({x}, 9) + 0.0")
    sql = (
        f"with {before}{grid}, {linear_map_sql('lat_', src, 'lat', 'grid', 'lat_idx')}, "
        f"{linear_map_sql('lon_', src, 'lon', 'grid', 'lon_idx')}, "
        f"r as ({bilinear_sql(src, ['value'], ['time'])}), "
        "w as (select cast(date_trunc('week', time) as date) + 6 as week, lat_idx, lon_idx, avg(value) as v "
        "from r group by 1, 2, 3), b as (select min(week) as lo, max(week) as hi from w), "
        "sp as (select g.lat_idx, g.lon_idx, cast(unnest(generate_series(b.lo, b.hi, interval 7 day)) as date) as week "
        "from grid g, b), "
        "d as (select sp.week, sp.lat_idx, sp.lon_idx, w.v from sp left join w on sp.week = w.week "
        "and sp.lat_idx = w.lat_idx and sp.lon_idx = w.lon_idx)")
    if not with_gradient:
        return sql + f" select week, lat_idx, lon_idx, {rnd('v')} as {out} from d"
    return sql + (
        ", dd as (select week, lat_idx, lon_idx, v, "
        f"case when lon_idx = 0 then (lead(v) over wr - v) / {h!r} when lon_idx = {last} then "
        f"(v - lag(v) over wr) / {h!r} else (lead(v) over wr - lag(v) over wr) / {2.0 * h!r} end as dx, "
        f"case when lat_idx = 0 then (lead(v) over wc - v) / {h!r} when lat_idx = {last} then "
        f"(v - lag(v) over wc) / {h!r} else (lead(v) over wc - lag(v) over wc) / {2.0 * h!r} end as dy "
        "from d window wr as (partition by week, lat_idx order by lon_idx), "
        "wc as (partition by week, lon_idx order by lat_idx)) "
        f"select week, lat_idx, lon_idx, {rnd('v')} as {out}, "
        f"{rnd('sqrt(dx * dx + dy * dy)')} as SST_grad_C_km from dd")


def _sunday(t):
    """Sunday label of the Monday-based week holding ``t`` (a driver scalar)."""
    if t is None:
        return None
    d = t.date() if hasattr(t, "date") else t
    return d + datetime.timedelta(days=6 - d.weekday())


def cube_product(spark, out: str, with_gradient: bool, res: float = tf.DEFAULT_RESOLUTION):
    """Resample the daily cube (J9) -> weekly mean (A1) -> dense weeks x grid
    (W6) -> optional per-week gradient (W1). Not rounded."""
    grid = G.target_grid(spark, BBOX, res)
    cube = spark.table("v_cube")
    # only cells with all four corners carry a value; the week range is the
    # one of the source rows that feed the grid at all
    daily, t0, t1 = RS.resample_with_range(cube, grid, ["value"], ["time"], "time")
    weekly = T.aggregate_weekly(daily, "value", "mean", "time", ["lat_idx", "lon_idx"], out=out, fill=False)
    dense = TR.densify_weeks(weekly, grid, lo=_sunday(t0), hi=_sunday(t1))
    if with_gradient:
        n_lat, n_lon = G.grid_shape(BBOX, res)
        dense = TR.gradient_magnitude(dense, out, res, n_lat, n_lon, keys=["week"], out="SST_grad_C_km")
        return dense.select("week", "lat_idx", "lon_idx", out, "SST_grad_C_km")
    return dense.select("week", "lat_idx", "lon_idx", out)


#: The weekly ocean variables: name of the layer, its columns, and what its variable may be called.
OCEAN = {"sst": (("SST_mean_C", "SST_grad_C_km"), C.SST_ALIASES), "chlorophyll": (("Chla_mean_mg_m3",), C.CHL_ALIASES),
         "sea_level": (("SSHA_mean_m",), ("sla", "ssha")), "salinity": (("Salinity_mean_PSU",), ("sss_smap", "sss"))}


def _ocean_squares(spark, sf):
    """The source squares of every week, with mean corners; the ocean variables come in the same granules."""
    def build():
        cube = C.normalize_columns(spark.table("v_ocean"), {name: aliases for name, (_, aliases) in OCEAN.items()})
        cube = materialize(cube.select("time", "lat", "lon", *OCEAN), "granules")
        return LN.weekly_squares(cube, G.target_grid(spark, BBOX, 0.1), list(OCEAN))

    return store.layer(spark, sf, "ocean_squares", ["week"], build)


def ocean_layer(spark, sf):
    """Q1-Q4 as one stored layer of strips: A1 -> J9 (-> W1)."""
    layers = [(name, columns[0], columns[1] if len(columns) > 1 else None) for name, (columns, _) in OCEAN.items()]
    return store.layer(spark, sf, "ocean", STRIP, lambda: LN.lay_out(_ocean_squares(spark, sf), BBOX, 0.1, layers))


def week_strips(spark, sf):
    """Every week between the first and the last that feeds the grid, with every strip of the grid."""
    def build():
        span = _ocean_squares(spark, sf).agg(F.min("week").alias("lo"), F.max("week").alias("hi"))
        return LN.every_strip(span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 7 days"))).alias("week")), BBOX, 0.1)

    return store.layer(spark, sf, "weeks", STRIP, build)


def _squares_of(spark, sf, view):
    """The source squares of every week of a cube over the whole calendar, with mean corners, stored."""
    def build():
        cube = spark.table(view)
        if view == "v_granules":
            cube = C.normalize_columns(cube, {name: aliases for name, (_, aliases) in OCEAN.items()})
        values = ["value"] if view == "v_cube" else list(OCEAN)
        cube = materialize(cube.filter(F.col("time").isNotNull()).select("time", "lat", "lon", *values), "granules")
        return LN.weekly_squares(cube, G.target_grid(spark, BBOX, 0.1), values)

    return store.layer(spark, sf, f"{view}_squares", ["week"], build)


def _all_weeks(squares):
    """Every week between the first and the last that feeds the grid."""
    span = squares.agg(F.min("week").alias("lo"), F.max("week").alias("hi"))
    return span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 7 days"))).alias("week"))


def _granules_layer(spark, sf):
    """Q1-Q4 of the whole calendar as one stored layer of strips at 0.1 degree."""
    layers = [(name, columns[0], columns[1] if len(columns) > 1 else None) for name, (columns, _) in OCEAN.items()]
    return store.layer(spark, sf, "granules", STRIP, lambda: LN.lay_out(_squares_of(spark, sf, "v_granules"), BBOX, 0.1, layers))


#: Lines of the 0.1-degree grid in a cell of half a degree.
HALF = 5


def half_degree_sql(name: str) -> str:
    parts = "".join(f", count({v}) as n_{v}, round(max({v}) filter (where lat_idx % {HALF} = 0 and lon_idx % {HALF} = 0), 9) + 0.0 as {v}, "
                    f"round(min({v}), 9) + 0.0 as {v}_min, round(max({v}), 9) + 0.0 as {v}_max" for v in OCEAN[name][0])
    return (f"select week, lat_idx // {HALF} as lat_idx, lon_idx // {HALF} as lon_idx{parts} from ({ocean_sql(name, 'v_granules')}) p "
            f"group by week, lat_idx // {HALF}, lon_idx // {HALF}")


def _half_degree_report(spark, sf, name):
    """The 0.1-degree layer of the whole calendar in cells of half a degree: the value at the cell's corner, number, least and
    greatest of all values inside."""
    columns, n_lat, n_lon = OCEAN[name][0], *G.grid_shape(BBOX, 0.1)
    cells = (_granules_layer(spark, sf).select("week", "lat_idx", "strip", F.posexplode(F.arrays_zip(*columns)).alias("place", "at"))
             .select("week", "lat_idx", (F.col("strip") * LN.STRIP + F.col("place")).alias("lon_idx"), *[F.col(f"at.{v}").alias(v) for v in columns])
             .filter(F.col("lon_idx") < n_lon))
    corner = (F.col("lat_idx") % HALF == 0) & (F.col("lon_idx") % HALF == 0)
    halves = cells.groupBy("week", F.floor(F.col("lat_idx") / HALF).cast("int").alias("lat_idx"), F.floor(F.col("lon_idx") / HALF).cast("int").alias("lon_idx")).agg(
        *[c for v in columns for c in (F.count(v).alias(f"n_{v}"), F.max(F.when(corner, F.col(v))).alias(v), F.min(v).alias(f"{v}_min"), F.max(v).alias(f"{v}_max"))])
    spine = _all_weeks(_squares_of(spark, sf, "v_granules"))
    for axis, n in (("lat_idx", n_lat), ("lon_idx", n_lon)):
        spine = spine.withColumn(axis, F.explode(F.sequence(F.lit(0), F.lit((n - 1) // HALF))))
    whole = spine.join(halves, ["week", "lat_idx", "lon_idx"], "left")
    return report(whole.withColumns({f"n_{v}": F.coalesce(f"n_{v}", F.lit(0)).cast("long") for v in columns}))


def ocean_sql(name: str, view: str = "v_ocean") -> str:
    """Cell by cell at 0.1 degree, not rounded: ``(week, lat_idx, lon_idx, columns)``."""
    columns, aliases = OCEAN[name]
    before = f"oc as (select date as time, latitude as lat, longitude as lon, {aliases[0]} as value from {view}), "
    return _cube_weekly_sql(columns[0], len(columns) > 1, GRID01, H_KM_01, 200, "oc", before, exact=True)


def line_summary_sql(name: str, keys: str = "week, lat_idx") -> str:
    parts = "".join(f", count({v}) as n_{v}, round(avg({v}), 9) + 0.0 as {v}_mean, "
                    f"round(sum({v} * (lon_idx + 1)) / (count({v}) * 201), 9) + 0.0 as {v}_placed"
                    for v in OCEAN[name][0])
    return f"select {keys}{parts} from ({ocean_sql(name)}) p group by {keys}"


def _strips(spark, sf, name):
    return store.side_by_side(week_strips(spark, sf), [ocean_layer(spark, sf).select(*STRIP, *OCEAN[name][0])], STRIP)


def _line_report(spark, sf, name):
    """For each line of each week the number of values, their mean, and their mean weighted by place."""
    columns, n_lon = OCEAN[name][0], G.grid_shape(BBOX, 0.1)[1]
    sums = [c for v in columns for c in (LN.count(v).alias(f"n_{v}"), LN.total(F.col(v)).alias(f"s_{v}"), LN.placed(v).alias(f"p_{v}"))]
    lines = _strips(spark, sf, name).select("week", "lat_idx", *sums).groupBy("week", "lat_idx").agg(
        *[F.sum(f"{k}_{v}").alias(f"{k}_{v}") for v in columns for k in "nsp"])
    return report(lines.select("week", "lat_idx", *[c for v in columns for c in (
        F.col(f"n_{v}"), F.when(F.col(f"n_{v}") > 0, F.col(f"s_{v}") / F.col(f"n_{v}")).alias(f"{v}_mean"),
        F.when(F.col(f"n_{v}") > 0, F.col(f"p_{v}") / (F.col(f"n_{v}") * n_lon)).alias(f"{v}_placed"))]))


@register("product_sst", ["v_granules"], half_degree_sql("sst"))
def q_sst(spark, sf):
    """Q1: SST weekly mean and front gradient on the 0.1-degree grid, every week of the calendar, in half-degree cells."""
    return _half_degree_report(spark, sf, "sst")


@register("product_sst_weeks", ["v_cube"],
          "select week, count(*) as n_cells, count(SST_mean_C) as n_values, round(avg(SST_mean_C), 6) as sst_mean, "
          "round(max(SST_grad_C_km), 9) + 0.0 as grad_max, count(SST_grad_C_km) as n_grad from ("
          + _cube_weekly_sql("SST_mean_C", True, GRID01, H_KM_01, 200) + ") p group by week")
def q_sst_weeks(spark, sf):
    """Q1 on the whole 0.1-degree grid (13.9 M week-cells), reported week by week."""
    squares, (n_lat, n_lon), mean, grad = _squares_of(spark, sf, "v_cube"), G.grid_shape(BBOX, 0.1), "SST_mean_C", "SST_grad_C_km"
    strips = LN.lay_out(squares, BBOX, 0.1, [("value", mean, grad)])
    sums = strips.select("week", LN.count(mean).alias("n"), LN.total(F.col(mean)).alias("total"), F.array_max(grad).alias("top"),
                         LN.count(grad).alias("n_grad")).groupBy("week").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("top").alias("top"), F.sum("n_grad").alias("n_grad"))
    return _all_weeks(squares).join(sums, "week", "left").select(
        "week", F.lit(n_lat * n_lon).cast("long").alias("n_cells"), F.coalesce("n", F.lit(0)).cast("long").alias("n_values"),
        F.when(F.col("n") > 0, F.round(F.col("total") / F.col("n"), 6)).alias("sst_mean"), tf.rnd("top", 9).alias("grad_max"),
        F.coalesce("n_grad", F.lit(0)).cast("long").alias("n_grad"))


@register("product_chlorophyll", ["v_granules"], half_degree_sql("chlorophyll"))
def q_chl(spark, sf):
    """Q2: chlorophyll weekly mean on the 0.1-degree grid, every week of the calendar, in half-degree cells."""
    return _half_degree_report(spark, sf, "chlorophyll")


@register("product_sea_level", ["v_ocean"], line_summary_sql("sea_level"))
def q_ssha(spark, sf):
    """Q3: sea-level anomaly weekly mean on the 0.1-degree grid, line by line."""
    return _line_report(spark, sf, "sea_level")


@register("product_salinity", ["v_granules"], half_degree_sql("salinity"))
def q_sss(spark, sf):
    """Q4: salinity weekly mean on the 0.1-degree grid, every week of the calendar, in half-degree cells."""
    return _half_degree_report(spark, sf, "salinity")


def _weeks_sql(name: str, view: str = "v_ocean") -> str:
    out = OCEAN[name][0][0]
    return (f"select week, count(*) as n_cells, count({out}) as n_values, round(avg({out}), 9) + 0.0 as value_mean, "
            f"round(min({out}), 9) + 0.0 as value_min, round(max({out}), 9) + 0.0 as value_max from ("
            + ocean_sql(name, view) + ") p group by week")


def _weeks(spark, sf, name: str, strips=None):
    out, (n_lat, n_lon) = OCEAN[name][0][0], G.grid_shape(BBOX, 0.1)
    strips = (_strips(spark, sf, name) if strips is None else strips).select("week", LN.count(out).alias("n"), LN.total(F.col(out)).alias("total"),
                                             F.array_min(out).alias("lo"), F.array_max(out).alias("hi"))
    weeks = strips.groupBy("week").agg(F.sum("n").alias("n_values"), F.sum("total").alias("total"), F.min("lo").alias("value_min"),
                                       F.max("hi").alias("value_max"))
    return report(weeks.select("week", F.lit(n_lat * n_lon).cast("long").alias("n_cells"), "n_values", F.when(
        F.col("n_values") > 0, F.col("total") / F.col("n_values")).alias("value_mean"), "value_min", "value_max"))


@register("product_chlorophyll_weeks", ["v_granules"], _weeks_sql("chlorophyll", "v_granules"))
def q_chl_weeks(spark, sf):
    """Q2 on the whole 0.1-degree grid, every week of the calendar, reported week by week."""
    weeks = _all_weeks(_squares_of(spark, sf, "v_granules"))
    return _weeks(spark, sf, "chlorophyll", weeks.join(_granules_layer(spark, sf), "week", "left"))


@register("product_sea_level_weeks", ["v_ocean"], _weeks_sql("sea_level"))
def q_ssha_weeks(spark, sf):
    """Q3 on the whole 0.1-degree grid, reported week by week."""
    return _weeks(spark, sf, "sea_level")


@register("product_salinity_weeks", ["v_ocean"], _weeks_sql("salinity"))
def q_sss_weeks(spark, sf):
    """Q4 on the whole 0.1-degree grid, reported week by week."""
    return _weeks(spark, sf, "salinity")


OXY_SRC = ("ox as (select 25.0 + cast(lat_idx as double) * 1.0 as lat, -130.0 + cast(lon_idx as double) * 1.0 as lon, "
           "max_by(o_an, depth_m) filter (where o_an is not null) as oxy from v_oxygen group by lat_idx, lon_idx)")


@register("product_oxygen", ["v_oxygen"],
          f"with {GRID01}, {OXY_SRC}, {linear_map_sql('lat_', 'ox', 'lat', 'grid', 'lat_idx')}, "
          f"{linear_map_sql('lon_', 'ox', 'lon', 'grid', 'lon_idx')}, "
          f"r as ({bilinear_sql('ox', ['oxy'])}) "
          "select g.lat_idx, g.lon_idx, round(r.oxy, 9) + 0.0 as Oxygen_bottom_ml_L "
          "from grid g left join r on g.lat_idx = r.lat_idx and g.lon_idx = r.lon_idx")
def q_oxygen(spark, sf):
    """Q5: bottom oxygen (A18) on the 1-degree climatology grid -> J9 to 0.1 degree."""
    return report(oxygen_layer(spark, sf))


def oxygen_layer(spark, sf):
    def build():
        bottom = T.bottom_value(spark.table("v_oxygen"), out="oxy")
        src = bottom.select((F.lit(25.0) + F.col("lat_idx").cast("double") * F.lit(1.0)).alias("lat"),
                            (F.lit(-130.0) + F.col("lon_idx").cast("double") * F.lit(1.0)).alias("lon"), "oxy")
        grid = G.target_grid(spark, BBOX, 0.1)
        return RS.resample(src, grid, ["oxy"], "bilinear").withColumnRenamed("oxy", "Oxygen_bottom_ml_L")

    return store.layer(spark, sf, "oxygen", CELL, build)


def spline_sql(p: str, src: str, axis: str, targets: str) -> str:
    """CTEs ending in ``{p}out(line, idx, v)``: not-a-knot cubic splines along one axis.

    ``src(line, x, y)`` holds the lines, ``axis(x)`` the source coordinates
    and ``targets(idx, t)`` the target coordinates. The tridiagonal system is
    solved by two recursive sweeps over the axis.
    """
    return (
        f"{p}a as (select x, row_number() over (order by x) - 1 as i, count(*) over () as n, "
        f"lead(x) over (order by x) - x as h, x - lag(x) over (order by x) as hp, "
        f"lead(x, 2) over (order by x) - lead(x) over (order by x) as hn, "
        f"lag(x) over (order by x) - lag(x, 2) over (order by x) as hpp from {axis}), "
        # rows of the system, with the not-a-knot ends folded into the first and last
        f"{p}c as (select *, case when i = 1 then 0.0 when i = n - 2 then hp - h * h / hp else hp end as ca, "
        f"2.0 * (hp + h) + case when i = 1 then hp * (hp + h) / h else 0.0 end "
        f"+ case when i = n - 2 then h * (hp + h) / hp else 0.0 end as cb, "
        f"case when i = n - 2 then 0.0 when i = 1 then h - hp * hp / h else h end as cc from {p}a where n >= 4), "
        f"{p}y as (select s.line, c.*, s.y, lead(s.y) over w as yn, lag(s.y) over w as yp from {src} s "
        f"join {p}c c on s.x = c.x where s.line in (select line from {src} group by line "
        f"having count(y) = (select count(*) from {axis})) window w as (partition by s.line order by c.i)), "
        f"{p}f(line, i, cp, rp) as (select line, i, cc / cb, 6.0 * ((yn - y) / h - (y - yp) / hp) / cb from {p}y where i = 1 "
        f"union all select y.line, y.i, y.cc / (y.cb - y.ca * f.cp), "
        f"(6.0 * ((y.yn - y.y) / y.h - (y.y - y.yp) / y.hp) - y.ca * f.rp) / (y.cb - y.ca * f.cp) "
        f"from {p}f f join {p}y y on y.line = f.line and y.i = f.i + 1 where y.i <= y.n - 2), "
        f"{p}b(line, i, m) as (select f.line, f.i, f.rp from {p}f f where f.i = (select max(n) - 2 from {p}a) "
        f"union all select f.line, f.i, f.rp - f.cp * b.m from {p}b b join {p}f f on f.line = b.line and f.i = b.i - 1), "
        f"{p}m as (select line, i, m from {p}b union all "
        f"select b.line, 0, max((a.hp + a.h) / a.h * b.m) filter (where b.i = 1) "
        f"- max(a.hp / a.h) * max(case when b.i = 2 then b.m end) from {p}b b, (select * from {p}a where i = 1) a "
        f"where b.i in (1, 2) group by b.line union all "
        f"select b.line, a.n - 1, max(case when b.i = a.n - 2 then (a.hp + a.h) / a.hp * b.m end) "
        f"- max(case when b.i = a.n - 3 then a.h / a.hp * b.m end) from {p}b b, (select * from {p}a where i = n - 2) a "
        f"where b.i >= a.n - 3 group by b.line, a.n), "
        f"{p}k as (select y.line, y.i, y.x, y.h, y.y, lead(y.y) over w as y1, m.m, lead(m.m) over w as m1 "
        f"from {p}y y join {p}m m on m.line = y.line and m.i = y.i window w as (partition by y.line order by y.i)), "
        f"{p}out as (select k.line, t.idx, k.m * pow(k.x + k.h - t.t, 3) / (6 * k.h) + k.m1 * pow(t.t - k.x, 3) / (6 * k.h) "
        f"+ (k.y / k.h - k.m * k.h / 6) * (k.x + k.h - t.t) + (k.y1 / k.h - k.m1 * k.h / 6) * (t.t - k.x) as v "
        f"from {targets} t join {p}k k on k.h is not null and ((t.t > k.x and t.t <= k.x + k.h) or (k.i = 0 and t.t = k.x)))")


@register("resample_cubic", ["v_surface"],
          f"with recursive {GRID01}, lonx as (select distinct lon as x from v_surface), "
          "latx as (select distinct lat as x from v_surface), "
          "lont as (select distinct lon_idx as idx, lon as t from grid), "
          "latt as (select distinct lat_idx as idx, lat as t from grid), "
          "rows1 as (select lat as line, lon as x, elevation as y from v_surface), "
          f"{spline_sql('p', 'rows1', 'lonx', 'lont')}, "
          "rows2 as (select idx as line, line as x, v as y from pout), "
          f"{spline_sql('q', 'rows2', 'latx', 'latt')} "
          "select g.lat_idx, g.lon_idx, round(q.v, 3) + 0.0 as elevation from grid g "
          "left join qout q on q.line = g.lon_idx and q.idx = g.lat_idx")
def q_cubic(spark, sf):
    """Surface elevation onto the 0.1-degree grid by not-a-knot cubic splines, to
    the millimetre (two solvers of one system differ in the last bits)."""
    grid = G.target_grid(spark, BBOX, 0.1)
    cubic = RS.resample_cubic(spark.table("v_surface"), grid, "elevation")
    whole = grid.select("lat_idx", "lon_idx").join(cubic, ["lat_idx", "lon_idx"], "left")
    return report(whole, 3)
