"""Column expressions (all JVM-side, codegen-friendly).

Every helper returns a ``Column``; nothing here touches data. Conventions
that define the answers:

* 111 km per degree, flat (no cos(lat)), on both axes.
* NaN is turned into NULL once at every source; after that NULL semantics.
* Week = Monday 00:00 .. Sunday 24:00, labelled by its Sunday (a ``date``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (reference configuration defaults).
KM_PER_DEG = 111.0
DEFAULT_RESOLUTION = 0.1
DEFAULT_BBOX = {"min_lon": -130.0, "max_lon": -110.0, "min_lat": 25.0, "max_lat": 45.0}
DEFAULT_START = "2020-01-01"
DEFAULT_END = "2023-12-31"
DEFAULT_MAX_DISTANCE_KM = 500.0
DEFAULT_BUFFER_KM = 100.0
DEFAULT_SEED = 42
SUMMER_MONTHS = (6, 7, 8)
DEFAULT_GEARS = ("tuna_purse_seines", "drifting_longlines")
ADULT_LENGTH_M = 3.5
NURSERY_MAX_DEPTH = 100.0
NURSERY_MAX_SLOPE = 5.0
NURSERY_MIN_SST = 16.0
PREY_SPECIES = ("Zalophus californianus", "Mirounga angustirostris",
                "Arctocephalus pusillus", "Phoca vitulina")
ORCA = "Orcinus orca"
STAGES = ("Adult_Male", "Adult_Female", "Juvenile")


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN -> NULL (Spark orders NaN above every number; NULL is what we want)."""
    c = col_(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def deg_to_km(c) -> Column:
    return col_(c) * F.lit(KM_PER_DEG)


def km_to_deg(km: float) -> float:
    return km / KM_PER_DEG


def cap(c, max_value) -> Column:
    """min(distance, cap) when a cap is given (P20)."""
    return col_(c) if max_value is None else F.least(col_(c), F.lit(float(max_value)))


def season(month) -> Column:
    """Season name for a month number."""
    m = col_(month)
    return (F.when(m.isin(12, 1, 2), "Winter").when(m.isin(3, 4, 5), "Spring")
            .when(m.isin(6, 7, 8), "Summer").otherwise("Autumn"))


def season_code(ts) -> Column:
    """Climatology season label DJF/MAM/JJA/SON."""
    m = F.month(col_(ts))
    return (F.when(m.isin(12, 1, 2), "DJF").when(m.isin(3, 4, 5), "MAM")
            .when(m.isin(6, 7, 8), "JJA").otherwise("SON"))


def life_stage(length, sex) -> Column:
    """Life stage from length (m) and sex."""
    s = F.lower(F.coalesce(col_(sex), F.lit("")))
    ln = col_(length)
    return (F.when(ln.isNull(), "Unknown")
            .when(ln >= ADULT_LENGTH_M,
                  F.when(s.isin("male", "m"), "Adult_Male")
                  .when(s.isin("female", "f"), "Adult_Female").otherwise("Adult"))
            .otherwise("Juvenile"))


def elevation_to_depth(elev) -> Column:
    """Depth = -elevation below sea level, 0 on land and where missing."""
    e = col_(elev)
    return F.when(e < 0, -e).otherwise(F.lit(0.0)) + F.lit(0.0)


def week_label(ts) -> Column:
    """Sunday that closes the Monday-based week holding ``ts`` (A1)."""
    return F.date_add(F.to_date(F.date_trunc("week", col_(ts))), 6)


def week_monday(ts) -> Column:
    return F.to_date(F.date_trunc("week", col_(ts)))


def iso_week(ts) -> Column:
    return F.weekofyear(col_(ts)).cast("int")


def is_summer(ts, months=SUMMER_MONTHS) -> Column:
    return F.month(col_(ts)).isin(*months)


def snap_index(c, origin: float, res: float) -> Column:
    """Nearest grid index on one axis: floor((x - origin) / res + 0.5)."""
    return F.floor((col_(c) - F.lit(origin)) / F.lit(res) + F.lit(0.5)).cast("int")


def axis_coord(idx, origin: float, res: float) -> Column:
    return F.lit(origin) + col_(idx).cast("double") * F.lit(res)


def hashed_uniform(seed, stage, attempt, axis: str) -> Column:
    """Uniform [0,1) from md5('seed:stage:attempt:axis').

    The first 8 hex digits / 2^32. The same number is reproducible in SQL, and
    it does not depend on partitioning or task order.
    """
    key = F.concat_ws(":", F.lit(str(seed)), col_(stage).cast("string"),
                      col_(attempt).cast("string"), F.lit(axis))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def point_wkt(lon, lat) -> Column:
    return F.format_string("POINT (%s %s)", col_(lon).cast("string"), col_(lat).cast("string"))


def bbox_wkt(min_lon, max_lon, min_lat, max_lat) -> Column:
    """Closed 5-vertex ring of a box as WKT."""
    xs = [min_lon, max_lon, max_lon, min_lon, min_lon]
    ys = [min_lat, min_lat, max_lat, max_lat, min_lat]
    parts = []
    for x, y in zip(xs, ys):
        parts.append(F.concat_ws(" ", col_(x).cast("string"), col_(y).cast("string")))
    return F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *parts), F.lit("))"))


def bbox_ring(min_lon, max_lon, min_lat, max_lat) -> Column:
    """Closed 5-vertex ring as array<array<double>> (GeoJSON order)."""
    xs = [min_lon, max_lon, max_lon, min_lon, min_lon]
    ys = [min_lat, min_lat, max_lat, max_lat, min_lat]
    return F.array(*[F.array(col_(x).cast("double"), col_(y).cast("double")) for x, y in zip(xs, ys)])


# Nudge (1% of the 9-digit unit) added away from zero before report
# rounding: exact decimal ties (common for means of short decimals) then round
# the same way in every engine and partitioning instead of being decided by
# last-bit summation noise; no value moves by a visible amount.
TIE_NUDGE = 1e-11


def rnd(c, digits: int = 9) -> Column:
    """Report rounding: fixed digits, ties away from zero, -0.0 folded to 0.0.

    Scaled-integer rounding ``sign(y) * floor(|y| + 0.5) / 10^d`` on the
    double ``y = x * 10^d`` (the common SQL-engine definition, e.g. DuckDB's),
    so the same double rounds to the same double in both engines; NaN and
    infinities pass through.
    """
    c = col_(c)
    scale = float(10 ** digits)
    y = (c + F.signum(c) * F.lit(TIE_NUDGE)) * F.lit(scale)
    r = F.signum(y) * F.floor(F.abs(y) + F.lit(0.5)).cast("double") / F.lit(scale)
    # NaN is above every number; kept short, since the code of many such columns is one method that must stay compilable
    return F.when(F.abs(y) >= F.lit(2.0 ** 52), y / F.lit(scale)).otherwise(r) + F.lit(0.0)
