"""Checked queries for range joins, absence generation and distance layers.

Survey rows J1, J3-J6, J10, W4, Q10-Q12.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as tf
from ..operators import grid as G
from ..operators import sets as U
from ..operators import spatial as SP
from ..operators import synthetic as S
from .q_columns import STAGE_SQL, UNIFORM_SQL
from .registry import register, report

BBOX = tf.DEFAULT_BBOX


def _rd2(km: float) -> str:
    rd = tf.km_to_deg(km)
    return repr(rd * rd)


PRESENCE_SQL = (f"presence as (select t.event_id, t.shark_id, t.ts, t.lon, t.lat, i.name, i.sex, i.length_m, "
                f"i.weight_kg, {STAGE_SQL} as life_stage from v_tracks t join v_individuals i on t.shark_id = i.id "
                "where i.species = 'Carcharodon carcharias')")

GRID_SQL = ("grid as (select cast(id // 201 as int) as lat_idx, cast(id % 201 as int) as lon_idx, "
            "25.0 + cast(id // 201 as double) * 0.1 as lat, -130.0 + cast(id % 201 as double) * 0.1 as lon "
            "from range(0, 201 * 201) t(id))")


# A study box wide enough that the default buffer leaves free area on these tables.
WIDE_BBOX = {"min_lon": -150.0, "max_lon": -90.0, "min_lat": 5.0, "max_lat": 65.0}


def _absence_sql(buffer_km: float, bbox: dict = BBOX) -> str:
    width, height = bbox["max_lon"] - bbox["min_lon"], bbox["max_lat"] - bbox["min_lat"]
    return (
        f"with {PRESENCE_SQL}, "
        "staged as (select * from presence where life_stage in ('Adult_Male', 'Adult_Female', 'Juvenile')), "
        "targets as (select life_stage as stage, cast(floor(count(*) * 1.0) as bigint) as n_target from staged group by 1), "
        "c as (select stage, n_target, unnest(range(0, n_target * 10)) as attempt from targets), "
        f"cand as (select stage, n_target, attempt, {bbox['min_lon']} + {UNIFORM_SQL.format(axis='lon')} * {width} as lon, "
        f"{bbox['min_lat']} + {UNIFORM_SQL.format(axis='lat')} * {height} as lat from c), "
        "pts as (select distinct life_stage, lon, lat from staged), "
        "acc as (select * from cand c where not exists (select 1 from pts p where p.life_stage = c.stage and "
        f"(c.lon - p.lon) * (c.lon - p.lon) + (c.lat - p.lat) * (c.lat - p.lat) <= {_rd2(buffer_km)})), "
        "ranked as (select *, row_number() over (partition by stage order by attempt) as rn from acc) "
        "select stage as Life_Stage, attempt, round(lon, 9) + 0.0 as lon, round(lat, 9) + 0.0 as lat, "
        "0 as Shark_Presence_Status, 'Absence' as Point_Type from ranked where rn <= n_target")


def _presence(spark):
    return S.presence_points(spark.table("v_tracks"), spark.table("v_individuals"))


@register("enrich_tracks", ["v_tracks", "v_individuals"],
          "select t.event_id, t.shark_id, i.name, i.sex, round(i.length_m, 9) + 0.0 as length_m, "
          "round(i.weight_kg, 9) + 0.0 as weight_kg from v_tracks t join v_individuals i on t.shark_id = i.id")
def q_enrich(spark, sf):
    df = U.enrich_tracks(spark.table("v_tracks"), spark.table("v_individuals"), "shark_id", "id")
    return report(df.select("event_id", "shark_id", "name", "sex", "length_m", "weight_kg"))


@register("product_presence", ["v_tracks", "v_individuals"],
          f"with {PRESENCE_SQL} select event_id, 1 as Shark_Presence_Status, cast(shark_id as varchar) as Shark_ID, "
          "sex as Sex, life_stage as Life_Stage, ts as Date, round(lon, 9) + 0.0 as lon, round(lat, 9) + 0.0 as lat, "
          "'Presence' as Point_Type from presence")
def q_presence(spark, sf):
    """Q11: P6 -> J1 -> P17 -> P13 presence points."""
    p = _presence(spark)
    return report(p.select("event_id", "Shark_Presence_Status", F.col("shark_id").cast("string").alias("Shark_ID"),
                           F.col("sex").alias("Sex"), F.col("life_stage").alias("Life_Stage"),
                           F.col("ts").alias("Date"), "lon", "lat", F.lit("Presence").alias("Point_Type")))


@register("product_absence", ["v_tracks", "v_individuals"], _absence_sql(5.0))
def q_absence(spark, sf):
    """Q12 with a 5 km buffer (fixture density: 100 km leaves no free area)."""
    return report(S.generate_absence(_presence(spark), BBOX, 5.0))


@register("product_absence_100km", ["v_tracks", "v_individuals"], _absence_sql(100.0, WIDE_BBOX))
def q_absence_default(spark, sf):
    """Q12 with the default 100 km buffer, in a study box around the tracks' area."""
    return report(S.generate_absence(_presence(spark), WIDE_BBOX, 100.0))


@register("exclude_buffer", ["v_tracks", "v_individuals"],
          f"with {PRESENCE_SQL}, "
          "targets as (select life_stage as stage, count(*) as n_target from presence "
          "where life_stage in ('Adult_Male', 'Adult_Female', 'Juvenile') group by 1), "
          "c as (select stage, unnest(range(0, n_target * 10)) as attempt from targets), "
          f"cand as (select stage, attempt, -130.0 + {UNIFORM_SQL.format(axis='lon')} * 20.0 as lon, "
          f"25.0 + {UNIFORM_SQL.format(axis='lat')} * 20.0 as lat from c), "
          "pts as (select distinct lon, lat from presence) "
          "select stage, attempt from cand c where not exists (select 1 from pts p where "
          f"(c.lon - p.lon) * (c.lon - p.lon) + (c.lat - p.lat) * (c.lat - p.lat) <= {_rd2(20.0)})")
def q_exclude(spark, sf):
    """Candidates outside 20 km of every presence point (all stages pooled)."""
    p = _presence(spark)
    cand = G.absence_candidates(spark, S.stage_targets(p), BBOX)
    return SP.exclude_buffer(cand, p, 20.0).select("stage", "attempt")


@register("exclusion_mask", ["v_tracks"],
          f"with {GRID_SQL}, pts as (select distinct lon, lat from v_tracks) "
          "select g.lat_idx, g.lon_idx, exists (select 1 from pts p where "
          f"(g.lon - p.lon) * (g.lon - p.lon) + (g.lat - p.lat) * (g.lat - p.lat) <= {_rd2(20.0)}) as excluded "
          "from grid g")
def q_mask(spark, sf):
    """Grid cells within 20 km of any track ping."""
    cells = G.target_grid(spark, BBOX, 0.1)
    return SP.exclusion_mask(cells, spark.table("v_tracks"), 20.0).select("lat_idx", "lon_idx", "excluded")


@register("nearest_distance", ["v_occurrences"],
          f"with {GRID_SQL}, pts as (select distinct lon, lat from v_occurrences "
          "where species_name <> 'Orcinus orca' and lon is not null and lat is not null) "
          "select g.lat_idx, g.lon_idx, round(least(sqrt(min((g.lon - p.lon) * (g.lon - p.lon) + "
          "(g.lat - p.lat) * (g.lat - p.lat))) * 111.0, 500.0), 9) + 0.0 as distance_km from grid g, pts p "
          "group by 1, 2")
def q_nearest(spark, sf):
    """Distance from every 0.1-degree cell to the nearest prey sighting, capped at 500 km."""
    cells = G.target_grid(spark, BBOX, 0.1)
    prey = spark.table("v_occurrences").filter(F.col("species_name") != tf.ORCA)
    return report(SP.nearest_distance(cells, prey, 500.0).select("lat_idx", "lon_idx", "distance_km"))


@register("lane_distance", ["v_lane_vertices"],
          f"with {GRID_SQL}, pts as (select distinct lon, lat from v_lane_vertices) "
          "select g.lat_idx, g.lon_idx, round(least(sqrt(min((g.lon - p.lon) * (g.lon - p.lon) + "
          "(g.lat - p.lat) * (g.lat - p.lat))) * 111.0, 500.0), 9) + 0.0 as Dist_to_Shipping_Lane_km "
          "from grid g, pts p group by 1, 2")
def q_lane_distance(spark, sf):
    """Distance to the nearest shipping-lane vertex, capped at 500 km."""
    cells = G.target_grid(spark, BBOX, 0.1)
    out = SP.nearest_distance(cells, spark.table("v_lane_vertices"), 500.0, out="Dist_to_Shipping_Lane_km")
    return report(out.select("lat_idx", "lon_idx", "Dist_to_Shipping_Lane_km"))


@register("eps_neighbours", ["v_occurrences"],
          "with p as (select occ_id, lon, lat from v_occurrences where species_name <> 'Orcinus orca' "
          "and lon is not null and lat is not null) "
          "select a.occ_id, count(*) as n_neighbours from p a join p b on "
          f"(a.lon - b.lon) * (a.lon - b.lon) + (a.lat - b.lat) * (a.lat - b.lat) <= {_rd2(10.0)} group by a.occ_id")
def q_eps(spark, sf):
    """Prey sightings within 10 km of each sighting (itself included)."""
    prey = spark.table("v_occurrences").filter(F.col("species_name") != tf.ORCA)
    prey = prey.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull())
    return SP.neighbour_counts(prey, 10.0).select("occ_id", F.col("n_neighbours").cast("bigint"))
