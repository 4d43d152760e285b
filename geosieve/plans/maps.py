"""Two states of a map made of parts, and what differs between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geosieve.operators import maps
from geosieve.plans.registry import Tables, query
from geosieve.plans.spatial import PARTS, parts

_MAPS = f"""{PARTS}, a AS (SELECT 'Map/Group ' || feature % 7 || '/Layer ' || size % 5 AS folder, 'Mark ' || feature % 900 AS name, f_lng AS lng, f_lat AS lat FROM parts),
    b AS (SELECT CASE WHEN feature % 13 = 0 THEN 'Map/New' ELSE 'Map/Group ' || feature % 7 || '/Layer ' || size % 5 END AS folder, 'Mark ' || (feature + CASE WHEN feature % 17 = 0 THEN 5000 ELSE 0 END) % 6500 % 5900 % 900 AS name, CASE WHEN feature % 19 = 0 THEN f_lng + 1e-5 WHEN feature % 5 = 0 THEN f_lng + 1e-9 ELSE f_lng END AS lng, f_lat AS lat FROM parts WHERE feature % 11 <> 0),
    u AS (SELECT folder, name, round(lng, 6) AS lng, round(lat, 6) AS lat, 1 AS a, 0 AS b FROM a UNION ALL SELECT folder, name, round(lng, 6), round(lat, 6), 0, 1 FROM b),
    g AS (SELECT folder, name, lng, lat, sum(a) AS a, sum(b) AS b FROM u GROUP BY ALL)"""


def _states(t: Tables) -> tuple[DataFrame, DataFrame]:
    k, lng = F.col("feature"), F.col("f_lng")
    folder = F.concat(F.lit("Map/Group "), k % 7, F.lit("/Layer "), F.col("size") % 5)
    mark = lambda x: F.array(F.array(F.array(F.struct(x.alias("lng"), F.col("f_lat").alias("lat"))))).alias("parts")
    a = parts(t).select(folder.alias("folder"), F.concat(F.lit("Mark "), k % 900).alias("name"), mark(lng))
    renamed = (k + F.when(k % 17 == 0, 5000).otherwise(0)) % 6500 % 5900 % 900
    b = parts(t).where(k % 11 != 0).select(F.when(k % 13 == 0, "Map/New").otherwise(folder).alias("folder"), F.concat(F.lit("Mark "), renamed).alias("name"), mark(F.when(k % 19 == 0, lng + 1e-5).when(k % 5 == 0, lng + 1e-9).otherwise(lng)))
    return a, b


@query(f"""WITH {_MAPS}, k AS (SELECT folder, name, CAST(sum(a) AS BIGINT) AS in_a, CAST(sum(b) AS BIGINT) AS in_b, bool_or(a <> b) AS off FROM g GROUP BY ALL)
    SELECT folder, name, in_a, in_b, CASE WHEN in_b = 0 THEN 'only in a' WHEN in_a = 0 THEN 'only in b' WHEN off THEN 'differs' ELSE 'same' END AS outcome FROM k""")
def map_changes(t: Tables) -> DataFrame:
    """Every mark of two states of a map by path and name: same, differing, or only in one."""
    return maps.map_difference(*_states(t))


@query(f"""WITH {_MAPS} SELECT name, min(folder) FILTER (a > b) AS from_folder, min(folder) FILTER (b > a) AS to_folder FROM g WHERE a <> b GROUP BY name, lng, lat HAVING sum(greatest(a - b, 0)) = 1 AND sum(greatest(b - a, 0)) = 1""")
def map_moves(t: Tables) -> DataFrame:
    """Marks that went from one folder to another unchanged."""
    return maps.moved(*_states(t)).drop("digest")


@query(f"""WITH {_MAPS}, s AS (SELECT 'a' AS side, folder FROM a UNION ALL SELECT 'b', folder FROM b), n AS (SELECT side, folder, count(*) AS n FROM s GROUP BY ALL),
    f AS (SELECT * FROM n UNION ALL SELECT side, array_to_string(list_slice(string_split(folder, '/'), 1, i), '/'), 0 FROM n, range(1, 4) r(i) WHERE i <= len(string_split(folder, '/')))
    SELECT folder, CAST(sum(n) FILTER (side = 'a') AS BIGINT) AS in_a, CAST(sum(n) FILTER (side = 'b') AS BIGINT) AS in_b FROM f GROUP BY folder""")
def map_folders(t: Tables) -> DataFrame:
    """How many marks each folder holds in two states of a map."""
    return maps.folder_counts(*_states(t))
