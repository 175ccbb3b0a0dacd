"""Queries over vectors: distances, exact and hashed neighbours, scores, search."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from ..functions import vectors as fv
from ..operators import lsh, neighbours as nb
from .registry import query
from .views import md5_sql, table

_EUCLIDEAN = "list_distance(a.vec, b.vec)"
_COSINE = """1 - list_dot_product(a.vec, b.vec)
  / sqrt(list_dot_product(a.vec, a.vec) * list_dot_product(b.vec, b.vec))"""

_VECTORS = "v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS vec, label FROM embeddings)"


def _pairs_sql(distance: str) -> str:
    return f"""WITH {_VECTORS},
pairs AS (SELECT a.id, b.id AS neighbour_id, {distance} AS distance
          FROM v a JOIN v b ON a.id <> b.id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, neighbour_id) AS rank
           FROM pairs)"""


_TOP = "top AS (SELECT * FROM ranked WHERE rank <= 5)"
_LISTS = """lists AS (SELECT id, string_agg(neighbour_id::VARCHAR, ',' ORDER BY rank) AS neighbours
  FROM top GROUP BY id)"""


def embeddings(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label"
    )


def _long(pairs):
    return pairs.select(
        "id", "neighbour_id", F.round("distance", 9).alias("distance"),
        F.col("rank").cast("bigint").alias("rank"),
    )


@query("M7 J2 W1", f"""{_pairs_sql(_EUCLIDEAN)}, {_TOP}
SELECT id, neighbour_id, round(distance, 9) AS distance, rank FROM top""")
def exact_neighbours(spark, sf_dir):
    return _long(nb.exact_neighbours(embeddings(spark, sf_dir), "id", "vec"))


@query("M7 J2 W1", f"""{_pairs_sql(_EUCLIDEAN)}, {_TOP}
SELECT id, neighbour_id, round(distance, 9) AS distance, rank FROM top""")
def exact_neighbours_blocked(spark, sf_dir):
    """The way for many slices, forced here: slices of 32 vectors, branches of 4 slices."""
    rows = embeddings(spark, sf_dir)
    return _long(nb.exact_neighbours(rows, "id", "vec", block_rows=32, max_slices=4))


@query("M7 J2 W1 X6", f"""{_pairs_sql(_COSINE)}, {_TOP}
SELECT id, neighbour_id, round(distance, 9) AS distance, rank FROM top""")
def exact_neighbours_cosine(spark, sf_dir):
    return _long(nb.exact_neighbours(embeddings(spark, sf_dir), "id", "vec", distance="cosine"))


@query("M7 A9 J4", f"""{_pairs_sql(_EUCLIDEAN)}, {_TOP}, {_LISTS}
SELECT v.id, label, neighbours FROM v LEFT JOIN lists USING (id)""")
def attach_neighbours(spark, sf_dir):
    rows = embeddings(spark, sf_dir)
    lists = nb.neighbour_lists(nb.exact_neighbours(rows, "id", "vec"))
    return nb.attach_neighbours(rows, lists).select(
        "id", "label", F.array_join("neighbours", ",").alias("neighbours")
    )


@query("J2 O3", f"""WITH {_VECTORS}
SELECT a.id AS id_a, b.id AS id_b, round({_EUCLIDEAN}, 9) AS distance
FROM v a JOIN v b ON a.id < b.id WHERE {_EUCLIDEAN} < 1.2""")
def close_pairs(spark, sf_dir):
    pairs = nb.close_pairs(embeddings(spark, sf_dir), "id", "vec", 1.2)
    return pairs.withColumn("distance", F.round("distance", 9)).orderBy("distance", "id_a", "id_b")


@query("A11", f"""{_pairs_sql(_EUCLIDEAN)}, {_TOP}
SELECT id, {', '.join(f"round(max(distance) FILTER (rank = {n}), 9) AS distance_{n}" for n in range(1, 6))}
FROM top GROUP BY id""")
def neighbour_matrix(spark, sf_dir):
    pairs = nb.exact_neighbours(embeddings(spark, sf_dir), "id", "vec")
    matrix = nb.neighbour_matrix(pairs)
    return matrix.select("id", *[
        F.round(name, 9).alias(name) for name in matrix.columns if name != "id"
    ])


@query("A11", f"""{_pairs_sql(_EUCLIDEAN)}, {_TOP}
SELECT id, rank::INTEGER AS rank, round(distance, 9) AS distance FROM top""")
def melt_matrix(spark, sf_dir):
    pairs = nb.exact_neighbours(embeddings(spark, sf_dir), "id", "vec")
    return nb.melt_matrix(nb.neighbour_matrix(pairs)).withColumn("distance", F.round("distance", 9))


@query("W1", f"""WITH {_VECTORS},
pairs AS (SELECT a.id, b.id AS neighbour_id, {_EUCLIDEAN} AS distance
          FROM v a JOIN v b ON a.id < b.id WHERE {_EUCLIDEAN} < 1.25),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, neighbour_id) AS rank FROM pairs)
SELECT id, neighbour_id, round(distance, 9) AS distance, rank FROM ranked WHERE rank <= 5""")
def top_k_neighbours(spark, sf_dir):
    pairs = nb.close_pairs(embeddings(spark, sf_dir), "id", "vec", 1.25, nearest=nb.NEIGHBOURS).select(
        F.col("id_a").alias("id"), F.col("id_b").alias("neighbour_id"), "distance"
    )
    return _long(nb.top_k_neighbours(pairs))


@query("X6 X7", """
WITH v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS vec, label FROM embeddings),
next AS (SELECT id, vec, lead(vec) OVER (PARTITION BY label ORDER BY id) AS other FROM v)
SELECT id, round(list_distance(vec, other), 9) AS euclidean,
  CASE WHEN other IS NULL THEN 2.0 ELSE round(1 - list_dot_product(vec, other)
    / sqrt(list_dot_product(vec, vec) * list_dot_product(other, other)), 9) END AS cosine
FROM next""")
def vector_distances(spark, sf_dir):
    """Each vector against the next of its label, with the JVM expressions."""
    rows = embeddings(spark, sf_dir)
    following = nb.Window.partitionBy("label").orderBy("id")
    paired = rows.withColumn("other", F.lead("vec").over(following))
    vec, other = F.col("vec"), F.col("other")
    return paired.select(
        "id", F.round(fv.euclidean_distance(vec, other), 9).alias("euclidean"),
        F.round(fv.cosine_distance(vec, other), 9).alias("cosine"),
    )


# Directions that SQL can compute, in place of MLlib's random ones.
def _uniform(text: str) -> float:
    return (int(hashlib.md5(text.encode()).hexdigest()[:8], 16) + 0.5) / 2**32


DIRECTIONS = [[2 * _uniform(f"{t}:{j}") - 1 for j in range(64)] for t in range(5)]
# The reference thresholds return nothing on these vectors, whose least distance is about 1.
FIXED = lsh.LshParams(num_hash_tables=3, distance_threshold=1.25, bucket_length=0.5)
GRID = [
    lsh.LshParams(tables, threshold, length)
    for tables in (1, 3, 5) for threshold in (1.1, 1.2, 1.3) for length in (0.5, 1.0, 3.0)
]

_JT = "t::VARCHAR || ':' || j::VARCHAR"
DIRECTIONS_SQL = f"""directions AS (
  SELECT t, list(2 * ({md5_sql(_JT)} + 0.5) / 4294967296.0 - 1 ORDER BY j)::DOUBLE[] AS r
  FROM range(5) AS ts(t), range(64) AS js(j) GROUP BY t)"""
_HASHED_SQL = f"""WITH {_VECTORS},
{DIRECTIONS_SQL},
lengths AS (SELECT unnest([0.5, 1.0, 3.0])::DOUBLE AS bucket_length),
hashed AS (SELECT id, vec, t, bucket_length,
             floor(list_dot_product(vec, r) / bucket_length)::BIGINT AS bucket
           FROM v, directions, lengths),
met AS (SELECT bucket_length, a.id, b.id AS neighbour_id, min(t) AS first_table
        FROM hashed a JOIN hashed b USING (bucket_length, t, bucket)
        WHERE a.id <> b.id GROUP BY ALL),
near AS (SELECT met.*, {_EUCLIDEAN} AS distance
         FROM met JOIN v a ON a.id = met.id JOIN v b ON b.id = met.neighbour_id)"""
_FIXED_SQL = "first_table < 3 AND bucket_length = 0.5 AND distance < 1.25"
_FIXED_TOP = f"""{_HASHED_SQL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, neighbour_id) AS rank
           FROM near WHERE {_FIXED_SQL}),
top AS (SELECT * FROM ranked WHERE rank <= 5)"""
_TRUTH_SQL = f"""
all_ranked AS (SELECT a.id, b.id AS neighbour_id, row_number() OVER (
    PARTITION BY a.id ORDER BY {_EUCLIDEAN}, b.id) AS rank FROM v a JOIN v b ON a.id <> b.id),
truth AS (SELECT id, list(neighbour_id) AS found FROM all_ranked WHERE rank <= 5 GROUP BY id)"""
_IOU_SQL = """CASE WHEN p.found IS NULL THEN 0.0 ELSE len(list_intersect(truth.found, p.found))
    / len(list_distinct(list_concat(truth.found, p.found)))::DOUBLE END"""


@query("J3", f"""{_HASHED_SQL}
SELECT id AS id_a, neighbour_id AS id_b, round(distance, 9) AS distance
FROM near WHERE {_FIXED_SQL} AND id < neighbour_id""")
def approx_similarity_join(spark, sf_dir):
    pairs = lsh.approx_similarity_join(
        embeddings(spark, sf_dir), "id", "vec", FIXED, projections=DIRECTIONS
    )
    return pairs.withColumn("distance", F.round("distance", 9))


@query("M8 J3 W1", f"""{_FIXED_TOP}
SELECT id, neighbour_id, round(distance, 9) AS distance, rank FROM top""")
def lsh_neighbours(spark, sf_dir):
    return _long(lsh.lsh_neighbours(
        embeddings(spark, sf_dir), "id", "vec", FIXED, projections=DIRECTIONS
    ))


@query("M8 J3")
def lsh_neighbours_random_directions(spark, sf_dir):
    return _long(lsh.lsh_neighbours(embeddings(spark, sf_dir), "id", "vec", FIXED))


def _truth(spark, sf_dir):
    rows = embeddings(spark, sf_dir)
    return rows, lsh.with_truth(rows, "id", nb.exact_neighbours(rows, "id", "vec"))


@query("M9 X8 U3", f"""{_FIXED_TOP}, {_TRUTH_SQL},
p AS (SELECT id, list(neighbour_id) AS found FROM top GROUP BY id)
SELECT truth.id, round({_IOU_SQL}, 9) AS iou FROM truth LEFT JOIN p USING (id)""")
def overlap_scores(spark, sf_dir):
    rows, truth = _truth(spark, sf_dir)
    near = lsh.lsh_neighbours(rows, "id", "vec", FIXED, projections=DIRECTIONS)
    scores = lsh.overlap_scores(truth, nb.neighbour_lists(near, "found"))
    return scores.withColumn("iou", F.round("iou", 9))


@query("M9 A10", f"""{_FIXED_TOP}, {_TRUTH_SQL},
p AS (SELECT id, list(neighbour_id) AS found FROM top GROUP BY id)
SELECT 3 AS num_hash_tables, 1.25::DOUBLE AS distance_threshold, 0.5::DOUBLE AS bucket_length,
  round(avg({_IOU_SQL}), 9) AS iou FROM truth LEFT JOIN p USING (id)""")
def evaluate_lsh(spark, sf_dir):
    rows, truth = _truth(spark, sf_dir)
    result = lsh.evaluate_lsh(rows, "id", "vec", truth, FIXED, projections=DIRECTIONS)
    return result.drop("computation_time").withColumn("iou", F.round("iou", 9))


@query("M10", f"""{_HASHED_SQL}, {_TRUTH_SQL},
sets AS (SELECT * FROM (VALUES (1), (3), (5)) AS a(num_hash_tables),
  (VALUES (1.1::DOUBLE), (1.2::DOUBLE), (1.3::DOUBLE)) AS b(distance_threshold), lengths),
ranked AS (SELECT num_hash_tables, distance_threshold, bucket_length, id, neighbour_id, row_number() OVER (
    PARTITION BY num_hash_tables, distance_threshold, bucket_length, id
    ORDER BY distance, neighbour_id) AS rank
  FROM sets JOIN near USING (bucket_length)
  WHERE first_table < num_hash_tables AND distance < distance_threshold),
p AS (SELECT num_hash_tables, distance_threshold, bucket_length, id, list(neighbour_id) AS found
      FROM ranked WHERE rank <= 5 GROUP BY ALL)
SELECT num_hash_tables, distance_threshold, bucket_length, round(avg({_IOU_SQL}), 9) AS iou
FROM sets CROSS JOIN truth LEFT JOIN p USING (num_hash_tables, distance_threshold, bucket_length, id)
GROUP BY ALL""")
def search_lsh(spark, sf_dir):
    rows, truth = _truth(spark, sf_dir)
    results = lsh.search_lsh(rows, "id", "vec", truth, GRID, projections=DIRECTIONS)
    return results.drop("computation_time").withColumn("iou", F.round("iou", 9))


@query("M10 O6")
def search_lsh_random_directions(spark, sf_dir):
    rows, truth = _truth(spark, sf_dir)
    return lsh.best_then_fastest(lsh.search_lsh(rows, "id", "vec", truth, GRID))


# Events summed up in the shape of a search result, for the operators that rank one.
_RESULTS_SQL = """WITH results AS (
  SELECT CAST(1 + 2 * (user_id % 3) AS INTEGER) AS num_hash_tables,
    CASE event_type WHEN 'click' THEN 0.3 WHEN 'view' THEN 0.5 ELSE 0.9 END::DOUBLE
      AS distance_threshold,
    CASE WHEN user_id % 2 = 0 THEN 0.5 ELSE 1.0 END::DOUBLE AS bucket_length,
    floor(avg(value)) / 100.0 AS iou, count(*)::DOUBLE AS computation_time
  FROM events GROUP BY 1, 2, 3)"""


def _results(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    threshold = F.when(F.col("event_type") == "click", 0.3).when(
        F.col("event_type") == "view", 0.5
    ).otherwise(0.9)
    return events.groupBy(
        (1 + 2 * (F.col("user_id") % 3)).cast("int").alias("num_hash_tables"),
        threshold.alias("distance_threshold"),
        F.when(F.col("user_id") % 2 == 0, 0.5).otherwise(1.0).alias("bucket_length"),
    ).agg(
        (F.floor(F.avg("value")) / 100.0).alias("iou"),
        F.count(F.lit(1)).cast("double").alias("computation_time"),
    )


_SET_ORDER = "num_hash_tables, distance_threshold, bucket_length"


@query("O5", f"{_RESULTS_SQL} SELECT * FROM results ORDER BY iou DESC, {_SET_ORDER} LIMIT 3")
def best_params(spark, sf_dir):
    return lsh.best_params(_results(spark, sf_dir))


@query("O5 O4", f"{_RESULTS_SQL} SELECT * FROM results")
def best_params_all(spark, sf_dir):
    return lsh.best_params(_results(spark, sf_dir), top=-1)


@query("O6", f"""{_RESULTS_SQL}
SELECT * FROM results ORDER BY iou DESC, computation_time, {_SET_ORDER} LIMIT 1""")
def best_then_fastest(spark, sf_dir):
    return lsh.best_then_fastest(_results(spark, sf_dir))


def _pivot_sql(value: str) -> str:
    cells = ", ".join(
        f"max({value}) FILTER (distance_threshold = {t}) AS \"{t}\"" for t in (0.3, 0.5, 0.9)
    )
    return f"{_RESULTS_SQL} SELECT bucket_length, num_hash_tables, {cells} FROM results GROUP BY 1, 2"


@query("A12", _pivot_sql("iou"))
def grid_pivot_iou(spark, sf_dir):
    return lsh.grid_pivot(_results(spark, sf_dir), "iou", list(lsh.DISTANCE_THRESHOLDS))


@query("A12", _pivot_sql("computation_time"))
def grid_pivot_time(spark, sf_dir):
    return lsh.grid_pivot(_results(spark, sf_dir), "computation_time", list(lsh.DISTANCE_THRESHOLDS))
