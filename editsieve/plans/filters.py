"""Queries over the Bloom filter of bot accounts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bloom, changes as ch, evaluation as ev
from ..streaming.registry import active_accused
from .events import _FLAGS_SQL, metrics_sql, scratch, windows_as_seconds, windows_sql
from .registry import query
from .views import SPLIT_SECONDS, changes, md5_sql, with_changes


def _labelled(spark, sf_dir, part=None):
    return ch.label_from_flag(changes(spark, sf_dir, part))


def trained(spark, sf_dir, fpr: float = bloom.DEFAULT_FPR) -> bloom.BloomTables:
    return bloom.bloom_build(_labelled(spark, sf_dir, "train"), fpr)


def sizing_sql(n: str = "n", p: str = "0.1") -> str:
    return f"""greatest(1, CAST(floor(-{n} * ln({p}) / (ln(2) * ln(2))) AS BIGINT)) AS size"""


_FILTER_SQL = f""",
train AS (SELECT DISTINCT "user" FROM ch WHERE bot AND "timestamp" < {SPLIT_SECONDS}),
sized AS (SELECT count(*) AS n, {sizing_sql('count(*)')} FROM train),
par AS (SELECT n, size, CASE WHEN n = 0 THEN 1
          ELSE greatest(1, CAST(floor(size / n::DOUBLE * ln(2)) AS BIGINT)) END AS k FROM sized),
seeds AS (SELECT unnest(range(0, k)) AS seed, size, k FROM par),
bits AS (SELECT DISTINCT {md5_sql("CAST(seed AS VARCHAR) || ':' || \"user\"", 15)} % size AS bit
         FROM train, seeds),
keys AS (SELECT DISTINCT "user" FROM ch),
hits AS (SELECT "user", min(CASE WHEN b.bit IS NULL THEN 0 ELSE 1 END) AS prediction
         FROM (SELECT "user", {md5_sql("CAST(seed AS VARCHAR) || ':' || \"user\"", 15)} % size AS bit
               FROM keys, seeds) a LEFT JOIN bits b USING (bit) GROUP BY "user"),
looked_up AS (SELECT ch.*, prediction FROM ch JOIN hits USING ("user")
              WHERE "timestamp" >= {SPLIT_SECONDS})"""


@query("B1 A8", with_changes(f"""{_FILTER_SQL}
SELECT size, CAST(k AS INTEGER) AS hash_count, n AS capacity, 0.1::DOUBLE AS false_positive_rate,
  n AS inserted_count FROM par"""))
def bloom_params(spark, sf_dir):
    users = ch.distinct_positive_users(_labelled(spark, sf_dir, "train"))
    return bloom.bloom_params_table(users).drop("hasher")


@query("B1", """
WITH shapes AS (
  SELECT event_type, count(DISTINCT user_id) AS n FROM events GROUP BY event_type),
forward AS (SELECT event_type, n, p, greatest(1, CAST(floor(-n * ln(p) / (ln(2) * ln(2))) AS BIGINT)) AS size
            FROM shapes, (VALUES (0.1::DOUBLE), (0.01::DOUBLE)) AS rates(p)),
hashed AS (SELECT *, greatest(1, CAST(floor(size / n::DOUBLE * ln(2)) AS BIGINT)) AS k FROM forward),
back AS (SELECT *, greatest(1, CAST(floor(size / k::DOUBLE * ln(2)) AS BIGINT)) AS capacity FROM hashed)
SELECT event_type, n, p, size, CAST(k AS INTEGER) AS hash_count, capacity,
  round(exp(-size / capacity::DOUBLE * ln(2) * ln(2)), 9) AS false_positive_rate FROM back""")
def bloom_sizing_both_ways(spark, sf_dir):
    shapes = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").agg(
        F.countDistinct("user_id").alias("n")
    ).withColumn("p", F.explode(F.array(F.lit(0.1), F.lit(0.01))))
    size, hashes = bloom.bloom_sizing(F.col("n"), F.col("p"))
    forward = shapes.withColumn("size", size).withColumn("hash_count", hashes)
    # the number of hashes is derived from the size column's own expression, so it is kept
    capacity, fpr = bloom.bloom_inverse_sizing(F.col("size"), F.col("hash_count"))
    return forward.withColumn("capacity", capacity).withColumn(
        "false_positive_rate", F.round(fpr, 9)
    )


@query("B2", with_changes(f"{_FILTER_SQL} SELECT bit FROM bits"))
def bloom_bits(spark, sf_dir):
    return bloom.bloom_bits(trained(spark, sf_dir).words)


@query("B2", with_changes(f"""{_FILTER_SQL}
SELECT bit // 64 AS word, count(*) AS set_bits FROM bits GROUP BY 1"""))
def bloom_words(spark, sf_dir):
    words = trained(spark, sf_dir).words
    return words.select("word", F.bit_count("bits").cast("bigint").alias("set_bits"))


@query("B3", with_changes(f'{_FILTER_SQL} SELECT id, "user", prediction FROM looked_up'))
def bloom_lookup(spark, sf_dir):
    found = bloom.bloom_lookup(changes(spark, sf_dir, "validation"), trained(spark, sf_dir))
    return found.select("id", "user", "prediction")


@query("B3", with_changes(f'{_FILTER_SQL} SELECT id, "user", prediction FROM looked_up'))
def bloom_lookup_large_filter(spark, sf_dir):
    """The way for filters beyond the broadcast bound, forced here."""
    found = bloom.bloom_lookup(
        changes(spark, sf_dir, "validation"), trained(spark, sf_dir), broadcast_words=0
    )
    return found.select("id", "user", "prediction")


@query("J5", with_changes(f'{_FILTER_SQL} SELECT id, "user" FROM looked_up WHERE prediction = 0'))
def membership_filter(spark, sf_dir):
    kept = bloom.membership_filter(changes(spark, sf_dir, "validation"), trained(spark, sf_dir))
    return kept.select("id", "user")


_EXACT_SQL = f"""
SELECT id, "user" FROM ch WHERE "timestamp" >= {SPLIT_SECONDS} AND "user" {{}} IN
  (SELECT "user" FROM ch WHERE bot AND "timestamp" < {SPLIT_SECONDS})"""


@query("J5", with_changes(_EXACT_SQL.format("NOT")))
def exact_anti_membership(spark, sf_dir):
    return bloom.exact_membership_filter(
        changes(spark, sf_dir, "validation"), changes(spark, sf_dir, "train").filter("bot")
    ).select("id", "user")


@query("J5", with_changes(_EXACT_SQL.format("")))
def exact_semi_membership(spark, sf_dir):
    return bloom.exact_membership_filter(
        changes(spark, sf_dir, "validation"), changes(spark, sf_dir, "train").filter("bot"), keep_members=True
    ).select("id", "user")


@query("A2 A3 A5 A8 B1 B2 B3 T2", with_changes(f"""{_FILTER_SQL},
flags AS (SELECT *, {_FLAGS_SQL} FROM looked_up), windows AS ({windows_sql('flags')})
SELECT *, {metrics_sql(1)} FROM windows"""))
def filter_metrics(spark, sf_dir):
    """Train on the first half of the events, look up the second, report sliding windows."""
    found = bloom.bloom_lookup(changes(spark, sf_dir, "validation"), trained(spark, sf_dir))
    return windows_as_seconds(ev.derive_metrics(ev.windowed_confusion(found)))


@query("J6 A8", with_changes(f"""{_FILTER_SQL},
triggered AS (SELECT DISTINCT "user" FROM looked_up WHERE prediction = 1),
val AS (SELECT DISTINCT "user" FROM looked_up WHERE bot)
SELECT (SELECT count(*) FROM triggered) AS triggered_users,
  (SELECT count(*) FROM train) AS train_bots, (SELECT count(*) FROM val) AS validation_bots,
  (SELECT count(*) FROM val WHERE "user" IN (FROM train)) AS known_validation_bots,
  (SELECT count(*) FROM val WHERE "user" NOT IN (FROM train)) AS new_validation_bots,
  (SELECT count(*) FROM triggered WHERE "user" IN (FROM val)) AS caught_bots,
  (SELECT count(*) FROM triggered WHERE "user" NOT IN (FROM val)) AS wrongly_triggered"""))
def account_overlap(spark, sf_dir):
    validation = changes(spark, sf_dir, "validation")
    predicted = bloom.bloom_lookup(validation, trained(spark, sf_dir))
    return ch.account_overlap(predicted, changes(spark, sf_dir, "train"), validation)


@query("B5", with_changes(f"""{_FILTER_SQL}
SELECT count(*) AS unseen_keys, coalesce(avg(prediction), 0.0) AS measured_fpr
FROM hits WHERE "user" NOT IN (FROM train)"""))
def bloom_measured_fpr(spark, sf_dir):
    members = ch.distinct_positive_users(_labelled(spark, sf_dir, "train"))
    return bloom.bloom_measured_fpr(changes(spark, sf_dir), members, trained(spark, sf_dir))


@query("B6", with_changes(f"""{_FILTER_SQL}
SELECT size, CAST(k AS INTEGER) AS hash_count, n AS capacity, n AS inserted_count,
  (SELECT count(*) FROM bits) AS set_bits, (SELECT count(*) FROM bits) / size::DOUBLE AS fill_ratio,
  (SELECT count(*) FROM train) >= n AS at_capacity FROM par"""))
def bloom_health(spark, sf_dir):
    return bloom.bloom_health(trained(spark, sf_dir))


@query("B4", with_changes(f"{_FILTER_SQL} SELECT bit, 1::BIGINT AS version FROM bits"))
def bloom_round_trip(spark, sf_dir):
    """Bits of a filter that was saved over an older version and read back."""
    path = scratch(spark, "filter")
    tables = trained(spark, sf_dir)
    bloom.bloom_save(bloom.bloom_reset(spark, tables.params), path)
    bloom.bloom_save(tables, path)
    version = bloom.bloom_newest_version(spark, path)
    loaded = bloom.bloom_load(spark, path, version)
    return bloom.bloom_bits(loaded.words).withColumn("version", F.lit(version).cast("bigint"))


_PRESET = 5000


@query("B1 B2", with_changes(f""",
par AS (SELECT {sizing_sql(str(_PRESET))}), shape AS (
  SELECT size, greatest(1, CAST(floor(size / {_PRESET}::DOUBLE * ln(2)) AS BIGINT)) AS k FROM par),
seeds AS (SELECT unnest(range(0, k)) AS seed, size FROM shape)
SELECT DISTINCT {md5_sql("CAST(seed AS VARCHAR) || ':' || \"user\"", 15)} % size AS bit
FROM (SELECT DISTINCT "user" FROM ch WHERE bot), seeds"""))
def bloom_merge(spark, sf_dir):
    """Two filters of one preset capacity, filled from the two halves of the events and joined."""
    empty = bloom.bloom_preset(spark, _PRESET)
    halves = [
        bloom.bloom_insert(empty, changes(spark, sf_dir, part).filter("bot")) for part in ("train", "validation")
    ]
    return bloom.bloom_bits(bloom.bloom_merge(*halves).words)


@query("B2 B6", with_changes(""",
inserted AS (SELECT count(DISTINCT "user") AS n FROM ch WHERE bot)
SELECT capacity, n AS inserted_count, n >= capacity AS at_capacity
FROM inserted, (VALUES (1::BIGINT), (1000000::BIGINT)) AS presets(capacity)"""))
def bloom_capacity(spark, sf_dir):
    """Filters of a small and a large preset capacity with the same keys in them."""
    bots = changes(spark, sf_dir).filter("bot")
    health = [bloom.bloom_health(bloom.bloom_insert(bloom.bloom_preset(spark, n), bots)) for n in (1, 1_000_000)]
    return health[0].unionByName(health[1]).select("capacity", "inserted_count", "at_capacity")


@query("T4 D3", with_changes(""", seen AS (
  SELECT "user", max("timestamp") AS last_accused FROM ch WHERE bot GROUP BY 1)
SELECT "user", last_accused FROM seen
WHERE last_accused >= (SELECT max(last_accused) FROM seen) - 259200"""))
def forgetting_registry(spark, sf_dir):
    accused = changes(spark, sf_dir).filter("bot").select(
        "user", F.timestamp_seconds("timestamp").alias("timestamp")
    )
    active = active_accused(accused, forget_seconds=3 * 86400)
    return active.select("user", F.unix_seconds("last_accused").alias("last_accused"))
