"""Queries over texts: cleaning, tokens, features, the classifier, both similarity pipelines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as ft, vectors as fv
from ..functions.hashing import md5_number
from ..operators import classifier as cl, evaluation as ev, lsh, neighbours as nb, texts as tx
from ..operators.numbering import ordered_split
from ..operators.skew import lookup_join
from ..schemas import ARTICLES_SCHEMA
from ..session import cut_lineage
from ..sources import texts as src
from .events import scratch
from .registry import query
from .similarity import DIRECTIONS, DIRECTIONS_SQL
from .views import md5_sql, spread, table


def documents(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "lang")
    return spread(rows)


_CLEAN = r"regexp_replace(text, '[^a-zA-Z\x{0400}-\x{04FF}]', ' ', 'g')"
_SPLIT = rf"string_split_regex(lower({_CLEAN}), '\s')"
# Words of at least a fifth of a language's documents stand in for a stopword list.
_LIST_SQL = f"""words AS (
  SELECT lang, unnest(list_distinct({_SPLIT})) AS word FROM documents),
sizes AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
frequent AS (SELECT lang, word FROM words JOIN sizes USING (lang)
  WHERE trim(word) <> '' GROUP BY lang, word, n HAVING count(*) * 5 >= n)"""


def frequent_words(spark, sf_dir):
    rows = documents(spark, sf_dir)
    tokens = ft.array_distinct_tokens(F.col("text"))
    counts = (
        tx.token_rows(rows.select("lang", tokens.alias("words")), "words", "word", "lang")
        .filter(F.trim("word") != "")
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("in_documents"))
    )
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    joined = lookup_join(counts, sizes, ["lang"], "inner")
    # both lists are taken from it
    return cut_lineage(joined.filter(F.col("in_documents") * 5 >= F.col("n")).select("lang", "word"))


def stopwords(spark, sf_dir):
    lists = frequent_words(spark, sf_dir)
    return src.union_stopwords(
        lists.filter("lang = 'en'").select("word"), lists.filter("lang <> 'en'").select("word")
    )


@query("U1", f"WITH {_LIST_SQL} SELECT DISTINCT word FROM frequent")
def stopword_union(spark, sf_dir):
    return stopwords(spark, sf_dir)


@query("S13 U1", f"WITH {_LIST_SQL} SELECT DISTINCT word FROM frequent")
def load_stopwords(spark, sf_dir):
    path = scratch(spark, "stopwords")
    lists = frequent_words(spark, sf_dir)
    lists.filter("lang = 'en'").select("word").write.text(f"{path}/en")
    lists.filter("lang <> 'en'").select("word").write.text(f"{path}/other")
    return src.load_stopwords(spark, [f"{path}/en", f"{path}/other"])


@query("X1", f"SELECT doc_id AS id, md5({_CLEAN}) AS cleaned FROM documents")
def strip_symbols(spark, sf_dir):
    return documents(spark, sf_dir).select("id", F.md5(ft.strip_symbols(F.col("text"))).alias("cleaned"))


@query("X1 X2", f"""
SELECT doc_id AS id, len({_SPLIT}) AS n_tokens,
  md5(array_to_string({_SPLIT}, '|')) AS tokens FROM documents""")
def tokenize(spark, sf_dir):
    tokens = ft.tokenize(ft.strip_symbols(F.col("text")))
    return documents(spark, sf_dir).select(
        "id", F.size(tokens).cast("bigint").alias("n_tokens"),
        F.md5(F.array_join(tokens, "|")).alias("tokens"),
    )


@query("X10", r"""
SELECT doc_id AS id, len(regexp_extract_all(text, '\S+')) AS n_tokens,
  md5(array_to_string(regexp_extract_all(text, '\S+'), '|')) AS tokens FROM documents""")
def whitespace_tokens(spark, sf_dir):
    tokens = ft.whitespace_tokens(F.col("text"))
    return documents(spark, sf_dir).select(
        "id", F.size(tokens).cast("bigint").alias("n_tokens"),
        F.md5(F.array_join(tokens, "|")).alias("tokens"),
    )


_KEPT_SQL = f"""WITH {_LIST_SQL},
split AS (SELECT doc_id AS id, {_SPLIT} AS tokens FROM documents),
places AS (SELECT id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM split),
kept AS (SELECT * FROM places
         WHERE trim(token) <> '' AND token NOT IN (SELECT word FROM frequent)),
stemmed AS (SELECT id, pos, CASE WHEN length(token) > 4
    THEN regexp_replace(token, '(ing|ed|es|s)$', '') ELSE token END AS token FROM kept)"""


def _lists_sql(source: str) -> str:
    return f"""{_KEPT_SQL}
SELECT id, count(*) AS n_tokens, md5(string_agg(token, '|' ORDER BY pos)) AS tokens
FROM {source} GROUP BY id"""


def _listed(df):
    return df.select(
        "id", F.size("tokens").cast("bigint").alias("n_tokens"),
        F.md5(F.array_join("tokens", "|")).alias("tokens"),
    )


def split_tokens(spark, sf_dir):
    rows = documents(spark, sf_dir)
    return rows.withColumn("tokens", ft.letter_tokens(F.col("text")))


def stems(spark, sf_dir, more=None):
    """Stem of each distinct token of the documents, and of ``more`` texts, by a rule on its ending."""
    words = tx.token_rows(split_tokens(spark, sf_dir), "tokens")
    if more is not None:
        words = words.unionByName(tx.token_rows(more.select(ft.letter_tokens(F.col("text")).alias("tokens")), "tokens"))
    words = words.distinct()
    stem = F.when(
        F.length("token") > 4, F.regexp_replace("token", "(ing|ed|es|s)$", "")
    ).otherwise(F.col("token"))
    return words.select("token", stem.alias("stem"))


@query("X3 X5", _lists_sql("kept"))
def remove_noise(spark, sf_dir):
    kept = tx.remove_noise(split_tokens(spark, sf_dir), "tokens", stopwords(spark, sf_dir))
    return _listed(tx.drop_empty(kept, "tokens"))


@query("X3 X4 X5", _lists_sql("stemmed"))
def stem_tokens(spark, sf_dir):
    cleaned = tx.clean_tokens(
        documents(spark, sf_dir), "text", "tokens", stopwords(spark, sf_dir), stems(spark, sf_dir), columns=["id"]
    )
    return _listed(cleaned)


@query("M2", f"""{_KEPT_SQL},
counts AS (SELECT id, token AS term, count(*) AS tf FROM kept GROUP BY 1, 2),
frequencies AS (SELECT term, count(*) AS df FROM counts GROUP BY term),
total AS (SELECT count(DISTINCT id) AS n FROM kept)
SELECT id, term, tf, df, round(tf * ln((n + 1.0) / (df + 1)), 9) AS tfidf
FROM counts JOIN frequencies USING (term), total""")
def tfidf_terms(spark, sf_dir):
    tokens = tx.clean_tokens(documents(spark, sf_dir), "text", "tokens", stopwords(spark, sf_dir))
    return tx.tfidf_terms(tokens, "id").withColumn("tfidf", F.round("tfidf", 9))


@query("M1 M2")
def tfidf_features(spark, sf_dir):
    rows = tx.add_features(
        documents(spark, sf_dir), "text", method="tfidf", stopwords=stopwords(spark, sf_dir), columns=["id"]
    )
    return rows.select("id", F.round(F.aggregate(
        nb.vector_to_array("features"), F.lit(0.0), lambda total, x: total + x
    ), 6).alias("weight"))


@query("M1 M3")
def word2vec_features(spark, sf_dir):
    rows = tx.add_features(documents(spark, sf_dir), "text", stopwords=stopwords(spark, sf_dir), columns=["id"])
    return rows.select("id", F.size(nb.vector_to_array("features")).alias("width"))


@query("M3 X9 X11", f"{_KEPT_SQL} SELECT DISTINCT id, 64::BIGINT AS width, true AS is_mean FROM kept")
def word2vec_means(spark, sf_dir):
    """A text's vector is the mean of the vectors of its words, by MLlib's model and by the engine's own pooling."""
    tokens = tx.clean_tokens(documents(spark, sf_dir), "text", "tokens", stopwords(spark, sf_dir), columns=["id"])
    tokens = tx.written_lists(tokens, "tokens", " ")
    model = tx.fit_word2vec(tokens)
    own = cl.embed_tokens(tokens, "id", "tokens", cl.word_vectors(model))
    both = model.transform(tokens).select("id", nb.vector_to_array("features").alias("features")).join(own, "id")
    apart = F.aggregate(F.zip_with("features", "embedding", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda x, y: F.greatest(x, y))
    return both.select("id", F.size("features").cast("bigint").alias("width"), (apart < 1e-5).alias("is_mean"))


@query("P9 P10 O2", """
WITH kept AS (SELECT text AS name, min(doc_id) AS first_id FROM documents GROUP BY text)
SELECT row_number() OVER (ORDER BY first_id) - 1 AS id, md5(name) AS name FROM kept""")
def clean_listings(spark, sf_dir):
    rows = documents(spark, sf_dir).withColumnRenamed("text", "name")
    return src.clean_listings(rows).withColumn("name", F.md5("name"))


@query("P9 O4", """
WITH first AS (SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 100),
kept AS (SELECT text AS name, min(doc_id) AS first_id FROM first GROUP BY text)
SELECT row_number() OVER (ORDER BY first_id) - 1 AS id, md5(name) AS name FROM kept""")
def clean_first_listings(spark, sf_dir):
    rows = documents(spark, sf_dir).withColumnRenamed("text", "name")
    return src.clean_listings(rows, n=100).withColumn("name", F.md5("name"))


def article_responses(spark, sf_dir):
    """Conversations as responses: one item holding up to a hundred turns as articles."""
    article = F.struct(
        F.col("text").alias("article"), F.length("text").cast("bigint").alias("views"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("rank"),
    )
    grouped = table(spark, sf_dir, "conversations").groupBy(
        "conv_id", F.floor(F.col("turn") / 100)
    ).agg(
        F.collect_list(article).alias("articles")
    )
    return grouped.select(F.array(F.struct("articles")).alias("items"))


@query("S12", """
SELECT text AS article, length(text) AS views, conv_id * 1000 + turn AS rank FROM conversations""")
def articles_from_json(spark, sf_dir):
    body = article_responses(spark, sf_dir).select(F.to_json(F.struct("items")).alias("value"))
    parsed = body.select(F.from_json("value", ARTICLES_SCHEMA).alias("response"))
    return src.articles_from_json(parsed.select("response.items"))


# Word vectors that SQL can compute: four numbers per token.
def token_vectors(tokens):
    words = tx.token_rows(tokens, "tokens").distinct()
    numbers = [
        md5_number(F.concat(F.lit(f"{i}:"), F.col("token"))) / F.lit(2.0**32) for i in range(4)
    ]
    return words.select("token", F.array(*numbers).alias("vector"))


_EMBED_SQL = rf"""WITH tokens AS (
  SELECT doc_id AS id, unnest(regexp_extract_all(text, '\S+')) AS token FROM documents),
embedded AS (SELECT id, {', '.join(
    f"avg({md5_sql(chr(39) + str(i) + ':' + chr(39) + ' || token')} / 4294967296.0) AS e{i}"
    for i in range(4))} FROM tokens GROUP BY id)"""


@query("X9 X10 X11", f"""{_EMBED_SQL}
SELECT id, {', '.join(f'round(e{i}, 9) AS e{i}' for i in range(4))} FROM embedded""")
def embed_tokens(spark, sf_dir):
    tokens = documents(spark, sf_dir).select("id", ft.whitespace_tokens(F.col("text")).alias("tokens"))
    pooled = cl.embed_tokens(tokens, "id", "tokens", token_vectors(tokens))
    return pooled.select("id", *[
        F.round(F.col("embedding")[i], 9).alias(f"e{i}") for i in range(4)
    ])


@query("X9", f"""
WITH v AS (SELECT label, embedding::DOUBLE[] AS vec FROM embeddings),
parts AS (SELECT label, unnest(vec) AS x, generate_subscripts(vec, 1) AS pos FROM v)
SELECT label, pos, round(avg(x), 9) AS mean FROM parts GROUP BY label, pos""")
def mean_vector_by_label(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(
        "label", F.posexplode(fv.as_doubles(F.col("embedding"))).alias("pos", "x")
    )
    return rows.groupBy("label", (F.col("pos") + 1).cast("bigint").alias("pos")).agg(
        F.round(F.avg("x"), 9).alias("mean")
    )


@query("X9", """
WITH v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS vec,
    lag(embedding::DOUBLE[]) OVER (ORDER BY vec_id) AS other FROM embeddings)
SELECT id, CASE WHEN other IS NULL THEN round(list_sum(vec), 6)
  ELSE round((list_sum(vec) + list_sum(other)) / 2, 6) END AS mean_sum FROM v""")
def mean_vector_of_two(spark, sf_dir):
    """Mean of each vector and the one before it, with the array expression."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    previous = rows.select((F.col("id") + 1).alias("id"), F.col("embedding").alias("other"))
    both = rows.join(previous, "id", "left")
    mean = fv.mean_vector(F.array_compact(F.array("embedding", "other")), 64)
    return both.select("id", F.round(
        F.aggregate(mean, F.lit(0.0), lambda total, x: total + x), 6
    ).alias("mean_sum"))


_COEFFICIENTS = [((7 * j) % 11 - 5) / 10 for j in range(64)]


@query("M5", """
WITH scored AS (SELECT vec_id AS id, 1 / (1 + exp(-(list_dot_product(embedding::DOUBLE[],
    list_transform(range(64), lambda j: ((7 * j) % 11 - 5) / 10.0)::DOUBLE[]) + 0.05))) AS p
  FROM embeddings)
SELECT id, round(p, 9) AS probability, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS prediction FROM scored""")
def linear_prediction(spark, sf_dir):
    probability, prediction = cl.linear_prediction(F.col("embedding"), _COEFFICIENTS, 0.05)
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.round(probability, 9).alias("probability"),
        prediction.alias("prediction"),
    )


@query("M4 A7", """
SELECT place, true AS is_zero FROM range(65) AS places(place)""")
def classifier_gradient(spark, sf_dir):
    """Slope of the weighted, regularised loss at the fitted model, for each coefficient and, last, the intercept."""
    rows = table(spark, sf_dir, "embeddings").select("embedding", (F.col("label") < 3).cast("int").alias("label"))
    params = cl.ClassifierParams(max_iter=200, weight_type="balanced")
    model = cl.fit_embedded(rows, params)
    weighted = ev.class_weights(rows, "balanced")
    probability, _ = cl.linear_prediction(F.col("embedding"), list(model.coefficients), model.intercept)
    miss = F.col("weight") * (probability - F.col("label"))
    count = len(model.coefficients)
    x = [F.col("embedding")[k].cast("double") for k in range(count)]
    sums = weighted.agg(
        F.sum("weight").alias("total"), F.sum(miss).alias("miss"), *[F.sum(miss * v).alias(f"g{k}") for k, v in enumerate(x)],
        # MLlib penalises coefficients of features of unit spread, which it takes from weighted rows
        *[((F.sum(F.col("weight") * v * v) - F.sum(F.col("weight") * v) ** 2 / F.sum("weight")) / (
            F.sum("weight") - F.sum(F.col("weight") ** 2) / F.sum("weight"))).alias(f"s{k}") for k, v in enumerate(x)],
    )
    slopes = [F.col(f"g{k}") / F.col("total") + params.reg_param * F.col(f"s{k}") * float(c) for k, c in enumerate(model.coefficients)]
    held = sums.select(F.posexplode(F.array(*slopes, F.col("miss") / F.col("total"))).alias("place", "slope"))
    return held.select(F.col("place").cast("bigint").alias("place"), (F.abs("slope") < 1e-4).alias("is_zero"))


def labelled_texts(spark, sf_dir):
    """Documents of low quality stand in for bot edits."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "quality")
    rows = documents(spark, sf_dir).join(labels, "id")
    return rows.select(
        "id", "text", (F.col("quality") == 0).alias("bot"),
        (F.col("quality") == 0).cast("int").alias("label"),
    )


def _learned_vectors(train):
    tokens = train.select(ft.whitespace_tokens(F.col("text")).alias("tokens"))
    return cut_lineage(cl.word_vectors(tx.fit_word2vec(tx.written_lists(tokens, "tokens", " "))))


@query("M4 M5 A13 P11")
def classify_texts(spark, sf_dir):
    train, validation = ordered_split(labelled_texts(spark, sf_dir), ["id"])
    model = cl.fit_classifier(train, _learned_vectors(train), cl.ClassifierParams(weight_type="balanced"))
    return ev.validation_report(model.predict(validation))


@query("M6 A6")
def search_classifier(spark, sf_dir):
    train, validation = ordered_split(labelled_texts(spark, sf_dir), ["id"])
    scores, _ = cl.search_classifier(train, validation, _learned_vectors(train))
    return scores


def _vectors_sql(name: str, source: str, stemmed: str, rounded: bool = True) -> str:
    """Hashed TF-IDF vectors of a table ``source`` (id, text), cleaned as ``clean_tokens`` does."""
    weight = "coalesce(tf, 0) * ln((n + 1.0) / (coalesce(m, 0) + 1))"
    weight = f"round({weight} * 1024) / 1024" if rounded else weight
    return f"""
{name}_places AS (SELECT id, unnest({_SPLIT}) AS token FROM {source}),
{name}_kept AS (SELECT id, {stemmed} AS token FROM {name}_places
  WHERE trim(token) <> '' AND token NOT IN (SELECT word FROM frequent)),
{name}_counts AS (SELECT id, {md5_sql('token')} % 64 AS place, count(*) AS tf FROM {name}_kept GROUP BY 1, 2),
{name}_seen AS (SELECT place, count(*) AS m FROM {name}_counts GROUP BY 1),
{name} AS (SELECT id, list({weight} ORDER BY place)::DOUBLE[] AS vec
  FROM (SELECT DISTINCT id FROM {name}_kept) CROSS JOIN range(64) AS places(place)
  CROSS JOIN (SELECT count(DISTINCT id) AS n FROM {name}_kept)
  LEFT JOIN {name}_counts USING (id, place) LEFT JOIN {name}_seen USING (place) GROUP BY id)"""


_STEM_SQL = "CASE WHEN length(token) > 4 THEN regexp_replace(token, '(ing|ed|es|s)$', '') ELSE token END"


@query("M1 M2 X3 X4", f"""WITH {_LIST_SQL}, docs AS (SELECT doc_id AS id, text FROM documents),
{_vectors_sql('v', 'docs', _STEM_SQL, rounded=False)}
SELECT id, round(unnest(vec), 9) AS weight, generate_subscripts(vec, 1) - 1 AS place FROM v""")
def tfidf_md5_vectors(spark, sf_dir):
    """Whole vectors of all documents, stopwords left out and tokens stemmed."""
    rows = tx.add_features(
        documents(spark, sf_dir), "text", method="tfidf_md5", stopwords=stopwords(spark, sf_dir), stems=stems(spark, sf_dir),
        columns=["id"],
    )
    placed = rows.select("id", F.posexplode("features").alias("place", "weight"))
    return placed.select("id", F.col("place").cast("bigint").alias("place"), F.round("weight", 9).alias("weight"))


def _lists(spark, sf_dir):
    more = table(spark, sf_dir, "conversations").select("text")
    return {"stopwords": stopwords(spark, sf_dir), "stems": cut_lineage(stems(spark, sf_dir, more))}


def _featured(rows, text_col, id_col, method, lists):
    """Rows with their vectors; those that SQL repeats are rounded to 1/1024, so that equal distances are equal there too."""
    rows = tx.add_features(rows, text_col, method=method, id_col=id_col, columns=[id_col], **lists)
    if method == "tfidf_md5":
        rows = rows.withColumn("features", F.transform("features", lambda x: F.round(x * 1024) / 1024))
    return cut_lineage(rows)


def _similarity(rows, text_col, id_col, grid, method, projections=None, **lists):
    """Clean, vectorise, find the exact neighbours, and score every parameter set of the approximate search."""
    featured = _featured(rows, text_col, id_col, method, lists)
    truth = lsh.with_truth(featured, id_col, nb.exact_neighbours(featured, id_col))
    return featured, truth, lsh.search_lsh(featured, id_col, "features", truth, grid, projections=projections)


def _listings(spark, sf_dir):
    return src.clean_listings(documents(spark, sf_dir).withColumnRenamed("text", "name"))


def _articles(spark, sf_dir):
    return src.articles_from_json(article_responses(spark, sf_dir))


@query("M12 P9 M1 M7 M10 O6")
def listing_similarity(spark, sf_dir):
    _, _, results = _similarity(_listings(spark, sf_dir), "name", "id", lsh.default_grid(), "tfidf", **_lists(spark, sf_dir))
    return lsh.best_then_fastest(results)


@query("M13 S12 M1 M7 M10 O6")
def article_similarity(spark, sf_dir):
    _, _, results = _similarity(_articles(spark, sf_dir), "article", "rank", lsh.default_grid(), "word2vec", **_lists(spark, sf_dir))
    return lsh.best_then_fastest(results)


@query("M11")
def transfer_params(spark, sf_dir):
    lists = _lists(spark, sf_dir)
    _, _, results = _similarity(_listings(spark, sf_dir), "name", "id", lsh.default_grid(), "tfidf", **lists)
    other = _featured(_articles(spark, sf_dir), "article", "rank", "tfidf", lists)
    truth = lsh.with_truth(other, "rank", nb.exact_neighbours(other, "rank"))
    return lsh.transfer_params(other, "rank", "features", truth, results)


# The same three over vectors and directions that SQL can compute. Distances are larger than in the default grid.
_GRID = [
    lsh.LshParams(tables, threshold, length) for tables in (1, 3) for threshold in (4.0, 8.0) for length in (1.0, 4.0)
]
_TRUTH = """(SELECT id, list(neighbour_id) AS found FROM (
  SELECT a.id, b.id AS neighbour_id, row_number() OVER (
    PARTITION BY a.id ORDER BY list_distance(a.vec, b.vec), b.id) AS rank FROM {v} a JOIN {v} b ON a.id <> b.id)
  WHERE rank <= 5 GROUP BY id)"""


def _scores_sql(name: str) -> str:
    """IOU of every set of ``_GRID`` over the vectors ``name``, as table ``<name>_scores``."""
    sets = ", ".join(f"({p.num_hash_tables}, {p.distance_threshold}::DOUBLE, {p.bucket_length}::DOUBLE)" for p in _GRID)
    return f"""
{name}_sets AS (SELECT * FROM (VALUES {sets}) AS s(num_hash_tables, distance_threshold, bucket_length)),
{name}_hashed AS (SELECT id, t, bucket_length, floor(list_dot_product(vec, r) / bucket_length)::BIGINT AS bucket
  FROM {name}, directions, (SELECT DISTINCT bucket_length FROM {name}_sets)),
{name}_met AS (SELECT bucket_length, a.id, b.id AS neighbour_id, min(t) AS first_table
  FROM {name}_hashed a JOIN {name}_hashed b USING (bucket_length, t, bucket) WHERE a.id <> b.id GROUP BY ALL),
{name}_near AS (SELECT m.*, list_distance(a.vec, b.vec) AS distance FROM {name}_met m
  JOIN {name} a ON a.id = m.id JOIN {name} b ON b.id = m.neighbour_id),
{name}_ranked AS (SELECT num_hash_tables, distance_threshold, bucket_length, id, neighbour_id, row_number() OVER (
    PARTITION BY num_hash_tables, distance_threshold, bucket_length, id ORDER BY distance, neighbour_id) AS rank
  FROM {name}_sets JOIN {name}_near USING (bucket_length)
  WHERE first_table < num_hash_tables AND distance < distance_threshold),
{name}_found AS (SELECT num_hash_tables, distance_threshold, bucket_length, id, list(neighbour_id) AS found
  FROM {name}_ranked WHERE rank <= 5 GROUP BY ALL),
{name}_truth AS {_TRUTH.format(v=name)},
{name}_scores AS (SELECT num_hash_tables, distance_threshold, bucket_length, round(avg(
    CASE WHEN p.found IS NULL THEN 0.0 ELSE len(list_intersect(truth.found, p.found))
      / len(list_distinct(list_concat(truth.found, p.found)))::DOUBLE END), 9) AS iou
  FROM {name}_sets CROSS JOIN {name}_truth AS truth
  LEFT JOIN {name}_found p USING (num_hash_tables, distance_threshold, bucket_length, id) GROUP BY ALL)"""


_LISTINGS_SQL = """listings AS (SELECT row_number() OVER (ORDER BY first_id) - 1 AS id, text FROM (
  SELECT text, min(doc_id) AS first_id FROM documents WHERE text IS NOT NULL GROUP BY text))"""
_ARTICLES_SQL = "articles AS (SELECT conv_id * 1000 + turn AS id, text FROM conversations)"


def _checked(rows, text_col, id_col, lists):
    featured, truth, results = _similarity(rows, text_col, id_col, _GRID, "tfidf_md5", DIRECTIONS, **lists)
    return featured, truth, results.withColumn("iou", F.round("iou", 9))


@query("M12 M10", f"""WITH {_LIST_SQL}, {DIRECTIONS_SQL}, {_LISTINGS_SQL}, {_vectors_sql('v', 'listings', _STEM_SQL)},
{_scores_sql('v')} SELECT * FROM v_scores""")
def listing_similarity_scores(spark, sf_dir):
    """The whole grid over the listings, with stopwords and stems."""
    _, _, results = _checked(_listings(spark, sf_dir), "name", "id", _lists(spark, sf_dir))
    return results.drop("computation_time")


@query("M13 M10", f"""WITH {_LIST_SQL}, {DIRECTIONS_SQL}, {_ARTICLES_SQL}, {_vectors_sql('v', 'articles', _STEM_SQL)},
{_scores_sql('v')} SELECT * FROM v_scores""")
def article_similarity_scores(spark, sf_dir):
    """The same over the articles."""
    _, _, results = _checked(_articles(spark, sf_dir), "article", "rank", _lists(spark, sf_dir))
    return results.drop("computation_time")


@query("M11 O5", f"""WITH {_LIST_SQL}, {DIRECTIONS_SQL}, {_LISTINGS_SQL}, {_ARTICLES_SQL},
small AS (SELECT * FROM articles ORDER BY id LIMIT (SELECT (count(*) + 4) // 5 FROM articles)),
{_vectors_sql('v', 'small', _STEM_SQL)}, {_scores_sql('v')},
{_vectors_sql('w', 'listings', _STEM_SQL)}, {_scores_sql('w')},
best AS (SELECT num_hash_tables, distance_threshold, bucket_length FROM v_scores
  ORDER BY iou DESC, num_hash_tables, distance_threshold, bucket_length LIMIT 1)
SELECT w_scores.* FROM w_scores JOIN best USING (num_hash_tables, distance_threshold, bucket_length)""")
def transfer_params_scores(spark, sf_dir):
    """The best set of the first fifth of the articles, scored on the whole, larger second dataset."""
    lists = _lists(spark, sf_dir)
    articles = _articles(spark, sf_dir)
    fifth = articles.orderBy("rank").limit(-(-articles.count() // 5))
    _, _, results = _checked(fifth, "article", "rank", lists)
    best = lsh.best_params(results, top=1).withColumn("computation_time", F.lit(0.0))
    other = _featured(_listings(spark, sf_dir), "name", "id", "tfidf_md5", lists)
    truth = lsh.with_truth(other, "id", nb.exact_neighbours(other, "id"))
    scored = lsh.transfer_params(other, "id", "features", truth, best, projections=DIRECTIONS)
    return scored.drop("computation_time").withColumn("iou", F.round("iou", 9))
