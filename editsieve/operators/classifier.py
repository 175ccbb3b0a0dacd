"""Texts to mean word vectors to a weighted logistic regression, and its parameter search."""

from __future__ import annotations

import itertools
from dataclasses import asdict, dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import Word2VecModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import text as ft
from ..functions.vectors import dot
from ..session import cut_lineage, is_written
from .evaluation import class_weights, f1_with_precision_floor, validation_report
from .skew import BROADCAST_ROWS, fits, lookup_join
from .texts import token_rows
from .wordvectors import SpreadWord2VecModel, vector_sums

# The searched grid and the precision floor of the search.
MAX_ITERATIONS = (5, 10)
REGULARIZATION = (0.1, 0.3)
ELASTIC_NET = (0.0, 0.3)
WEIGHT_TYPES = (None, "balanced", "sqrt")
SEARCH_FLOOR = 0.8


@dataclass(frozen=True)
class ClassifierParams:
    max_iter: int = 10
    reg_param: float = 0.1
    elastic_net_param: float = 0.0
    weight_type: str | None = None

    def __post_init__(self):
        if self.weight_type not in WEIGHT_TYPES:
            raise ValueError(f"weight type must be one of {WEIGHT_TYPES}, not {self.weight_type!r}")

    def estimator(self) -> LogisticRegression:
        return LogisticRegression(
            maxIter=self.max_iter, regParam=self.reg_param, elasticNetParam=self.elastic_net_param,
            featuresCol="features", labelCol="label", weightCol="weight",
        )


def default_grid() -> list[ClassifierParams]:
    return [
        ClassifierParams(*combination) for combination in
        itertools.product(MAX_ITERATIONS, REGULARIZATION, ELASTIC_NET, WEIGHT_TYPES)
    ]


def word_vectors(model: Word2VecModel | SpreadWord2VecModel) -> DataFrame:
    """``token`` and ``vector`` (array of doubles) of a fitted word model."""
    if isinstance(model, SpreadWord2VecModel):
        return model.vectors
    return model.getVectors().select(
        F.col("word").alias("token"), vector_to_array("vector").alias("vector")
    )


def embed_tokens(
    df: DataFrame, id_col: str, tokens_col: str, vectors: DataFrame, name: str = "embedding", glue: str | None = None
) -> DataFrame:
    """``id_col`` and the mean of the word vectors of its tokens; no row for a text without token.

    A token without a vector counts as zeros. Few vectors are broadcast: tokens are counted per
    text first, and each dimension is a sum that is combined before the shuffle. Of many, those
    of the words of a bundle of texts are sent to it; ``glue`` is what no token holds, if that is known.
    """
    if not is_written(vectors):
        vectors = cut_lineage(vectors.select("token", "vector"))
    first = vectors.select(F.size("vector").alias("width")).first()
    width = first["width"] if first else 0  # without word vectors the means have no dimension
    if not fits(vectors, BROADCAST_ROWS):
        sums = vector_sums(df, id_col, tokens_col, vectors, width, glue).filter(F.col("_tokens") > 0)
        totals = [F.sum(F.col("_sums")[i]).alias(f"_s{i}") for i in range(width)]
        pooled = sums.groupBy(id_col).agg(F.sum("_tokens").alias("_tokens"), *totals)
        return pooled.select(id_col, F.array(*[F.col(f"_s{i}") / F.col("_tokens") for i in range(width)]).alias(name))
    counts = cut_lineage(
        token_rows(df, tokens_col, "token", id_col)
        .groupBy(id_col, "token")
        .agg(F.count(F.lit(1)).alias("_times"))
    )
    found = counts.join(F.broadcast(vectors), "token", "left")
    sums = [F.sum(F.col("_times") * F.col("vector")[i]).alias(f"_s{i}") for i in range(width)]
    pooled = found.groupBy(id_col).agg(F.sum("_times").alias("_tokens"), *sums)
    mean = F.array(*[
        F.coalesce(F.col(f"_s{i}"), F.lit(0.0)) / F.col("_tokens") for i in range(width)
    ])
    return pooled.select(id_col, mean.cast("array<double>").alias(name))


def embed_texts(
    df: DataFrame, text_col: str, vectors: DataFrame, id_col: str = "id", name: str = "embedding"
) -> DataFrame:
    """Every row with the mean word vector of its whole text; null without any token."""
    tokens = df.select(id_col, ft.whitespace_tokens(F.col(text_col)).alias("_tokens"))
    return df.join(embed_tokens(tokens, id_col, "_tokens", vectors, name, " "), id_col, "left")


def embed_repeated_texts(
    df: DataFrame, text_col: str, vectors: DataFrame, name: str = "embedding"
) -> DataFrame:
    """``embed_texts`` for rows without an id: each distinct text is embedded once.

    A text that many rows share is joined back by broadcast.
    """
    texts = df.select(F.col(text_col).alias("_text")).filter(F.col("_text").isNotNull()).distinct()
    tokens = texts.select("_text", ft.whitespace_tokens(F.col("_text")).alias("_tokens"))
    embedded = embed_tokens(tokens, "_text", "_tokens", vectors, name)
    return lookup_join(df.withColumn("_text", F.col(text_col)), embedded, ["_text"], "left").drop("_text")


@dataclass(frozen=True)
class TextClassifier:
    """Fitted model with the word vectors it needs."""

    params: ClassifierParams
    model: LogisticRegressionModel
    vectors: DataFrame

    def predict(
        self, df: DataFrame, text_col: str = "text", id_col: str = "id", name: str = "prediction"
    ) -> DataFrame:
        return predict(self.model, embed_texts(df, text_col, self.vectors, id_col), name)

    def predict_texts(self, df: DataFrame, text_col: str = "text", name: str = "prediction") -> DataFrame:
        """The same for rows that no column identifies, such as those of a micro-batch."""
        embedded = embed_repeated_texts(df, text_col, self.vectors)
        return predict(self.model, embedded, name).drop("embedding")


@dataclass(frozen=True)
class LinearTextClassifier:
    """A logistic model given by its numbers, with the word vectors it needs."""

    coefficients: tuple[float, ...]
    intercept: float
    vectors: DataFrame
    threshold: float = 0.5

    def predict_texts(self, df: DataFrame, text_col: str = "text", name: str = "prediction") -> DataFrame:
        """0/1 prediction per row; a row without an embedding is predicted 0."""
        embedded = embed_repeated_texts(df, text_col, self.vectors)
        _, prediction = linear_prediction(F.col("embedding"), list(self.coefficients), self.intercept, self.threshold)
        return embedded.withColumn(name, F.coalesce(prediction, F.lit(0))).drop("embedding")


def fit_embedded(embedded: DataFrame, params: ClassifierParams) -> LogisticRegressionModel:
    """Fit on rows with ``embedding`` and ``label``; rows without an embedding are left out."""
    usable = embedded.filter(F.col("embedding").isNotNull())
    weighted = class_weights(usable, params.weight_type)
    return params.estimator().fit(weighted.withColumn("features", array_to_vector("embedding")))


def fit_classifier(
    df: DataFrame, vectors: DataFrame, params: ClassifierParams = ClassifierParams(),
    text_col: str = "text", id_col: str = "id",
) -> TextClassifier:
    embedded = embed_texts(df, text_col, vectors, id_col).select("embedding", "label").persist()
    try:
        return TextClassifier(params, fit_embedded(embedded, params), vectors)
    finally:
        embedded.unpersist()


def predict(model: LogisticRegressionModel, embedded: DataFrame, name: str = "prediction") -> DataFrame:
    """0/1 prediction per row; a row without an embedding is predicted 0."""
    width = model.numFeatures
    blank = F.array_repeat(F.lit(0.0), width)
    vector = array_to_vector(F.coalesce("embedding", blank))
    scored = model.transform(embedded.withColumn(model.getFeaturesCol(), vector))
    flag = F.when(F.col("embedding").isNull(), 0).otherwise(F.col(model.getPredictionCol()).cast("int"))
    return scored.select(*embedded.columns, flag.alias(name))


def linear_prediction(
    vector: Column, coefficients: list[float], intercept: float, threshold: float = 0.5
) -> tuple[Column, Column]:
    """Probability and 0/1 prediction of a logistic model given by its numbers."""
    weights = F.array(*[F.lit(float(value)) for value in coefficients])
    probability = F.lit(1.0) / (F.lit(1.0) + F.exp(-(dot(vector, weights) + F.lit(float(intercept)))))
    return probability, (probability > threshold).cast("int")


SCORES_DDL = (
    "max_iter int, reg_param double, elastic_net_param double, weight_type string, "
    "precision double, recall double, f1_score double, accuracy double, score double"
)


def search_classifier(
    train: DataFrame, validation: DataFrame, vectors: DataFrame,
    grid: list[ClassifierParams] | None = None, floor: float = SEARCH_FLOOR,
    text_col: str = "text", id_col: str = "id",
) -> tuple[DataFrame, TextClassifier]:
    """Scores of every parameter set (one row each, in grid order) and the best, fitted again.

    Texts are embedded once and kept. Of sets that score the same the first one wins.
    """
    spark = train.sparkSession
    train_rows = embed_texts(train, text_col, vectors, id_col).select("embedding", "label").persist()
    check_rows = embed_texts(validation, text_col, vectors, id_col).select("embedding", "bot").persist()
    scores, best, best_score = [], None, float("-inf")
    try:
        for params in grid if grid is not None else default_grid():
            predicted = predict(fit_embedded(train_rows, params), check_rows)
            row = f1_with_precision_floor(validation_report(predicted), floor).first()
            scores.append(tuple(asdict(params).values()) + tuple(
                row[name] for name in ("precision", "recall", "f1_score", "accuracy", "score")
            ))
            if row["score"] > best_score:
                best, best_score = params, row["score"]
        model = TextClassifier(best, fit_embedded(train_rows, best), vectors)
    finally:
        train_rows.unpersist()
        check_rows.unpersist()
    return spark.createDataFrame(scores, SCORES_DDL), model


def _holds_files(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(target) and len(files.listStatus(target)) > 0


def save_classifier(classifier: TextClassifier, path: str) -> None:
    """Write word vectors, estimator and model below ``path``, which must hold nothing yet."""
    if _holds_files(classifier.vectors.sparkSession, path):
        raise ValueError(f"target folder should be empty or absent: {path}")
    classifier.vectors.write.parquet(f"{path}/vectors")
    classifier.params.estimator().save(f"{path}/estimator")
    weights = [(classifier.params.weight_type,)]
    classifier.vectors.sparkSession.createDataFrame(weights, "weight_type string").write.json(f"{path}/weights", ignoreNullFields=False)
    classifier.model.save(f"{path}/model")


def load_classifier(spark: SparkSession, path: str) -> TextClassifier:
    estimator = LogisticRegression.load(f"{path}/estimator")
    params = ClassifierParams(
        estimator.getMaxIter(), estimator.getRegParam(), estimator.getElasticNetParam(),
        spark.read.schema("weight_type string").json(f"{path}/weights").first()["weight_type"],
    )
    model = LogisticRegressionModel.load(f"{path}/model")
    return TextClassifier(params, model, spark.read.parquet(f"{path}/vectors"))
