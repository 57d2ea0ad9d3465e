"""Vector expressions and the text embedding."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCORE_DIGITS = 6


def _doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(_doubles(v), F.lit(0.0), lambda total, x: total + x * x))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity, rounded; null when either vector is zero."""
    return F.round(F.try_divide(dot(a, b), norm(a) * norm(b)), SCORE_DIGITS)


def mean_vector(df: DataFrame, group: list[str], vector: str, dim: int, name: str = "embedding") -> DataFrame:
    """Element-wise mean per group: one partial aggregate per element, no vector is collected."""
    means = [F.avg(F.get(F.col(vector), F.lit(i)).cast("double")) for i in range(dim)]
    return df.groupBy(*group).agg(F.array(*means).alias(name))


def fit_text_embedding(texts: DataFrame, column: str = "content", dim: int = 256) -> PipelineModel:
    """Hashed term frequencies, inverse document frequencies and unit length, fitted over all the texts."""
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol=column, outputCol="__tokens", pattern=r"(?U)\W+", minTokenLength=1),
            HashingTF(inputCol="__tokens", outputCol="__tf", numFeatures=dim),
            IDF(inputCol="__tf", outputCol="__tfidf"),
            Normalizer(inputCol="__tfidf", outputCol="__unit"),
        ]
    ).fit(texts.where(F.col(column).isNotNull()))


def embed_text(model: PipelineModel, df: DataFrame, column: str, name: str = "embedding") -> DataFrame:
    """Add the embedding of a text column. Texts without any known term get a zero vector."""
    fitted_on = model.stages[0].getInputCol()
    keep = df.columns
    prepared = df if column == fitted_on else df.withColumn(fitted_on, F.col(column))
    prepared = prepared.withColumn(fitted_on, F.coalesce(F.col(fitted_on), F.lit("")))
    embedded = model.transform(prepared).withColumn(name, vector_to_array("__unit", "float32"))
    return embedded.select(*[F.col(c) for c in keep if c != name], name)
