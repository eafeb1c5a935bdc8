"""Text relevance model: TF-IDF and a probabilistic classifier in Spark ML."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardspark.functions import text as T
from hazardspark.operators.filters import column_or_null, long_enough_title


def with_model_text(df: DataFrame, out: str = "model_text") -> DataFrame:
    """Title, host and start of the description; absent columns are skipped."""
    return df.withColumn(
        out,
        T.relevance_text(
            column_or_null(df, "title"), column_or_null(df, "link"), column_or_null(df, "description")
        ),
    )


def train(
    df: DataFrame, text: str = "model_text", label: str = "label", features: int = 1 << 14,
    iterations: int = 20,
) -> PipelineModel:
    """Hashed term counts (no vocabulary on the driver), IDF, logistic regression."""
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=r"(?U)\W+"),
            HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=features),
            IDF(inputCol="_tf", outputCol="_tfidf"),
            LogisticRegression(
                featuresCol="_tfidf", labelCol=label, maxIter=iterations, regParam=0.01,
                probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_prediction",
            ),
        ]
    ).fit(df)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(df: DataFrame, model: PipelineModel | None, out: str = "ml_relevance_score") -> DataFrame:
    """Probability of the positive class; without a model every row scores 1."""
    if model is None:
        return df.withColumn(out, F.lit(1.0))
    # A filter on the score reads it; otherwise the model's functions are copied into the filter and run again there.
    scored = T.computed_once(model.transform(df), **{out: vector_to_array("_probability")[1]})
    return scored.select(*df.columns, out)


def is_relevant(score_col: Column, threshold: float = 0.5) -> Column:
    return score_col >= threshold


def model_or_rules(score_col: Column, title: Column, threshold: float = 0.6) -> Column:
    """Kept by the model or by the title rule."""
    return is_relevant(score_col, threshold) | long_enough_title(title)


def prioritised(df: DataFrame, model: PipelineModel | None) -> DataFrame:
    """Most relevant first; no row is removed and the score is not kept."""
    if model is None:
        return df
    return score(df, model, "_score").orderBy(F.desc("_score")).drop("_score")
