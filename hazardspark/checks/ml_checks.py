"""Queries over the relevance model: rows are labelled documents."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from hazardspark.checks.base import check, table
from hazardspark.operators import relevance
from hazardspark.session import fresh_dir


def relevance_rows(spark, sf):
    """All documents with their whole text as title; ``label`` where known."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    rows = docs.join(labels, "doc_id", "left").withColumnRenamed("text", "title")
    return relevance.with_model_text(rows)


def relevance_model(spark, sf) -> PipelineModel:
    rows = relevance_rows(spark, sf)
    return relevance.train(rows.where(F.col("label").isNotNull()), iterations=10)


@check("m1_train_save_load")
def m1(spark, sf):
    """Train, save, load; per label the number of documents and the mean score."""
    path = fresh_dir(spark, "model")
    relevance.save(relevance_model(spark, sf), path)
    scored = relevance.score(relevance_rows(spark, sf), relevance.load(path))
    return scored.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.avg("ml_relevance_score").alias("mean_score"))


@check("m2_predict_relevance")
def m2(spark, sf):
    scored = relevance.score(relevance_rows(spark, sf), relevance_model(spark, sf))
    return scored.select("doc_id", "ml_relevance_score", relevance.is_relevant(F.col("ml_relevance_score")).alias("is_relevant"))


@check("m2_without_model", "SELECT doc_id, 1.0::DOUBLE AS ml_relevance_score, true AS is_relevant FROM documents")
def m2b(spark, sf):
    scored = relevance.score(relevance_rows(spark, sf), None)
    return scored.select("doc_id", "ml_relevance_score", relevance.is_relevant(F.col("ml_relevance_score")).alias("is_relevant"))


@check("m3_model_or_rules")
def m3(spark, sf):
    scored = relevance.score(relevance_rows(spark, sf), relevance_model(spark, sf))
    # The source name stands for the title, so that the length rule decides some rows.
    rules = relevance.model_or_rules(F.col("ml_relevance_score"), F.col("source"))
    return scored.where(rules).select("doc_id")
