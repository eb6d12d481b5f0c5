"""Labels learned from reviews, for listings that no rule decides.

Words and word pairs of the classification text are hashed to a fixed width
and a multinomial logistic regression is fitted on the reviewed rows, all
with spark.ml: the features are columns, the gradient is summed over the
partitions, and only the weights (width x labels) are on the driver.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import layers
from . import labels

#: Width of the hashed features (words and pairs each).
WIDTH = 1 << 14
#: A prediction below this probability stays with the reviewers.
LEAST_PROBABILITY = 0.5
LEARNED = "learned"


def is_held_out(parts: int = 3) -> Column:
    """A fold by the row key: reviews in it are for measuring only."""
    key = F.concat_ws("|", F.col("market"), F.col("source_file"), F.col("file_row_number").cast("string"))
    return F.pmod(F.xxhash64(key), F.lit(parts)) == 0


def fit(rows: DataFrame, width: int = WIDTH, iterations: int = 30) -> PipelineModel | None:
    """The model from rows with a ``manual_review_label`` of the closed set;
    others say nothing.  None where fewer than two labels were given."""
    known = reviewed(rows)
    index = F.array_position(F.array(*[F.lit(x) for x in labels.LABELS]), F.col("manual_review_label")) - 1
    rows = known.select(F.coalesce("classification_text", F.lit("")).alias("classification_text"), index.cast("double").alias("target"))
    if rows.select("target").distinct().limit(2).count() < 2:
        return None
    words = Pipeline(stages=[
        RegexTokenizer(inputCol="classification_text", outputCol="_words", pattern=r"[^\p{L}\p{N}]+"),
        NGram(n=2, inputCol="_words", outputCol="_pairs"),
        HashingTF(inputCol="_words", outputCol="_word_counts", numFeatures=width, binary=True),
        HashingTF(inputCol="_pairs", outputCol="_pair_counts", numFeatures=width, binary=True),
        VectorAssembler(inputCols=["_word_counts", "_pair_counts"], outputCol="_features"),
    ]).fit(rows)
    # the estimator reads its rows more than once: their texts are taken apart once, for a table
    features = layers.materialize(words.transform(rows).select("target", "_features"), "learned-features")
    lr = LogisticRegression(featuresCol="_features", labelCol="target", probabilityCol="_probability", predictionCol="_prediction", rawPredictionCol="_raw",
                            family="multinomial", maxIter=iterations, regParam=1e-4)
    return PipelineModel([*words.stages, lr.fit(features)])


def label(labelled: DataFrame, model: PipelineModel | None, least: float = LEAST_PROBABILITY) -> DataFrame:
    """``labelled`` (of ``labels.label``) with the model's label where no rule
    decided; those rows have the rule id ``learned``.  Predictions that are
    not probable enough, and all without a model, stay unclear."""
    if model is None:
        return labelled
    columns = labelled.columns
    text, open_ = F.coalesce("classification_text", F.lit("")), F.col("rule_id") == labels.NO_RULE
    # a decided row's text is not taken apart: the model reads nothing of it
    read = labelled.withColumns({"_text": text, "classification_text": F.when(open_, text).otherwise(F.lit(""))})
    scored = model.transform(read).withColumn("_p", vector_to_array("_probability"))
    names = F.array(*[F.lit(x) for x in labels.LABELS])
    sure = open_ & (F.array_max("_p") >= least)
    return scored.withColumns({
        "classification_text": F.col("_text"),
        "predicted_label": F.when(sure, names[F.col("_prediction").cast("int")]).otherwise(F.col("predicted_label")),
        "rule_id": F.when(sure, F.lit(LEARNED)).otherwise(F.col("rule_id"))}).select(*columns)


def reviewed(labelled: DataFrame) -> DataFrame:
    """The rows with a review that counts."""
    return labelled.filter(F.col("manual_review_label").isin(*labels.LABELS))


def metrics(labelled: DataFrame) -> DataFrame:
    """N7 for all labels: precision and recall of each against the reviews."""
    both = reviewed(labelled).groupBy("predicted_label", "manual_review_label").agg(F.count(F.lit(1)).alias("n"))
    each = F.explode(F.array(*[F.lit(x) for x in labels.LABELS])).alias("label")
    cells = both.select("*", each)
    said, true = F.col("predicted_label") == F.col("label"), F.col("manual_review_label") == F.col("label")
    total = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    return cells.groupBy("label").agg(total(said & true).alias("hits"), total(said).alias("predicted"), total(true).alias("reviewed")).select(
        "label", "hits", "predicted", "reviewed", F.try_divide("hits", "predicted").alias("precision"), F.try_divide("hits", "reviewed").alias("recall"))
