"""Text classes: a Spark ML pipeline and the label table."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageprism import fixed, schemas


def class_labels(spark: SparkSession) -> DataFrame:
    """The shop categories, for models that were trained on their ids."""
    return spark.createDataFrame(list(enumerate(fixed.CLASS_LABELS)), schemas.CLASS_LABELS)


def train(labelled: DataFrame, text: str = "text", label: str = "label", features: int = 1 << 12,
          rounds: int = 10) -> PipelineModel:
    """Word-hash features and multinomial logistic regression; the fit aggregates over the cluster."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"\P{L}+"),
        HashingTF(inputCol="_words", outputCol="_features", numFeatures=features),
        LogisticRegression(featuresCol="_features", labelCol=label, maxIter=rounds, regParam=0.01,
                           predictionCol="_class", probabilityCol="_probability", rawPredictionCol="_raw"),
    ]).fit(labelled)


def predict(model: PipelineModel, df: DataFrame, keep: list[str], labels: DataFrame) -> DataFrame:
    """``keep`` plus ``id, literal, probability`` of the most likely class. ``labels`` (``id, literal``) names the classes
    that the model was trained on; texts that are null count as empty."""
    scored = model.transform(df.fillna("", ["text"])).select(
        *keep, F.col("_class").cast("int").alias("id"),
        F.array_max(vector_to_array("_probability")).alias("probability"))
    return scored.join(labels, "id", "left").select(*keep, "id", "literal", "probability")
