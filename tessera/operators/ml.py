"""Feature engineering and classification with ``pyspark.ml``.

Everything is a ``pyspark.ml`` stage, so fitting and scoring are distributed
jobs.  Split before fitting: imputation means and string indexes are fitted
on the training split only and reused on the test split (the reference
refits on the test set).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import Bucketizer, HashingTF, Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_split(df: DataFrame, key: str, train_percent: int = 60, seed: int = 1234) -> tuple[DataFrame, DataFrame]:
    """Deterministic train/test split by a hash of the row key (ML-06).
    Unlike ``randomSplit`` it is stable under repartitioning and re-reads,
    so a retried task or a re-run produces the same split."""
    from tessera.operators.generate import digest_bits

    bucket = digest_bits(seed, key, hex_digits=8) % 100
    return df.where(bucket < train_percent), df.where(bucket >= train_percent)


def mean_imputer(train: DataFrame, columns: Sequence[str]):
    """Fit mean imputation on ``train`` (ML-01); apply the model to any split."""
    return Imputer(strategy="mean", inputCols=list(columns), outputCols=list(columns)).fit(train)


def bucketizer(column: str, splits: Sequence[float], output: str) -> Bucketizer:
    """Bucket by split points (ML-03); out-of-range values keep a bucket of
    their own instead of failing the job."""
    return Bucketizer(splits=list(splits), inputCol=column, outputCol=output, handleInvalid="keep")


def indexers(columns: Sequence[str]) -> list[StringIndexer]:
    """Frequency-ordered string indexes; unseen or null labels skip the row (ML-02)."""
    return [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="skip", stringOrderType="frequencyDesc")
            for c in columns]


def feature_stages(categorical: Sequence[str], one_hot: Sequence[str], numeric: Sequence[str]) -> list:
    """Index categoricals (ML-02), one-hot some of them (ML-04), assemble all
    into ``features`` (ML-05): one-hot codes, other indexes, numbers."""
    enc = OneHotEncoder(inputCols=[f"{c}_idx" for c in one_hot], outputCols=[f"{c}_vec" for c in one_hot])
    feats = [f"{c}_vec" for c in one_hot] + [f"{c}_idx" for c in categorical if c not in one_hot] + list(numeric)
    return [*indexers(categorical), enc, VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="skip")]


def forest_pipeline(categorical: Sequence[str], one_hot: Sequence[str], numeric: Sequence[str], label: str,
                    trees: int = 100, depth: int = 6, seed: int = 1234) -> Pipeline:
    """The features and a random forest on them (ML-07)."""
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed)
    return Pipeline(stages=[*feature_stages(categorical, one_hot, numeric), rf])


def area_under_roc(scored: DataFrame, label: str, score: str = "rawPrediction", bins: int = 1000) -> float:
    """Area under the ROC curve (ML-08).  ``score`` is a column of raw
    predictions or of plain doubles.  The curve has about ``bins`` points; 0
    takes a point for each distinct score, which is exact."""
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=score, metricName="areaUnderROC",
                                         numBins=bins).evaluate(scored)


def confusion(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n): the counts of a scored frame by class."""
    return scored.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


TF_BUCKETS = 10000  # fixed value


def term_frequencies(text: str, features: int = TF_BUCKETS) -> list:
    """Space-split words -> hashed term frequencies (ML-10)."""
    return [_SplitWords(inputCol=text, outputCol="_words"),
            HashingTF(numFeatures=features, inputCol="_words", outputCol="features")]


def text_classifier(text: str, label: str, features: int = TF_BUCKETS, iterations: int = 100) -> Pipeline:
    """Hashed term frequencies -> logistic regression (ML-11; the SGD variant
    is legacy in Spark)."""
    lr = LogisticRegression(labelCol=label, featuresCol="features", maxIter=iterations)
    return Pipeline(stages=[*term_frequencies(text, features), lr])


def mlp(layers: Sequence[int], seed: int = 1234, iterations: int = 100) -> MultilayerPerceptronClassifier:
    """Multilayer perceptron (ML-12)."""
    return MultilayerPerceptronClassifier(layers=list(layers), seed=seed, maxIter=iterations, blockSize=128)


def weighted_precision(scored: DataFrame, label: str, prediction: str = "prediction") -> float:
    """Multiclass precision (ML-13); Spark 4 names it ``weightedPrecision``."""
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction,
                                             metricName="weightedPrecision").evaluate(scored)


def as_vector(col: str | Column) -> Column:
    return array_to_vector(F.col(col) if isinstance(col, str) else col)


# A tiny transformer so the space split is a pipeline stage (ML-10).
from pyspark import keyword_only  # noqa: E402
from pyspark.ml import Transformer  # noqa: E402
from pyspark.ml.param.shared import HasInputCol, HasOutputCol  # noqa: E402
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable  # noqa: E402


class _SplitWords(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOutputCol(), F.split(F.coalesce(F.col(self.getInputCol()), F.lit("")), " "))


__all__ = ["PipelineModel", "hash_split", "mean_imputer", "bucketizer", "indexers", "feature_stages", "forest_pipeline",
           "area_under_roc", "confusion", "term_frequencies", "text_classifier", "mlp", "weighted_precision", "as_vector"]
