"""Split, train and score: MLlib estimators behind one prediction schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    LogisticRegression,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.functions.keys import in_percent
from flowlab.functions.vectors import class_probability
from flowlab.operators.capping import OutlierCaps
from flowlab.operators.forest import HistogramForest
from flowlab.sources.storage import name_checkpoint_folder
from flowlab.sources.tables import dealt_once

# The model names of the comparison, the share of training rows, and the settings
# of each estimator (all others are MLlib's defaults).
MODEL_LR = "Model A - Logistic Regression"
MODEL_MLP = "Model B - Deep Learning MLP"
MODEL_RF = "Model C - Random Forest"
TRAIN_PERCENT = 80
SEED = 42
LR_SETTINGS = {"maxIter": 10}
MLP_SETTINGS = {"maxIter": 80, "blockSize": 256, "seed": SEED}
RF_SETTINGS = {
    "numTrees": 80,
    "maxDepth": 12,
    "maxBins": 32,
    "featureSubsetStrategy": "sqrt",
    "impurity": "gini",
    "seed": SEED,
}
# How MLlib's own trainer builds a forest, where it is left to it: a level of all trees fits into one pass
# over the rows, and each row walks to its nodes again. Remembering them would store a number per row and
# tree several times over, more than the table itself.
RF_EXECUTION = {"cacheNodeIds": False, "maxMemoryInMB": 1024}

SCORE = "attack_probability"


def split(df: DataFrame, key: str = "flow_id", percent: int = TRAIN_PERCENT) -> tuple[DataFrame, DataFrame]:
    """(train, test) by key hash: the same rows on every run and file layout, without a shuffle."""
    train = in_percent(key, percent)
    return df.filter(train), df.filter(~train)


def unit_deviation(train: DataFrame, column: str = "features", output: str = "scaled_features") -> Model:
    """Scaler to unit standard deviation without centring, fitted on the training rows only."""
    return StandardScaler(inputCol=column, outputCol=output, withStd=True, withMean=False).fit(train)


def feature_width(df: DataFrame, column: str = "features") -> int:
    """Width of a vector column from its metadata; from one row where there is none."""
    known = df.schema[column].metadata.get("ml_attr", {}).get("num_attrs")
    return known if known is not None else df.select(column).first()[0].size


def layer_sizes(width: int) -> list[int]:
    """Input, two hidden layers (half and a quarter of the input, held in a range), two classes."""
    return [width, min(128, max(32, width // 2)), min(64, max(16, width // 4)), 2]


class PlainLogisticRegression(LogisticRegression):
    """MLlib's, whose models keep no training summary: it holds the session, which no task can be sent."""

    def _create_model(self, java_model):
        java_model.setSummary(SparkSession.active()._jvm.scala.Option.empty())
        return super()._create_model(java_model)


def estimator_lr(width: int, **settings) -> Estimator:
    return PlainLogisticRegression(**{**LR_SETTINGS, **settings})


def estimator_mlp(width: int, **settings) -> Estimator:
    """Scaler and network as one pipeline: unscaled inputs drive the network to one class."""
    scaler = StandardScaler(inputCol="features", outputCol="scaled_features", withStd=True, withMean=False)
    network = MultilayerPerceptronClassifier(
        featuresCol="scaled_features", **{"layers": layer_sizes(width), **MLP_SETTINGS, **settings}
    )
    return Pipeline(stages=[scaler, network])


def estimator_rf(width: int, **settings) -> Estimator:
    return HistogramForest(**{**RF_SETTINGS, **RF_EXECUTION, **settings})


#: The unfitted estimator of each model, from the width of its feature vector and further settings.
ESTIMATORS: dict[str, Callable[..., Estimator]] = {
    MODEL_LR: estimator_lr,
    MODEL_MLP: estimator_mlp,
    MODEL_RF: estimator_rf,
}


def train_lr(train: DataFrame, **settings) -> Model:
    return estimator_lr(0, **settings).fit(train)


def train_mlp(train: DataFrame, **settings) -> Model:
    return estimator_mlp(feature_width(train), **settings).fit(train)


def train_rf(train: DataFrame, **settings) -> Model:
    name_checkpoint_folder(train.sparkSession)  # for callers that turn cacheNodeIds on
    return estimator_rf(0, **settings).fit(train)


TRAINERS: dict[str, Callable[..., Model]] = {MODEL_LR: train_lr, MODEL_MLP: train_mlp, MODEL_RF: train_rf}


def from_features(columns: list[str], classifier: Estimator, **caps) -> Pipeline:
    """Caps, vector and classifier in one pipeline over engineered columns: fitted, it holds everything
    between a row's features and its score."""
    vector = VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[OutlierCaps(inputCols=columns, **caps), vector, classifier])


def save_model(model: Model, path: str) -> None:
    """Write a fitted model, whatever its kind, over what is at ``path``."""
    whole = model if isinstance(model, PipelineModel) else PipelineModel(stages=[model])
    whole.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """A model that ``save_model`` wrote; it scores as the fitted one did."""
    return PipelineModel.load(path)


def feature_importance(model: Model, names: list[str], spark: SparkSession) -> DataFrame:
    """(feature, importance) of a fitted forest, most important first; the importances add up to 1."""
    rows = sorted(zip(names, map(float, model.featureImportances.toArray()), strict=True), key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(rows, "feature string, importance double")


def without_summary(model: Model) -> Model:
    """A copy of a fitted model without its training summary, which holds the session and the training
    rows' plan and would be shipped to every task that scores."""
    copied = model.copy()
    for stage in copied.stages if isinstance(copied, PipelineModel) else [copied]:
        if isinstance(stage, PipelineModel):
            stage.stages = without_summary(stage).stages
        elif getattr(stage, "hasSummary", False):
            stage._java_obj.setSummary(SparkSession.active()._jvm.scala.Option.empty())
    return copied


def predict(model: Model, rows: DataFrame, name: str) -> DataFrame:
    """Scored rows in one schema for every model, lineage columns first.

    ``attack_probability`` is the plain number that ROC curves read, so they need no vector.
    """
    lineage = [c for c in ("flow_id", "label", "label_original", "features") if c in rows.columns]
    return without_summary(model).transform(rows).select(
        F.lit(name).alias("model"),
        *lineage,
        "rawPrediction",
        "probability",
        "prediction",
        class_probability().alias(SCORE),
    )


def fit_named(name: str, ml_ready: DataFrame, key: str = "flow_id", weight: str | None = None, **settings) -> Model:
    """Train the named model on the training split.

    Rows are dealt out by key: the same rows and settings add up in the same partitions. They are
    shuffled once, however often the estimator plans its input.
    ``weight`` names a column of row weights.
    """
    train, _ = split(ml_ready, key)
    columns = ["features", "label", *([weight] if weight else [])]
    if weight:
        settings["weightCol"] = weight
    with dealt_once(train, key, *columns) as rows:
        return TRAINERS[name](rows, **settings)


def fit_and_predict(name: str, ml_ready: DataFrame, key: str = "flow_id", **settings) -> DataFrame:
    """Train the named model on the training split and score the test split, whose rows are read lazily."""
    return predict(fit_named(name, ml_ready, key, **settings), split(ml_ready, key)[1], name)
