"""Labels of a column as ranks by their smoothed mean target: ordered categories of any number for trees.

A tree cuts an ordered category like a number, so its bins need not hold every label.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasLabelCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.functions.columns import present
from tabprep.operators.ranking import global_row_number
from tabprep.session import reliable_checkpoint, shared_path

SMOOTHING = 10.0
#: Means that agree in so many digits after the point are equal; then the label decides.
DIGITS = 6


def rank_labels(df: DataFrame, column: str, target: str, smoothing: float = SMOOTHING) -> DataFrame:
    """(label, n, score, rank) of every label, from 0 for the smallest score.

    The score is the mean target of the label's rows, drawn to the mean of all by ``smoothing``
    rows of it, rounded to ``DIGITS``. Rows without a label or target do not count; a label
    whose rows all lack a target has the score of an unseen one. Labels are summed with map-side
    combine, so a hot one costs nothing, and ranked by a distributed sort.
    """
    y = present(df, target)
    sums = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("label")).agg(
        F.count(y).alias("n"), F.coalesce(F.sum(y), F.lit(0.0)).alias("total")
    )
    sums = reliable_checkpoint(sums)
    mean = sums.agg(F.sum("total") / F.nullif(F.sum("n"), F.lit(0))).first()[0]
    prior = F.lit(float(mean or 0.0))
    score = F.round((F.col("total") + smoothing * prior) / (F.col("n") + smoothing), DIGITS)
    ranked = global_row_number(sums.select("label", "n", score.alias("score")), [F.asc("score"), F.asc("label")], "rank")
    return ranked.select("label", "n", "score", "rank", F.round(prior, DIGITS).alias("prior"))


class LabelRankerModel(Model, HasInputCol, HasOutputCol, MLReadable, MLWritable):
    """Joins the ranks kept below ``path``; unseen and null labels get the rank the mean of all would have."""

    path = Param(Params._dummy(), "path", "folder of the ranks", TypeConverters.toString)
    unseen = Param(Params._dummy(), "unseen", "rank of labels that were not seen", TypeConverters.toFloat)

    def __init__(self, path: str | None = None, unseen: float | None = None):
        super().__init__()
        if path is not None:
            self._set(path=path, unseen=unseen)

    def ranks(self, spark) -> DataFrame:
        return spark.read.parquet(self.getOrDefault(self.path))

    def _transform(self, df: DataFrame) -> DataFrame:
        column, output = self.getInputCol(), self.getOutputCol()
        known = self.ranks(df.sparkSession).select(F.col("label").alias(column), F.col("rank").cast("double").alias(output))
        joined = df.join(known, column, "left").select(*[F.col(f"`{c}`") for c in df.columns], output)
        return joined.withColumn(output, F.coalesce(output, F.lit(self.getOrDefault(self.unseen))))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    """Params with the ranks beside them, so a saved pipeline needs no other folder."""

    def __init__(self, instance: LabelRankerModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        spark = self.sparkSession
        DefaultParamsWriter.saveMetadata(self.instance, path, spark)
        self.instance.ranks(spark).write.parquet(f"{path}/ranks")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> LabelRankerModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model._set(path=f"{path}/ranks")
        return model


class LabelRanker(Estimator, HasInputCol, HasOutputCol, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """Learns ``rank_labels`` of a column and writes them to the shared folder.

    As a stage of a pipeline it is fitted inside each fold, on the rows that train there.
    """

    smoothing = Param(Params._dummy(), "smoothing", "rows of the overall mean added to each label", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, labelCol=None, smoothing=SMOOTHING):
        super().__init__()
        self._setDefault(smoothing=SMOOTHING)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> LabelRankerModel:
        column, spark = self.getInputCol(), df.sparkSession
        path = shared_path(spark, "label-ranks")
        rank_labels(df, column, self.getLabelCol(), self.getOrDefault(self.smoothing)).write.parquet(path)
        below = spark.read.parquet(path).agg(F.count_if(F.col("score") < F.col("prior"))).first()[0]
        return self._copyValues(LabelRankerModel(path, float(below)))
