"""Feature preparation: indexing, encoding, assembling, splitting, scaling, components."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.expressions import hash_percent
from tabulon.operators.ordered import one_row, positions
from tabulon.session import settle

#: Most frequent values of a column that are sent to all executors; the rest of its index is shuffled.
HOT_VALUES = 10_000


def frequency_index(df: DataFrame, column: str, name: str = "index") -> DataFrame:
    """Each value with its rank by frequency (0 = most frequent; ties by value)."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return positions(counts, [], [F.desc("count"), F.asc(column)], name)


def sparse_vector(size: int, indices: Column, values: Column) -> Column:
    """A sparse vector from its set slots, in ascending order, inside the JVM.

    No built-in function makes one; the JSON reader does, from a vector's own fields.
    """
    fields = F.struct(
        F.lit(0).cast("byte").alias("type"), F.lit(size).alias("size"),
        indices.cast("array<int>").alias("indices"), values.cast("array<double>").alias("values"),
    )
    schema = T.StructType([T.StructField("v", VectorUDT())])
    return F.from_json(F.to_json(F.struct(fields.alias("v"))), schema)["v"]


class FrequencyEncoder:
    """Indices, one-hot vectors and features for columns with any number of distinct values.

    Does what ``feature_pipeline`` does, but the values stay in tables: the driver learns how many there are.
    Indices go by frequency, ties by value. A null or a value that was not there when fitted has the index after the
    last one and sets no slot; as a label it is null. A null number makes the features null.
    """

    def __init__(self, df: DataFrame, categorical: Sequence[str], numeric: Sequence[str], label: str | None = None,
                 hot_values: int = HOT_VALUES):
        self.categorical, self.numeric, self.label, self.hot_values = list(categorical), list(numeric), label, hot_values
        self.tables, self.sizes = {}, {}
        for c in [*self.categorical, *([label] if label else [])]:
            table = frequency_index(df.select(F.col(c).alias("value")), "value").select("value", "index")
            self.tables[c] = settle(table)
            self.sizes[c] = self.tables[c].count()
        self.width = sum(self.sizes[c] for c in self.categorical) + len(self.numeric)

    def _offsets(self) -> dict[str, int]:
        offsets, at = {}, 0
        for c in self.categorical:
            offsets[c], at = at, at + self.sizes[c]
        return offsets

    def slots(self) -> DataFrame:
        """What every slot of the features stands for: slot, feature."""
        last = self.width - len(self.numeric)
        spark = next(iter(self.tables.values())).sparkSession
        parts = spark.createDataFrame([(last + i, n) for i, n in enumerate(self.numeric)], "slot bigint, feature string")
        for c, offset in self._offsets().items():
            name = F.concat(F.lit(f"{c}_vec_"), F.col("value").cast("string"))
            parts = parts.unionByName(self.tables[c].select((F.col("index") + offset).alias("slot"), name.alias("feature")))
        return parts

    def _indexed(self, df: DataFrame, key: str, column: str, name: str) -> DataFrame:
        """Common values by a broadcast of a fixed number of rows; only rows with another value look further.

        Rows that are settled are dealt by their key in the second join, so they do not meet in one task.
        """
        table = self.tables[column].toDF("_value", "_index")
        hot = table.where(F.col("_index") < self.hot_values)
        out = df.join(F.broadcast(hot), df[column] == F.col("_value"), "left").drop("_value")
        if self.sizes[column] > self.hot_values:
            rest = table.where(F.col("_index") >= self.hot_values).toDF("_value", "_late").withColumn("_open", F.lit(0))
            looks = F.col("_index").isNull() & F.col(column).isNotNull()
            out = out.withColumn("_look", F.when(looks, 0).otherwise(1 + F.pmod(F.xxhash64(key), F.lit(1 << 20))).cast("int"))
            out = out.join(rest, (out[column] == rest["_value"]) & (F.col("_look") == F.col("_open")), "left")
            out = out.withColumn("_index", F.coalesce("_index", "_late")).drop("_value", "_late", "_open", "_look")
        return out.withColumnRenamed("_index", name)

    def transform(self, df: DataFrame, key: str) -> DataFrame:
        """Adds ``<column>_index`` and ``<column>_vec`` for each category, ``features``, and ``label`` where there is one.

        ``key`` is a column that tells rows apart; it only spreads the work. Rows and other columns stay.
        """
        out, indices, values = df, [], []
        for c, offset in self._offsets().items():
            size = self.sizes[c]
            out = self._indexed(out, key, c, f"{c}_index")
            out = out.withColumn(f"{c}_index", F.coalesce(f"{c}_index", F.lit(size)).cast("double"))
            place, seen = F.col(f"{c}_index").cast("int"), F.col(f"{c}_index") < size
            set_slot = lambda at, seen=seen, place=place: F.when(seen, F.array(place + at)).otherwise(F.array().cast("array<int>"))
            ones = F.when(seen, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>"))
            out = out.withColumn(f"{c}_vec", sparse_vector(size, set_slot(0), ones))
            indices.append(set_slot(offset))
            values.append(ones)
        if self.label is not None:
            out = self._indexed(out, key, self.label, "label").withColumn("label", F.col("label").cast("double"))
        base = self.width - len(self.numeric)
        indices.append(F.array(*[F.lit(base + i) for i in range(len(self.numeric))]).cast("array<int>"))
        values.append(F.array(*[F.col(n).cast("double") for n in self.numeric]).cast("array<double>"))
        features = sparse_vector(self.width, F.concat(*indices), F.concat(*values))
        whole = [F.col(n).isNotNull() for n in self.numeric]
        for test in whole:
            features = F.when(test, features)
        return out.withColumn("features", features)


def feature_pipeline(
    categorical: Sequence[str], numeric: Sequence[str], label: str | None = None, features: str = "features"
) -> Pipeline:
    """Index and one-hot encode the categories, then assemble them with the numbers.

    Values unseen when fitted get a slot of their own, so the pipeline can be
    fitted on the training part alone.
    """
    stages = []
    if categorical:
        indexed = [f"{c}_index" for c in categorical]
        encoded = [f"{c}_vec" for c in categorical]
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded))
    else:
        encoded = []
    if label is not None:
        stages.append(StringIndexer(inputCol=label, outputCol="label"))
    stages.append(VectorAssembler(inputCols=[*encoded, *numeric], outputCol=features))
    return Pipeline(stages=stages)


def apply_pipeline(model: PipelineModel, df: DataFrame, keep: Sequence[str], label: bool = True) -> DataFrame:
    """Label, features and the original columns."""
    return model.transform(df).select(*(["label"] if label else []), "features", *keep)


def hash_split(df: DataFrame, key: str | Column, train_percent: int = 70) -> tuple[DataFrame, DataFrame]:
    """Train and test parts by a hash of the key: the same on every run and layout."""
    in_train = hash_percent(key) < train_percent
    return df.where(in_train), df.where(~in_train)


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Spark's own split; the parts depend on how the table is partitioned."""
    return df.randomSplit(list(weights), seed)


def column_limits(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row holding the smallest and largest value of each column."""
    return df.agg(
        *[F.min(c).cast("double").alias(f"{c}__min") for c in columns],
        *[F.max(c).cast("double").alias(f"{c}__max") for c in columns],
    )


def scale(df: DataFrame, limits: DataFrame, columns: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """Min-max scaling by limits fitted elsewhere; a constant column becomes 0."""
    row = one_row(limits)
    added = []
    for c in columns:
        low, high = row[f"{c}__min"], row[f"{c}__max"]
        added.append(F.coalesce(F.try_divide(F.col(c) - low, high - low), F.lit(0.0)).alias(f"{c}{suffix}"))
    return df.select("*", *added)


def unscale(df: DataFrame, limits: DataFrame, column: str, fitted: str, name: str) -> DataFrame:
    """Back to the units of the fitted column."""
    row = one_row(limits)
    low, high = row[f"{fitted}__min"], row[f"{fitted}__max"]
    return df.select("*", (F.col(column) * (high - low) + low).alias(name))


def as_vector(df: DataFrame, column: str, name: str = "features") -> DataFrame:
    if isinstance(df.schema[column].dataType, VectorUDT):
        return df.withColumn(name, F.col(column))
    return df.withColumn(name, array_to_vector(F.col(column).cast("array<double>")))


def _centred(df: DataFrame, features: str):
    scaler = StandardScaler(inputCol=features, outputCol="_centred", withMean=True, withStd=False)
    return scaler.fit(df)


def principal_scores(df: DataFrame, features: str, k: int, prefix: str = "pc") -> DataFrame:
    """Scores on the first k components of the centred vectors, as columns pc1..pck.

    The sign of a component is arbitrary; each is turned so that its largest
    loading is positive.
    """
    centring = _centred(df, features)
    centred = centring.transform(df)
    model = PCA(k=k, inputCol="_centred", outputCol="_scores").fit(centred)
    loadings = model.pc.toArray()
    signs = [1.0 if abs(loadings[:, j].max()) >= abs(loadings[:, j].min()) else -1.0 for j in range(k)]
    scored = model.transform(centred).withColumn("_scores", vector_to_array("_scores"))
    return scored.select(
        *df.columns, *[(F.col("_scores")[j] * signs[j]).alias(f"{prefix}{j + 1}") for j in range(k)]
    )


def principal_model(df: DataFrame, features: str, k: int) -> tuple[list[float], list[list[float]]]:
    """Mean vector and the k component vectors: small, whatever the size of the table."""
    centring = _centred(df, features)
    model = PCA(k=k, inputCol="_centred", outputCol="_scores").fit(centring.transform(df))
    loadings = model.pc.toArray()
    return [float(m) for m in centring.mean.toArray()], [loadings[:, j].tolist() for j in range(k)]


def explained_variance(df: DataFrame, features: str) -> DataFrame:
    """Variance and share of every component, in order."""
    width = len(df.select(features).first()[0])
    total = df.agg(F.aggregate(vector_to_array(Summarizer.variance(F.col(features))), F.lit(0.0), lambda a, x: a + x).alias("v"))
    model = PCA(k=width, inputCol=features, outputCol="_scores").fit(df)
    spark = df.sparkSession
    rows = [(i + 1, float(r)) for i, r in enumerate(model.explainedVariance.toArray())]
    ratios = spark.createDataFrame(rows, "component int, ratio double")
    return ratios.withColumn("variance", F.col("ratio") * total.scalar())
