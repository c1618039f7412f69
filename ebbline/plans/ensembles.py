"""What Spark's tree ensembles lack: class weights per bootstrap of a forest, and penalised leaf values of boosted trees."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from itertools import accumulate
from math import exp, factorial

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.functions.scalar import UNIFORM_KEY_RANGE, uniform_key
from ebbline.plans.threads import THREADS, concurrently
from ebbline.session import stage

KEYS = ("client_id", "snapshot_date")
#: Shares of the uniform keys below which a row is drawn at most 0, 1, 2, ... times: the Poisson law of mean 1.
DRAW_BOUNDS = [int(p * UNIFORM_KEY_RANGE) for p in accumulate(exp(-1) / factorial(k) for k in range(13))]


def with_draws(rows: DataFrame, parts: int, seed: int) -> DataFrame:
    """``draws``: how often a row stands in each bootstrap, Poisson numbers from hashes of its keys, so every engine, retry and
    partitioning draws the same. The cap on training rows uses the hash of ``seed`` itself."""
    bounds = F.array(*[F.lit(bound) for bound in DRAW_BOUNDS])
    keys = F.transform(F.sequence(F.lit(seed + 1), F.lit(seed + parts)), lambda part: uniform_key(part, *KEYS))
    return rows.withColumn("draws", F.transform(keys, lambda key: F.size(F.filter(bounds, lambda bound: key >= bound)).cast("byte")))


def bootstrap_class_counts(drawn: DataFrame) -> DataFrame:
    """``part, churn, n_rows, n_draws, class_weight``: the draws of a class in a bootstrap weigh half of all its draws."""
    each = drawn.select("churn", F.posexplode("draws").alias("part", "n")).filter("n > 0")
    counts = each.groupBy("part", "churn").agg(F.count("*").alias("n_rows"), F.sum("n").cast("bigint").alias("n_draws"))
    of_part = Window.partitionBy("part")
    weight = F.sum("n_draws").over(of_part) / (F.count("*").over(of_part) * F.col("n_draws"))
    return counts.withColumn("class_weight", weight)


def part_rows(drawn: DataFrame, part: int, weights: dict[int, float]) -> DataFrame:
    """Rows of a bootstrap, each once, weighing its draws times the weight of its class."""
    of_class = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    drawn_times = F.col("draws")[part]
    return drawn.filter(drawn_times > 0).select("churn", "features", (drawn_times * of_class[F.col("churn")]).alias("weight"))


class WeightedMean(Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Mean of class probabilities, weighted by the number of trees behind each."""

    weights = Param(Params._dummy(), "weights", "weight of each input column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None, weights=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        inputs, weights = self.getInputCols(), self.getOrDefault(self.weights)
        churn = sum(vector_to_array(c)[1] * w for c, w in zip(inputs, weights)) / sum(weights)
        return dataset.withColumn(self.getOutputCol(), array_to_vector(F.array(1 - churn, churn))).drop(*inputs)


def fit_forest(
    rows: DataFrame, forest: Callable[[int], RandomForestClassifier], trees: int, bootstraps: int, seed: int, threads: int = THREADS
) -> list:
    """A forest in parts, fitted side by side: one bootstrap each, with class weights of its own. ``forest`` makes the unfitted
    forest of a number of trees. As many bootstraps as trees give each tree its own."""
    parts = max(1, min(bootstraps, trees))
    drawn = stage(with_draws(rows, parts, seed).select("churn", "features", "draws"), "bootstraps")
    weights: dict[int, dict[int, float]] = {}
    for r in bootstrap_class_counts(drawn).collect():  # two rows a bootstrap
        weights.setdefault(r.part, {})[r.churn] = r.class_weight
    sizes = {part: trees // parts + (part < trees % parts) for part in sorted(weights)}

    def fit_part(part: int) -> RandomForestClassificationModel:
        model = forest(sizes[part]).setBootstrap(False).setSeed(seed + part).fit(part_rows(drawn, part, weights[part]))
        return model.setRawPredictionCol("").setPredictionCol("").setProbabilityCol(f"probability_{part}")

    models = concurrently(rows.sparkSession, {part: partial(fit_part, part) for part in sizes}, threads)
    names = [f"probability_{part}" for part in models]
    mean = WeightedMean(inputCols=names, outputCol="probability", weights=[float(sizes[part]) for part in models])
    return [*models.values(), mean]


class LeafScores(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Class probabilities from the leaf of every tree: the logistic of the summed leaf values."""

    values = Param(Params._dummy(), "values", "values of the leaves, tree by tree", TypeConverters.toListFloat)
    width = Param(Params._dummy(), "width", "places of a tree in the values", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, values=None, width=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def terms(self) -> Column:
        """What each tree adds to the margin."""
        text = ",".join(map(repr, self.getOrDefault(self.values)))
        values = F.split(F.lit(text), ",").cast("array<double>")  # folded to one constant
        leaves = vector_to_array(self.getInputCol())
        return F.transform(leaves, lambda leaf, tree: F.get(values, (tree * self.getOrDefault(self.width) + leaf).cast("int")))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        churn = 1 / (1 + F.exp(-F.aggregate(self.terms(), F.lit(0.0), lambda a, x: a + x)))
        with_score = dataset.withColumn("_churn", churn)
        return with_score.withColumn(self.getOutputCol(), array_to_vector(F.array(1 - F.col("_churn"), F.col("_churn")))).drop("_churn")


def leaf_totals(rows: DataFrame, l2: float) -> DataFrame:
    """``leaf, value`` that minimises the second-order loss of a leaf with penalty ``l2``, from ``leaf, churn, margin``."""
    pulls = rows.select("leaf", "churn", (1 / (1 + F.exp(-F.col("margin")))).alias("p"))
    sums = pulls.groupBy("leaf").agg(F.sum(F.col("churn") - F.col("p")).alias("pull"), F.sum(F.col("p") * (1 - F.col("p"))).alias("curve"))
    return sums.select("leaf", (F.col("pull") / (F.col("curve") + l2)).alias("value"))


def penalised_leaves(boosted: GBTClassificationModel, rows: DataFrame, step: float, l2: float, together: int = 20) -> list:
    """The trees of ``boosted`` with new leaf values: tree after tree, from the margin of those before, ``sum of pulls / (sum of curvatures +
    l2)`` in each leaf times ``step``. The margin starts at 0; a leaf without rows adds nothing.

    A round is one aggregation; only the values of a tree's leaves, at most 2 ** depth, reach the driver. Margins are stored every
    ``together`` rounds, so plans stay short.
    """
    boosted = boosted.copy().setLeafCol("leaves").setRawPredictionCol("").setProbabilityCol("").setPredictionCol("")
    width = max((tree.numNodes + 1) // 2 for tree in boosted.trees)
    leaves = vector_to_array("leaves").cast("array<int>").alias("leaves")
    current = stage(boosted.transform(rows).select("churn", leaves, F.lit(0.0).alias("margin")), "leaves")
    values: list[float] = []
    for tree in range(len(boosted.trees)):
        at = current.withColumn("leaf", F.col("leaves")[tree])
        found = {r.leaf: step * r.value for r in leaf_totals(at, l2).collect()}
        own = [found.get(leaf, 0.0) for leaf in range(width)]
        values += own
        current = current.withColumn("margin", F.col("margin") + F.get(F.array(*map(F.lit, own)), F.col("leaves")[tree]))
        if (tree + 1) % together == 0:
            current = stage(current, "leaves")
    return [boosted, LeafScores(inputCol="leaves", outputCol="probability", values=values, width=width)]


def leaf_residuals(fitted: list, rows: DataFrame, step: float, l2: float) -> DataFrame:
    """``tree, n_rows, positives, residual``: by how much the values of a tree's leaves miss their optimum. The margins before each tree are running
    sums over the trees of a row, apart from the rounds of the fit."""
    boosted, scores = fitted
    terms = boosted.transform(rows).select(*KEYS, "churn", F.posexplode(F.arrays_zip(vector_to_array("leaves").alias("leaf"), scores.terms().alias("value"))))
    trees = terms.select(*KEYS, "churn", F.col("pos").alias("tree"), "col.leaf", "col.value")
    before = Window.partitionBy(*KEYS).orderBy("tree").rowsBetween(Window.unboundedPreceding, -1)
    p = 1 / (1 + F.exp(-F.coalesce(F.sum("value").over(before), F.lit(0.0))))
    pulls = trees.withColumn("p", p).groupBy("tree", "leaf").agg(
        F.count("*").alias("n_rows"), F.sum("churn").cast("bigint").alias("positives"),
        F.sum(F.col("churn") - F.col("p")).alias("pull"), F.sum(F.col("p") * (1 - F.col("p"))).alias("curve"), F.first("value").alias("value"),
    )
    miss = F.abs(F.col("value") * (F.col("curve") + l2) - step * F.col("pull"))
    return pulls.groupBy("tree").agg(F.sum("n_rows").alias("n_rows"), F.sum("positives").alias("positives"), F.max(miss).alias("residual"))
