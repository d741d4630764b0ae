"""Risk classifier (boosted trees) and anomaly model (isolation forest)."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.constants import CLASSIFIER_PARAMS, FOREST_PARAMS, MODEL_FEATURES, STOPPING_PATIENCE, TOP_K
from riskloom.operators.alerts import decide, explain
from riskloom.operators.evaluate import curve_metrics, score_counts
from riskloom.operators.ordering import exact_quantiles
from riskloom.operators.prepare import class_balance
from riskloom.session import stored

# --- classifier --------------------------------------------------------------------


def _training_rows(prepared: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The rows of the train and val splits with class weights, and the model's columns.

    Stored once: the weight and every tree read these rows again."""
    present = [c for c in columns if c in prepared.columns]
    rows = stored(
        prepared.where(F.col("split").isin("train", "val")).select("split", "label", *present)
    )
    train = rows.where(F.col("split") == "train").select((F.col("label") == 1).alias("label"))
    weight = class_balance(train).first()["positive_weight"]
    return rows.withColumns(
        {
            "weight": F.when(F.col("label") == 1, F.lit(float(weight))).otherwise(F.lit(1.0)),
            "is_validation": F.col("split") == "val",
            "label": F.col("label").cast("double"),
        }
    ), present


def _boosting(columns: Sequence[str], params: Mapping[str, float] | None, **more) -> Pipeline:
    gbt = GBTClassifier(
        labelCol="label",
        featuresCol="features",
        weightCol="weight",
        featureSubsetStrategy="0.8",
        **{**CLASSIFIER_PARAMS, **(params or {}), **more},
    )
    return Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="keep"), gbt])


def train_classifier(
    prepared: DataFrame,
    columns: Sequence[str] = tuple(MODEL_FEATURES),
    params: Mapping[str, float] | None = None,
) -> PipelineModel:
    """Fit on the train split; the val split decides when to stop adding trees.

    Positives are weighted by negatives per positive of the train split. Columns are
    sampled per node, not per tree, and stopping watches the loss, so scores differ from
    other boosted-tree libraries. ``train_classifier_by_area`` stops by PR-AUC."""
    rows, present = _training_rows(prepared, columns)
    return _boosting(present, params, validationIndicatorCol="is_validation").fit(rows)


def train_classifier_by_area(
    prepared: DataFrame,
    columns: Sequence[str] = tuple(MODEL_FEATURES),
    params: Mapping[str, float] | None = None,
    patience: int = STOPPING_PATIENCE,
) -> tuple[PipelineModel, DataFrame]:
    """Fit on the train split and keep the number of trees with the best PR-AUC on the val
    split. Returns the model and ``chosen_stage``'s table.

    A boosted ensemble's first k trees do not depend on those after them, so the kept trees
    are the first of the longer fit."""
    rows, present = _training_rows(prepared, columns)
    train = rows.where(F.col("split") == "train")
    whole = _boosting(present, params).fit(train)
    areas = staged_pr_auc(whole, rows.where(F.col("split") == "val").withColumn("label", F.col("label") == 1))
    stages = stored(chosen_stage(areas, patience))
    kept = stages.where("chosen").first()
    if kept is None or kept["trees"] == whole.stages[-1].getNumTrees:
        return whole, stages
    return _boosting(present, params, maxIter=kept["trees"]).fit(train), stages


AREA_STEPS = 10_000


def staged_pr_auc(model: PipelineModel, rows: DataFrame, steps: int = AREA_STEPS) -> DataFrame:
    """``trees, pr_auc``: the area that the first 1, 2, ... trees of a model reach on labelled
    rows (``label`` boolean).

    All trees score a row in one pass. Scores are taken on a grid of ``steps`` cells, so what is
    shuffled is at most trees x cells counts, however many rows there are; two scores in one
    cell count as equal."""
    boosted = model.stages[-1]
    scored = model.stages[0].transform(rows.where(F.col("label").isNotNull()))
    for number, tree in enumerate(boosted.trees):
        scored = tree.setPredictionCol(f"_tree_{number}").transform(scored)
    weighted = [F.col(f"_tree_{n}") * F.lit(w) for n, w in enumerate(boosted.treeWeights)]
    margin = lambda count: F.aggregate(F.slice("each", 1, count), F.lit(0.0), lambda a, x: a + x)
    margins = F.transform(F.sequence(F.lit(1), F.lit(len(weighted))), margin)
    staged = scored.select("label", F.array(*weighted).alias("each")).select(
        "label", F.posexplode(margins).alias("before", "margin")
    )
    # the classifier's probability is the logistic function of twice the margin
    cell = F.floor(F.lit(steps) / (1 + F.exp(-2 * F.col("margin")))) / steps
    counts = score_counts(staged.select((F.col("before") + 1).alias("trees"), "label", cell.alias("score")), ["trees"])
    return curve_metrics(counts, ["trees"]).select("trees", "pr_auc")


def chosen_stage(areas: DataFrame, patience: int = STOPPING_PATIENCE) -> DataFrame:
    """``trees, pr_auc, since_best, reached, chosen`` of a table with one row per tree.

    Adding trees ends once the best area is ``patience`` trees old; the number of trees that
    had it is chosen (the smallest, if several). Where no area is above 0 (no positives to
    judge by), the last one is. One task: the table has as many rows as the model trees."""
    order = Window.partitionBy(F.lit(0)).orderBy("trees")
    whole = Window.partitionBy(F.lit(0))
    areas = areas.select(F.col("trees").cast("int").alias("trees"), "pr_auc")
    order_of = F.struct("pr_auc", (-F.col("trees")).alias("fewest"))
    best = F.max(order_of).over(order)
    aged = areas.withColumn("since_best", F.col("trees") + best["fewest"])
    end = F.min(F.when(F.col("since_best") >= patience, F.col("trees"))).over(whole)
    known = aged.withColumn("reached", F.coalesce(F.col("trees") <= end, F.lit(True)))
    winner = F.max(F.when(F.col("reached"), order_of)).over(whole)
    picked = F.when(winner["pr_auc"] > 0, -winner["fewest"]).otherwise(F.max("trees").over(whole))
    return known.withColumn("chosen", F.col("trees") == picked)


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Add ``score``, the probability of the positive class. Columns the model expects
    and the rows lack count as 0."""
    expected = model.stages[0].getInputCols()
    absent = {c: F.lit(0.0) for c in expected if c not in rows.columns}
    scored = model.transform(rows.withColumns(absent) if absent else rows)
    return scored.withColumn("score", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction", *absent
    )


def importances(model: PipelineModel) -> dict[str, float]:
    names = model.stages[0].getInputCols()
    return dict(zip(names, model.stages[-1].featureImportances.toArray().tolist(), strict=True))


def feature_importance(model: PipelineModel) -> DataFrame:
    """Feature names with their importance, highest first; one row per model column."""
    rows = sorted(importances(model).items(), key=lambda r: (-r[1], r[0]))
    return SparkSession.getActiveSession().createDataFrame(rows, "feature string, importance double")


def score_and_explain(model: PipelineModel, rows: DataFrame, top_k: int = TOP_K) -> DataFrame:
    """Score, decision, top features and risk factors of scoring rows, batch or stream."""
    return explain(decide(score(model, rows)), importances(model), top_k=top_k)


def load_model(folder: str, name: str, version: int) -> PipelineModel:
    return PipelineModel.load(f"{folder}/{name}/{version}")


# --- isolation forest ----------------------------------------------------------------

NODE = "tree int, node int, feature int, cut double, left int, right int, path double"


def _average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among n values (Liu et al. 2008)."""
    n = np.asarray(n, dtype=float)
    harmonic = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def _grow(sample: pd.DataFrame, seed: int) -> pd.DataFrame:
    """One isolation tree over its small sample, as a node table."""
    tree = int(sample["tree"].iloc[0])
    points = np.stack(sample.sort_values("draw")["x"].to_numpy())
    rng = np.random.default_rng([seed, tree])
    limit = int(np.ceil(np.log2(max(len(points), 2))))
    nodes: list[list] = []
    todo = [(points, 0, -1, 0)]
    while todo:
        part, depth, parent, side = todo.pop()
        number = len(nodes)
        if parent >= 0:
            nodes[parent][4 + side] = number
        low, high = part.min(axis=0), part.max(axis=0)
        open_columns = np.flatnonzero(high > low)
        if depth >= limit or len(part) < 2 or len(open_columns) == 0:
            nodes.append([tree, number, -1, 0.0, -1, -1, depth + float(_average_path(len(part)))])
            continue
        column = int(rng.choice(open_columns))
        cut = float(rng.uniform(low[column], high[column]))
        nodes.append([tree, number, column, cut, -1, -1, 0.0])
        goes_left = part[:, column] <= cut
        todo.append((part[goes_left], depth + 1, number, 0))
        todo.append((part[~goes_left], depth + 1, number, 1))
    return pd.DataFrame(nodes, columns=["tree", "node", "feature", "cut", "left", "right", "path"])


class IsolationForest:
    """A grown forest: node table (at most trees x 2 x sample rows), columns, sample size."""

    def __init__(self, nodes: DataFrame, columns: Sequence[str], sample_rows: int):
        self.nodes, self.columns, self.sample_rows = nodes, list(columns), sample_rows

    def save(self, path: str) -> None:
        marked = self.nodes.withColumns(
            {"columns": F.lit(",".join(self.columns)), "sample_rows": F.lit(self.sample_rows)}
        )
        marked.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> IsolationForest:
        stored = spark.read.parquet(path)
        head = stored.select("columns", "sample_rows").first()
        return cls(stored.drop("columns", "sample_rows"), head["columns"].split(","), head["sample_rows"])


def train_isolation_forest(
    rows: DataFrame,
    columns: Sequence[str] = tuple(MODEL_FEATURES),
    trees: int = FOREST_PARAMS["trees"],
    sample_rows: int = FOREST_PARAMS["sample_rows"],
    seed: int = FOREST_PARAMS["seed"],
    key: str = "transaction_id",
) -> IsolationForest:
    """Grow trees on random samples of 256 rows each, one task per tree.

    Each row gets a hash per tree and the smallest 256 form that tree's sample. A threshold
    on the hash leaves a few times 256 rows of all rows for each tree before anything is
    copied or ranked, so groups stay small whatever the table's size."""
    present = [c for c in columns if c in rows.columns]
    total = rows.count()
    unit = lambda *parts: (F.pmod(F.xxhash64(*parts), F.lit(1 << 40)) / float(1 << 40))
    values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in present])
    keep = min(1.0, 4.0 * sample_rows / max(total, 1))
    draw = lambda tree: unit(F.col(key), F.lit(seed), tree)
    chosen = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: draw(t) <= keep)
    drawn = (
        rows.select(key, values.alias("x"), F.explode(chosen).alias("tree"))
        .select("tree", draw(F.col("tree")).alias("draw"), "x")
        .groupBy("tree")
        .agg(F.slice(F.sort_array(F.collect_list(F.struct("draw", "x"))), 1, sample_rows).alias("s"))
        .select("tree", F.explode("s").alias("s"))
        .select("tree", "s.draw", "s.x")
    )
    nodes = drawn.groupBy("tree").applyInPandas(lambda sample: _grow(sample, seed), NODE)
    return IsolationForest(stored(nodes), present, min(sample_rows, total))


def anomaly_scores(forest: IsolationForest, rows: DataFrame, out: str = "anomaly_score") -> DataFrame:
    """2^(-mean path / expected path): near 1 is unusual, below 0.5 is usual.

    The forest has a fixed maximal size (a few MB), so it goes to every executor; rows
    are walked through all trees in Arrow batches, without a shuffle."""
    table = forest.nodes.orderBy("tree", "node").toPandas()
    starts = table.index[table["node"] == 0].to_numpy()
    offset = starts[np.searchsorted(starts, np.arange(len(table)), side="right") - 1]
    feature = table["feature"].to_numpy()
    # leaves point at themselves, so every row can walk the same number of steps
    left = np.where(feature < 0, np.arange(len(table)), table["left"].to_numpy() + offset)
    right = np.where(feature < 0, np.arange(len(table)), table["right"].to_numpy() + offset)
    arrays = (starts, np.maximum(feature, 0), table["cut"].to_numpy(), left, right, table["path"].to_numpy())
    shared = rows.sparkSession.sparkContext.broadcast(arrays)
    steps = int(np.ceil(np.log2(max(forest.sample_rows, 2))))
    expected = float(_average_path(forest.sample_rows))

    @F.pandas_udf("double")
    def walk(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        roots, feature, cut, left, right, path = shared.value
        for batch in batches:
            if not len(batch):
                yield pd.Series([], dtype=float)
                continue
            x = np.stack(batch.to_numpy())
            every = np.arange(len(x))
            depth = np.zeros(len(x))
            for root in roots:
                at = np.full(len(x), root)
                for _ in range(steps):
                    at = np.where(x[every, feature[at]] <= cut[at], left[at], right[at])
                depth += path[at]
            yield pd.Series(2.0 ** (-depth / len(roots) / max(expected, 1e-9)))

    vector = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in forest.columns])
    return rows.withColumn(out, walk(vector))


def is_anomaly(scored: DataFrame, contamination: float = FOREST_PARAMS["contamination"], score_column: str = "anomaly_score") -> DataFrame:
    """Flag the expected share of most unusual rows, by the exact quantile of the scores."""
    one = scored.select(F.lit(1).alias("all"), score_column)
    cut = exact_quantiles(one, [1.0 - contamination], ["all"], score_column).select("quantile").scalar()
    return scored.withColumn("is_anomaly", F.col(score_column) > cut)
