"""Order clustering: features, scaling, K-Means, and exactly repeatable Lloyd iterations.

Both features are integers, so many orders share one point. Training groups them into points
with a row count first. Passes over the points stay small however many orders there are, and a
point that holds a third of all orders is still one row.
"""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.schemas import RESULT_COLUMNS
from salesflow.sources.workspace import saved

# Feature columns and number of clusters.
FEATURES = ["countryid", "amount"]
CLUSTERS = 4

SEED = 17
_ROWS = "rows"
_POINTS_PER_TASK = 50_000


def assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=FEATURES, outputCol="features")


def scaler() -> StandardScaler:
    return StandardScaler(inputCol="features", outputCol="scaledFeatures")


def feature_columns(df: DataFrame, vector: str) -> DataFrame:
    """Order id and the vector's parts as plain columns."""
    parts = vector_to_array(F.col(vector))
    return df.select("orderid", *(parts[i].alias(name) for i, name in enumerate(FEATURES)))


def points(fact: DataFrame) -> DataFrame:
    """Distinct feature points with the number of orders at each."""
    return fact.groupBy(*FEATURES).agg(F.count(F.lit(1)).alias(_ROWS))


def _require_trainable(grouped: DataFrame) -> int:
    """Number of points; an error if there are none or a feature is missing."""
    incomplete = " or ".join(f"{name} is null" for name in FEATURES)
    found = grouped.agg(
        F.count(F.lit(1)).alias("points"), F.count_if(F.expr(incomplete)).alias("incomplete")
    ).first()
    if not found["points"]:
        raise ValueError("clustering needs at least one fact row")
    if found["incomplete"]:
        raise ValueError(f"clustering needs {' and '.join(FEATURES)} in every fact row")
    return found["points"]


def fit(fact: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> PipelineModel:
    """Assembler, fitted scaler and fitted K-Means as one model.

    The scaler sees every order. K-Means sees the weighted points, which leaves the update step
    unchanged. They are stored once, because each iteration reads them again and an executor
    may be lost in between. Equal seeds give equal starts only on equal partitions, hence the
    fixed placement and order.
    """
    grouped = saved(points(fact), "points")
    partitions = math.ceil(_require_trainable(grouped) / _POINTS_PER_TASK)
    placed = grouped.repartition(partitions, *FEATURES).sortWithinPartitions(*FEATURES)
    assemble = assembler()
    scale = scaler().fit(assemble.transform(fact.select(*FEATURES)))
    train = scale.transform(assemble.transform(placed)).select("scaledFeatures", _ROWS)
    kmeans = KMeans(k=k, featuresCol="scaledFeatures", weightCol=_ROWS, seed=seed).fit(train)
    return PipelineModel([assemble, scale, kmeans])


def _in_centre_order(model: PipelineModel) -> Column:
    """The predicted cluster renumbered by its centre, so that labels do not depend on the run."""
    centres = [tuple(c) for c in model.stages[-1].clusterCenters()]
    ranks = sorted(range(len(centres)), key=centres.__getitem__)
    return F.element_at(
        F.array(*(F.lit(ranks.index(i)) for i in range(len(centres)))), F.col("prediction") + 1
    )


def score(model: PipelineModel, fact: DataFrame) -> DataFrame:
    """Every fact row with the number of its nearest centre."""
    scored = model.transform(fact).withColumn("cluster", _in_centre_order(model))
    return scored.select(*RESULT_COLUMNS)


def feature_stddev(fact: DataFrame) -> DataFrame:
    """Sample standard deviation of each feature: what the scaler divides by."""
    return fact.agg(*(F.stddev_samp(name).alias(f"{name}_stddev") for name in FEATURES))


def _wide(column: Column) -> Column:
    return column.cast("decimal(20,0)")


def _weighted_sums(power: int) -> list[Column]:
    """Exact sums of feature powers over all orders (decimals do not overflow or round)."""
    sums = []
    for name in FEATURES:
        value = _wide(F.col(_ROWS))
        for _ in range(power):
            value = (value * F.col(name)).cast("decimal(38,0)")
        sums.append(F.sum(value).alias(f"{name}_{power}"))
    return sums


def _exact_stddev(grouped: DataFrame) -> list[float]:
    total = grouped.agg(
        F.sum(_ROWS).alias(_ROWS), *_weighted_sums(1), *_weighted_sums(2)
    ).first()
    n, spread = int(total[_ROWS]), []
    for name in FEATURES:
        s, q = int(total[f"{name}_1"]), int(total[f"{name}_2"])
        # Integers do not cancel, however far the mean is above the spread.
        spread.append(math.sqrt(float(n * q - s * s) / float(n * (n - 1))) if n > 1 else 0.0)
    return spread


def _distance(centre: tuple[float, ...], spread: list[float]) -> Column:
    """Squared distance to a centre in scaled space."""
    parts = []
    for name, middle, deviation in zip(FEATURES, centre, spread):
        if deviation > 0:  # a constant feature scales to zero and adds no distance
            gap = (F.col(name).cast("double") - F.lit(middle)) / F.lit(deviation)
            parts.append(gap * gap)
    total = parts[0] if parts else F.lit(0.0)
    for part in parts[1:]:
        total = total + part
    return total


def _nearest(centres: list[tuple[float, ...]], spread: list[float]) -> Column:
    """Number of the nearest centre in scaled space; the lowest number wins a tie."""
    options = [
        F.struct(_distance(c, spread).alias("distance"), F.lit(i).alias("cluster"))
        for i, c in enumerate(centres)
    ]
    nearest = F.least(*options) if len(options) > 1 else options[0]
    return nearest["cluster"]


def _chance(step: str) -> Column:
    """A fixed pseudo-random number above 0, up to 1, for a point and a step."""
    bits = F.xxhash64(F.lit(step), *FEATURES).bitwiseAND((1 << 52) - 1)
    return (bits + 1) / float(1 << 52)


def spread_centres(
    grouped: DataFrame, spread: list[float], k: int, seed: int = SEED, candidates: int = 4
) -> list[tuple[float, ...]]:
    """k starting centres that lie apart: points drawn by orders times squared distance.

    Each step draws a few points with these weights by fixed hashes of the points (the smallest
    -ln(u) / weight wins), and takes the one that leaves the smallest summed distance. Nothing depends on
    how points are partitioned, and only the drawn points reach the driver. Fewer centres come back
    if there are fewer different points in scaled space.
    """
    centres: list[tuple[float, ...]] = []
    for step in range(k):
        nearest = _least_distance(centres, spread) if centres else None
        weight = F.col(_ROWS).cast("double") * (F.lit(1.0) if nearest is None else nearest)
        drawn = (
            grouped.filter(weight > 0)
            .select(*FEATURES, (-F.log(_chance(f"{seed}:{step}")) / weight).alias("draw"))
            .orderBy("draw", *FEATURES)
            .limit(candidates)
            .collect()
        )
        points_drawn = [tuple(float(row[name]) for name in FEATURES) for row in drawn]
        if not points_drawn:
            break

        def left(point: tuple[float, ...]) -> Column:
            distance = _distance(point, spread)
            distance = distance if nearest is None else F.least(distance, nearest)
            # Decimals add up alike in any order.
            return F.sum((F.col(_ROWS) * distance).cast("decimal(38,9)"))

        sums = grouped.agg(*(left(p).alias(f"left_{i}") for i, p in enumerate(points_drawn))).first()
        centres.append(min(zip(sums, points_drawn))[1])
    return centres


def seeded_lloyd(
    fact: DataFrame, k: int = CLUSTERS, iterations: int = 100, starts: int = 3, seed: int = SEED
) -> DataFrame:
    """Lloyd iterations until nothing moves, from the best of a few spread starts.

    Repeatable under any partitioning: starts come from hashes, sums are exact.
    """
    grouped = saved(points(fact), "points")
    _require_trainable(grouped)
    spread = _exact_stddev(grouped)
    found = []
    for start in range(starts):
        centres = _moved(grouped, spread, spread_centres(grouped, spread, k, seed + start), iterations)
        inner = F.sum((F.col(_ROWS) * _least_distance(centres, spread)).cast("decimal(38,9)"))
        found.append((grouped.agg(inner.alias("inner")).first()["inner"], centres))
    centres = sorted(min(found)[1])
    return fact.select("orderid", *FEATURES, _nearest(centres, spread).alias("cluster"))


def _least_distance(centres: list[tuple[float, ...]], spread: list[float]) -> Column:
    distances = [_distance(c, spread) for c in centres]
    return F.least(*distances) if len(distances) > 1 else distances[0]


def _moved(
    grouped: DataFrame, spread: list[float], centres: list[tuple[float, ...]], iterations: int
) -> list[tuple[float, ...]]:
    """Centres after Lloyd iterations; a cluster without orders keeps its centre."""
    for _ in range(iterations):
        sums = (
            grouped.groupBy(_nearest(centres, spread).alias("cluster"))
            .agg(F.sum(_ROWS).alias(_ROWS), *_weighted_sums(1))
            .collect()
        )
        moved = list(centres)
        for row in sums:
            moved[row["cluster"]] = tuple(
                float(row[f"{name}_1"]) / float(row[_ROWS]) for name in FEATURES
            )
        if moved == centres:
            break
        centres = moved
    return centres


def lloyd(
    fact: DataFrame,
    centres: list[tuple[float, ...]] | None = None,
    iterations: int = 5,
    k: int = CLUSTERS,
) -> DataFrame:
    """Assign orders after a fixed number of Lloyd iterations from given centres.

    Without centres, the k orders with the lowest ids are used. Centres are kept in feature
    units and computed from exact integer sums, so the result does not depend on how rows are
    partitioned. Only the k centres reach the driver, and they return as literals, so the plan
    does not grow with the iterations.
    """
    grouped = saved(points(fact), "points")
    _require_trainable(grouped)
    spread = _exact_stddev(grouped)
    if centres is None:
        start = fact.orderBy("orderid").select(*FEATURES).limit(k).collect()
        centres = [tuple(float(v) for v in row) for row in start]
    centres = _moved(grouped, spread, centres, iterations)
    return fact.select("orderid", *FEATURES, _nearest(centres, spread).alias("cluster"))


def centres_of(model: PipelineModel) -> list[tuple[float, ...]]:
    """The model's centres in feature units, in the order of the cluster numbers."""
    scale = [float(s) for s in model.stages[1].std]
    scaled = sorted(tuple(map(float, c)) for c in model.stages[-1].clusterCenters())
    return [tuple(v * s for v, s in zip(centre, scale)) for centre in scaled]


def assignment_check(result: DataFrame, model: PipelineModel) -> DataFrame:
    """For every order whether its cluster is one of the model's, and the nearest of them."""
    centres, spread = centres_of(model), [float(s) for s in model.stages[1].std]
    distances = F.array(*(_distance(c, spread) for c in centres))
    own = F.get(distances, F.col("cluster"))
    return result.select(
        "orderid",
        *FEATURES,
        F.col("cluster").between(0, len(centres) - 1).alias("in_range"),
        # Both sides were rounded on different ways.
        (own <= F.array_min(distances) * (1 + 1e-9) + 1e-12).alias("is_nearest"),
    )


def cost(assigned: DataFrame) -> DataFrame:
    """One row: orders, clusters, and the summed squared scaled distance to the clusters' means.

    Computed from one row per cluster.
    """
    squares = [
        (F.count(F.lit(1)) * F.var_pop(name)).alias(f"inner_{name}") for name in FEATURES
    ]
    total = [F.var_samp(name).alias(f"all_{name}") for name in FEATURES]
    per_cluster = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias(_ROWS), *squares)
    inner = per_cluster.agg(
        F.sum(_ROWS).alias(_ROWS),
        F.count(F.lit(1)).alias("clusters"),
        *(F.sum(f"inner_{name}").alias(f"inner_{name}") for name in FEATURES),
    ).first()
    spread = assigned.agg(*total).first()
    value = sum(
        inner[f"inner_{name}"] / spread[f"all_{name}"] for name in FEATURES if spread[f"all_{name}"]
    )
    schema = f"{_ROWS} long, clusters long, cost double"
    return assigned.sparkSession.createDataFrame(
        [(inner[_ROWS], inner["clusters"], float(value))], schema
    )
