"""A regression model as Spark jobs: split, features inside the model, fit, score, save."""

from __future__ import annotations

from dataclasses import dataclass
from math import isqrt

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, Window, functions as F

from millrace.operators.aggregates import ranked_counts


def hash_split(df: DataFrame, key: list[str], train_tenths: int = 8) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by the MD5 of their key's text: the same split whenever and by whatever engine."""
    digits = F.substring(F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key])), 1, 8)
    bucket = F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(10))
    return df.where(bucket < train_tenths), df.where(bucket >= train_tenths)


MAX_CATEGORIES = 10_000  # an indicator each; more is an error, never a cut


@dataclass(frozen=True)
class TrainingFacts:
    """What the features need to know of the training rows, from one pass over them."""
    rows: int
    means: dict[str, float]
    deviations: dict[str, float]
    label_deviation: float
    categories: list[str]


def training_facts(train: DataFrame, numeric: list[str], category: str | None, label: str) -> TrainingFacts:
    """Means, population deviations and the values of the category, of which there may be MAX_CATEGORIES."""
    aggs = [F.count(F.lit(1)).alias("rows"), F.stddev_pop(label).alias("label_deviation")]
    aggs += [F.avg(c).alias(f"mean_{c}") for c in numeric] + [F.stddev_pop(c).alias(f"dev_{c}") for c in numeric]
    categories = []
    if category:
        found = train.where(F.col(category).isNotNull()).select(category).distinct().limit(MAX_CATEGORIES + 1).collect()
        if len(found) > MAX_CATEGORIES:
            raise ValueError(f"{category} has more than {MAX_CATEGORIES} values")
        categories = sorted(r[0] for r in found)
    one = train.agg(*aggs).first()
    return TrainingFacts(one["rows"], {c: one[f"mean_{c}"] for c in numeric}, {c: one[f"dev_{c}"] for c in numeric},
                         one["label_deviation"], categories)


def feature_stages(facts: TrainingFacts, category: str | None, cuts: dict[str, list[float]] | None = None) -> list:
    """Numbers scaled by their population deviation, and a category as indicators.

    The stages are ready-made from the facts, so fitting them costs no further pass. A
    constant number becomes zero, and a category that training did not see all zeros.
    With ``cuts`` a second stage puts the number of the bin in place of the scaled number.
    """
    scaled = {f"_scaled_{c}": (f"(`{c}` - {facts.means[c]!r}D) / {d!r}D" if d else "0D")
              for c, d in facts.deviations.items()}
    columns = ", ".join(f"{e} AS `{n}`" for n, e in scaled.items())
    stages = [SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__")]
    inputs = list(scaled)
    if cuts is not None:
        columns = ", ".join(f"{bin_sql(f'_scaled_{c}', cuts[c])} AS `_bin_{c}`" for c in facts.deviations)
        stages.append(SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__"))
        inputs = [f"_bin_{c}" for c in facts.deviations]
    if category:
        stages += [StringIndexerModel.from_labels(facts.categories, inputCol=category, outputCol="_index",
                                                  handleInvalid="keep"),
                   OneHotEncoder(inputCol="_index", outputCol="_indicators", dropLast=True)]
        inputs.append("_indicators")
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features")]


def bin_sql(column: str, cuts: list[float]) -> str:
    """How many of the sorted ``cuts`` are below the number, as a number; what is none stays as it is, for the assembler to refuse."""
    steps = " ".join(f"WHEN `{column}` <= {cut!r}D THEN {at}D" for at, cut in enumerate(cuts))
    return f"CASE WHEN `{column}` IS NULL OR isnan(`{column}`) THEN `{column}` {steps} ELSE {len(cuts)}D END"


def cut_places(df: DataFrame, columns: list[str], bins: int) -> dict[str, list[float]]:
    """Where Spark's trees may cut each number, by the counts of all its values and not of a sample.

    Up to ``bins`` values are cut between each two neighbours. Of more, a cut is made wherever the rows so far
    are nearest to the next multiple of an even share, and one between two values at most: a value that spans several
    shares is made good by the values after it. Only the first values of each share can be cut at, and the last one
    comes before the next share's cut: no more than these come to the driver.
    """
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("_number"), F.col(c).cast("double").alias("_value")) for c in columns])).alias("p"))
    counts = (pairs.select("p.*").where(F.col("_value").isNotNull() & ~F.isnan("_value")).groupBy("_number", "_value")
              .agg(F.count(F.lit(1)).alias("copies")).persist())
    try:
        passed = F.ceil((F.col("before") + F.col("copies") / 2) * bins / F.col("group_rows")) - 1  # shares that end before the middle of its rows
        ranked = ranked_counts(counts, ["_number"], "_value").withColumn("_share", F.least(passed, F.lit(bins - 1)))
        nth = F.row_number().over(Window.partitionBy("_number", "_share").orderBy("_value"))
        firsts, ends = {}, {c: [] for c in columns}
        for r in ranked.withColumn("_nth", nth).where(F.col("_nth") <= bins).select("_number", "_share", "_value").collect():
            firsts.setdefault((r["_number"], r["_share"]), []).append(r["_value"])
        for r in ranked.groupBy("_number", "_share").agg(F.max("_value").alias("last"), F.count(F.lit(1)).alias("values")).collect():
            ends[r["_number"]].append((r["_share"], r["last"], r["values"]))
    finally:
        counts.unpersist()
    cuts = {}
    for column, shares in ends.items():
        found, last = [], None
        every = sum(values for _, _, values in shares) <= bins
        for share, end, _ in sorted(shares):
            for value in sorted(firsts[column, share]):
                if last is not None and (every or len(found) < share):
                    found.append((last + value) / 2)
                last = value
            last = end
        cuts[column] = found
    return cuts


def fit_ridge(train: DataFrame, numeric: list[str], category: str | None, label: str,
              alpha: float = 1.0) -> PipelineModel:
    """Least squares with a squared penalty ``alpha`` on scaled coefficients, in closed form.

    Spark divides the loss by the number of rows and scales the label, hence the factor.
    """
    facts = training_facts(train, numeric, category, label)
    regression = LinearRegression(featuresCol="features", labelCol=label, solver="normal", elasticNetParam=0.0,
                                  standardization=False, regParam=alpha * facts.label_deviation / facts.rows)
    return Pipeline(stages=[*feature_stages(facts, category), regression]).fit(train)


CELLS_A_TASK = 20_000
MOST_BINS = 46_340  # its square is the largest that Spark's trees count in an int


def fit_boosted(train: DataFrame, numeric: list[str], category: str | None, label: str,
                rounds: int = 100, depth: int = 3, bins: int = 32, seed: int = 7) -> PipelineModel:
    """Boosted trees with step 0.1. A number is cut at one of ``bins`` places, between all values where there are no more.

    Trees see of a row only its bins and its category. Rows that agree in these become one cell with its rows as weight and
    their mean as label: sums of residuals, gains and leaf values are those of the rows. So the rows are read a few
    times, not in each round, and every round costs as much as there are cells.
    """
    facts = training_facts(train, numeric, category, label)
    scale = feature_stages(facts, category)[0]
    found = cut_places(scale.transform(train), [f"_scaled_{c}" for c in numeric], bins)
    scale, cut, *encode = feature_stages(facts, category, {c: found[f"_scaled_{c}"] for c in numeric})
    by = [*[f"_bin_{c}" for c in numeric], *([category] if category else [])]
    cells = (cut.transform(scale.transform(train)).groupBy(*by)
             .agg(F.avg(F.col(label).cast("double")).alias(label), F.count(F.lit(1)).cast("double").alias("_rows"))).persist()
    try:
        n = cells.count()
        dealt = cells.coalesce(1 + n // CELLS_A_TASK)
        if n == 1:  # trees want as many rows as an indicator has values
            dealt = dealt.union(dealt)
        # Spark looks for cuts in a sample of rows unless there are fewer than the square of maxBins
        trees = GBTRegressor(featuresCol="features", labelCol=label, weightCol="_rows", maxIter=rounds, stepSize=0.1, maxDepth=depth,
                             maxBins=max(bins, min(isqrt(n) + 1, MOST_BINS)), seed=seed, checkpointInterval=10)
        fitted = Pipeline(stages=[*encode, trees]).fit(dealt)
    finally:
        cells.unpersist()
    return PipelineModel([scale, cut, *fitted.stages])


def mean_absolute_error(scored: DataFrame, label: str) -> DataFrame:
    return scored.agg(F.avg(F.abs(F.col(label) - F.col("prediction"))).alias("mae"),
                      F.count(F.lit(1)).alias("n"))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def prediction_records(scored: DataFrame, inputs: list[str]) -> DataFrame:
    """(instance, prediction), the shape of a batch prediction file."""
    return scored.select(F.struct(*inputs).alias("instance"), "prediction")
