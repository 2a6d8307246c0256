"""Churn: features, exact stratified split, boosted trees, search of parameters, attribution, promotion."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.functions import values as V
from tidemark.operators import attribution, gold, parzen
from tidemark.operators.metrics import all_metrics, auc_rank
from tidemark.operators.parzen import Dim
from tidemark.operators.ranking import number_rows

LABEL = "churn"


# --- features -------------------------------------------------------------------------


def churn_features(rfm: DataFrame, days: int = 30) -> DataFrame:
    """RFM row per customer with the label "no purchase in the last ``days``".

    The label is a function of a feature, as in the published feature table; see
    :func:`forward_features` for one without that leak.
    """
    return rfm.select(
        "id_cliente", "recency_dias", "frequency", "monetary", "r_score", "f_score", "m_score",
        "rfm_score", "segmento", C.churn_label("recency_dias", days).alias(LABEL),
    )


#: Days of purchases that features look back on.
HISTORY_DAYS = 180


def forward_features(df: DataFrame, cutoff: str, days: int = 30, history: int = HISTORY_DAYS) -> DataFrame:
    """Features from the ``history`` days up to ``cutoff``; label from the ``days`` after it."""
    kind = df.schema["dt_transacao"].dataType
    start = F.date_add(F.lit(cutoff).cast("date"), 1).cast(kind)
    end = F.date_add(F.lit(cutoff).cast("date"), days + 1).cast(kind)
    buyers = (
        df.filter((F.col("dt_transacao") >= start) & (F.col("dt_transacao") < end))
        .select("id_cliente").distinct().withColumn("__back", F.lit(True))
    )
    known = gold.rfm(df, cutoff, history)
    return (
        churn_features(known, days).drop(LABEL)
        .join(buyers, "id_cliente", "left")
        .withColumn(LABEL, F.col("__back").isNull().cast("int"))
        .drop("__back")
    )


def positive_rate(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.agg(F.avg(F.col(label).cast("double")).alias("taxa"), F.count(F.lit(1)).alias("linhas"))


def index_col(df: DataFrame, c: str = "segmento", out: str = "segmento_enc") -> DataFrame:
    """Category as its position in alphabetical order."""
    indexer = StringIndexer(inputCol=c, outputCol=out, stringOrderType="alphabetAsc")
    return indexer.fit(df).transform(df)


def assemble(df: DataFrame, features: Sequence[str] = V.FEATURES, out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(df)


def stratified_split(
    df: DataFrame, parts: Mapping[str, float], key: str = "id_cliente", label: str = LABEL, seed: int = 42,
    out: str = "part",
) -> DataFrame:
    """Names the part of every row: exact shares within each class, the same on every run.

    Rows of a class are numbered in the order of a seeded hash of their key; the last part
    takes what rounding leaves.
    """
    counts = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}  # one row per class
    hashed = df.withColumn("__hash", F.xxhash64(F.lit(seed), F.col(key)))
    numbered = number_rows(hashed, [label, "__hash", key], "__rn")
    names = list(parts)
    total = sum(parts.values())
    chosen, before = F, 0
    for value in sorted(counts, key=lambda v: (v is not None, v)):
        share = 0.0
        for name in names[:-1]:
            share += parts[name] / total
            upto = before + round(share * counts[value])
            chosen = chosen.when(F.col(label).eqNullSafe(F.lit(value)) & (F.col("__rn") <= upto), name)
        before += counts[value]
    return numbered.withColumn(out, chosen.otherwise(names[-1]) if chosen is not F else F.lit(names[-1])).drop(
        "__rn", "__hash"
    )


# --- training -------------------------------------------------------------------------


@dataclass(frozen=True)
class Space:
    """Bounds of the search, inclusive. Learning rate is drawn on a log scale."""

    depth: tuple[int, int] = (3, 12)
    min_rows: tuple[int, int] = (1, 10)
    row_share: tuple[float, float] = (0.6, 1.0)
    column_share: tuple[float, float] = (0.6, 1.0)
    rate: tuple[float, float] = (0.005, 0.3)
    trees: tuple[int, int, int] = (100, 800, 50)
    min_gain: tuple[float, float] = V.MIN_GAIN

    def draw(self, rng: random.Random) -> dict[str, float]:
        low, high = self.rate
        return {
            "maxDepth": rng.randint(*self.depth),
            "minInstancesPerNode": rng.randint(*self.min_rows),
            "subsamplingRate": rng.uniform(*self.row_share),
            "featureSubsetStrategy": str(round(rng.uniform(*self.column_share), 3)),
            "stepSize": low * (high / low) ** rng.random(),
            "maxIter": rng.randrange(self.trees[0], self.trees[1] + 1, self.trees[2]),
            "minInfoGain": rng.uniform(*self.min_gain),
        }


    def dims(self) -> list[Dim]:
        """The same bounds for a search that learns from its trials."""
        low, high, step = self.trees
        return [
            Dim("maxDepth", *self.depth, step=1), Dim("minInstancesPerNode", *self.min_rows, step=1),
            Dim("subsamplingRate", *self.row_share), Dim("featureSubsetStrategy", *self.column_share),
            Dim("stepSize", *self.rate, log=True), Dim("maxIter", low, low + (high - low) // step * step, step=step),
            Dim("minInfoGain", *self.min_gain),
        ]


# Small enough for tests and local runs.
SMALL_SPACE = Space(depth=(2, 4), trees=(3, 9, 3), min_gain=(0.0, 0.05), rate=(0.05, 0.3))


def classifier(params: Mapping[str, object] | None = None, seed: int = 42) -> GBTClassifier:
    return GBTClassifier(featuresCol="features", labelCol=LABEL, seed=seed, **(params or {}))


def preparation(features: Sequence[str] = V.FEATURES) -> Pipeline:
    indexer = StringIndexer(
        inputCol="segmento", outputCol="segmento_enc", stringOrderType="alphabetAsc", handleInvalid="keep"
    )
    return Pipeline(stages=[indexer, VectorAssembler(inputCols=list(features), outputCol="features")])


def train_gbt(train: DataFrame, params: Mapping[str, object] | None = None, features: Sequence[str] = V.FEATURES) -> PipelineModel:
    """Preparation and boosted trees as one model over raw feature rows."""
    prepared = preparation(features).fit(train)
    model = classifier(params).fit(prepared.transform(train))
    return PipelineModel(stages=[*prepared.stages, model])


def score(model: PipelineModel, df: DataFrame, out: str = "score") -> DataFrame:
    """Probability of churn per row."""
    scored = model.transform(df).withColumn(out, vector_to_array("probability")[1])
    return scored.select(*df.columns, out)


def _run_trials(
    train: DataFrame, val: DataFrame, drawn: Sequence[Mapping[str, object]], first: int = 0, parallel: int = 4
) -> list:
    """Rows (trial, parameters, metrics) of trials that are fitted side by side, then scored in one pass."""
    spark = train.sparkSession
    with ThreadPool(max(1, min(parallel, len(drawn)))) as pool:
        models = pool.map(inheritable_thread_target(spark)(lambda p: train_gbt(train, p)), drawn)
    scored = reduce(DataFrame.unionByName, [
        score(m, val).select(F.lit(first + i).alias("trial"), F.col(LABEL), "score") for i, m in enumerate(models)
    ])
    return all_metrics(scored, LABEL, "score", ["trial"]).collect()  # one row per trial


def _log(spark: SparkSession, drawn: Sequence[Mapping[str, object]], measured: Sequence) -> tuple[dict[str, object], DataFrame]:
    """(the parameters of the trial with the best AUC, one row per trial)."""
    kinds = {str: "string", float: "double", int: "int"}
    fields = [f"{k} {kinds[type(v)]}" for k, v in drawn[0].items()]
    of = {r["trial"]: r.asDict() for r in measured}
    metrics = [c for c in measured[0].asDict() if c != "trial"]
    types = {c: "long" if all(isinstance(r[c], int) for r in of.values()) else "double" for c in metrics}
    rows = [(i, *p.values(), *[of[i][c] for c in metrics]) for i, p in enumerate(drawn)]
    log = spark.createDataFrame(rows, ", ".join(["trial int", *fields, *[f"{c} {types[c]}" for c in metrics]]))
    auc = {i: of[i]["auc"] for i in of}
    best = max(auc, key=lambda i: (auc[i] if auc[i] is not None else -1.0, -i))
    return dict(drawn[best]), log


def random_search(
    train: DataFrame, val: DataFrame, space: Space = Space(), trials: int = 30, seed: int = 42, parallel: int = 4
) -> tuple[dict[str, object], DataFrame]:
    """(best parameters, trial log) of parameters drawn independently.

    ``train`` and ``val`` are read by every trial; give frames that are cached or stored.
    """
    rng = random.Random(seed)
    drawn = [space.draw(rng) for _ in range(trials)]
    return _log(train.sparkSession, drawn, _run_trials(train, val, drawn, 0, parallel))


def _params(values: Mapping[str, float]) -> dict[str, object]:
    """Searched values as the classifier takes them."""
    return {k: str(round(v, 3)) if k == "featureSubsetStrategy" else v for k, v in values.items()}


def parzen_search(
    train: DataFrame, val: DataFrame, space: Space = Space(), trials: int = 30, seed: int = 42, parallel: int = 4
) -> tuple[dict[str, object], DataFrame]:
    """(best parameters, trial log) of a search that learns from its trials (``parzen``); loss is one less the AUC.

    ``parallel`` trials are fitted side by side, and the next ones chosen from their results.
    """
    measured, drawn = [], []

    def run(batch: list[dict[str, float]]) -> list[float]:
        made = [_params(p) for p in batch]
        rows = {r["trial"]: r for r in _run_trials(train, val, made, len(drawn), parallel)}
        losses = [1.0 - (rows[len(drawn) + i]["auc"] or 0.0) for i in range(len(batch))]
        measured.extend(rows.values())
        drawn.extend(made)
        return losses

    parzen.minimise(space.dims(), run, trials, seed, parallel)
    return _log(train.sparkSession, drawn, measured)


def fit_final(train: DataFrame, val: DataFrame, test: DataFrame, params: Mapping[str, object]) -> tuple[PipelineModel, DataFrame]:
    """Model of train and validation rows together, and its metrics on the untouched test rows."""
    model = train_gbt(train.unionByName(val), params)
    return model, all_metrics(score(model, test), LABEL, "score")


def permutation_importance(
    model: PipelineModel, df: DataFrame, features: Sequence[str], key: str = "id_cliente", seed: int = 42
) -> DataFrame:
    """Loss of AUC when the values of one feature are exchanged between rows, largest first.

    One pairing of every row with another serves all features.
    """
    rows = number_rows(df, [key], "__n")
    donors = number_rows(
        df.select(key, *features).withColumn("__h", F.xxhash64(F.lit(seed), F.col(key))), ["__h", key], "__n"
    ).select("__n", *[F.col(c).alias(f"__d_{c}") for c in features])
    paired = rows.join(donors, "__n")
    versions = [score(model, df).select(F.lit("").alias("feature"), F.col(LABEL), "score")]
    for c in features:
        swapped = paired.withColumn(c, F.col(f"__d_{c}")).select(*df.columns)
        versions.append(score(model, swapped).select(F.lit(c).alias("feature"), F.col(LABEL), "score"))
    measured = auc_rank(reduce(DataFrame.unionByName, versions), LABEL, "score", ["feature"])
    base = measured.filter("feature = ''").select("auc").first()["auc"]
    return (
        measured.filter("feature <> ''")
        .select("feature", (F.lit(base) - F.col("auc")).alias("importance"))
        .orderBy(F.desc("importance"), "feature")
    )


def attributed(model: PipelineModel, df: DataFrame, features: Sequence[str] = V.FEATURES) -> DataFrame:
    """Rows with the Shapley values of their features, which add up with ``base`` to ``margin``."""
    *prepared, trees = model.stages
    vectors = PipelineModel(stages=prepared).transform(df)
    found = attribution.shapley(trees, vectors, features)
    return found.select(*df.columns, "attribution", "base", "margin")


# --- registry -------------------------------------------------------------------------

PRODUCTION, ARCHIVED = "Production", "Archived"
REGISTRY_SCHEMA = (
    "name string, version int, auc double, stage string, trained_at timestamp, path string, "
    "input_schema string, output_schema string, input_example string"
)


def register(spark: SparkSession, model: PipelineModel, path: str, name: str, version: int, auc: float, at: object, sample: DataFrame) -> DataFrame:
    """Saves the model and returns its registry row: schemas of input and output, five input rows."""
    model.write().overwrite().save(path)
    out = score(model, sample)
    rows = sample.limit(5).agg(F.to_json(F.collect_list(F.struct("*"))).alias("rows")).first()["rows"]
    row = (name, version, auc, "None", at, path, sample.schema.json(), out.schema.json(), rows)
    return spark.createDataFrame([row], REGISTRY_SCHEMA)


REGISTRY_COLUMNS = [f.split()[0] for f in REGISTRY_SCHEMA.split(", ")]


def promote(registry: DataFrame, min_auc: float = 0.75) -> DataFrame:
    """Per model name the candidate to put in production, if any.

    The best version must reach ``min_auc`` and beat the version now in production.
    """
    place = F.struct(F.col("auc"), -F.col("version"))
    incumbent = F.max(F.when(F.col("stage") == PRODUCTION, F.col("auc")))
    best = registry.filter(F.col("auc").isNotNull()).groupBy("name").agg(
        F.max_by("version", place).alias("version"),
        F.max("auc").alias("auc"),
        incumbent.alias("incumbent_auc"),
    )
    better = F.col("incumbent_auc").isNull() | (F.col("auc") > F.col("incumbent_auc"))
    return best.filter((F.col("auc") >= min_auc) & better)


def with_stages(registry: DataFrame, min_auc: float = 0.75) -> DataFrame:
    """The registry after promotion: a candidate is in production, what it replaces is archived, all else stays."""
    chosen = promote(registry, min_auc).select("name", F.col("version").alias("__chosen"))  # one row per name
    stage = (
        F.when(F.col("version") == F.col("__chosen"), PRODUCTION)
        .when(F.col("__chosen").isNotNull() & (F.col("stage") == PRODUCTION), ARCHIVED)
        .otherwise(F.col("stage"))
    )
    return registry.join(chosen, "name", "left").withColumn("stage", stage).drop("__chosen")


def latest_stages(entries: DataFrame) -> DataFrame:
    """One row per model version from an append-only registry: the last entry counts."""
    last = F.max_by(F.struct(*[c for c in entries.columns if c not in ("name", "version")]), "entry")
    return entries.groupBy("name", "version").agg(last.alias("x")).select("name", "version", "x.*")
