"""The model path: features, training frame, trees, scores and their evaluation."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..contract import CLASSES, CONFIDENCE_ORDINAL, FEATURES
from ..fixtures import view
from ..functions import scalars as S
from ..operators import history as H
from ..storage import once, save, shared_folder
from . import labels as L
from .catalog import _GC, det, query
from .oracle import sql_list
from .reports import cutoff_of, spatial_block_split, _CUTOFF

# What stands for a missing number, and the categories of which each value has a column.
MISSING = {
    "bright_ti4": -1.0, "bright_ti5": -1.0, "frp": -1.0,
    "dist_to_industrial_m": 50_000.0, "dist_to_flare_capable_m": 50_000.0, "dist_to_heat_industry_m": 50_000.0,
}
CATEGORIES = ["satellite", "daynight", "landcover_class", "nearest_flare_facility_type", "nearest_heat_facility_type"]
_DISTANCES = [c for c in MISSING if c.startswith("dist_")]


def known_values(column: str) -> list[str]:
    """Of a category, the values that have a column; whatever else is known is "other", and nothing is set for a null."""
    return [v for c, _, v in (f.partition("__") for f in FEATURES) if c == column and v != "other"]


MODEL_CLASSES = ["agricultural burning", "gas flare", "industrial", "wildfire"]
#: Trees of a class at most, their depth, and how much of each tree's correction is taken.
TREES, DEPTH, STEP, SEED = 12, 4, 0.3, 11


def one_hot_columns(columns: list[str]) -> dict[str, Column]:
    out = {}
    for c in columns:
        text, values = F.col(c).cast("string"), known_values(c)
        hot = {f"{c}__{v}": text == v for v in values} | {f"{c}__other": ~text.isin(values)}
        out |= {f: F.coalesce(condition.cast("double"), F.lit(0.0)) for f, condition in hot.items()}
    return out


def feature_columns() -> list[Column]:
    """FEATURES in their order, all double, none null: the same for a batch and for one row."""
    out = one_hot_columns(CATEGORIES)
    for c, instead in MISSING.items():
        number = F.col(c).cast("double")
        lost = number.isNull() | F.isnan(number)
        out |= {c: F.when(lost, instead).otherwise(number), f"{c}_missing": lost.cast("double")}
    out["confidence_ordinal"] = F.coalesce(S.lookup(F.lower(F.trim("confidence")), CONFIDENCE_ORDINAL), F.lit(1)).cast("double")
    out["recurrence_count"] = F.coalesce(F.col("recurrence_count").cast("double"), F.lit(1.0))
    out["is_anomalous"] = F.coalesce(F.col("is_anomalous").cast("double"), F.lit(0.0))
    return [out[f].alias(f) for f in FEATURES]


def feature_matrix(rows: DataFrame, *keep: str) -> DataFrame:
    return rows.select(*keep, *feature_columns())


def _one_hot_sql(columns: list[str]) -> dict[str, str]:
    out = {}
    for c in columns:
        out |= {f"{c}__{v}": f"coalesce(({c}::VARCHAR = '{v}')::INT, 0)::DOUBLE" for v in known_values(c)}
        out[f"{c}__other"] = f"coalesce(({c}::VARCHAR NOT IN ({sql_list(known_values(c))}))::INT, 0)::DOUBLE"
    return out


def _feature_sql(history: str = "recurrence_count") -> str:
    out = _one_hot_sql(CATEGORIES)
    for c, instead in MISSING.items():
        value = f"coalesce({c}, {instead})"
        out |= {c: f"round({value}, 2)::DOUBLE" if c in _DISTANCES else f"{value}::DOUBLE", f"{c}_missing": f"({c} IS NULL)::INT::DOUBLE"}
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in CONFIDENCE_ORDINAL.items())
    out |= {"confidence_ordinal": f"coalesce(CASE lower(confidence) {cases} END, 1)::DOUBLE", "recurrence_count": f"coalesce({history}, 1)::DOUBLE", "is_anomalous": "is_anomalous::INT::DOUBLE"}
    return ", ".join(f'{out[f]} AS "{f}"' for f in FEATURES)


@query("one_hot", "SELECT det_id, " + ", ".join(f'{v} AS "{f}"' for f, v in _one_hot_sql(CATEGORIES).items()) + " FROM feat")
def one_hot(s, d):
    return L.labelled(s, d).select("det_id", *[v.alias(f) for f, v in one_hot_columns(CATEGORIES).items()])


def _rounded(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.round(c, 2) for c in _DISTANCES})


@query("feature_matrix", f"SELECT det_id, {_feature_sql()} FROM lab")
def feature_matrix_query(s, d):
    return _rounded(feature_matrix(L.labelled(s, d), "det_id"))


def prepare_training(s, d) -> DataFrame:
    """det_id, label, is_test and FEATURES of labelled rows outside gold cells. The latest fifth of the days is the test set, and
    recurrence counts days before it only, so that no feature looks past the split."""
    gold = H.with_grid(view(s, d, "gold")).select("cell").distinct()
    rows = L.labelled(s, d).where(F.col("label").isin(MODEL_CLASSES)).join(gold, "cell", "left_anti")
    cutoff = cutoff_of(view(s, d, "detections"))
    past = det(s, d).join(F.broadcast(cutoff)).where(F.col("acq_date") < F.col("cutoff")).groupBy("gi", "gj").agg(F.countDistinct("acq_date").alias("recurrence_count"))
    rows = rows.drop("recurrence_count").join(past, ["gi", "gj"], "left").join(F.broadcast(cutoff))
    return feature_matrix(rows.withColumn("is_test", F.col("acq_date") >= F.col("cutoff")), "det_id", "label", "is_test")


@query("prepare_training", f"""SELECT det_id, label, acq_date >= cutoff AS is_test, {_feature_sql("past.n")} FROM lab, ({_CUTOFF}) c LEFT JOIN (
  SELECT gi AS pi, gj AS pj, count(DISTINCT acq_date) AS n FROM det WHERE acq_date < (SELECT cutoff FROM ({_CUTOFF}) k) GROUP BY gi, gj) past ON pi = gi AND pj = gj
  WHERE label <> 'unknown' AND cell NOT IN (SELECT {_GC} FROM gold)""")
def prepare_training_query(s, d):
    return _rounded(prepare_training(s, d))


@dataclass(frozen=True)
class BoostedTrees:
    """A boosted model for each class against the others, with the columns it was trained on in their order."""

    features: list[str]
    classes: list[str]
    trees: list[GBTClassificationModel]

    def save(self, spark: SparkSession, path: str) -> None:
        for i, t in enumerate(self.trees):
            t.write().overwrite().save(f"{path}/class={i}")
        names = [("feature", i, f) for i, f in enumerate(self.features)] + [("class", i, c) for i, c in enumerate(self.classes)]
        spark.createDataFrame(names, "kind string, i int, name string").coalesce(1).write.mode("overwrite").json(f"{path}/names")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTrees:
        rows = spark.read.schema("kind string, i int, name string").json(f"{path}/names").orderBy("i").collect()
        names = {k: [r.name for r in rows if r.kind == k] for k in ("feature", "class")}
        return BoostedTrees(names["feature"], names["class"], [GBTClassificationModel.load(f"{path}/class={i}") for i in range(len(names["class"]))])


def train_model(rows: DataFrame, features: list[str] = FEATURES) -> BoostedTrees:
    """Boosted trees for each class of ``rows`` against the others. A tenth of the rows, by a hash of all they hold, tells when more trees
    stop to help; where they leave none to learn from, or are none, all rows are learned from. No rows give a model without classes."""
    classes = [r.label for r in rows.select("label").distinct().orderBy("label").collect()]
    held = F.pmod(F.xxhash64("label", *features), F.lit(10)) == 0
    table = VectorAssembler(inputCols=features, outputCol="features").transform(rows.withColumn("is_held", held)).select("label", "features", "is_held")
    table = save(table, "training_vectors")
    stop = {"validationIndicatorCol": "is_held", "validationTol": 0.01} if table.select("is_held").distinct().count() == 2 else {}
    booster = GBTClassifier(labelCol="target", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED, **stop)
    return BoostedTrees(list(features), classes, [booster.fit(table.withColumn("target", (F.col("label") == c).cast("double"))) for c in classes])


def score_model(rows: DataFrame, model: BoostedTrees) -> DataFrame:
    """``rows`` with model_label and probabilities (label -> probability, their sum 1). Refuses rows whose features aren't the model's, in its order.
    A model that had no rows to learn from knows no class: model_label is null and probabilities has no entry."""
    own = [c for c in rows.columns if c in set(model.features) or c in set(FEATURES)]
    if own != model.features:
        raise ValueError(f"the model was trained on {model.features}, the rows have {own}")
    if not model.trees:
        return rows.withColumn("model_label", F.lit(None).cast("string")).withColumn("probabilities", F.create_map().cast("map<string,double>"))
    scored = VectorAssembler(inputCols=model.features, outputCol="features").transform(rows)
    for i, t in enumerate(model.trees):
        t = t.copy({t.predictionCol: f"prediction{i}", t.rawPredictionCol: f"raw{i}", t.probabilityCol: f"probability{i}"})
        scored = t.transform(scored).withColumn(f"p{i}", F.get(vector_to_array(f"probability{i}"), F.lit(1)))
    parts = [F.col(f"p{i}") for i in range(len(model.trees))]
    share = [p / reduce(Column.__add__, parts) for p in parts]
    best = F.array_max(F.array(*[F.struct(p.alias("p"), F.lit(-i).alias("i"), F.lit(c).alias("name")) for i, (p, c) in enumerate(zip(parts, model.classes))]))
    probability = F.map_from_arrays(F.array(*map(F.lit, model.classes)), F.array(*share))
    return scored.withColumn("model_label", best["name"]).withColumn("probabilities", probability).select(*rows.columns, "model_label", "probabilities")


def classify(rows: DataFrame, scored: DataFrame | None) -> DataFrame:
    """det_id, label and label_source: the rule's label where a rule decides, else the model's, else unknown. Without a
    model (None) the rules stand alone."""
    if scored is None:
        return rows.select("det_id", "label", "label_source")
    both = rows.select("det_id", "label", "label_source").join(scored.select("det_id", "model_label"), "det_id", "left")
    use = (F.col("label") == "unknown") & F.col("model_label").isNotNull()
    return both.select("det_id", F.when(use, F.col("model_label")).otherwise(F.col("label")).alias("label"), F.when(use, "model").otherwise(F.col("label_source")).alias("label_source"))


def _training(s, d) -> DataFrame:
    """``prepare_training`` with ``is_new_cell``: whether the row's cell is one of the newest fifth."""
    cells = det(s, d).select("det_id", "cell").join(spatial_block_split(s, d).withColumnRenamed("is_test", "is_new_cell"), "cell").drop("cell")
    return once(s, d, "training", lambda: prepare_training(s, d).join(cells, "det_id"))


_trained: dict[tuple[str, str, str], str] = {}


def trained(s, d, split: str) -> BoostedTrees:
    """The model of the rows that ``split`` (a column of ``_training``) doesn't hold out, trained and written once for an application and input folder, and read back."""
    key = (s.sparkContext.applicationId, d, split)
    if key not in _trained:
        path = f"{shared_folder(s)}/models/{uuid.uuid4().hex}"
        train_model(_training(s, d).where(~F.col(split))).save(s, path)
        _trained[key] = path
    return BoostedTrees.load(s, _trained[key])


def scored_rows(s, d) -> DataFrame:
    make = lambda: score_model(feature_matrix(L.labelled(s, d), "det_id", "label", "acq_date"), trained(s, d, "is_test")).select("det_id", "label", "acq_date", "model_label", "probabilities")
    return once(s, d, "scored", make)


@query("train_model")
def train_model_query(s, d):
    """What was learned for each class: the features by importance, and how many trees."""
    model = trained(s, d, "is_test")
    rows = [(c, f, float(v), t.getNumTrees) for c, t in zip(model.classes, model.trees) for f, v in zip(model.features, t.featureImportances.toArray())]
    return s.createDataFrame(rows, "label string, feature string, importance double, trees int")


@query("score_model")
def score_model_query(s, d):
    return scored_rows(s, d).select("det_id", "model_label", F.map_entries("probabilities").alias("probabilities"))


@query("classify")
def classify_query(s, d):
    return classify(L.labelled(s, d), scored_rows(s, d))


def report(rows: DataFrame, actual: str, predicted: str, labels: list[str]) -> DataFrame:
    """(label, precision, recall, f1, support) of each of ``labels``, then rows for the accuracy, the plain mean and the mean weighted by support."""
    sides = F.array(F.struct(F.col(actual).alias("name"), F.lit(1).alias("t"), F.lit(0).alias("p")), F.struct(F.col(predicted).alias("name"), F.lit(0).alias("t"), F.lit(1).alias("p")))
    each = rows.select((F.col(actual) == F.col(predicted)).cast("int").alias("hit"), F.inline(sides))
    known = rows.sparkSession.createDataFrame([(c,) for c in labels], "name string")
    counts = F.broadcast(known).join(each, "name", "left").groupBy(F.col("name").alias("label")).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(a) for c, a in ((F.col("hit") * F.col("t"), "hits"), (F.col("p"), "predicted"), (F.col("t"), "support"))]
    )
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    hits, told, support = F.col("hits"), F.col("predicted"), F.col("support")
    by_class = counts.select("label", ratio(hits, told).alias("precision"), ratio(hits, support).alias("recall"), ratio(2 * hits, told + support).alias("f1"), "support", "hits")
    scores = ("precision", "recall", "f1")
    whole = F.sum("support")
    mean = by_class.agg(F.lit("macro avg").alias("label"), *[F.avg(c).alias(c) for c in scores], whole.alias("support"))
    weighted = by_class.agg(F.lit("weighted avg").alias("label"), *[ratio(F.sum(F.col(c) * support), whole).alias(c) for c in scores], whole.alias("support"))
    right = by_class.agg(F.lit("accuracy").alias("label"), *[ratio(F.sum("hits"), whole).alias(c) for c in scores], whole.alias("support"))
    return by_class.drop("hits").unionByName(right).unionByName(mean).unionByName(weighted)


_REPORT = f"""WITH c AS (SELECT c.label, count(*) FILTER (WHERE g.label = c.label AND verified_label = c.label) AS hits,
  count(*) FILTER (WHERE g.label = c.label) AS predicted, count(*) FILTER (WHERE verified_label = c.label) AS support
  FROM gold g, (SELECT unnest([{sql_list(CLASSES)}]) AS label) c GROUP BY c.label),
r AS (SELECT label, coalesce(hits / nullif(predicted, 0), 0)::DOUBLE AS precision, coalesce(hits / nullif(support, 0), 0)::DOUBLE AS recall,
  coalesce(2 * hits / nullif(predicted + support, 0), 0)::DOUBLE AS f1, support, hits FROM c)
SELECT label, precision, recall, f1, support::BIGINT AS support FROM r UNION ALL SELECT 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support), sum(hits) / sum(support), sum(support) FROM r
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM r
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM r"""


@query("classification_report", f"SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM ({_REPORT}) t")
def classification_report(s, d):
    r = lambda c: F.round(c, 6).alias(c)
    return report(view(s, d, "gold"), "verified_label", "label", CLASSES).select("label", r("precision"), r("recall"), r("f1"), "support")


def confusion(rows: DataFrame, actual: str, predicted: str, labels: list[str]) -> DataFrame:
    """(actual, predicted, n) for each pair of ``labels``, 0 where there are no rows."""
    spark = rows.sparkSession
    grid = spark.createDataFrame([(a, p) for a in labels for p in labels], "actual string, predicted string")
    counts = rows.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))
    return grid.join(counts, ["actual", "predicted"], "left").select("actual", "predicted", F.coalesce("n", F.lit(0)).alias("n"))


@query("confusion_matrix", f"""SELECT a.l AS actual, p.l AS predicted, (SELECT count(*) FROM gold WHERE verified_label = a.l AND label = p.l) AS n
  FROM (SELECT unnest([{sql_list(CLASSES)}]) AS l) a CROSS JOIN (SELECT unnest([{sql_list(CLASSES)}]) AS l) p""")
def confusion_matrix(s, d):
    return confusion(view(s, d, "gold"), "verified_label", "label", CLASSES)


@query("evaluate_split")
def evaluate_split(s, d):
    """The report of both splits side by side: by date, and by place with the newest fifth of the cells held out."""
    parts = []
    for split, name in (("is_test", "date"), ("is_new_cell", "place")):
        rows = _training(s, d).where(split)
        scored = score_model(rows.select("det_id", "label", *FEATURES), trained(s, d, split))
        parts.append(report(scored, "label", "model_label", MODEL_CLASSES).withColumn("split", F.lit(name)))
    return reduce(DataFrame.unionByName, parts)


@query("train_evaluate")
def train_evaluate(s, d):
    """Accuracy on the rows after the cutoff of a model trained before it."""
    test = scored_rows(s, d).join(_training(s, d).where("is_test").select("det_id"), "det_id", "left_semi")
    return test.agg(F.count("*").alias("n"), F.avg((F.col("label") == F.col("model_label")).cast("double")).alias("accuracy"))
