"""Model specs, the table they live in, and scoring as a column.

A spec is small control data.  Linear, logistic and small tree models become
plain column expressions; large tree models and user-supplied models run as an
Arrow-batched iterator UDF that loads the model once per task.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from importlib import import_module
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorefold.functions import kernels as K
from scorefold.functions import rules
from scorefold.operators.features import add_funding_features
from scorefold.operators.impute import loan_columns
from scorefold.operators.projection import add_approval_names, require_columns

# Beyond this many nodes nested CASE expressions cost more than a batch UDF.
MAX_COLUMN_NODES = 256


def _with_link(x: str, link: str) -> str:
    return f"1 / (1 + exp(-({x})))" if link == "logistic" else x


def _link_array(x: np.ndarray, link: str) -> np.ndarray:
    return 1 / (1 + np.exp(-x)) if link == "logistic" else x


@dataclass(frozen=True)
class LinearModel:
    """Weighted sum with an identity or logistic link; missing inputs count as ``missing``."""

    weights: dict[str, float]
    intercept: float = 0.0
    link: str = "identity"
    missing: float = 0.0

    @property
    def features(self) -> list[str]:
        return list(self.weights)

    @property
    def as_column(self) -> bool:
        return True

    def sql(self) -> str:
        gap = K.literal(float(self.missing))
        terms = [K.literal(float(self.intercept))]
        for name, weight in self.weights.items():
            x = f"CAST({K.quoted(name)} AS DOUBLE)"
            terms.append(f"coalesce(nanvl({x}, {gap}), {gap}) * {K.literal(float(weight))}")
        return _with_link(" + ".join(terms), self.link)

    def load(self) -> Callable[[pd.DataFrame], np.ndarray]:
        weights = np.array(list(self.weights.values()))

        def predict(batch: pd.DataFrame) -> np.ndarray:
            x = batch[self.features].astype("float64").fillna(self.missing).to_numpy()
            return _link_array(x @ weights + self.intercept, self.link)

        return predict

    def to_json(self) -> str:
        return json.dumps({
            "kind": "linear", "weights": self.weights, "intercept": self.intercept,
            "link": self.link, "missing": self.missing,
        })


#: Rows times trees that are walked at once.
WALKED = 1 << 20


@dataclass(frozen=True)
class FlatTrees:
    """Trees as arrays over all their nodes: a leaf has feature -1 and stays where it is."""

    names: list[str]
    roots: np.ndarray
    feature: np.ndarray
    below: np.ndarray
    yes: np.ndarray
    no: np.ndarray
    #: Whether a missing value follows ``yes``.
    missing_yes: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    depth: int

    @staticmethod
    def of(trees: Sequence[dict]) -> FlatTrees:
        names: dict[str, int] = {}
        rows, roots, depth = [], [], 0
        for tree in trees:
            roots.append(len(rows))
            level = [(tree, None, None)]
            height = -1
            while level:  # level by level: a node's row is known before its children's
                height += 1
                below = []
                for node, parent, side in level:
                    at = len(rows)
                    if parent is not None:
                        rows[parent][side] = at
                    if "leaf" in node:
                        rows.append([-1, 0.0, at, at, False, node["leaf"], 0.0])
                    else:
                        f = names.setdefault(node["feature"], len(names))
                        rows.append([f, node["below"], 0, 0, node["missing"] == "yes", 0.0, node.get("gain", 0.0)])
                        below += [(node["yes"], at, 2), (node["no"], at, 3)]
                level = below
            depth = max(depth, height)
        columns = list(zip(*rows)) if rows else [()] * 7
        kinds = (np.int64, float, np.int64, np.int64, bool, float, float)
        return FlatTrees(list(names), np.array(roots, np.int64), *(np.array(c, k) for c, k in zip(columns, kinds)), depth)

    def add_up(self, x: np.ndarray, base: float) -> np.ndarray:
        """Base and the leaves of every row of ``x``, whose columns are ``names``, added tree by tree."""
        out = np.empty(len(x))
        step = max(1, WALKED // max(1, len(self.roots)))
        for begin in range(0, len(x), step):
            part = x[begin:begin + step]
            rows = np.arange(len(part))[:, None]
            at = np.tile(self.roots, (len(part), 1))
            for _ in range(self.depth):
                feature = self.feature[at]
                v = part[rows, np.maximum(feature, 0)]
                left = (v < self.below[at]) | (np.isnan(v) & self.missing_yes[at])
                at = np.where(left, self.yes[at], self.no[at])
            total = np.full(len(part), float(base))
            for values in self.value[at].T:
                total += values
            out[begin:begin + step] = total
        return out


@dataclass(frozen=True)
class TreeModel:
    """Sum of regression trees.

    A node is ``{"leaf": value}`` or ``{"feature", "below", "yes", "no",
    "missing": "yes" | "no"}``: values below the threshold follow ``yes``.
    """

    trees: list[dict]
    base: float = 0.0
    link: str = "identity"

    @property
    def features(self) -> list[str]:
        return self.flat().names

    @property
    def as_column(self) -> bool:
        def size(node: dict) -> int:
            return 1 if "leaf" in node else 1 + size(node["yes"]) + size(node["no"])

        return sum(size(t) for t in self.trees) <= MAX_COLUMN_NODES

    def sql(self) -> str:
        def branch(node: dict) -> str:
            if "leaf" in node:
                return K.literal(float(node["leaf"]))
            x = f"CAST({K.quoted(node['feature'])} AS DOUBLE)"
            gone = f"({x} IS NULL OR isnan({x}))"
            test = f"{x} < {K.literal(float(node['below']))}"
            test = f"({gone} OR {test})" if node["missing"] == "yes" else f"(NOT {gone} AND {test})"
            return K.case([(test, branch(node["yes"]))], branch(node["no"]))

        return _with_link(" + ".join([K.literal(float(self.base)), *map(branch, self.trees)]), self.link)

    def flat(self) -> FlatTrees:
        return FlatTrees.of(self.trees)

    def load(self) -> Callable[[pd.DataFrame], np.ndarray]:
        flat = self.flat()

        def predict(batch: pd.DataFrame) -> np.ndarray:
            x = batch[flat.names].astype("float64").to_numpy() if flat.names else np.empty((len(batch), 0))
            return _link_array(flat.add_up(x, self.base), self.link)

        return predict

    def importance(self) -> dict[str, float]:
        """Gain per feature, summed over splits that record one."""
        flat = self.flat()
        split = flat.feature >= 0
        gains = np.bincount(flat.feature[split], weights=flat.gain[split], minlength=len(flat.names))
        return dict(zip(flat.names, gains.tolist()))

    def to_json(self) -> str:
        return json.dumps({"kind": "trees", "trees": self.trees, "base": self.base, "link": self.link})


def _imported(place: str):
    """The object that ``package.module:name`` names."""
    module, _, name = place.partition(":")
    return getattr(import_module(module), name)


@dataclass(frozen=True)
class CustomModel:
    """A user's model: ``loader`` runs once per task and returns ``predict(batch)``.

    To live in a model table, ``loader`` is the text ``package.module:function``
    of a function that the executors can import; ``settings`` are its arguments.
    """

    feature_names: Sequence[str]
    loader: str | Callable[..., Callable[[pd.DataFrame], Any]]
    settings: dict = field(default_factory=dict)

    @property
    def features(self) -> list[str]:
        return list(self.feature_names)

    @property
    def as_column(self) -> bool:
        return False

    def load(self) -> Callable[[pd.DataFrame], Any]:
        loader = _imported(self.loader) if isinstance(self.loader, str) else self.loader
        return loader(**self.settings)

    def to_json(self) -> str:
        if not isinstance(self.loader, str):
            raise ValueError("a stored model names its loader as 'package.module:function'")
        return json.dumps({"kind": "custom", "feature_names": self.features, "loader": self.loader, "settings": self.settings})


def load_linear(**settings) -> Callable[[pd.DataFrame], np.ndarray]:
    """Loader of a linear model for ``CustomModel``: its settings are those of ``LinearModel``."""
    return LinearModel(**settings).load()


@dataclass(frozen=True)
class PreparedModel:
    """A model with the preparation of its inputs, ``package.module:function`` from frame to frame, run before it scores."""

    model: LinearModel | TreeModel | CustomModel
    prepare: str

    def to_json(self) -> str:
        return json.dumps(json.loads(self.model.to_json()) | {"prepare": self.prepare})

    def __getattr__(self, name: str):
        return getattr(object.__getattribute__(self, "model"), name)


def model_from_json(text: str) -> LinearModel | TreeModel | CustomModel | PreparedModel:
    spec = json.loads(text)
    kind, prepare = spec.pop("kind"), spec.pop("prepare", None)
    model = {"linear": LinearModel, "trees": TreeModel, "custom": CustomModel}[kind](**spec)
    return PreparedModel(model, prepare) if prepare else model


# -------------------------------------------------------------------- scoring

_RUN = "__run"


def arrow_scorer(model) -> Callable[..., Column]:
    """Iterator UDF over a struct of features; rows not marked to run give NULL, a NaN score stays NaN."""

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        predict = model.load()
        for batch in batches:
            table = pa.RecordBatch.from_struct_array(batch).to_pandas()
            wanted = table[_RUN].to_numpy(dtype=bool, na_value=False)
            scores = np.zeros(len(table))
            if wanted.any():
                scores[wanted] = np.asarray(predict(table.loc[wanted].drop(columns=_RUN)), dtype="float64")
            yield pa.array(scores, pa.float64(), mask=~wanted, from_pandas=False)

    return run


def score(
    df: DataFrame, model, output: str, where: str | None = None, engine: str = "auto"
) -> DataFrame:
    """Add ``output`` with the model's score; rows outside the condition ``where`` get NULL.

    Only the model's own features reach the model, so unused columns are
    pruned at the scan.  ``engine`` is "column", "arrow" or "auto".
    """
    if engine not in ("auto", "column", "arrow"):
        raise ValueError("engine must be 'auto', 'column' or 'arrow'")
    if isinstance(model, PreparedModel):
        # The preparation may overwrite columns, which the caller gets back as they were.
        copies = df.withColumns({f"_own_{c}": F.col(K.quoted(c)) for c in df.columns})
        ready = score(_imported(model.prepare)(copies), model.model, output, where, engine)
        return ready.select(*[F.col(K.quoted(f"_own_{c}")).alias(c) for c in df.columns if c != output], output)
    if engine == "column" or (engine == "auto" and model.as_column):
        return K.with_sql(df, {output: model.sql() if where is None else K.case([(where, model.sql())])})
    require_columns(df, model.features)
    run = "TRUE" if where is None else f"coalesce({where}, FALSE)"
    fields = [f"'{c}', {K.quoted(c)}" for c in model.features] + [f"'{_RUN}', {run}"]
    return df.withColumn(output, arrow_scorer(model)(F.expr(f"named_struct({', '.join(fields)})")))


def cast_loan_inputs(df: DataFrame) -> DataFrame:
    """Integer inputs of the loan-amount model, truncated; text that is no number gives NULL."""
    return K.with_sql(df, {c: f"TRY_CAST(TRY_CAST({c} AS DOUBLE) AS INT)" for c in ("W49_AUC1002", "lastreportedhousingpayment")})


def cast_legacy_loan_inputs(df: DataFrame) -> DataFrame:
    return K.with_sql(cast_loan_inputs(df), {"PIE_v4": "TRY_CAST(PIE_v4 AS FLOAT)"})


@dataclass(frozen=True)
class ScoreStep:
    """One score of a run: output column, model reference and input preparation."""

    output: str
    model: str
    prepare: Callable[[DataFrame], DataFrame] = field(default=lambda df: df)

    def apply(self, df: DataFrame, models: ModelTable, where: str | None = None) -> DataFrame:
        return score(self.prepare(df), models.resolve(self.model), self.output, where)


# --- fixed values: score columns and the versions they come from -------------
CURRENT_SCORES = {
    "PIE_Income_Estimation": ScoreStep("PIE_Income_Estimation", "models:/income/Production"),
    "LAE_Loan_Amount_Estimation": ScoreStep(
        "LAE_Loan_Amount_Estimation", "models:/loan_amount/Production", cast_loan_inputs
    ),
    "CM_Credit_Model_Score": ScoreStep(
        "CM_Credit_Model_Score", "models:/credit/1", lambda df: K.with_sql(df, loan_columns())
    ),
    "RR_ResponseProb_v9": ScoreStep("RR_ResponseProb_v9", "models:/response/9"),
    "RR_ResponseProb": ScoreStep("RR_ResponseProb", "models:/response/Production"),
    "AR_ApprovalProb": ScoreStep("AR_ApprovalProb", "models:/approval/Production"),
    "FR_FundingProb": ScoreStep("FR_FundingProb", "models:/funding/Production"),
    "preUOLScore": ScoreStep("preUOLScore", "models:/pre_uol/1"),
}
LEGACY_SCORES = {
    "PIE_v3": ScoreStep("PIE_v3", "models:/income/3"),
    "PIE_v4": ScoreStep("PIE_v4", "models:/income/4"),
    "LAE_v3": ScoreStep("LAE_v3", "models:/loan_amount/3", cast_legacy_loan_inputs),
    "RR_v8": ScoreStep("RR_v8", "models:/response/8"),
    "RR_v8_dm": ScoreStep("RR_v8_dm", "models:/response_dm/8"),
    "AR_v6": ScoreStep("AR_v6", "models:/approval/6", add_approval_names),
    "FR_v6": ScoreStep("FR_v6", "models:/funding/6", add_funding_features),
    "FR_v4_python": ScoreStep("FR_v4_python", "models:/funding/4"),
    "pre_UOL_score_v1": ScoreStep("pre_UOL_score_v1", "models:/pre_uol/1"),
    "creative_v2_black_back_202007": ScoreStep("creative_v2_black_back_202007", "models:/creative_black_back/2"),
    "creative_v2_confetti_201910": ScoreStep("creative_v2_confetti_201910", "models:/creative_confetti/2"),
}

# ---------------------------------------------------------------- model table

MODEL_SCHEMA = "name string, version int, stage string, spec string"


@dataclass(frozen=True)
class ModelTable:
    """Rows of (name, version, stage, spec)."""

    table: DataFrame
    _resolved: dict = field(default_factory=dict, compare=False, repr=False)

    @staticmethod
    def from_models(spark, rows: Sequence[tuple[str, int, str, Any]]) -> ModelTable:
        data = [(name, version, stage, model.to_json()) for name, version, stage, model in rows]
        return ModelTable(spark.createDataFrame(data, MODEL_SCHEMA))

    @staticmethod
    def read(spark, path: str) -> ModelTable:
        return ModelTable(spark.read.schema(MODEL_SCHEMA).parquet(path))

    def write(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(path)

    def latest_version(self, name: str) -> int:
        """Highest version of a model; 1 if none is recorded."""
        return self.table.where(F.col("name") == name).agg(F.max("version")).first()[0] or 1

    def resolve(self, reference: str):
        """Model for ``models:/name/version`` or ``models:/name/stage``; a bare name is the latest.

        The table is searched by Spark; one row is read.
        """
        if reference not in self._resolved:
            name, _, wanted = reference.removeprefix("models:/").partition("/")
            rows = self.table.where(F.col("name") == name)
            if wanted:
                rows = rows.where((F.col("version").cast("string") == wanted) | (F.col("stage") == wanted))
            found = rows.orderBy(F.desc("version")).select("spec").first()
            if found is None:
                raise LookupError(f"no model for {reference}")
            self._resolved[reference] = model_from_json(found["spec"])
        return self._resolved[reference]

    def promote(self, name: str, version: int, stage: str) -> ModelTable:
        """Give one version a stage; the version that held it is archived."""
        this = (F.col("name") == name) & (F.col("version") == version)
        held = (F.col("name") == name) & (F.col("stage") == stage)
        moved = F.when(this, F.lit(stage)).when(held, F.lit("Archived")).otherwise(F.col("stage"))
        return ModelTable(self.table.withColumn("stage", moved))


def latest_versions(registry: DataFrame, name: str = "name", version: str = "version") -> DataFrame:
    """Highest version per model name."""
    return registry.groupBy(name).agg(F.max(version).alias("latest_version"))


@dataclass(frozen=True)
class FeatureCheck:
    missing: list[str]
    extra: list[str]
    same_order: bool


def check_features(declared: Sequence[str], model_features: Sequence[str]) -> FeatureCheck:
    """Compare a feature list with the order the model was trained on."""
    return FeatureCheck(
        missing=[f for f in model_features if f not in set(declared)],
        extra=[f for f in declared if f not in set(model_features)],
        same_order=list(declared) == list(model_features),
    )


def feature_differences(declared: DataFrame, model) -> DataFrame:
    """(name, status, declared_at, model_at): a list of names from elsewhere against the order of a stored model.

    ``declared`` has ``name`` and ``position`` (from 0).  The status is missing
    (the model wants it), extra, moved or same.
    """
    wanted = declared.sparkSession.createDataFrame([(n, i) for i, n in enumerate(model.features)], "name string, model_at int")
    both = declared.select("name", F.col("position").cast("int").alias("declared_at")).join(F.broadcast(wanted), "name", "full")
    status = (F.when(F.col("declared_at").isNull(), "missing").when(F.col("model_at").isNull(), "extra")
              .when(F.col("declared_at") != F.col("model_at"), "moved").otherwise("same"))
    return both.select("name", status.alias("status"), "declared_at", "model_at")


def all_input_features(*lists: Sequence[str]) -> list[str]:
    """Sorted union of model feature lists and the housing inputs."""
    return sorted(set(rules.HOUSING_FEATURES).union(*lists))
