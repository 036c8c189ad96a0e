"""Fitted preprocessing: exact imputation, scaling and encoding as one ``pyspark.ml`` estimator.

``fit`` runs a few aggregations and keeps a small dictionary of numbers; ``transform`` is one projection of literals.
The fitted dictionary is a JSON parameter of the model, so ``save``/``load`` and ``PipelineModel`` work as usual.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweft.functions.exprs import numeric_names
from riskweft.functions.features import create_features, create_notebook_features
from riskweft.operators.order_stats import exact_quantiles, group_values, left_out_medians
from riskweft.schema import LABEL, NON_FEATURE_COLUMNS, RULE_FLAG

MAX_CATEGORIES = 1000
SCALINGS = ("standard", "robust", "none")
ENCODINGS = ("onehot_drop_first", "onehot", "label")
CATEGORICAL = ["type", "amount_category"]


# ---- single fitted steps ---------------------------------------------------------------------------------------------


def fit_medians(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Exact medians; 0 for a column without values."""
    return {c: q[0] if q[0] is not None else 0.0 for c, q in exact_quantiles(df, columns, [0.5])[None].items()}


def fit_modes(df: DataFrame, columns: list[str]) -> dict[str, str | None]:
    """Most frequent value, the smallest on ties; one job per categorical column."""
    modes = {}
    for c in columns:
        counts = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
        top = counts.orderBy(F.desc("_n"), F.asc(c)).first()
        modes[c] = top[0] if top else None
    return modes


def fit_categories(df: DataFrame, columns: list[str]) -> dict[str, list[str | None]]:
    """Sorted categories per column, NULL last; too many categories is an error, not a truncation."""
    found = {}
    for c in columns:
        values = [r[0] for r in df.select(c).distinct().limit(MAX_CATEGORIES + 1).collect()]
        if len(values) > MAX_CATEGORIES:
            raise ValueError(f"{c} has more than {MAX_CATEGORIES} categories; it cannot be encoded")
        found[c] = sorted(v for v in values if v is not None) + ([None] if None in values else [])
    return found


def impute(column: str, fill: float | str | None) -> Column:
    return F.coalesce(F.col(column), F.lit(fill)) if fill is not None else F.col(column)


def fit_scaling(df: DataFrame, columns: list[str], fill: dict[str, float], scaling: str) -> dict[str, tuple[float, float]]:
    """(centre, scale) of the imputed columns; a constant column gets scale 1."""
    if scaling == "none" or not columns:
        return {c: (0.0, 1.0) for c in columns}
    if scaling == "standard":
        row = df.agg(
            *[F.struct(F.avg(impute(c, fill[c])).alias("m"), F.stddev_pop(impute(c, fill[c])).alias("s")).alias(c) for c in columns]
        ).first()
        return {c: (row[c]["m"] or 0.0, row[c]["s"] or 1.0) for c in columns}
    imputed = df.select(*[impute(c, fill[c]).cast("double").alias(c) for c in columns])
    quartiles = exact_quantiles(imputed, columns, [0.25, 0.5, 0.75])[None]
    return {c: (q[1] or 0.0, ((q[2] or 0.0) - (q[0] or 0.0)) or 1.0) for c, q in quartiles.items()}


def scale(column: Column, centre: float, width: float) -> Column:
    return (column.cast("double") - F.lit(float(centre))) / F.lit(float(width))


def one_hot(column: str, categories: list[str | None], drop_first: bool, value: Column | None = None) -> dict[str, Column]:
    """``column_value`` indicators; a value never seen in fitting gives zeros everywhere."""
    source = F.col(column) if value is None else value
    kept = categories[1:] if drop_first else categories
    return {
        f"{column}_{v}": F.when(source.isNull() if v is None else source == F.lit(v), 1.0).otherwise(0.0) for v in kept
    }


def label_code(column: str, categories: list[str | None]) -> Column:
    """Position in the sorted categories; an unseen value is an error."""
    code = F.raise_error(F.concat(F.lit(f"unseen value in {column}: "), F.coalesce(F.col(column).cast("string"), F.lit("NULL")))).cast("int")
    for i, v in enumerate(categories):
        code = F.when(F.col(column).isNull() if v is None else F.col(column) == F.lit(v), i).otherwise(code)
    return code


# ---- the composite ---------------------------------------------------------------------------------------------------


class _PreprocessParams(Params):
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)
    preset = Param(Params._dummy(), "preset", "feature preset: module, notebook or none", TypeConverters.toString)
    groups = Param(Params._dummy(), "groups", "feature switches as JSON", TypeConverters.toString)
    numericCols = Param(Params._dummy(), "numericCols", "numeric columns, all when empty", TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "categorical columns, known ones when empty", TypeConverters.toListString)
    excludedCols = Param(Params._dummy(), "excludedCols", "columns that are never features", TypeConverters.toListString)
    scaling = Param(Params._dummy(), "scaling", f"one of {SCALINGS}", TypeConverters.toString)
    encoding = Param(Params._dummy(), "encoding", f"one of {ENCODINGS}", TypeConverters.toString)
    fillCategories = Param(Params._dummy(), "fillCategories", "impute categories by the most frequent value", TypeConverters.toBoolean)

    def _defaults(self) -> None:
        self._setDefault(
            outputCol="features",
            preset="module",
            groups="{}",
            numericCols=[],
            categoricalCols=[],
            excludedCols=[*NON_FEATURE_COLUMNS, "event_id", "ts", "score", "copy"],
            scaling="standard",
            encoding="onehot_drop_first",
            fillCategories=False,
        )


class Preprocessor(Estimator, _PreprocessParams, DefaultParamsReadable, DefaultParamsWritable):
    """Features, imputation, scaling and encoding; fit once, apply to batches and streams alike."""

    @keyword_only
    def __init__(
        self,
        *,
        outputCol="features",
        preset="module",
        groups="{}",
        numericCols=[],
        categoricalCols=[],
        excludedCols=None,
        scaling="standard",
        encoding="onehot_drop_first",
        fillCategories=False,
    ):
        super().__init__()
        self._defaults()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        if self.getOrDefault("scaling") not in SCALINGS or self.getOrDefault("encoding") not in ENCODINGS:
            raise ValueError(f"scaling must be one of {SCALINGS}, encoding one of {ENCODINGS}")

    @classmethod
    def notebook(cls, **kw) -> Preprocessor:
        """Median + robust scaling for numbers, most frequent + full one-hot for categories."""
        return cls(**{"scaling": "robust", "encoding": "onehot", "fillCategories": True, **kw})

    def _fit(self, dataset: DataFrame) -> PreprocessorModel:
        return self._fit_filled(dataset)

    def fit_left_out(self, dataset: DataFrame, by: str, fits: int = 1) -> dict[object, PreprocessorModel]:
        """The fit to all rows (under None) and, for each value of ``by``, to the rows with another value.

        The medians of all of them come from the same passes; the other passes run for each fit, ``fits`` side by side.
        """
        if self.getOrDefault("preset") == "notebook":  # its features depend on the rows of the fit
            medians = dict.fromkeys([None, *[value for value, _ in group_values(dataset, by)]])
        else:
            featured = add_features(dataset, self._features())
            medians = left_out_medians(featured, self._numeric(featured.drop(by)), by)

        def fit(value: object) -> PreprocessorModel:
            kept = dataset if value is None else dataset.filter(~F.col(by).eqNullSafe(F.lit(value)))
            known = medians[value]
            return self._fit_filled(kept.drop(by), known and {c: 0.0 if m is None else m for c, m in known.items()})

        with ThreadPoolExecutor(max(1, min(fits, len(medians)))) as pool:
            return dict(zip(medians, pool.map(fit, medians)))

    def _features(self) -> dict:
        return {"preset": self.getOrDefault("preset"), "groups": json.loads(self.getOrDefault("groups"))}

    def _categorical(self, featured: DataFrame) -> list[str]:
        return self.getOrDefault("categoricalCols") or [c for c in CATEGORICAL if c in featured.columns]

    def _numeric(self, featured: DataFrame) -> list[str]:
        excluded = {*self.getOrDefault("excludedCols"), *self._categorical(featured)}
        return self.getOrDefault("numericCols") or [c for c in numeric_names(featured) if c not in excluded]

    def _fit_filled(self, dataset: DataFrame, medians: dict[str, float] | None = None) -> PreprocessorModel:
        """The fit; ``medians`` of the numeric columns are looked up unless they are given."""
        get = self.getOrDefault
        state: dict = self._features()
        if state["preset"] == "notebook":
            state["large_amount"] = exact_quantiles(dataset, ["amount"], [0.95])[None]["amount"][0]
        featured = add_features(dataset, state)
        categorical, numeric = self._categorical(featured), self._numeric(featured)
        fill = medians if medians is not None else fit_medians(featured, numeric) if numeric else {}
        modes = fit_modes(featured, categorical) if get("fillCategories") else {}
        filled = featured.withColumns({c: impute(c, m) for c, m in modes.items()}) if modes else featured
        encoding = get("encoding")
        state |= {
            "numeric": numeric,
            "categorical": categorical,
            "fill": fill,
            "modes": modes,
            "scaling": fit_scaling(featured, numeric, fill, get("scaling")),
            # Label codes are defined for a single categorical column only.
            "encoding": encoding,
            "categories": fit_categories(filled, categorical) if encoding != "label" or len(categorical) == 1 else {},
        }
        model = PreprocessorModel(state=json.dumps(state))
        return self._copyValues(model)


def add_features(df: DataFrame, state: dict) -> DataFrame:
    if state["preset"] == "notebook":
        return create_notebook_features(df, state["large_amount"])
    if state["preset"] == "module":
        return create_features(df, state["groups"])
    return df


class PreprocessorModel(Model, _PreprocessParams, DefaultParamsReadable, DefaultParamsWritable):
    state = Param(Params._dummy(), "state", "fitted numbers as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, state=None):
        super().__init__()
        self._defaults()
        if state is not None:
            self._set(state=state)

    def fitted(self) -> dict:
        if not self.isDefined("state"):
            raise ValueError("fit the preprocessor before transforming")
        return json.loads(self.getOrDefault("state"))

    def feature_columns(self) -> dict[str, Column]:
        """Output name -> expression over the featured frame: numbers first, then categories."""
        s = self.fitted()
        out: dict[str, Column] = {c: scale(impute(c, s["fill"][c]), *s["scaling"][c]) for c in s["numeric"]}
        for c in s["categorical"]:
            if s["encoding"] == "label":
                if len(s["categorical"]) == 1:
                    out[c] = label_code(c, s["categories"][c]).cast("double")
            else:
                value = impute(c, s["modes"].get(c))
                out |= one_hot(c, s["categories"][c], s["encoding"] == "onehot_drop_first", value)
        return out

    def feature_names(self) -> list[str]:
        return list(self.feature_columns())

    def feature_table(self, spark) -> DataFrame:
        return spark.createDataFrame(list(enumerate(self.feature_names())), "idx int, feature string")

    def to_frame(self, df: DataFrame, keep: list[str] = []) -> DataFrame:
        """Kept columns and the named output features."""
        featured = add_features(df, self.fitted())
        return featured.select(*keep, *[v.alias(k) for k, v in self.feature_columns().items()])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """The input columns and the feature vector."""
        featured = add_features(dataset, self.fitted())
        vector = array_to_vector(F.array(*self.feature_columns().values())).alias(self.getOrDefault("outputCol"))
        return featured.select(*dataset.columns, vector)


def labelled(df: DataFrame) -> DataFrame:
    """The label as the double column ``label`` the estimators expect, without the rule flag."""
    return df.drop(RULE_FLAG).withColumn("label", F.col(LABEL).cast("double"))
