"""Codes for categories, scaling, projection and tree-leaf encoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA, OneHotEncoder, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywind.operators.joins import attach_all
from tallywind.operators.ordering import row_index
from tallywind.storage import Stored, side_by_side, store


def label_codes(df: DataFrame, cols: Sequence[str]) -> dict[str, Stored]:
    """Per column, a table (value, code): code 0..n-1 in ascending order of the distinct values.

    Columns of one type are coded together: their distinct (column, value) pairs get one position in a
    distributed order, and a column's code is that position counted from its first value.
    """
    kinds: dict[str, list[str]] = {}
    for c in cols:
        kind = "string" if isinstance(df.schema[c].dataType, T.StringType) else "number"
        kinds.setdefault(kind, []).append(c)
    coded = side_by_side(lambda names: _codes_of(df, names), list(kinds.values()))
    out = {c: table for tables in coded for c, table in tables.items()}
    return {c: out[c] for c in cols}


def _codes_of(df: DataFrame, names: Sequence[str]) -> dict[str, Stored]:
    """Code tables of columns of one type."""
    text = isinstance(df.schema[names[0]].dataType, T.StringType)
    entries = [f"named_struct('c', '{c}', 'v', {f'`{c}`' if text else f'cast(`{c}` as bigint)'})" for c in names]
    pairs = df.selectExpr(f"inline(array({', '.join(entries)}))").filter("v is not null")
    placed = store(row_index(pairs.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")), ["c", "v"], "i")).df
    # One row per coded column.
    spans = {r["c"]: r for r in placed.groupBy("c").agg(F.min("i").alias("lo"), F.count("i").alias("n"), F.sum(F.octet_length(F.col("v").cast("string"))).alias("bytes")).collect()}
    out = {}
    for c in names:
        lo, n, size = (spans[c]["lo"], spans[c]["n"], spans[c]["bytes"]) if c in spans else (0, 0, 0)
        kind = df.schema[c].dataType.simpleString()
        table = placed.filter(f"c = '{c}'").selectExpr(f"cast(v as {kind}) as `{c}`", f"i - {lo} as `{c}_code`", "n as _n")
        out[c] = Stored(table, (n, size if kind == "string" else 0))
    return out


def label_encode(df: DataFrame, cols: Sequence[str], suffix: str = "_code", **options) -> DataFrame:
    """Add the dense code of every column as ``<col><suffix>``; with an empty suffix the column is replaced."""
    out = attach_all(df, [(table, [c]) for c, table in label_codes(df, cols).items()], weight="_n", **options)
    kept = [c for c in df.columns if suffix or c not in cols]
    return out.select(*kept, *[F.col(f"{c}_code").alias(c + suffix) for c in cols])


def to_category(codes: dict[str, Stored], df: DataFrame, suffix: str = "_cat", **options) -> DataFrame:
    """Category codes as fitted on the training rows by ``label_codes``; unseen values share the next code."""
    out = attach_all(df, [(table, [c]) for c, table in codes.items()], weight="_n", **options)
    known = [F.coalesce(F.col(f"{c}_code"), F.lit(table.rows)).alias(c + suffix) for c, table in codes.items()]
    return out.select(*df.columns, *known)


def nominal(train: DataFrame, frames: Sequence[DataFrame], cols: Sequence[str], suffix: str = "_cat", most: int = 64) -> tuple[list[DataFrame], dict[str, int]]:
    """(frames with codes fitted on ``train``, number of codes per code column) for the columns with few enough values.

    Values unknown to ``train`` share the last code. Columns of more than ``most`` values are left out: a tree would try
    every one of them at each node. ``target_statistic`` is for those.
    """
    codes = {c: table for c, table in label_codes(train, cols).items() if table.rows < most}
    return [to_category(codes, df, suffix) if codes else df for df in frames], {c + suffix: table.rows + 1 for c, table in codes.items()}


def target_statistic(
    df: DataFrame, cols: Sequence[str], label: str = "is_trade", day: str = "day", weight: float = 10.0, suffix: str = "_rate", **options
) -> DataFrame:
    """Add per column ``<col><suffix>``: the mean label of its value on all days before the row's, drawn towards the mean over
    all values by ``weight`` rows of it.

    Nothing of the row's own day or a later one is used, so the label cannot leak into its feature. A value without
    history, or a null, gets the mean alone; on the first day that is 0. Days meet as one row per (value, day), and what is
    joined back is that small.
    """
    before = Window.orderBy(day).rangeBetween(Window.unboundedPreceding, -1)  # a row per day
    per_day = store(df.groupBy(day).agg(F.count(label).alias("n"), F.sum(label).alias("y"))).df
    mean = F.sum("y").over(before) / F.nullif(F.sum("n").over(before), F.lit(0))
    out = attach_all(df, [(per_day.select(day, F.coalesce(mean, F.lit(0.0)).alias("_mean")), [day])], **options)
    tables = []
    for c in cols:
        daily = df.where(F.col(c).isNotNull()).groupBy(c, day).agg(F.count(label).alias("_k"), F.sum(label).alias("_y"), F.count(F.lit(1)).alias("_n"))
        earlier = Window.partitionBy(c).orderBy(day).rangeBetween(Window.unboundedPreceding, -1)
        sums = {f"_k_{c}": F.coalesce(F.sum("_k").over(earlier), F.lit(0)), f"_y_{c}": F.coalesce(F.sum("_y").over(earlier), F.lit(0))}
        tables.append((daily.select(c, day, "_n", *[v.alias(k) for k, v in sums.items()]), [c, day]))
    out = attach_all(out, tables, weight="_n", **options)
    rate = lambda c: (F.coalesce(F.col(f"_y_{c}"), F.lit(0)) + weight * F.col("_mean")) / (F.coalesce(F.col(f"_k_{c}"), F.lit(0)) + weight)
    return out.select(*df.columns, *[rate(c).alias(c + suffix) for c in cols])


def moments(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column (one row on the driver)."""
    aggs = [f(c).alias(f"{name}{i}") for i, c in enumerate(cols) for name, f in (("m", F.avg), ("s", F.stddev_pop))]
    row = df.agg(*aggs).first()
    return {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 0.0) for i, c in enumerate(cols)}

def standardize(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None, suffix: str = "") -> DataFrame:
    """Zero mean and unit population deviation, as measured on ``fit_on`` (else on ``df`` itself)."""
    stats = moments(df if fit_on is None else fit_on, cols)
    return df.withColumns(
        {
            c + suffix: (F.col(c).cast("double") - F.lit(float(mean))) / F.lit(float(std)) if std > 0
            else F.when(F.col(c).isNotNull(), F.lit(0.0))
            for c, (mean, std) in stats.items()
        }
    )

def fit_pca(train: DataFrame, cols: Sequence[str], k: int = 19):
    """Principal components of centred columns; component signs are arbitrary."""
    stages = [VectorAssembler(inputCols=list(cols), outputCol="_vector"), PCA(k=k, inputCol="_vector", outputCol="pca")]
    return Pipeline(stages=stages).fit(train)

def pca(df: DataFrame, cols: Sequence[str], k: int = 19, fit_on: DataFrame | None = None) -> DataFrame:
    """Add the vector ``pca`` of the first ``k`` components."""
    return fit_pca(df if fit_on is None else fit_on, cols, k).transform(df).drop("_vector")

def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Put columns and vectors of the same row side by side in one vector."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)

def leaf_columns(model, df: DataFrame, leaf: str = "leaf") -> DataFrame:
    """One column ``leaf_<t>`` per tree with the index of the leaf a row falls into."""
    placed = model.transform(df)
    leaves = vector_to_array(F.col(leaf))
    # The model's own outputs are dropped so that a second model can be fitted on the result.
    return placed.withColumns({f"leaf_{t}": F.get(leaves, F.lit(t)) for t in range(len(model.trees))}).drop(
        leaf, "rawPrediction", "probability", "prediction"
    )

def leaf_encoder(model, fit_frames: Sequence[DataFrame]):
    """One-hot encoder of the leaves that the rows of ``fit_frames`` fall into."""
    trees = range(len(model.trees))
    both = leaf_columns(model, fit_frames[0])
    for frame in fit_frames[1:]:
        both = both.unionByName(leaf_columns(model, frame), allowMissingColumns=True)
    return OneHotEncoder(
        inputCols=[f"leaf_{t}" for t in trees],
        outputCols=[f"hot_{t}" for t in trees],
        handleInvalid="keep",
        dropLast=False,
    ).fit(both)


def leaf_encode(model, fit_frames: Sequence[DataFrame], df: DataFrame, out: str = "leaves", encoder=None) -> DataFrame:
    """One-hot vector of the leaves, the leaf values being those met in ``fit_frames``, or known to ``encoder``."""
    trees = range(len(model.trees))
    encoded = (encoder or leaf_encoder(model, fit_frames)).transform(leaf_columns(model, df))
    wide = VectorAssembler(inputCols=[f"hot_{t}" for t in trees], outputCol=out).transform(encoded)
    return wide.drop(*[f"leaf_{t}" for t in trees], *[f"hot_{t}" for t in trees])


def select_by_importance(df: DataFrame, model, names: Sequence[str], factor: float = 1.25, out: str = "selected"):
    """Keep the features whose importance is at least ``factor`` times the mean. Returns (rows, kept names)."""
    scores = model.featureImportances.toArray()
    floor = factor * scores.mean()
    # Equal importances are all below the floor: then nothing sets a feature apart and all stay.
    kept = [i for i, s in enumerate(scores) if s >= floor] or list(range(len(scores)))
    sliced = VectorSlicer(inputCol=model.getFeaturesCol(), outputCol=out, indices=kept).transform(df)
    return sliced, [names[i] for i in kept]
