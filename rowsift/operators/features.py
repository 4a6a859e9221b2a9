"""Label codes, imputation, scaling, one-hot, dimension reduction, token features."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsift.functions.ranking import KEY_DIGITS, exact_medians
from rowsift.functions.runtime import collect_small, materialize
from rowsift.functions.text import BEGIN, END, shape_features


#: Most columns whose d x d products are summed and decomposed exactly.
EXACT_WIDTH = 512
#: Directions beyond the wanted ones in the randomized range finder, its passes at most, and
#: the relative gain of captured energy at which they end.
OVERSAMPLE = 10
PASSES = 8
SETTLED = 1e-5
#: Most bytes of a basis that is sent to every task.
BASIS_BYTES = 1 << 30


def column_roles(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric, categorical) columns by type; booleans count as numeric."""
    numeric, categorical = [], []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        is_number = isinstance(f.dataType, (T.NumericType, T.BooleanType))
        (numeric if is_number else categorical).append(f.name)
    return numeric, categorical


def label_codes(df: DataFrame, label: str) -> DataFrame:
    """Dimension table (label, code): sorted distinct labels get 0..K-1."""
    distinct = df.select(F.col(label).alias("label")).filter("label IS NOT NULL").distinct()
    rows = sorted(r["label"] for r in collect_small(distinct))
    return df.sparkSession.createDataFrame(
        [(v, i) for i, v in enumerate(rows)],
        T.StructType([T.StructField("label", df.schema[label].dataType), T.StructField("code", T.IntegerType())]),
    )


def encode(df: DataFrame, label: str, codes: DataFrame, out: str = "code") -> DataFrame:
    """Attach the code of each row's label; ``codes`` comes from :func:`label_codes`."""
    dim = codes.select(F.col("label").alias(label), F.col("code").alias(out))
    return df.join(F.broadcast(dim), label, "left")


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, null_percent) from one pass over the table."""
    one = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(c) for c in columns])
    return one.unpivot([], list(columns), "column_name", "null_percent")


def class_share(df: DataFrame, label: str) -> DataFrame:
    """(label, n, percent) per class; the window runs over the few class rows."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("percent", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()))


@dataclass(frozen=True)
class Preprocessor:
    """Fitted parameters: small driver-side dicts applied as plain expressions."""

    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    fill: dict[str, object] = field(default_factory=dict)
    center: dict[str, float] = field(default_factory=dict)
    spread: dict[str, float] = field(default_factory=dict)
    levels: dict[str, list[str]] = field(default_factory=dict)
    pooled: dict[str, bool] = field(default_factory=dict)
    #: (name, level) of all levels seen, as a table; however many they are
    seen: DataFrame | None = None

    def impute(self, df: DataFrame) -> DataFrame:
        cols = {c: F.coalesce(_number(df, c), F.lit(self.fill[c])) for c in self.numeric}
        cols |= {c: F.coalesce(F.col(c).cast("string"), F.lit(self.fill[c])) for c in self.categorical}
        return df.withColumns(cols) if cols else df

    def scale(self, df: DataFrame) -> DataFrame:
        cols = {
            c: (F.col(c) - F.lit(self.center[c])) / F.lit(self.spread[c])
            for c in self.numeric
            if c in self.spread
        }
        return df.withColumns(cols) if cols else df

    def one_hot(self, df: DataFrame, column: str, out: str) -> DataFrame:
        """Add a 0/1 array over the kept levels, plus one pooled slot when levels were cut.

        At most max_categories levels are kept, so they are a constant; whether any other
        value is a rare level or was never seen comes from a join with the level table.
        """
        known = F.array(*[F.lit(v) for v in self.levels[column]]).cast("array<string>")
        slots = F.transform(known, lambda v: (v == F.col(column)).cast("double"))
        if not self.pooled[column]:
            return df.withColumn(out, slots)
        rare = self.seen.filter(F.col("name") == column).select(F.col("level").alias("_level"), F.lit(1.0).alias("_rare"))
        other = F.when(~F.array_contains(known, F.col(column)), F.col(column))
        joined = df.withColumn("_other", other).join(rare, F.col("_other") == F.col("_level"), "left")
        return joined.withColumn(out, F.concat(slots, F.array(F.coalesce("_rare", F.lit(0.0))))).drop("_other", "_level", "_rare")

    @property
    def width(self) -> int:
        hot = sum(len(self.levels[c]) + int(self.pooled[c]) for c in self.categorical)
        return len(self.numeric) + hot

    def transform(self, df: DataFrame, out: str = "features") -> DataFrame:
        """Numeric then one-hot columns as one ARRAY<DOUBLE>; the inputs are dropped."""
        ready = self.scale(self.impute(df))
        parts = [F.array(*[F.col(c) for c in self.numeric])] if self.numeric else []
        for c in self.categorical:
            ready = self.one_hot(ready, c, f"{c}//hot")
            parts.append(F.col(f"`{c}//hot`"))
        if not parts:
            return ready.withColumn(out, F.array().cast("array<double>"))
        hot = [f"{c}//hot" for c in self.categorical]
        return ready.withColumn(out, F.concat(*parts)).drop(*self.numeric, *self.categorical, *hot)


def _number(df: DataFrame, c: str) -> Column:
    as_double = F.col(c).cast("double")
    return F.when(F.isnan(as_double), F.lit(None)).otherwise(as_double)


def fit_preprocessor(
    train: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    impute: str = "median",
    scale: bool = True,
    max_categories: int = 100,
) -> Preprocessor:
    """Learn fill values, centre and spread, and category levels on ``train`` only.

    Medians are exact. A constant column is divided by 1. When a column has
    more than ``max_categories`` levels the most frequent max-1 keep their own
    slot (ties: smaller name first) and the rest share one.
    """
    if impute not in ("median", "mean"):
        raise ValueError(f"unknown numeric imputation: {impute}")
    fill: dict[str, object] = {}
    numbers = train.select(*[_number(train, c).alias(c) for c in numeric]) if numeric else None
    if numeric and impute == "mean":
        means = numbers.agg(*[F.avg(c).alias(c) for c in numeric]).first()
        fill |= {c: means[c] if means[c] is not None else 0.0 for c in numeric}
    elif numeric:
        fill |= {c: m or 0.0 for c, m in exact_medians(numbers, numeric).items()}
    center, spread = {}, {}
    if numeric and scale:
        filled = numbers.select(*[F.coalesce(c, F.lit(fill[c])).alias(c) for c in numeric])
        stats = filled.agg(
            *[F.avg(c).alias(f"{c}//m") for c in numeric],
            *[F.stddev_pop(c).alias(f"{c}//s") for c in numeric],
        ).first()
        center = {c: stats[f"{c}//m"] for c in numeric}
        spread = {c: stats[f"{c}//s"] if round(stats[f"{c}//s"] or 0.0, 12) > 0 else 1.0 for c in numeric}
    levels, pooled, seen = {}, {}, None
    if categorical:
        # one aggregate counts the levels of all columns
        long = train.select(*[F.col(c).cast("string").alias(c) for c in categorical]).unpivot([], list(categorical), "name", "level")
        seen = materialize(long.filter("level IS NOT NULL").groupBy("name", "level").agg(F.count(F.lit(1)).alias("n")))
        by_size = Window.partitionBy("name").orderBy(F.desc("n"), "level")
        top = seen.withColumn("at", F.row_number().over(by_size)).filter(F.col("at") <= max_categories + 1)
        found: dict[str, list[str]] = {c: [] for c in categorical}
        for r in top.orderBy("name", "at").select("name", "level").collect():
            found[r["name"]].append(r["level"])
        for c, names in found.items():
            fill[c] = names[0] if names else ""
            pooled[c] = len(names) > max_categories
            levels[c] = sorted(names[: max_categories - 1] if pooled[c] else names)
    return Preprocessor(tuple(numeric), tuple(categorical), fill, center, spread, levels, pooled, seen)


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population std of the same table; constant columns divide by 1."""
    stats = df.agg(
        *[F.avg(c).alias(f"{c}//m") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}//s") for c in columns],
    ).first()
    return df.withColumns(
        {
            c: (F.col(c) - F.lit(stats[f"{c}//m"]))
            / F.lit(stats[f"{c}//s"] if round(stats[f"{c}//s"] or 0.0, 12) > 0 else 1.0)
            for c in columns
        }
    )


def fit_array_scaler(train: DataFrame, features: str, width: int) -> Callable[[DataFrame], DataFrame]:
    """Learn mean and population std per entry of an ARRAY<DOUBLE> column, in one pass."""
    at = [F.element_at(features, i + 1).cast("double") for i in range(width)]
    stats = train.agg(
        F.array(*[F.avg(x) for x in at]).alias("m"), F.array(*[F.stddev_pop(x) for x in at]).alias("s")
    ).first()
    mean = F.array(*[F.lit(m) for m in stats["m"]])
    std = F.array(*[F.lit(s if round(s or 0.0, 12) > 0 else 1.0) for s in stats["s"]])

    def scale(df: DataFrame) -> DataFrame:
        scaled = F.transform(
            features, lambda v, i: (v - F.element_at(mean, i + 1)) / F.element_at(std, i + 1)
        )
        return df.withColumn(features, scaled)

    return scale


def standardize_array(df: DataFrame, features: str, width: int) -> DataFrame:
    """:func:`standardize` for an ARRAY<DOUBLE> column of known width."""
    return fit_array_scaler(df, features, width)(df)


def reduce_dimensions(df: DataFrame, features: str, width: int, limit: int = 50) -> DataFrame:
    """Project onto the leading right singular vectors (not centred) when width > limit.

    ``features`` is ARRAY<DOUBLE>, or STRUCT<indices ARRAY<INT>, values ARRAY<DOUBLE>> for
    sparse rows, which come out as arrays. Up to ``EXACT_WIDTH`` columns the d x d Gram matrix
    is summed on Spark and decomposed once; beyond it :func:`range_basis` finds the
    vectors from d x (limit + OVERSAMPLE) sums. Neither grows with the rows.
    """
    if width == 0:
        raise ValueError("no_features")
    sparse = isinstance(df.schema[features].dataType, T.StructType)
    if width <= limit and not sparse:
        return df
    keep = width if width <= limit else min(limit, max(2, width - 1))
    basis = _gram_basis(df, features, width, keep) if width <= EXACT_WIDTH and not sparse else range_basis(df, features, width, keep)
    top = np.abs(basis).argmax(axis=0)
    shared = df.sparkSession.sparkContext.broadcast(basis * np.where(basis[top, range(basis.shape[1])] < 0, -1.0, 1.0))

    def project(batches):
        for batch in batches:
            yield pd.DataFrame({"_key": batch["_key"], "_out": list(_Rows(batch["x"]).times(shared.value))})

    if sparse:  # the projected rows meet the others by a row number that is written down first
        held = materialize(df.withColumn("_key", F.monotonically_increasing_id()))
        done = held.select("_key", F.col(features).alias("x")).mapInPandas(project, "_key bigint, _out array<double>")
        return held.drop(features).join(done, "_key").select(*[F.col("_out").alias(c) if c == features else F.col(c) for c in df.columns])

    @F.pandas_udf("array<double>")
    def project_column(x: pd.Series) -> pd.Series:
        return pd.Series(list(_Rows(x).times(shared.value)))

    return df.withColumn(features, project_column(F.col(features)))


class _Rows:
    """A batch of dense or sparse rows as a matrix that is multiplied from either side."""

    def __init__(self, x: pd.Series):
        self.n = len(x)
        self.dense = None
        if not self.n or not hasattr(x.iloc[0], "keys"):
            self.dense = np.stack(x.to_numpy()) if self.n else np.zeros((0, 0))
            return
        self.sizes = np.array([len(r["indices"]) for r in x])
        self.at = np.concatenate([np.asarray(r["indices"], np.int64) for r in x])
        self.values = np.concatenate([np.asarray(r["values"], np.float64) for r in x])
        self.row = np.repeat(np.arange(self.n), self.sizes)

    def times(self, m: np.ndarray) -> np.ndarray:
        if self.dense is not None:
            return self.dense @ m if self.n else np.zeros((0, m.shape[1]))
        out = np.zeros((self.n, m.shape[1]))
        np.add.at(out, self.row, self.values[:, None] * m[self.at])
        return out

    def transposed_times(self, y: np.ndarray, into: np.ndarray) -> None:
        if self.dense is None:
            np.add.at(into, self.at, self.values[:, None] * y[self.row])
        elif self.n:
            into += self.dense.T @ y


def _gram_basis(df: DataFrame, features: str, width: int, keep: int) -> np.ndarray:
    def partial_gram(batches):
        total = np.zeros((width, width))
        for batch in batches:
            if len(batch):
                x = np.stack(batch["x"].to_numpy())
                total += x.T @ x
        yield pd.DataFrame({"row": range(width), "sums": list(total)})

    parts = df.select(F.col(features).alias("x")).mapInPandas(partial_gram, "row int, sums array<double>")
    gram = _summed(parts, width, width)
    return np.linalg.eigh(gram)[1][:, ::-1][:, :keep]


def _summed(parts: DataFrame, rows: int, width: int) -> np.ndarray:
    """Sum of (row, sums) over all parts as a rows x width matrix; absent rows are zero."""
    total = parts.groupBy("row").agg(*[F.sum(F.col("sums")[c]).alias(f"s{c}") for c in range(width)])
    out = np.zeros((rows, width))
    for r in total.toLocalIterator():
        out[r[0]] = r[1:]
    return out


def range_basis(df: DataFrame, features: str, width: int, keep: int, seed: int = 42, passes: int = PASSES) -> np.ndarray:
    """Leading right singular vectors by a randomized range finder (Halko, Martinsson, Tropp 2011).

    A random d x r matrix, r = keep + OVERSAMPLE, is multiplied by X'X once per pass and made
    orthonormal. Tasks sum X'(XQ) over their rows and emit one row of r sums for each column
    that they saw, so sparse tables send little. Passes end when the energy that Q captures
    grows by less than ``SETTLED`` of itself, after ``passes`` at most; the r x r matrix of
    the last pass is decomposed on the driver. Q, which every task gets, has d x r numbers; it
    grows with the columns alone and is checked.
    """
    r = min(width, keep + OVERSAMPLE)
    if 8 * width * r > BASIS_BYTES:
        raise ValueError(f"{width} columns need more than {BASIS_BYTES} bytes for a basis of {r}")
    spark = df.sparkSession
    held = df.select(F.col(features).alias("x"))
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, r)))[0]
    energy = 0.0
    for _ in range(passes):
        shared = spark.sparkContext.broadcast(q)

        def partial(batches, shared=shared):
            basis, total, seen = shared.value, np.zeros((width, r)), np.zeros(width, bool)
            for batch in batches:
                rows = _Rows(batch["x"])
                rows.transposed_times(rows.times(basis), total)
            seen |= total.any(axis=1)
            at = np.flatnonzero(seen)
            for s in range(0, len(at), 4096):
                some = at[s : s + 4096]
                yield pd.DataFrame({"row": some.astype("int32"), "sums": list(total[some])})

        z = _summed(held.mapInPandas(partial, "row int, sums array<double>"), width, r)
        small = q.T @ z  # (XQ)'(XQ)
        values, vectors = np.linalg.eigh((small + small.T) / 2)
        basis, was, energy = q @ vectors[:, ::-1][:, :keep], energy, float(np.sort(values)[::-1][:keep].sum())
        shared.unpersist()
        if energy - was <= SETTLED * energy:
            break
        q = np.linalg.qr(z)[0]
    return basis


def token_features(
    tokens: DataFrame, token: str = "token", keys: tuple[str, str] = ("sent_id", "tok_i"), chunk: int = 1024
) -> DataFrame:
    """Word-shape features with the neighbouring words of each token.

    ``tok_i`` counts 0, 1, 2, ... in a sentence. Windows run over chunks of
    ``chunk`` positions, with the border tokens copied to the next chunk, so a
    very long sentence is spread over many tasks.
    """
    sent, pos = keys
    at = F.col(pos)
    own = F.floor(at / chunk)
    first, last = (at % chunk == 0) & (at > 0), at % chunk == chunk - 1
    homes = (
        F.when(first & last, F.array(own, own - 1, own + 1))
        .when(first, F.array(own, own - 1))
        .when(last, F.array(own, own + 1))
        .otherwise(F.array(own))
    )
    spread = tokens.withColumn("_chunk", F.explode(homes))
    w = Window.partitionBy(sent, "_chunk").orderBy(pos)
    near = spread.withColumns(
        {
            "_prev": F.lag(F.lower(token), 1, BEGIN).over(w),
            "_next": F.lead(F.lower(token), 1, END).over(w),
        }
    ).filter(F.col("_chunk") == own)
    feats = shape_features(F.col(token), F.col("_prev"), F.col("_next"))
    return near.select(*tokens.columns, *[c.alias(n) for n, c in feats.items()])


#: Columns produced by :func:`token_features`.
TOKEN_FEATURES = ("w", "is_upper", "is_title", "is_digit", "pre1", "pre2", "pre3", "suf1", "suf2", "suf3", "prev_w", "next_w")


def hashed_token_vector(tokens: DataFrame, out: str = "features", size: int = 1 << 18) -> DataFrame:
    """Sparse vector of the token features by feature hashing."""
    from pyspark.ml.feature import FeatureHasher

    text = [c for c in TOKEN_FEATURES if not c.startswith("is_")]
    ready = tokens.withColumns({c: F.col(c).cast("int") for c in TOKEN_FEATURES if c.startswith("is_")})
    hasher = FeatureHasher(inputCols=[*TOKEN_FEATURES], categoricalCols=text, outputCol=out, numFeatures=size)
    return hasher.transform(ready)


def rounded(df: DataFrame, columns: Sequence[str], digits: int = KEY_DIGITS) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})
