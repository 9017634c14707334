"""Dataset preparation (D1–D14): labelling, cleaning, balancing, splitting, validating.

Every "random" choice is a seeded hash of the row key — ``md5(key ':' seed)`` — so results do not depend
on partitioning or task retries, and any SQL engine with ``md5`` reproduces them row for row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import cube
from ..session import materialize
from .spatial import checked_broadcast


def seeded_key(id_cols: list[str], seed: int = 42) -> Column:
    """``md5('id1:id2:…:seed')`` — lowercase hex, identical in any engine with md5; a NULL id reads ``null``."""
    ids = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in id_cols]
    return F.md5(F.concat_ws(":", *ids, F.lit(str(seed))))


def label_union(tables: dict[str, DataFrame], label: str = "class_") -> tuple[DataFrame, dict[str, int]]:
    """Label = ordinal of the class name in the given mapping (D1); union by name."""
    class_map = {name: i for i, name in enumerate(tables)}
    parts = [df.withColumn(label, F.lit(class_map[name])) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts), class_map


def binary_union(positive: DataFrame, negative: DataFrame, label: str = "class") -> DataFrame:
    """Positive = 1, negative = 0."""
    return positive.withColumn(label, F.lit(1)).unionByName(negative.withColumn(label, F.lit(0)))


def background_rows(spark: SparkSession, n_features: int, n: int = 50, cls: int = 5,
                    features: str = "features", label: str = "class_",
                    id_cols: tuple[str, ...] | list[str] = ("pixel_id",)) -> DataFrame:
    """``n`` all-zero feature rows of the background class.

    Every id column holds −1 … −n (as a number or as text, whatever the rows they join hold), so the rows
    stay apart from real ones and from each other, and a split deals them like any others.
    """
    return spark.range(n).select(
        *[(-(F.col("id") + 1)).alias(c) for c in id_cols],
        F.array_repeat(F.lit(0.0).cast("float"), n_features).alias(features),
        F.lit(cls).alias(label),
    )


def class_counts(df: DataFrame, label: str = "class_") -> DataFrame:
    """Rows per class."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))


def balance_classes(df: DataFrame, id_cols: list[str], label: str = "class_", seed: int = 42,
                    prefix_digits: int = 4, max_rank_rows: int = 2_000_000) -> DataFrame:
    """Down-sample every class to the smallest class's size (D6), exactly and without a class-wide sort.

    The kept rows of a class are its ``min_count`` rows of smallest seeded hash — the same rows as
    ``row_number() over (partition by class order by hash, id) <= min_count`` — found without ranking a
    whole class in one task (a class may hold a third of the data):

    1. a histogram over the first ``prefix_digits`` hex digits of the hash (≤ 16^digits rows per class,
       partially aggregated) gives each class's boundary bucket and how many rows it still needs;
    2. while some boundary bucket holds more than ``max_rank_rows`` rows, only that bucket's rows are
       histogrammed again on the next digits (a filtered scan, a small aggregate);
       rows without a label belong to no class: they are left out throughout;
    3. rows whose hash prefix sorts below the boundary prefix are kept whole; only the final boundary
       bucket — at most ``max_rank_rows`` rows per class — is ranked.
    """
    keyed = df.where(F.col(label).isNotNull()).withColumn("_h", seeded_key(id_cols, seed))
    w = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def boundaries(hist: DataFrame, need: Column) -> DataFrame:
        # per class: the bucket where the running count first reaches ``need``
        h = hist.withColumn("_cum", F.sum("_n").over(w))
        return (h.where((F.col("_cum") - F.col("_n") < need) & (F.col("_cum") >= need))
                .select(label, F.col("_b").alias("_p"), (need - (F.col("_cum") - F.col("_n"))).alias("_need"),
                        F.col("_n").alias("_bn")))

    length = prefix_digits
    # classes × 16^digits rows at most: materialized once, scalars and boundaries read it
    hist = materialize(keyed.groupBy(label, F.substring("_h", 1, length).alias("_b")).agg(F.count(F.lit(1)).alias("_n")))
    min_count = hist.groupBy(label).agg(F.sum("_n").alias("_c")).agg(F.min("_c")).first()[0]
    if min_count is None:
        return df.limit(0)
    bound = materialize(boundaries(hist, F.lit(min_count)))
    while length < 32 and (bound.agg(F.max("_bn")).first()[0] or 0) > max_rank_rows:
        step = min(prefix_digits, 32 - length)
        inside = keyed.join(checked_broadcast(bound.select(label, "_p", "_need")), label).where(
            F.substring("_h", 1, length) == F.col("_p"))
        sub = inside.groupBy(label, "_need", F.substring("_h", 1, length + step).alias("_b")).agg(
            F.count(F.lit(1)).alias("_n"))
        bound = materialize(boundaries(sub, F.col("_need")))
        length += step
    b = checked_broadcast(bound.select(label, "_p", "_need"))  # one row per class
    j = keyed.withColumn("_b", F.substring("_h", 1, length)).join(b, label)
    whole = j.where(F.col("_b") < F.col("_p"))
    rank = Window.partitionBy(label).orderBy("_h", *id_cols)
    edge = (j.where(F.col("_b") == F.col("_p")).withColumn("_rn", F.row_number().over(rank))
            .where(F.col("_rn") <= F.col("_need")).drop("_rn"))
    return whole.unionByName(edge).drop("_h", "_b", "_p", "_need")


def prepare_training(df: DataFrame, id_cols: list[str], features: str = "features", label: str = "class_",
                     background: int | None = 5, n_background: int = 50, downsample: bool = True,
                     seed: int = 42, reference_order: bool = False, n_features: int | None = None) -> DataFrame:
    """Drop missing, balance, add background rows.

    Default: balance real classes first, then add background rows.  ``reference_order=True`` adds the
    background rows before balancing (so the background class caps every class at ``n_background``).
    """
    spark = df.sparkSession
    out = cube.drop_missing(df, features, also=[label])
    nf = n_features or cube.array_width(out, features)

    def add_bg(d):
        if background is None:
            return d
        bg = background_rows(spark, nf, n_background, background, features, label, id_cols)
        bg = bg.withColumns({c: F.col(c).cast(d.schema[c].dataType) for c in id_cols})
        return d.unionByName(bg, allowMissingColumns=True)

    if reference_order:
        out = add_bg(out)
        if downsample:
            out = cube.fill_missing(balance_classes(out, id_cols, label, seed), features, n_bands=nf)
        return out
    if downsample:
        out = cube.fill_missing(balance_classes(out, id_cols, label, seed), features, n_bands=nf)
    return add_bg(out)


def cap_all_missing(df: DataFrame, id_col: str, features: str = "features", cap: int = 200) -> DataFrame:
    """Keep at most ``cap`` rows whose features are all missing (lowest ids), set them to 0, keep the rest.

    A NULL array is all missing; it becomes zeros of the width of the first array there is.
    """
    allm = F.coalesce(cube.all_missing(features), F.lit(True))
    zeros = F.array_repeat(F.lit(0.0), cube.array_width(df, features)).cast(df.schema[features].dataType)
    capped = cube.fill_missing(df.where(allm).orderBy(id_col).limit(cap), features)
    capped = capped.withColumn(features, F.coalesce(features, zeros))
    return df.where(~allm).unionByName(capped)


def split_flag(id_cols: list[str], test_size: float = 0.3, seed: int = 42) -> Column:
    """True for test rows: first 8 hex digits of the seeded hash below ``test_size · 2^32``."""
    threshold = f"{int(test_size * (1 << 32)):08x}"
    return F.substring(seeded_key(id_cols, seed), 1, 8) < F.lit(threshold)


def train_test_split(df: DataFrame, id_cols: list[str], test_size: float = 0.3,
                     seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Stable hash split (D10): a row's side depends only on its key — no shuffle, no sort."""
    flag = split_flag(id_cols, test_size, seed)
    return df.where(~flag), df.where(flag)


def validate_split(df: DataFrame, split_col: str = "split", features: str = "features",
                   label: str = "class_") -> DataFrame:
    """Missing-value counts and row counts per split in one aggregate."""
    bad_f = F.col(features).isNull() | cube.any_missing(features)
    return df.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(bad_f).alias("n_missing_features"),
        F.count_if(F.col(label).isNull()).alias("n_missing_labels"),
    )


def assert_valid(report: DataFrame) -> None:
    """Raise if any split has a missing feature or label."""
    bad = report.where((F.col("n_missing_features") > 0) | (F.col("n_missing_labels") > 0)).limit(1).collect()
    if bad:
        raise ValueError(f"missing values after preprocessing: {bad[0].asDict()}")


def shuffle_rows(df: DataFrame, id_cols: list[str], seed: int = 42) -> DataFrame:
    """Seeded shuffle (D12): a global order by the seeded hash (range-partitioned sort)."""
    return df.withColumn("_h", seeded_key(id_cols, seed)).orderBy("_h", *id_cols).drop("_h")


def head(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First ``n`` rows in key order (D14): a top-k, never a full sort."""
    return df.orderBy(*order).limit(int(n))


def features_and_target(df: DataFrame, features: str = "features", label: str = "class_") -> DataFrame:
    """Split features / target for MLlib (D9): dense vector column ``fv`` and double column ``target``."""
    from pyspark.ml.functions import array_to_vector
    return df.withColumn("fv", array_to_vector(F.col(features))).withColumn("target", F.col(label).cast("double"))
