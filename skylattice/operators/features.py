"""Feature engineering: encoders and scalers as Spark jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, PolynomialExpansion, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import array_sum, keyed_number, let
from ..ordered import OrderedRows, attach


def hash_bucket(value: Column, buckets: int = 10) -> Column:
    """Repeatable bucket of a high-cardinality value."""
    return (keyed_number(value) % buckets).cast("int")


def one_hot_words(df: DataFrame, column: str, words: Sequence[str]) -> DataFrame:
    """One 0/1 column per word of a fixed vocabulary."""
    cols = [F.coalesce((F.col(column) == F.lit(w)).cast("int"), F.lit(0)).alias(f"{column}_{w}") for w in words]
    return df.select("*", *cols)


def one_hot_inferred(df: DataFrame, column: str, out: str) -> DataFrame:
    """One-hot vector over the values found in the data, in their order; a
    null has the place behind the last one."""
    n_values = df.agg(F.count_distinct(column).alias("n")).scalar()
    coded = label_encode(df, column, "__code")
    coded = coded.withColumn("__code", F.coalesce("__code", n_values).cast("double"))
    encode = OneHotEncoder(inputCol="__code", outputCol=out, dropLast=False)
    return encode.fit(coded).transform(coded).drop("__code")


def label_encode(df: DataFrame, column: str, out: str) -> DataFrame:
    """Sorted distinct values numbered from 0 by a distributed scan.

    A null has a null code.
    """
    codes = OrderedRows(df.select(column).where(F.col(column).isNotNull()).distinct(), [], [column]).row_number("__pos").finish()
    codes = codes.select(column, (F.col("__pos") - 1).cast("int").alias(out))
    return attach(df, codes, [column])


def map_categories(df: DataFrame, column: str, mapping: dict[str, object], out: str) -> DataFrame:
    pairs = [F.lit(v) for kv in mapping.items() for v in kv]
    return df.withColumn(out, F.create_map(*pairs)[F.col(column)])


def fit_moments(train: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Mean and population std per column (and key) of the training rows."""
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    return train.groupBy(*keys).agg(*aggs)


def fit_range(train: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    aggs = []
    for c in columns:
        aggs += [F.min(c).alias(f"{c}__lo"), F.max(c).alias(f"{c}__hi")]
    return train.groupBy(*keys).agg(*aggs)


def _with_fitted(df: DataFrame, fitted: DataFrame, keys: Sequence[str]) -> DataFrame:
    if keys:
        return attach(df, fitted, keys)
    names = [c for c in fitted.columns if "__" in c]
    row = fitted.select(F.struct(*names).alias("f")).scalar()
    packed = df.withColumn("__fit", row)
    return packed.select(*df.columns, *[F.col(f"__fit.{n}").alias(n) for n in names])


def standardise(df: DataFrame, fitted: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``(x - mean) / std`` with stored statistics; 0 where there is no spread."""
    rows = _with_fitted(df, fitted, keys)
    for c in columns:
        spread = F.when(F.col(f"{c}__std") == 0, F.lit(1.0)).otherwise(F.col(f"{c}__std"))
        rows = rows.withColumn(c, (F.col(c) - F.col(f"{c}__mean")) / spread)
    return rows.select(*df.columns)


def scale_range(df: DataFrame, fitted: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Minimum to 0 and maximum to 1; only the minimum is taken off where the
    two are equal."""
    rows = _with_fitted(df, fitted, keys)
    for c in columns:
        lo, hi = F.col(f"{c}__lo"), F.col(f"{c}__hi")
        rows = rows.withColumn(c, F.when(hi > lo, (F.col(c) - lo) / (hi - lo)).otherwise(F.col(c) - lo))
    return rows.select(*df.columns)


def standardise_profile(profile: Column) -> Column:
    """Each profile over its own levels, with the sample std."""
    n = F.size(profile)
    mean = array_sum(profile) / n

    def spread(m: Column) -> Column:
        return F.sqrt(F.aggregate(profile, F.lit(0.0), lambda s, x: s + (x - m) * (x - m)) / (n - 1))

    def scaled(m: Column, std: Column) -> Column:
        return F.when(std > 0, F.transform(profile, lambda x: (x - m) / std))

    return F.when(n > 1, let(mean, lambda m: let(spread(m), lambda std: scaled(m, std))))


# The characters taken as separators.
SEPARATORS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n"


def pieces(text: Column) -> Column:
    """Lower-case words, and an empty one between separators that touch."""
    return F.split(F.translate(F.lower(text), SEPARATORS, " " * len(SEPARATORS)), " ")


def tokens(text: Column) -> Column:
    """Lower-case words; punctuation separates."""
    return F.filter(pieces(text), lambda w: w != "")


def word_counts(df: DataFrame, text: str) -> DataFrame:
    # empty pieces are left out as rows, which needs no function per element
    words = df.select(F.explode(pieces(F.col(text))).alias("word")).where(F.col("word") != "")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def vocabulary(df: DataFrame, text: str, size: int) -> DataFrame:
    """The most frequent words with ids from 1, below ``size``; ties by word."""
    top = word_counts(df, text).orderBy(F.desc("n"), F.asc("word")).limit(size - 1)
    # at most size-1 rows are left to number
    ranked = top.select(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "word"))).alias("w"))
    return ranked.select(F.posexplode("w").alias("i", "w")).select(
        F.col("w.word").alias("word"), (F.col("i") + 1).alias("word_id"), (-F.col("w.m")).alias("n")
    )


def bag_of_ids(df: DataFrame, text: str, vocab: DataFrame, length: int = 20, out: str = "ids") -> DataFrame:
    """Word ids of each text, the last ``length`` of them, padded with 0.

    The vocabulary has a fixed number of words and becomes part of the
    expression: a hash set picks the known words of the whole text, and only
    the words that are kept are looked up. Nothing is shuffled.
    """
    ids = {r["word"]: r["word_id"] for r in vocab.select("word", "word_id").collect()}
    if not ids:
        return df.withColumn(out, F.array_repeat(F.lit(0), F.lit(length)))
    lookup = F.create_map(*[F.lit(v) for pair in ids.items() for v in pair])
    known = F.filter(pieces(F.col(text)), lambda w: w.isin(list(ids)))

    def last(words: Column) -> Column:
        kept = F.slice(words, F.greatest(F.size(words) - length + 1, F.lit(1)), F.lit(length))
        return F.transform(kept, lambda w: lookup[w])

    def padded(found: Column) -> Column:
        return F.concat(found, F.array_repeat(F.lit(0), F.lit(length) - F.size(found)))

    return df.withColumn(out, let(known, lambda words: let(last(words), padded)))


def assemble(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    """Columns as one vector. A null is an error; drop such rows first if that is meant."""
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="error").transform(df)


def polynomial(df: DataFrame, columns: Sequence[str], degree: int = 2, out: str = "poly") -> DataFrame:
    return PolynomialExpansion(degree=degree, inputCol="__v", outputCol=out).transform(
        assemble(df, columns, "__v")
    ).drop("__v")


def add_square(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(f"{column}_squared", F.col(column) * F.col(column))


def mask_one_station(
    df: DataFrame, time: Sequence[str], station: str, stations: Sequence, values: Sequence[str], seed: int
) -> DataFrame:
    """Input and target: one station per time, picked by a seeded hash, has its
    values put to 0 in the input and kept in ``target_*``."""
    names = F.array(*[F.lit(s) for s in stations])
    pick = F.element_at(names, (keyed_number(*time, seed=seed) % len(stations) + 1).cast("int"))
    rows = df.withColumn("hidden", F.col(station) == pick)
    for v in values:
        rows = rows.withColumn(f"target_{v}", F.when(F.col("hidden"), F.col(v)))
        rows = rows.withColumn(v, F.when(F.col("hidden"), F.lit(0.0)).otherwise(F.col(v)))
    return rows
