"""Class-balancing undersample and the train / test split.

Both are row-local predicates on a hash of the row key: no shuffle, no
driver state, and the same rows on any partition layout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundstop.functions.hashing import hash_prefix, hash_threshold
from groundstop.schemas import ROW_KEY

SPLIT_SALT = "split"


def _salted(key: str, salt: str) -> Column:
    return F.concat(F.col(key).cast("string"), F.lit(f"#{salt}")) if salt else F.col(key)


def undersample(
    df: DataFrame,
    fraction: float = 0.03,
    *,
    flag: str = "cancelled",
    key: str = ROW_KEY,
    method: str = "hash",
    seed: int = 3,
) -> DataFrame:
    """Keep every minority row (flag = 1) and ``fraction`` of the majority (flag = 0).

    ``method="hash"`` (default) is one filter over one scan.
    ``method="bernoulli"`` uses ``DataFrame.sample(False, fraction, seed)``,
    whose rows depend on the partition layout.
    """
    if method == "hash":
        keep = hash_prefix(key) < F.lit(hash_threshold(fraction))
        return df.where((F.col(flag) == 1) | ((F.col(flag) == 0) & keep))
    if method == "bernoulli":
        majority = df.where(F.col(flag) == 0).sample(withReplacement=False, fraction=fraction, seed=seed)
        return df.where(F.col(flag) == 1).unionByName(majority)
    raise ValueError(f"unknown method {method!r}")


def split_flag(key: str = ROW_KEY, train_fraction: float = 0.75, salt: str = SPLIT_SALT) -> Column:
    """True for training rows.  Salted, so it is independent of the undersample hash."""
    return hash_prefix(_salted(key, salt)) < F.lit(hash_threshold(train_fraction))


def train_test_split(
    df: DataFrame,
    train_fraction: float = 0.75,
    key: str = ROW_KEY,
    method: str = "hash",
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """Training and test parts.

    ``method="hash"`` (default): salted hash of the key, the same rows on
    any layout.  ``method="random"``: ``randomSplit`` with ``seed``, whose
    rows depend on the partition layout.
    """
    if method == "random":
        train, test = df.randomSplit([train_fraction, 1.0 - train_fraction], seed)
        return train, test
    flag = split_flag(key, train_fraction)
    return df.where(flag), df.where(~flag)


def split_counts(df: DataFrame, train_fraction: float = 0.75, key: str = ROW_KEY) -> DataFrame:
    """Rows per side of the split: ``(split, n)``."""
    side = F.when(split_flag(key, train_fraction), F.lit("train")).otherwise(F.lit("test"))
    return df.groupBy(side.alias("split")).agg(F.count(F.lit(1)).alias("n"))
