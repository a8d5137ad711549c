"""Dimension joins with an explicit broadcast decision."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def salted_join(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    how: str,
    buckets: int,
    salt_source: str,
) -> DataFrame:
    """Equi-join that spreads every key over ``buckets`` shuffle partitions.

    Each fact row gets a salt from a hash of ``salt_source`` (deterministic,
    so a re-run task sees the same salt), each dimension row is repeated once
    per salt value.  A subscriber with a third of all records is then joined
    by ``buckets`` tasks instead of one; the dimension grows ``buckets``
    times, so keep it small (8-64).
    """
    salt = F.pmod(F.xxhash64(F.col(salt_source)), F.lit(buckets)).cast("int")
    salted_fact = fact.withColumn("_salt", salt)
    salted_dim = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return salted_fact.join(salted_dim, on=[*on, "_salt"], how=how).drop("_salt")


def join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str] | str,
    how: str = "inner",
    trusted_small: bool = False,
    salt_buckets: int | None = None,
    salt_source: str | None = None,
) -> DataFrame:
    """Join a fact table to a dimension; building the plan starts no job.

    * ``trusted_small``: the dimension is bounded by construction (literal
      configuration rows), broadcast it.
    * ``salt_buckets`` (with ``salt_source``, a column of the fact table): salt
      the join, for clusters without AQE skew handling or with extreme skew.
    * neither: the planner decides by size.  A stored table's size is known from
      its files, and AQE measures a derived one at run time; below
      ``spark.sql.autoBroadcastJoinThreshold`` it is broadcast, beyond it the
      join is sort-merge and AQE splits skewed keys.
    """
    if trusted_small:
        return fact.join(F.broadcast(dim), on=on, how=how)
    if salt_buckets and salt_buckets > 1:
        keys = [on] if isinstance(on, str) else list(on)
        return salted_join(fact, dim, keys, how, salt_buckets, salt_source or keys[0])
    return fact.join(dim, on=on, how=how)
