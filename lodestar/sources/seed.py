"""The seed dimension of canonical names and their alternate forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.text import normalize_name
from lodestar.functions.similarity import token_sort
from lodestar.schemas import SEED, SEED_ENTITIES


def default_seed(spark: SparkSession, entities: dict | None = None) -> DataFrame:
    """Seed table ``(seed_idx, canonical, aliases)`` from a dict, in dict order."""
    entities = entities or SEED_ENTITIES
    rows = [(i, k, list(v)) for i, (k, v) in enumerate(entities.items())]
    return spark.createDataFrame(rows, SEED)


def seed_forms(seed: DataFrame, order_col: str = "seed_idx") -> DataFrame:
    """One row per form: the canonical itself first, then each alias in order.

    Columns: ``seed_order`` (the seed's order key), ``form_pos``, ``canonical``,
    ``form``, ``norm`` (normalised form) and ``sorted_norm`` (token sorted).
    The pair (seed_order, form_pos) is the form's position in the flat list;
    it decides "last wins" for exact lookups and "first wins" for fuzzy ties.
    """
    forms = seed.select(
        F.col(order_col).alias("seed_order"), "canonical",
        F.posexplode(F.concat(F.array(F.col("canonical")),
                              F.coalesce(F.col("aliases"), F.array().cast("array<string>"))))
        .alias("form_pos", "form"))
    return (forms.withColumn("norm", normalize_name("form"))
            .withColumn("sorted_norm", token_sort("norm")))
