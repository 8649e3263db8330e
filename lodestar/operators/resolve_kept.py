"""J5 kept up to date: a stored name map that follows changes of its seed and
takes in new names, so that a run costs what changed.

``refresh`` stores a version of the map under a folder: the seed's forms, and one
row per distinct raw name with its decision and the place of the form that won.
Names lie in buckets by the length of their token-sorted text.  A form reaches only
names of lengths that the threshold allows, exact hits included, so a changed form
touches only these buckets; the others are neither read nor written again, and a
bucket's newest finished version holds.

The next version compares the forms with those stored.  Of the names in the
buckets touched:

- a name whose normalised text is a form now is an exact hit;
- a name that is new, was an exact hit and is none any more, or whose winning form
  is gone, is resolved against all forms;
- every other name only meets the forms that were added (the same segment and gram
  joins); the best of them replaces the stored winner if its score is higher, or equal
  and its place earlier.  A name that meets none of them is not scored.

A form whose place in the seed moved counts as gone and added.

Defined results: null names are left out of the map and resolve as in ``resolve``;
repeated names are one row; an empty seed and a table without names are allowed; the
threshold is stored and a version with another one starts from nothing.  Names are
never removed.  A version counts once its names are written (``_SUCCESS``), so what a
crashed run left is not read.  One writer at a time.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.similarity import token_sort
from lodestar.functions.text import normalize_name, self_canonical
from lodestar.operators import resolve as R
from lodestar.operators.keys import with_spread_key
from lodestar.schemas import FUZZY_THRESHOLD, METHOD_EXACT, METHOD_FUZZY, METHOD_NONE
from lodestar.session import list_names, materialize, path_exists
from lodestar.sources.seed import seed_forms

LAST = 255   # the bucket of all longer names; there are LAST + 1 buckets at most
FILES = 32   # tasks that write one bucket
FORM = ["seed_order", "form_pos", "canonical", "norm", "sorted_norm"]
ROW = ["raw", "norm", "bucket", "canonical", "method", "confidence", "seed_order", "form_pos", "changed_in"]


def _versions(spark: SparkSession, base: str) -> tuple[list[str], int]:
    """Finished versions in order, and a number above all there are."""
    found = sorted(int(n[1:]) for n in list_names(spark, base) if re.fullmatch(r"v\d{6}", n))
    done = [f"{base}/v{n:06d}" for n in found if path_exists(spark, f"{base}/v{n:06d}/names/_SUCCESS")]
    return done, (found[-1] + 1 if found else 0)


def bucket_paths(spark: SparkSession, base: str) -> dict[int, str]:
    """The newest folder of each bucket."""
    newest = {}
    for version in _versions(spark, base.rstrip("/"))[0]:
        for name in list_names(spark, f"{version}/names"):
            if name.startswith("part="):
                newest[int(name[5:])] = f"{version}/names/{name}"
    return newest


def _bucket(text: Column) -> Column:
    return F.least(F.length(F.coalesce(text, F.lit(""))), F.lit(LAST))


def _distinct(col: Column, df: DataFrame) -> set[int]:
    """The buckets of a table: at most LAST + 1 numbers."""
    return {r[0] for r in df.select(col.alias("b")).distinct().collect()}


def reach(lengths, threshold: int) -> set[int]:
    """Buckets of all names that a form of one of these lengths can match."""
    out = set()
    for n in lengths:
        lo, hi = n * threshold // (200 - threshold) - 1, -(-n * (200 - threshold) // threshold) + 1
        out.update(range(max(0, min(lo, LAST)), min(hi, LAST) + 1))
    return out


def _place() -> Column:
    """A form's place in the seed as one key; null without a form."""
    return F.when(F.col("form_pos").isNotNull(), F.xxhash64("seed_order", "form_pos"))


def _stored(spark: SparkSession, paths: list[str], forms: DataFrame) -> DataFrame:
    place = [f"{f.name} {f.dataType.simpleString()}" for f in forms.select("seed_order", "form_pos").schema]
    schema = ("raw string, norm string, bucket int, canonical string, method string, confidence double, "
              + ", ".join(place) + ", changed_in int")
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def refresh(spark: SparkSession, base: str, seed: DataFrame, names: DataFrame | None = None, name_col: str = "name",
            threshold: int = FUZZY_THRESHOLD, order_col: str = "seed_idx") -> str:
    """Bring the map under ``base`` (a shared folder) up to date with ``seed`` and the
    ``name_col`` of ``names``; returns the folder of the new version."""
    base = f"{base.rstrip('/')}/at_{threshold}"
    done, number = _versions(spark, base)
    here = f"{base}/v{number:06d}"
    forms = _written(seed_forms(seed, order_col).select(*FORM).where("norm is not null"), f"{here}/forms")
    before = spark.read.schema(forms.schema).parquet(f"{done[-1]}/forms") if done else forms.limit(0)
    changed = _written(forms.subtract(before).withColumn("added", F.lit(True))
                       .unionByName(before.subtract(forms).withColumn("added", F.lit(False))), f"{here}/changed")
    touched = reach(_distinct(_bucket(F.col("sorted_norm")), changed), threshold)

    raw = spark.createDataFrame([], "raw string") if names is None else (
        names.select(F.col(name_col).cast("string").alias("raw")).where("raw is not null").distinct())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    raw = (raw.repartition(parts, F.xxhash64("raw"))
           .withColumn("norm", F.coalesce(normalize_name(F.col("raw")), F.lit("")))
           .withColumn("bucket", _bucket(token_sort("norm"))))
    raw = _written(raw, f"{here}/incoming")
    incoming = _distinct(F.col("bucket"), raw)

    paths = bucket_paths(spark, base)
    read = [paths[b] for b in sorted(touched | incoming) if b in paths]
    kept = _stored(spark, read, forms)
    new = raw.join(kept.select("raw"), "raw", "left_anti")
    rows = kept.unionByName(new, allowMissingColumns=True)
    gone = changed.where("not added").select(_place().cast("string").alias("__key__"), F.lit(True).alias("gone")).distinct()
    exact = R.exact_lookup(forms).withColumnRenamed("canonical", "exact")
    rows = with_spread_key(rows.join(exact, "norm", "left"), "__key__", _place())
    rows = materialize(rows.join(gone, "__key__", "left").drop("__key__"), "kept-rows")

    # Null-safe: a new name has no method yet.
    again = F.coalesce(F.col("method") == METHOD_EXACT, F.lit(True)) | F.col("gone").isNotNull()
    rest = rows.where("exact is null")
    found = R.fuzzy_best(rest.where(again), forms, threshold, "raw", with_form=True)
    if touched and read:
        add = changed.where("added").select(*FORM)
        found = found.unionByName(R.fuzzy_best(rest.where(~again), add, threshold, "raw", with_form=True))
    found = found.select("raw", F.struct("canonical", "confidence", "seed_order", "form_pos").alias("f"))
    out = _decide(rows.join(found, "raw", "left"), again, number)
    (out.withColumn("part", F.col("bucket")).repartition(parts, "part", F.pmod(F.xxhash64("raw"), F.lit(FILES)))
     .write.partitionBy("part").parquet(f"{here}/names"))
    return here


def _decide(rows: DataFrame, again: Column, number: int) -> DataFrame:
    """The new decision of each row from the stored one, the exact hit ``exact`` and the
    best form found ``f`` (of all forms where ``again``, else of the added ones)."""
    f, old = F.col("f"), F.struct("canonical", "method", "confidence", "seed_order", "form_pos")
    kinds = {c: rows.schema[c].dataType for c in ("seed_order", "form_pos")}

    def decision(canonical, method, confidence, order, pos):
        return F.struct(canonical.alias("canonical"), F.lit(method).alias("method"), confidence.alias("confidence"),
                        order.cast(kinds["seed_order"]).alias("seed_order"), pos.cast(kinds["form_pos"]).alias("form_pos"))
    none = F.lit(None)
    hit = decision(f["canonical"], METHOD_FUZZY, f["confidence"], f["seed_order"], f["form_pos"])
    better = F.col("form_pos").isNull() | (f["confidence"] > F.col("confidence")) | (
        (f["confidence"] == F.col("confidence"))
        & (F.struct(f["seed_order"], f["form_pos"]) < F.struct("seed_order", "form_pos")))
    now = (F.when(F.col("exact").isNotNull(), decision(F.col("exact"), METHOD_EXACT, F.lit(100.0), none, none))
           .when(again & f.isNotNull(), hit)
           .when(again, decision(none.cast("string"), METHOD_NONE, F.lit(0.0), none, none))
           .when(f.isNotNull() & better, hit)
           .otherwise(old))
    rows = rows.withColumn("now", now).withColumn("same", F.col("now").eqNullSafe(old))
    return rows.select("raw", "norm", "bucket", "now.*", F.when(F.col("same"), F.col("changed_in"))
                       .otherwise(F.lit(number)).alias("changed_in")).select(*ROW)


def kept_names(spark: SparkSession, base: str, threshold: int = FUZZY_THRESHOLD) -> DataFrame:
    """The stored rows of the newest version: ``ROW``; ``canonical`` is null without a match
    and ``changed_in`` is the number of the version that last changed the decision."""
    base = f"{base.rstrip('/')}/at_{threshold}"
    done = _versions(spark, base)[0]
    if not done:
        raise FileNotFoundError(f"no finished version under {base}")
    return _stored(spark, sorted(bucket_paths(spark, base).values()), spark.read.parquet(f"{done[-1]}/forms"))


def resolve_kept(df: DataFrame, name_col: str, base: str, threshold: int = FUZZY_THRESHOLD, prefix: str = "") -> DataFrame:
    """``resolve`` by the stored map: a join.  Names that no ``refresh`` has seen come out
    as ``no_seed_match`` with a null canonical name."""
    m = kept_names(df.sparkSession, base, threshold)
    names = m.select(F.col("raw").alias("__raw__"), F.coalesce("canonical", self_canonical("raw")).alias("__c__"),
                     F.col("method").alias("__m__"), F.col("confidence").alias("__s__"))
    return R.apply_map(df, name_col, names, prefix)
