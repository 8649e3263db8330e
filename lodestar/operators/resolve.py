"""Name resolution (J3-J5): exact seed lookup, fuzzy theta join with top-1,
and the self-canonical fallback, plus the mapping log (U2).

Plan shape (per call):

1. distinct normalised names of the input (map-side partial aggregation
   collapses hot names before the shuffle);
2. exact lookup: equi join with the seed's normalised forms (``max_by``
   per form implements "last form wins");
3. fuzzy: the names without an exact hit meet the seed forms that share a
   segment at a possible place (Pass-Join blocking, an equi-join on hashes;
   see ``_candidate_pairs``) or, for forms above ``LONG`` characters, a rare
   gram (``grams``), then cheap tests and the Indel ratio of the
   token-sorted strings keep the best form per name (ties: the earliest form);
4. the small name -> match map is joined back to every input row.

There is one path for seeds of any size; nothing is counted while the plan is
built, and AQE decides at runtime whether a side is small enough to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.similarity import cheap_bound_ok, lcs_length, lcs_length_batched
from lodestar.functions.text import normalize_name, self_canonical, token_sort
from lodestar.operators.grams import long_pairs
from lodestar.operators.keys import with_spread_key
from lodestar.schemas import FUZZY_THRESHOLD, METHOD_EXACT, METHOD_FUZZY, METHOD_NONE
from lodestar.sources.seed import seed_forms

LONG = 24  # characters; longer forms are looked up by grams: segment rows grow with the cube of the length


def exact_lookup(forms: DataFrame) -> DataFrame:
    """J3 table: normalised form -> canonical; if two canonicals share a form
    the one listed last wins."""
    return (forms.groupBy("norm")
            .agg(F.max_by("canonical", F.struct("seed_order", "form_pos")).alias("canonical")))


def _budget(l1: Column, l2: Column, threshold: int) -> Column:
    return F.floor((l1 + l2) * F.lit(100 - threshold) / F.lit(100)).cast("int")


def _compatible(l1: Column, l2: Column, threshold: int) -> Column:
    return F.lit(100) * F.abs(l1 - l2) <= F.lit(100 - threshold) * (l1 + l2)


def _length_range(l: Column, threshold: int):
    """Loose bounds on partner lengths; the exact test is ``_compatible``."""
    lo = F.greatest(F.lit(0), F.floor(l * F.lit(threshold) / F.lit(200 - threshold)) - 1)
    hi = F.ceil(l * F.lit(200 - threshold) / F.lit(threshold)) + 1
    return lo.cast("int"), hi.cast("int")


def _segments(l2: Column, tau: Column):
    """Even split of a length-``l2`` string into ``tau+1`` segments: returns
    per-segment (start0, length) columns for a segment index column ``i``."""
    m = tau + 1
    k = F.floor(l2 / m).cast("int")
    r = (l2 % m).cast("int")

    def seg(i: Column):
        start0 = i * k + F.greatest(F.lit(0), i - (m - r))
        length = F.when(i >= m - r, k + 1).otherwise(k)
        return start0, length
    return seg


def _candidate_pairs(names: DataFrame, forms: DataFrame, threshold: int) -> DataFrame:
    """All (nid, fid) pairs that can reach the threshold: by segments for forms
    of up to ``LONG`` characters, by grams for longer ones."""
    names = names.select("nid", "q_sorted", F.length("q_sorted").alias("l1"))
    forms = forms.select("fid", "sorted_norm", F.length("sorted_norm").alias("l2"))
    return _short_pairs(names, forms, threshold).unionByName(long_pairs(names, forms, threshold, LONG)).distinct()


def _short_pairs(names: DataFrame, forms: DataFrame, threshold: int) -> DataFrame:
    """(nid, fid), with repeats, by segment blocking, for forms of up to ``LONG`` characters.

    A form is cut into ``tau + 1`` segments for each compatible partner length
    (``tau``: the edits that the threshold allows at these two lengths).  At
    most ``tau`` edits leave one segment whole, and in the name it lies within
    a few places of its own: before segment ``i`` at most ``i`` edits can have
    happened, after it at most ``tau - i``, and of all edits at most
    ``(tau + d) / 2`` insert and ``(tau - d) / 2`` delete (``d``: length gap).
    Rows carry 64-bit hashes of the segment and ids of name and form; a
    colliding hash only adds a pair, which the exact score rejects."""
    def hashed(text, l1, l2, i):
        return F.xxhash64(text, l1, l2, i)

    # ``explode_outer``: see ``grams.prefixes``.
    none = F.array().cast("array<int>")
    lo, hi = _length_range(F.col("l2"), threshold)
    f = (forms.withColumn("l1", F.explode_outer(F.when(F.col("l2") <= LONG, F.sequence(lo, hi)).otherwise(none)))
         .where((F.col("l1") >= 0) & _compatible(F.col("l1"), F.col("l2"), threshold))
         .withColumn("tau", _budget(F.col("l1"), F.col("l2"), threshold))
         .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("tau")))))
    s0, sl = _segments(F.col("l2"), F.col("tau"))(F.col("i"))
    f = f.select("fid", hashed(F.substr(F.col("sorted_norm"), s0 + 1, sl), F.col("l1"), F.col("l2"), F.col("i")).alias("seg"))

    lo, hi = _length_range(F.col("l1"), threshold)
    # Only lengths that some form has: at most one row per form length.
    lengths = forms.select("l2").distinct()
    q = (names.withColumn("l2", F.explode_outer(
        F.when(lo <= LONG, F.sequence(lo, F.least(hi, F.lit(LONG)))).otherwise(none)))
         .where((F.col("l2") >= 0) & _compatible(F.col("l1"), F.col("l2"), threshold))
         .join(lengths, "l2", "left_semi")
         .withColumn("tau", _budget(F.col("l1"), F.col("l2"), threshold))
         .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("tau")))))
    s0, sl = _segments(F.col("l2"), F.col("tau"))(F.col("i"))
    gap, i, tau = F.col("l1") - F.col("l2"), F.col("i"), F.col("tau")
    back = F.greatest(-i, gap - (tau - i), -F.floor((tau - gap) / 2).cast("int"))
    ahead = F.least(i, gap + (tau - i), F.floor((tau + gap) / 2).cast("int"))
    q = (q.withColumn("s0", s0).withColumn("sl", sl)
         .withColumn("qlo", F.greatest(F.lit(0), F.col("s0") + back))
         .withColumn("qhi", F.least(F.col("l1") - F.col("sl"), F.col("s0") + ahead))
         .where(F.col("qlo") <= F.col("qhi"))
         .withColumn("qpos", F.explode(F.sequence(F.col("qlo"), F.col("qhi"))))
         .select("nid", hashed(F.substr(F.col("q_sorted"), F.col("qpos") + 1, F.col("sl")),
                               F.col("l1"), F.col("l2"), F.col("i")).alias("seg")))
    return q.join(f, "seg").select("nid", "fid")


def fuzzy_best(names: DataFrame, forms: DataFrame, threshold: int = FUZZY_THRESHOLD,
               key: str = "norm", lcs_impl: str = "batched", with_form: bool = False) -> DataFrame:
    """For each distinct ``key`` of ``names`` (with its ``norm``) the
    best-scoring seed form, kept only if its token-sort ratio reaches
    ``threshold``.  Returns ``(key, canonical, confidence)``, with ``with_form``
    also the form's place ``(seed_order, form_pos)``."""
    cols = [key] if key == "norm" else [key, "norm"]
    place = ["seed_order", "form_pos"] if with_form else []
    # Non-nullable on purpose: a nullable derived key lets Catalyst infer an
    # IsNotNull filter and push it below the distinct, i.e. onto every row.
    names = names.select(*cols).withColumn("q_sorted", F.coalesce(token_sort("norm"), F.lit("")))
    # Pairing and LCS are CPU-bound (names x forms), but the names are few
    # bytes, so AQE would coalesce them into very few tasks.  An explicit
    # partition count (the configured shuffle parallelism) is kept by AQE;
    # hashing an expression of the key (not the key itself) stops Catalyst
    # from dropping the exchange as already satisfied by the distinct.
    n_parts = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = names.repartition(n_parts, F.xxhash64(key))
    names = names.withColumn("nid", F.xxhash64(key))
    forms = forms.withColumn("fid", F.xxhash64("seed_order", "form_pos")).repartition(n_parts, "fid")
    found = _candidate_pairs(names, forms, threshold)
    pairs = (found.join(names, "nid")
             .join(forms.select("fid", "seed_order", "form_pos", "canonical", "sorted_norm"), "fid")
             .drop("nid", "fid").repartition(n_parts, F.xxhash64(key)))
    # Cheap lossless tests guard the quadratic LCS (CASE keeps the order).
    a, b = F.col("q_sorted"), F.col("sorted_norm")
    pairs = pairs.where(F.when(cheap_bound_ok(a, b, threshold), F.lit(True)).otherwise(F.lit(False)))
    lcs_fn = lcs_length_batched if lcs_impl == "batched" else lcs_length
    scored = (pairs.withColumn("lcs", lcs_fn(a, b))
              .withColumn("total", F.length(a) + F.length(b)))
    scored = (scored.withColumn("indel", F.col("total") - 2 * F.col("lcs"))
              .withColumn("score", F.when(F.col("total") == 0, F.lit(100.0))
                          .otherwise((F.lit(1.0) - F.col("indel") / F.col("total")) * F.lit(100.0))))
    best = (scored.groupBy(key)
            .agg(F.min_by(F.struct("canonical", "score", "indel", "total", *place),
                          F.struct((-F.col("score")).alias("neg_score"), "seed_order", "form_pos"))
                 .alias("b")))
    ok = F.lit(100) * F.col("b.indel") <= F.lit(100 - threshold) * F.col("b.total")
    return best.where(ok).select(key, F.col("b.canonical").alias("canonical"),
                                 F.col("b.score").alias("confidence"), *[F.col(f"b.{c}") for c in place])


def match_map(names: DataFrame, seed: DataFrame, threshold: int = FUZZY_THRESHOLD,
              order_col: str = "seed_idx", key: str = "norm") -> DataFrame:
    """Resolution of names that hit the seed: ``(key, canonical, method,
    confidence)``, exact first, fuzzy for the rest.  ``names`` must hold one
    row per ``key`` and a ``norm`` column (``key`` may be ``norm`` itself).

    No distinct is taken here: the caller dedupes once, before the regex
    normalisation, so Catalyst cannot fold two distincts into one below the
    (costly) normalisation."""
    forms = seed_forms(seed, order_col)
    exact = exact_lookup(forms)
    cols = [key] if key == "norm" else [key, "norm"]
    names = names.select(*cols)
    # One left join instead of inner + left_anti: Catalyst pushes semi/anti
    # joins through the distinct below it, which would evaluate ``norm``
    # on every input row.
    j = names.join(exact.withColumnRenamed("canonical", "__exact__"), "norm", "left")
    hit = j.where(F.col("__exact__").isNotNull()).withColumnRenamed("__exact__", "canonical")
    rest = j.where(F.col("__exact__").isNull()).drop("__exact__")
    fuzzy = fuzzy_best(rest, forms, threshold, key=key)
    return (hit.select(key, "canonical", F.lit(METHOD_EXACT).alias("method"),
                       F.lit(100.0).alias("confidence"))
            .unionByName(fuzzy.select(key, "canonical", F.lit(METHOD_FUZZY).alias("method"),
                                      "confidence")))


def resolve(df: DataFrame, name_col: str, seed: DataFrame, threshold: int = FUZZY_THRESHOLD,
            order_col: str = "seed_idx", prefix: str = "", materialized: bool = False) -> DataFrame:
    """Add ``canonical_name``, ``method``, ``confidence`` to every row.

    exact -> confidence 100; fuzzy -> the score; otherwise the raw name with
    one legal suffix stripped (or the raw name if that leaves nothing),
    method ``no_seed_match``, confidence 0.  A null name resolves to a null
    canonical with ``no_seed_match`` (D6).

    All regex and similarity work runs once per *distinct raw name*; the
    per-row cost is one equi join with the resulting name map (AQE picks a
    broadcast at runtime when the map is small, and splits skewed names).

    With ``materialized`` (off by default, as it runs jobs while the plan is
    built) the distinct names and the name map are each checkpointed once, so
    the input is not rescanned per plan branch and the lineage is cut.
    """
    from lodestar.session import materialize
    raw = df.select(F.col(name_col).alias("__raw__")).where(F.col("__raw__").isNotNull()).distinct()
    # coalesce keeps ``norm`` non-nullable, so no inferred IsNotNull(norm)
    # filter is pushed below the distinct onto every input row.
    # Regex work per distinct name is CPU-bound on few bytes: keep the
    # configured parallelism (AQE would coalesce this small shuffle).
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    raw = raw.repartition(n_parts, F.xxhash64("__raw__"))
    raw = raw.withColumn("norm", F.coalesce(normalize_name(F.col("__raw__")), F.lit("")))
    if materialized:
        raw = materialize(raw, "resolve-names")
    mm = match_map(raw, seed, threshold, order_col, key="__raw__")
    names = (raw.join(mm, "__raw__", "left")
             .select(F.col("__raw__"),
                     F.coalesce(F.col("canonical"), self_canonical(F.col("__raw__"))).alias("__c__"),
                     F.coalesce(F.col("method"), F.lit(METHOD_NONE)).alias("__m__"),
                     F.coalesce(F.col("confidence"), F.lit(0.0)).alias("__s__")))
    if materialized:
        names = materialize(names, "resolve-map")
    return apply_map(df, name_col, names, prefix)


def apply_map(df: DataFrame, name_col: str, names: DataFrame, prefix: str = "") -> DataFrame:
    """Every row of ``df`` with its name's ``canonical_name``, ``method`` and
    ``confidence`` from ``names(__raw__, __c__, __m__, __s__)``, one row per name."""
    names = names.withColumn("__raw__", F.col("__raw__").cast("string"))
    out = with_spread_key(df, "__key__", F.col(name_col)).join(names, F.col("__key__") == F.col("__raw__"), "left")
    return (out.withColumn(prefix + "canonical_name", F.col("__c__"))
            .withColumn(prefix + "method", F.coalesce(F.col("__m__"), F.lit(METHOD_NONE)))
            .withColumn(prefix + "confidence", F.coalesce(F.col("__s__"), F.lit(0.0)))
            .drop("__key__", "__raw__", "__c__", "__m__", "__s__"))


def mapping_log(resolved: DataFrame, entity_type: str, raw_col: str, url_col) -> DataFrame:
    """One record type's projection into the mapping log schema."""
    url = F.col(url_col) if isinstance(url_col, str) else url_col
    return resolved.select(F.lit(entity_type).alias("entityType"),
                           F.col(raw_col).alias("rawName"),
                           F.col("canonical_name").alias("canonicalName"),
                           F.col("method"), F.col("confidence").cast("double").alias("confidence"),
                           url.alias("sourceUrl"))
