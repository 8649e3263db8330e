"""Mixing sources to target weights by Pareto order sampling (native Spark).

Targets.  Sources in code-point order (null last) weigh 1, 2, 3, repeating.
The words of all sources are shared out by weight; a share stops at ``cap``
times its source's words, and what is left over is shared again by weight.
In closed form that is ``target = min(cap * size, weight * level)``; the level
follows from prefix sums over the sources ordered by ``cap * size / weight``.

Copies.  A document of a source with ``f = target / size`` is taken
``floor(f)`` whole times for certain.  The rest of the target is an
unequal-probability sample without replacement.  A document's inclusion odds are
those of ``p = f - floor(f)``, which differs between sources, times
``sqrt(TYPICAL / size)``: a long document uses up more of the sample and is taken
with less probability.  Documents are ranked by random odds over inclusion odds,
``(u/(1-u)) / (p/(1-p) * sqrt(TYPICAL / size))`` (Pareto order
sampling).  The sample has a fixed size in words: documents are taken in rank
order, those that do not fit any more are skipped, until none fits; last comes
the one whose size is nearest to the words still missing.

The rank is mapped to (0, 1) and cut into ``BINS`` bins.  Sums per source and
bin (aggregated map-side) find the bin of the first document that does not fit,
and only that bin's documents are put in order, so no task sees a whole source.
The search goes on behind that document with the words still missing, among
documents of at most that size; each round gives one run of ranks.  The random
number is a hash of id and text: reruns agree.

Defined results: a null text has no words; documents and sources without
words get target and taken 0; rows equal in id and text draw the same number
and are taken alike; no row is taken more than ``cap`` times; an empty table
gives an empty result; other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestar.llm.common import WORD, cut, fresh, has_rows, join_on, small

BINS = 4096
TYPICAL = 256  # words of a document whose inclusion odds are its source's
CAP = 3
PAST = 2.0  # behind every rank
RUNS = "array<struct<start: double, stop: double, most: double>>"
PLAN = ("whole", "p", "taken", "last")


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def uniform(*cols: Column) -> Column:
    """A number in (0, 1) from a hash of ``cols``: 52 bits and a half."""
    return (F.shiftrightunsigned(F.xxhash64(*cols), 12).cast("double") + 0.5) / F.lit(float(2 ** 52))


def targets(sources: DataFrame, cap: int = CAP) -> DataFrame:
    """(source, source_size) -> + target, whole (copies of every document),
    missing (words to sample) and p.  One row per source: the windows run over
    the source summary only."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy()
    limit = cap * F.col("source_size")
    s = (sources.withColumn("weight", (F.row_number().over(by_name) - 1) % 3 + 1)
         .withColumn("ratio", limit / F.col("weight"))
         .withColumn("level", (F.sum("source_size").over(all_rows) - F.coalesce(F.sum(limit).over(before), F.lit(0)))
                     / (F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
         .withColumn("nth", F.row_number().over(by_ratio)))
    # The first source that does not reach its limit sets the level of all such sources.
    open_at = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("nth", "level"))).over(all_rows)
    s = s.withColumn("open", open_at)
    share = F.col("weight") * F.col("open.level")
    s = s.withColumn("target", F.when(F.col("nth") >= F.col("open.nth"), F.least(share, limit.cast("double")))
                     .otherwise(limit.cast("double")))
    f = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return (s.withColumn("whole", F.least(F.floor(f), F.lit(cap)).cast("long"))
            .withColumn("missing", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))
            .withColumn("p", F.when(F.col("source_size") > 0, F.col("missing") / F.col("source_size")).otherwise(F.lit(0.0)))
            .select("source", "source_size", "target", "whole", "missing", "p"))


def inclusion(p: Column, size: Column) -> Column:
    """Inclusion odds of a document: those of its source's share, less for a
    long document, which uses up more of the sample (the square root of its
    length against ``TYPICAL`` words)."""
    return p / (1 - p) * F.sqrt(F.lit(TYPICAL) / F.greatest(size, F.lit(1)))


def rank(u: Column, p: Column, size: Column) -> Column:
    """Pareto rank q = odds(u) / inclusion odds as q / (1 + q); 1 where nothing is sampled."""
    q = (u / (1 - u)) / inclusion(p, size)
    return F.when(p > 0, q / (1 + q)).otherwise(F.lit(1.0))


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """Narrow table (id, source, size, u) of all documents."""
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       n_words(F.col(text_col)).alias("size"),
                       uniform(F.lit(seed), F.col(id_col), F.col(text_col)).alias("u"))


def plan_mix(narrow: DataFrame, cap: int = CAP, bins: int = BINS) -> DataFrame:
    """One row per source: its targets, ``taken`` (runs of ranks, each with the
    size up to which its documents are in the sample) and ``last`` (the rank of
    the document that ends it)."""
    per_source = small(cut(targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), cap)))
    v = rank(F.col("u"), F.col("p"), F.col("size"))
    ranked = (join_on(narrow, per_source, "source").where("missing > 0 and size > 0")
              .withColumn("v", v).withColumn("bin", F.least(F.floor(v * bins), F.lit(bins - 1)).cast("int")))
    upto = Window.partitionBy("source").orderBy("bin")
    inside = Window.partitionBy("source").orderBy("v")
    state = small(cut(per_source.where("missing > 0").select(
        "source", F.col("missing").alias("gap"), F.lit(-1.0).alias("start"), F.array().cast(RUNS).alias("taken"))))
    while True:
        able = (join_on(ranked.select("source", "size", "v", "bin"), state.select("source", "gap", "start"), "source")
                .where((F.col("v") > F.col("start")) & (F.col("size") <= F.col("gap"))))
        # The bin of the first document that does not fit; none if all that are left fit.
        edge = small(cut(able.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.first("gap").alias("gap"))
                         .withColumn("upto", F.sum("words").over(upto))
                         .groupBy("source").agg(
                             F.max("upto").alias("all"),
                             F.min(F.when(F.col("upto") > F.col("gap"),
                                          F.struct("bin", (F.col("upto") - F.col("words")).alias("before")))).alias("edge"))))
        if not has_rows(edge):
            break
        bins_cut = edge.where("edge is not null").select("source", "edge.bin", "edge.before")
        summed = join_on(able, small(bins_cut), "source", "bin").withColumn("upto", F.col("before") + F.sum("size").over(inside))
        fit = F.col("upto") <= F.col("gap")
        stop = summed.groupBy("source").agg(F.min(F.when(~fit, F.col("v"))).alias("stop"),
                                            F.max(F.when(fit, F.col("upto")).otherwise(F.col("before"))).alias("filled"))
        run = join_on(edge.select("source", "all"), stop, "source", how="left").select(
            "source", F.coalesce("stop", F.lit(PAST)).alias("stop"), F.coalesce("filled", "all").alias("filled"))
        state = small(cut(join_on(state, run, "source", how="left").select(
            "source", (F.col("gap") - F.coalesce("filled", F.lit(0))).alias("gap"),
            F.coalesce("stop", F.lit(PAST)).alias("start"),
            F.when(F.col("filled") > 0, F.array_append("taken", F.struct("start", F.col("stop").alias("stop"),
                                                                        F.col("gap").alias("most"))))
            .otherwise(F.col("taken")).alias("taken"))))
    off = F.abs(F.col("gap") - F.col("size"))
    last = (join_on(ranked.select("source", "size", "v"), state, "source")
            .where(~in_runs(F.col("v"), F.col("size"), F.col("taken")) & (off < F.col("gap")))
            .groupBy("source").agg(F.min(F.struct(off.alias("off"), "v")).getField("v").alias("last")))
    state = join_on(state.select("source", "taken"), cut(last), "source", how="left")
    out = join_on(per_source, state, "source", how="left")
    return cut(out.select("source", "source_size", "target", "whole", "p",
                          F.coalesce("taken", F.array().cast(RUNS)).alias("taken"),
                          F.coalesce("last", F.lit(-1.0)).alias("last")))


def in_runs(v: Column, size: Column, taken: Column) -> Column:
    """Whether a document lies in a run of ranks and is not too long for it."""
    return F.exists(taken, lambda t: (v > t["start"]) & (v < t["stop"]) & (size <= t["most"]))


def n_copies(u: Column, size: Column, whole: Column, p: Column, taken: Column, last: Column) -> Column:
    """How often a document is taken, from its random number, its size and its source's plan."""
    v = rank(u, p, size)
    return whole + F.when((p > 0) & (size > 0) & (in_runs(v, size, taken) | (v == last)), 1).otherwise(0)


def mix_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               cap: int = CAP, seed: int = 0) -> DataFrame:
    """One row per document: id, size, source_size, target, taken."""
    narrow = cut(sized(docs, id_col, text_col, source_col, seed))
    return (join_on(narrow, small(plan_mix(narrow, cap)), "source")
            .select(F.col("id").alias(id_col), "size", "source_size", "target",
                    (F.col("size") * n_copies(F.col("u"), F.col("size"), *map(F.col, PLAN))).alias("taken")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        cap: int = CAP, seed: int = 0) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken.
    Documents without words are left out.  The text is not shuffled."""
    plan = plan_mix(cut(sized(docs, id_col, text_col, source_col, seed)), cap)
    names = dict(zip(plan.columns, fresh(docs, *["mix_" + c for c in plan.columns])))
    u, copy, words = fresh(docs, "mix_u", "mix_copy", "mix_words")
    plan = small(plan).toDF(*names.values())
    wide = (docs.withColumn(u, uniform(F.lit(seed), F.col(id_col), F.col(text_col)))
            .withColumn(words, n_words(F.col(text_col))).where(F.col(words) > 0)
            .join(plan, docs[source_col].eqNullSafe(plan[names["source"]])))
    n = n_copies(F.col(u), F.col(words), *[F.col(names[c]) for c in PLAN])
    return (wide.withColumn(copy, F.explode(F.array_repeat(F.lit(1), n.cast("int")))).select(*docs.columns))
