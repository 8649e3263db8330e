r"""Chat formatting in budgeted windows (native Spark).

Template of a turn: ``<|im_start|>role\ntext<|im_end|>\n``.  The role is
URL-encoded; inside texts every control string gets a backslash after its
first character (``<\|im_end|>``, ``[\INST]``), and one more if it has some
already, so that un-escaping removes exactly one and gives the text back.

Windows.  Turns have a token count (by default their words, and
``TURN_TOKENS`` for the template).  Prefix sums of it cut a conversation into
turn-aligned spans: with ``stride`` tokens a span, a turn belongs to the span
in which it lies; a turn that crosses a border is a span of its own.  A
window is the system turn (the first turn, if its role says so), then the
turns that end within ``history`` tokens before the span, then the span; the
stride is what the budget leaves.  Only a single turn larger than the stride
can exceed the budget, as turns are never cut.

Loss mask: character spans of the assistant texts of the span itself.  The
repeated system turn and history are masked, so each assistant text is a
target once.

Prefix sums are taken in blocks of ``BLOCK`` turn numbers, then over the
blocks, and history is an equi-join on (conversation, token bucket): a
conversation with a large share of all turns spreads over many tasks.

Defined results: null text and null role count as empty; null conversation
ids are one conversation; null turn numbers come first; equal turn numbers
are ordered by role and text; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestar.llm.common import WORD, cut, join_on

START, END = "<|im_start|>", "<|im_end|>\n"
# Strings that common chat templates and tokenizers treat as control marks.
CONTROL = r"\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|<SYS>>|</SYS>>"
TURN_TOKENS = 4
BLOCK = 256


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({CONTROL})", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({CONTROL})", "$1$2$3")


def turn_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long") + TURN_TOKENS


def numbered(turns: DataFrame, tokens: Callable[[Column], Column], block: int) -> DataFrame:
    """(conv, role, text) with position ``pos``, ``size`` and the tokens before the turn, ``at``."""
    t = (turns.withColumn("size", tokens(F.col("text")))
         .withColumn("block", F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / block)))
    inside = Window.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("pos", F.row_number().over(inside) - 1).withColumn("at", F.sum("size").over(upto) - F.col("size"))
    over = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (turns.withColumn("size", tokens(F.col("text")))
              .groupBy("conv", F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / block).alias("block"))
              .agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("total"))
              .withColumn("pos0", F.coalesce(F.sum("n").over(over), F.lit(0)))
              .withColumn("at0", F.coalesce(F.sum("total").over(over), F.lit(0)))
              .select("conv", "block", "pos0", "at0"))
    return (join_on(t, blocks, "conv", "block")
            .select("conv", "role", "text", "size", (F.col("pos") + F.col("pos0")).alias("pos"),
                    (F.col("at") + F.col("at0")).alias("at")))


def format_chats(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", budget: int = 512, history: int = 128,
                 tokens: Callable[[Column], Column] = turn_tokens, block: int = BLOCK) -> DataFrame:
    """One row per window: conversation, ``window`` (ascending), ``n_repeated``
    (turns at its head that are repeated), ``formatted`` and ``loss`` (array of
    start and length, in characters of ``formatted``)."""
    turns = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    t = cut(numbered(turns, tokens, block))
    system = t.where("pos = 0 and role = 'system'").select("conv", "role", "text", "pos", F.col("size").alias("sys_size"))
    t = join_on(t, system.select("conv", "sys_size"), "conv", how="left")
    room = F.lit(budget - history) - F.coalesce("sys_size", F.lit(0))
    t = t.withColumn("stride", F.greatest(room, F.lit(max(1, budget // 4))))
    first, last = F.floor(F.col("at") / F.col("stride")), F.floor((F.col("at") + F.col("size") - 1) / F.col("stride"))
    t = t.withColumn("window", 2 * first + F.when(first == last, 0).otherwise(1))
    spans = t.groupBy("conv", "window").agg(F.min("pos").alias("from_pos"), F.min("at").alias("from_at"))
    own = t.select("conv", "window", F.lit(2).alias("kind"), "pos", "role", "text")
    later = spans.where("from_pos > 0")
    head = join_on(later, system, "conv").select("conv", "window", F.lit(0).alias("kind"), "pos", "role", "text")
    pieces = own.unionByName(head)
    if history > 0:
        ago = F.floor((F.col("from_at") - 1) / history)
        near = later.withColumn("bucket", F.explode(F.array(ago, ago - 1)))
        old = (t.where("pos > 0 or role <> 'system'")
               .select("conv", "pos", "at", "role", "text", F.floor(F.col("at") / history).alias("bucket")))
        pieces = pieces.unionByName(
            join_on(near, old, "conv", "bucket")
            .where((F.col("at") < F.col("from_at")) & (F.col("at") >= F.col("from_at") - history))
            .select("conv", "window", F.lit(1).alias("kind"), "pos", "role", "text"))
    pieces = (pieces.withColumn("open", F.concat(F.lit(START), F.url_encode("role"), F.lit("\n")))
              .withColumn("body", escape(F.col("text"))))
    order = Window.partitionBy("conv", "window").orderBy("kind", "pos").rowsBetween(Window.unboundedPreceding, 0)
    turn = F.concat("open", "body", F.lit(END))
    pieces = (pieces.withColumn("piece", turn)
              .withColumn("start", F.sum(F.length("piece")).over(order) - F.length("piece") + F.length("open")))
    target = F.when((F.col("kind") == 2) & (F.col("role") == "assistant"),
                    F.struct(F.col("start").cast("int").alias("start"), F.length("body").alias("length")))
    done = (pieces.groupBy("conv", "window")
            .agg(F.sort_array(F.collect_list(F.struct("kind", "pos", "piece", target.alias("target")))).alias("p")))
    return done.select(
        F.col("conv").alias(conv_col), "window",
        F.size(F.filter("p", lambda x: x["kind"] < 2)).alias("n_repeated"),
        F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("formatted"),
        F.filter(F.transform("p", lambda x: x["target"]), lambda x: x.isNotNull()).alias("loss"))


def parse_windows(windows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Read the output back: one row per window with ``turns`` (role and text of
    the turns that are not repeats) and ``targets`` (un-escaped text under the mask)."""
    marked = F.split("formatted", r"<\|im_end\|>\n", -1)
    marked = F.slice(marked, F.col("n_repeated") + 1, F.size(marked) - 1 - F.col("n_repeated"))
    body = lambda x: F.substring(x, F.lit(len(START) + 1), F.length(x))
    turns = F.transform(marked, lambda x: F.struct(
        F.url_decode(F.substring_index(body(x), "\n", 1)).alias("role"),
        unescape(F.substring(body(x), F.instr(body(x), "\n") + 1, F.length(x))).alias("text")))
    targets = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    return windows.select(conv_col, "window", turns.alias("turns"), targets.alias("targets"),
                          F.length("formatted").cast("long").alias("chars"))


def chat_digest(windows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row per conversation, from the formatted windows alone."""
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    w = parse_windows(windows, conv_col).select(
        conv_col, F.size("turns").alias("n"), "chars",
        F.struct("window", whole.alias("turns"), F.array_join("targets", "").alias("targets")).alias("w"))
    g = w.groupBy(conv_col).agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
                                F.sort_array(F.collect_list("w")).alias("ws"))
    text = lambda name: F.array_join(F.transform("ws", lambda x: x[name]), "")
    return g.select(conv_col, "n_turns", F.sha2(text("turns").cast("binary"), 256).alias("turns_sha256"),
                    F.length(text("targets")).cast("long").alias("loss_chars"),
                    F.sha2(text("targets").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
