"""Hidden Markov language model over words, trained by Baum-Welch.

Tokens are the words of the text with A-Z lower-cased, then one end token.
The ``OWN`` most frequent training words are symbols of their own; every other
word belongs to one of ``CLASSES`` classes by its last two bytes, and the end
token is a symbol too.  ``P(word | state)`` is the state's emission of the
word's symbol, times ``(c + 1) / (N_k + V_k + 1)`` inside a class (c: training
count of the word, N_k and V_k: tokens and distinct words of the class in
training; the last unit is that of one unseen word: different unseen words of a
class count as one and the same word, so each of them gets the whole unit).

Counting: every training word is counted, map-side first, then by a shuffle on
the word.  The most frequent words, at most ``DICTIONARY``, are broadcast with
their counts; the rare rest of each document is joined with the counts on the
word, so no join key is frequent and no table of all words is ever broadcast.

Training: documents become sequences of symbol numbers, checkpointed once.  In
each step every task runs scaled forward-backward over its sequences (all of a
group advance together, sorted by length) and returns its expected counts per
symbol; Spark adds them up, and the driver turns the sums (states x symbols)
into the next model.  Scoring is the scaled forward recursion alone, which
gives the exact likelihood of the whole sequence.

Defined results: a null text counts as empty and has the end token alone;
texts of any length are one sequence; without training rows every probability
of the base is 1 / 1 and the model keeps its starting values; rows are scored
one by one, also if ids repeat; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.bpe import text_slices
from lodestar.llm.common import cut, ship

OWN = 8192
CLASSES = 256
END = OWN + CLASSES
SYMBOLS = OWN + CLASSES + 1
DICTIONARY = 200_000
STATES = 8
STEPS = 6
SMOOTH = 0.05
COUNTED = 300_000       # words counted in a task before they are passed on
GROUP = 400_000         # tokens that advance together
HELD = 12_000_000       # tokens a task sorts by length at a time
TASKS_PER_CORE = 4      # training tasks: each returns one row per symbol


def words_of(text: str) -> list[bytes]:
    """Words with A-Z in lower case; bytes.split() cuts at the six ASCII blanks."""
    return text.encode().lower().split()


def count_words(batches):
    """Per task: (word, n), passed on whenever many words are held."""
    def out(c):
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())],
                                          ["word", "n"])
    c: Counter = Counter()
    for batch in batches:
        for _, texts in text_slices(batch):
            for t in texts:
                c.update(words_of(t))
            if len(c) > COUNTED:
                yield out(c)
                c = Counter()
    yield out(c)


def class_of(word: Column) -> Column:
    """The same number as ``zlib.crc32(word[-2:]) % CLASSES``."""
    return F.crc32(F.substring(word, F.greatest(F.length(word) - 1, F.lit(1)), F.lit(2))) % CLASSES


class Counts:
    """Corpus counts: totals, the dictionary and the classes; bounded in size."""

    def __init__(self, words: DataFrame, ends: int):
        """``words``: checkpointed (word, n) of all training words."""
        level = F.floor(F.log2("n") * 8)
        rows = (words.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("n"))
                .orderBy(F.desc("level")).collect())  # a few hundred rows
        self.total = sum(r["n"] for r in rows) + ends
        self.distinct = sum(r["v"] for r in rows) + (ends > 0)
        held, least = 0, None
        for r in rows:
            held += r["v"]
            if held > DICTIONARY:
                break
            least = r["level"]
        top = words.where(level >= least).toPandas() if least is not None else None
        self.words, self.n = [], np.zeros(0, np.int64)
        if top is not None:
            top = top.sort_values(["n", "word"], ascending=[False, True])
            self.words, self.n = [bytes(w) for w in top["word"]], top["n"].to_numpy(np.int64)
        self.rare = words.where(level < least) if least is not None else words
        k = self.rare.groupBy(class_of(F.col("word")).alias("k")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"))
        self.class_n, self.class_v = np.zeros(CLASSES), np.zeros(CLASSES)
        for r in k.collect():
            self.class_n[r["k"]], self.class_v[r["k"]] = r["n"], r["v"]
        for w, n in zip(self.words[OWN:], self.n[OWN:].tolist()):
            self.class_n[zlib.crc32(w[-2:]) % CLASSES] += n
            self.class_v[zlib.crc32(w[-2:]) % CLASSES] += 1
        self.ends = ends

    def base(self, n):
        return np.log10((n + 1) / (self.total + self.distinct + 1))

    def lookup(self) -> dict:
        """What a task needs to turn words into symbols."""
        k = np.array([zlib.crc32(w[-2:]) % CLASSES for w in self.words], np.int64)
        rank = np.arange(len(self.words))
        own = rank < OWN
        inside = np.log10((self.n + 1) / (self.class_n[k] + self.class_v[k] + 1)) if len(k) else np.zeros(0)
        return {"key": uuid.uuid4().hex, "words": self.words, "symbol": np.where(own, rank, OWN + k).astype(np.uint16),
                "base": self.base(self.n), "inside": np.where(own, 0.0, inside),
                "end_base": float(self.base(self.ends)), "end_known": int(self.ends > 0)}


_INDEX: dict = {}


def index_of(shared) -> tuple[dict, dict]:
    look = shared.value
    key = look["key"]
    if _INDEX.get("key") != key:
        _INDEX.update(key=key, index={w: i for i, w in enumerate(look["words"])})
    return look, _INDEX["index"]


def sequences(shared):
    """(id, train, text) -> (id, train, n_tokens, n_known, base, inside, seq, rare)."""
    def run(batches):
        look, index = index_of(shared)
        z = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for at, texts in text_slices(batch):
                split = [words_of(t) for t in texts]
                n = np.array([len(w) for w in split])
                flat = [w for ws in split for w in ws]
                i = np.fromiter(map(index.get, flat, repeat(-1)), np.int64, len(flat))
                doc = np.repeat(np.arange(len(texts)), n)
                hit = i >= 0
                symbol = np.zeros(len(flat), np.uint16)
                symbol[hit] = look["symbol"][i[hit]]
                rare = np.flatnonzero(~hit)
                symbol[rare] = [OWN + zlib.crc32(flat[k][-2:]) % CLASSES for k in rare.tolist()]
                sums = [np.bincount(doc[hit], v, len(texts)).astype(np.float64) for v in (None, look["base"][i[hit]], look["inside"][i[hit]])]
                ends = np.cumsum(n)
                cuts = np.searchsorted(rare, np.concatenate([[0], ends]))
                seqs = [z.compress(np.append(symbol[e - k:e], np.uint16(END)).tobytes()) for e, k in zip(ends.tolist(), n.tolist())]
                left = [z.compress(b" ".join(flat[k] for k in rare[a:b].tolist())) if b > a else None
                        for a, b in zip(cuts.tolist(), cuts[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), batch.column(1).slice(at, len(texts)), pa.array(n + 1),
                     pa.array(sums[0].astype(np.int64) + look["end_known"]), pa.array(sums[1] + look["end_base"]),
                     pa.array(sums[2]), pa.array(seqs, pa.binary()), pa.array(left, pa.binary())],
                    ["id", "train", "n_tokens", "n_known", "base", "inside", "seq", "rare"])
    return run


def rare_words(batches):
    """(row, rare) -> (row, word, n): the rare words of each document."""
    z = zstandard.ZstdDecompressor()
    for batch in batches:
        rows, words, n = [], [], []
        for row, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            c = Counter(z.decompress(packed).split(b" "))
            rows += [row] * len(c)
            words += c.keys()
            n += c.values()
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(words, pa.binary()), pa.array(n, pa.int64())],
                                         ["row", "word", "n"])


class Group:
    """Sequences of similar length that advance together, the longest first.

    Tokens lie step by step (all first tokens, all second ones, ...), and the
    active sequences of a step are a prefix, so every step works on slices."""

    def __init__(self, seqs: list[np.ndarray]):
        lengths = np.array([len(s) for s in seqs])
        self.active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
        self.offsets = np.concatenate([[0], np.cumsum(self.active)])
        doc = np.repeat(np.arange(len(seqs)), lengths)
        step = np.arange(len(doc)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        place = self.offsets[step] + doc
        self.symbols = np.empty(len(doc), np.int64)
        self.symbols[place] = np.concatenate(seqs)
        self.doc = np.empty(len(doc), np.int64)
        self.doc[place] = doc

    def slices(self):
        return list(zip(self.offsets.tolist(), self.active.tolist()))

    def forward(self, start, move, emit_t, keep: bool):
        """Natural log-likelihood of each sequence; with ``keep`` also the scaled
        forward vectors, the emissions and the scales of every place."""
        out = emit_t[self.symbols]
        alphas = np.empty_like(out) if keep else None
        scales = np.empty(len(out), out.dtype)
        ones = np.ones(len(start), out.dtype)
        v = None
        for o, a in self.slices():
            v = np.multiply(start if v is None else v[:a] @ move, out[o:o + a])
            s = v @ ones
            v /= s[:, None]
            scales[o:o + a] = s
            if keep:
                alphas[o:o + a] = v
        logs = np.bincount(self.doc, np.log(scales.astype(np.float64)))
        return logs, alphas, out, scales

    def expect(self, start, move, emit_t):
        """Log-likelihood and expected counts: first states, moves, symbols."""
        logs, gamma, out, scales = self.forward(start, move, emit_t, True)
        moves = np.zeros(move.shape)
        back = np.ascontiguousarray(move.T)
        steps = self.slices()
        beta = np.ones((steps[-1][1], len(start)), out.dtype)
        for (p, n), (o, a) in zip(reversed(steps[:-1]), reversed(steps[1:])):
            ahead = out[o:o + a]
            ahead *= beta
            ahead /= scales[o:o + a, None]
            moves += gamma[p:p + a].T @ ahead
            gamma[o:o + a] *= beta
            beta = np.ones((n, len(start)), out.dtype)
            np.matmul(ahead, back, out=beta[:a])
        gamma[:len(beta)] *= beta
        symbols = np.stack([np.bincount(self.symbols, gamma[:, s], SYMBOLS) for s in range(len(start))], axis=1)
        return logs.sum(), gamma[:len(beta)].sum(0), moves * move, symbols


def groups(packed: list[bytes]):
    """(places in ``packed``, Group) by falling length."""
    z = zstandard.ZstdDecompressor()
    seqs = [np.frombuffer(z.decompress(p), np.uint16) for p in packed]
    order = sorted(range(len(seqs)), key=lambda k: -len(seqs[k]))
    at = 0
    while at < len(order):
        n, to = 0, at
        while to < len(order) and (n < GROUP or to == at):
            n += len(seqs[order[to]])
            to += 1
        yield order[at:to], Group([seqs[k] for k in order[at:to]])
        at = to


def held_batches(batches, column: int, tokens: int):
    """Lists of batches with about ``HELD`` tokens, so that lengths sort well."""
    held, n = [], 0
    for b in batches:
        for a in range(0, b.num_rows, 1024):
            part = b.slice(a, 1024)
            held.append(part)
            n += int(np.sum(part.column(tokens).to_numpy()))
            if n > HELD:
                yield held
                held, n = [], 0
    if held:
        yield held


def expected_counts(shared):
    """E step of one task: (symbol, e0, e1, ...) rows.  Symbols from SYMBOLS on
    hold the moves out of each state, then the first states, then log-likelihood."""
    def run(batches):
        start, move, emit = (x.astype(np.float32) for x in shared.value)
        emit_t = np.ascontiguousarray(emit.T)
        total = np.zeros((SYMBOLS + STATES + 2, STATES))
        for held in held_batches(batches, 0, 1):
            for _, g in groups([p for b in held for p in b.column(0).to_pylist()]):
                logs, first, moves, symbols = g.expect(start, move, emit_t)
                total[:SYMBOLS] += symbols
                total[SYMBOLS:SYMBOLS + STATES] += moves
                total[SYMBOLS + STATES] += first
                total[SYMBOLS + STATES + 1, 0] += logs
        used = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), *(pa.array(total[used, s].astype(np.float32)) for s in range(STATES))],
            ["symbol", *(f"e{s}" for s in range(STATES))])
    return run


def starting_model(n: np.ndarray, seed: int = 0):
    """Sticky states; emissions are the symbol counts, perturbed per state."""
    rng = np.random.default_rng(seed)
    p = (n + SMOOTH) * rng.gamma(1.0, 1.0, (STATES, SYMBOLS))
    move = np.full((STATES, STATES), 0.1 / max(STATES - 1, 1))
    np.fill_diagonal(move, 0.9)
    return np.full(STATES, 1 / STATES), move, p / p.sum(1, keepdims=True)


def train(seqs: DataFrame, counts: Counts, steps: int = STEPS) -> tuple[tuple, list[float]]:
    """Baum-Welch over (seq, n_tokens) rows; the model and the log-likelihoods."""
    sc = seqs.sparkSession.sparkContext
    n = np.zeros(SYMBOLS)
    own = min(OWN, len(counts.n))
    n[:own] = counts.n[:own]
    n[OWN:OWN + CLASSES] = counts.class_n
    n[END] = counts.ends
    model, logs = starting_model(n), []
    rows = seqs.coalesce(max(1, TASKS_PER_CORE * sc.defaultParallelism))
    cols = ", ".join(f"e{s} float" for s in range(STATES))
    for _ in range(steps):
        got = (rows.mapInArrow(expected_counts(sc.broadcast(model)), f"symbol int, {cols}")
               .groupBy("symbol").agg(*[F.sum(f"e{s}").alias(f"e{s}") for s in range(STATES)]).toPandas())
        total = np.zeros((SYMBOLS + STATES + 2, STATES))
        total[got["symbol"].to_numpy(np.int64)] = got[[f"e{s}" for s in range(STATES)]].to_numpy()
        if not total[SYMBOLS + STATES].sum():
            break
        logs.append(float(total[SYMBOLS + STATES + 1, 0]))
        # Smoothed towards the corpus frequencies, so that no state excludes a symbol.
        prior = (n + 1) / (n + 1).sum() * SMOOTH * SYMBOLS
        emit = total[:SYMBOLS].T + prior
        move = total[SYMBOLS:SYMBOLS + STATES] + SMOOTH
        first = total[SYMBOLS + STATES] + SMOOTH
        model = first / first.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True)
    return model, logs


def likelihood(shared, carry: list[str]):
    """(seq, n_tokens, carry) -> (carry, log10 likelihood of the symbols)."""
    def run(batches):
        start, move, emit = shared.value
        emit_t = np.ascontiguousarray(emit.T)
        for held in held_batches(batches, 0, 1):
            out = np.zeros(sum(b.num_rows for b in held))
            for places, g in groups([p for b in held for p in b.column(0).to_pylist()]):
                out[places] = g.forward(start, move, emit_t, False)[0] / math.log(10)
            at = 0
            for b in held:
                yield pa.RecordBatch.from_arrays([*b.columns[2:], pa.array(out[at:at + b.num_rows])], [*carry, "states"])
                at += b.num_rows
    return run


def score_texts(docs: DataFrame, train_on: Column, id_col: str = "doc_id", text_col: str = "text",
                steps: int = STEPS) -> DataFrame:
    """One row per document: id, train, n_tokens, n_known, train_tokens, base_score, score."""
    wide = ship(docs).select(F.col(id_col).alias("id"), F.coalesce(train_on, F.lit(False)).alias("train"),
                             F.col(text_col).alias("text"))
    sc = wide.sparkSession.sparkContext
    learned = wide.where("train")
    words = cut(learned.select("text").mapInArrow(count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")))
    counts = Counts(words, learned.select("id").count())
    kind = wide.schema["id"].dataType.simpleString()
    seqs = cut(wide.mapInArrow(
        sequences(sc.broadcast(counts.lookup())),
        f"id {kind}, train boolean, n_tokens long, n_known long, base double, inside double, seq binary, rare binary")
        .withColumn("row", F.monotonically_increasing_id()))
    model, _ = train(seqs.where("train").select("seq", "n_tokens"), counts, steps)

    carry = ["id", "train", "row", "n_known", "base", "inside"]
    scored = seqs.select("seq", "n_tokens", *carry, F.col("n_tokens").alias("tokens")).mapInArrow(
        likelihood(sc.broadcast(model), [*carry, "tokens"]),
        f"id {kind}, train boolean, row long, n_known long, base double, inside double, tokens long, states double")

    c, times = F.coalesce("c", F.lit(0)), F.col("n")
    room = F.lit((counts.class_n + counts.class_v + 1).tolist())
    rare = seqs.where("rare is not null").select("row", "rare").mapInArrow(rare_words, "row long, word binary, n long")
    known = counts.rare.select(F.col("word").alias("rare_word"), F.col("n").alias("c"))
    rest = (rare.join(known, rare["word"] == known["rare_word"], "left")
            .withColumn("log_c", F.log10(c + 1.0))
            .groupBy("row").agg(
                F.sum(F.when(c > 0, times).otherwise(0)).alias("more_known"),
                F.sum(times * (F.col("log_c") - F.lit(math.log10(counts.total + counts.distinct + 1)))).alias("more_base"),
                F.sum(times * (F.col("log_c") - F.log10(F.get(room, class_of(F.col("word")).cast("int"))))).alias("more_inside"))
            .withColumnRenamed("row", "rare_row"))
    zero = F.lit(0.0)
    return (scored.join(rest, scored["row"] == rest["rare_row"], "left")
            .select(F.col("id").alias(id_col), "train", F.col("tokens").alias("n_tokens"),
                    (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
                    F.lit(counts.total).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"),
                    (F.col("states") + F.col("inside") + F.coalesce("more_inside", zero)).alias("score")))
