r"""Spelling variants by dense prefix-suffix tiling.

Two words are near if they differ by exactly one inserted, deleted or replaced
character.  Words become rows of two padded code-point matrices, one aligned at
the start and one at the end.  A tile compares all rows of one block with all
rows of another, column by column: the common prefix of every pair comes from
the first matrix, the common suffix from the second, and distinct words are
near if prefix + suffix >= length of the longer - 1.

Blocks.  A single edit lies in one window of the shorter word, and all that is
outside the window agrees.  So for each length, words are dealt out by what they
have outside each of ``WINDOWS`` windows, a word both by its own length and, as
the longer one, by the length less one.  A pair can meet in several windows and
counts in the one that holds its edit (the end of the common prefix).  Blocks of
more than ``BLOCK`` words get their window halved, down to one character;
then its words differ in that place only, so that the alphabet bounds the block,
and its rows are compared ``BLOCK`` at a time.  Small blocks of a kind are
stacked and compared together.  No pairs are emitted: a tile returns, for each
word, the number of near words and the best of them.

Counting.  Words are counted inside tasks before the shuffle.  ``typo`` deletes
one character of one in ``every`` occurrences, chosen by a checksum of document
and word, to have variants to find.

Defined results: null texts and empty tables have no words; words of any
length are whole; ties of the largest count go to the smallest word in
code-point order; null ids count as id 'null' for the checksum; repeated rows
count as often as they occur; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.bpe import text_slices
from lodestar.llm.common import cut, ship

RUN = "[A-Za-zÀ-ÿ]+"
EVERY = 199
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
WINDOWS = 3
BLOCK = 512
HELD_WORDS = 300_000     # distinct words that a task counts before it hands them on
TILE = 1 << 22           # pairs compared at a time


def typo(doc, word: str, every: int) -> str:
    """``word``, with one character deleted if the checksum of both says so."""
    h = zlib.crc32(f"{'null' if doc is None else doc}:{word}".encode())
    return word if h % every else word[:h % len(word)] + word[h % len(word) + 1:]


def count_words(pattern: str, every: int | None, min_length: int):
    """(id, text) -> (word, n), each word at most once per ``HELD_WORDS``."""
    def run(batches):
        runs, n = re.compile(pattern), Counter()

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())],
                                               ["word", "n"])
            n.clear()
            return batch

        for batch in batches:
            ids = batch.column(0)
            for at, texts in text_slices(batch.select(["text"])):
                for doc, text in zip(ids.slice(at, len(texts)).to_pylist(), texts):
                    found = runs.findall(text.encode().lower().decode())  # lower-cases A-Z only
                    if every is None:
                        n.update(w for w in found if len(w) >= min_length)
                        continue
                    head = zlib.crc32(f"{'null' if doc is None else doc}:".encode())
                    for w, k in Counter(found).items():
                        if len(w) >= min_length:
                            h = zlib.crc32(w.encode(), head)
                            if h % every == 0:
                                w = w[:h % len(w)] + w[h % len(w) + 1:]
                                if len(w) < min_length:
                                    continue
                            n[w] += k
                    if len(n) > HELD_WORDS:
                        yield flush()
                if len(n) > HELD_WORDS:
                    yield flush()
        yield flush()
    return run


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pattern: str = RUN,
               every: int | None = EVERY, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    ship(docs)
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(count_words(pattern, every, min_length), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def block_key(word: str, length: int, start: int, end: int) -> int:
    """Digest of what a word has outside the window [start, end) of a word of ``length``."""
    rest = f"{length}:{start}:{end}:{word[:start]}\0{word[len(word) - length + end:]}"
    return xxhash.xxh3_64_intdigest(rest.encode()) - (1 << 63)


def deal(windows: int):
    """(word, n) -> (key, length, start, end, word, n), a row per window and role."""
    def run(batches):
        for batch in batches:
            out = []
            for word, n in zip(*(c.to_pylist() for c in batch.columns)):
                for length in (len(word), len(word) - 1):
                    k = min(windows, length)
                    edges = [length * j // k for j in range(k + 1)] if length else [0, 0]
                    out += [(block_key(word, length, a, b), length, a, b, word, n) for a, b in zip(edges, edges[1:])]
            yield dealt_rows(out)
    return run


def halve(batches):
    """Rows of a block that is too large, dealt out by both halves of its window."""
    for batch in batches:
        out = []
        for _, length, a, b, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            m = (a + b) // 2
            out += [(block_key(word, length, x, y), length, x, y, word, n) for x, y in ((a, m), (m, b))]
        yield dealt_rows(out)


DEALT = "key long, length int, start int, end int, word string, n long"
_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64()]


def dealt_rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[]] * len(_TYPES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES)],
                                      ["key", "length", "start", "end", "word", "n"])


def matrices(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Padded code points aligned at the start, the same at the end, and lengths."""
    size = np.array([len(w) for w in words], np.int64)
    width = int(size.max())
    codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    left = np.zeros((len(words), width), np.uint32)
    right = np.zeros_like(left)
    row = np.repeat(np.arange(len(words)), size)
    col = np.arange(len(codes)) - np.repeat(np.cumsum(size) - size, size)
    left[row, col] = codes
    right[row, col + (width - size)[row]] = codes
    kind = np.uint8 if not len(codes) or codes.max() < 256 else np.uint32
    return left.astype(kind), right.astype(kind), size


def tile(x, y, length, start, end):
    """Which rows of the blocks ``x`` and ``y`` are near, with their edit in the
    window; both hold (left, right, size), with a first axis over stacked blocks."""
    sizes = np.minimum(x[2][:, :, None], y[2][:, None, :])
    both = []
    for k, columns in ((0, range(x[0].shape[2])), (1, range(x[0].shape[2] - 1, -1, -1))):
        alive = np.ones(sizes.shape, bool)
        run = np.zeros(sizes.shape, np.int32)
        for c in columns:
            alive &= x[k][:, :, None, c] == y[k][:, None, :, c]
            run += alive
        both.append(np.minimum(run, sizes))
    prefix, suffix = both
    longer = np.maximum(x[2][:, :, None], y[2][:, None, :])
    at = np.minimum(prefix, length[:, None, None] - 1)
    return ((sizes == length[:, None, None]) & (longer - sizes <= 1) & (prefix + suffix >= longer - 1)
            & ((longer > sizes) | (prefix < sizes)) & (at >= start[:, None, None]) & (at < end[:, None, None]))


class Best:
    """Near words counted and the best of them, per row of a table of words."""

    def __init__(self, words: list[str], n: np.ndarray):
        order = sorted(range(len(words)), key=lambda k: (-n[k], words[k]))
        self.rank = np.empty(len(words), np.int64)      # 0 is the best
        self.rank[order] = np.arange(len(words))
        self.order = np.array(order, np.int64)
        self.count = np.zeros(len(words), np.int64)
        self.first = np.full(len(words), len(words), np.int64)

    def add(self, rows: np.ndarray, near: np.ndarray) -> None:
        """``rows`` are near words of each other, pair by pair."""
        np.add.at(self.count, rows, 1)
        np.minimum.at(self.first, rows, self.rank[near])


def compare(words: list[str], n: np.ndarray, blocks: np.ndarray, length, start, end):
    """(row, number of near words, best near row) of all rows that have any.
    Rows of a block stand together; ``blocks`` has where each begins, and the
    last entry is the number of rows; the other arrays have an entry per block."""
    best = Best(words, n)
    width = np.diff(blocks)
    for s in sorted({1 << int(k - 1).bit_length() for k in width[(width > 1) & (width <= BLOCK)].tolist()}):
        some = np.flatnonzero((width > s // 2) & (width <= s) & (width > 1))
        # Blocks of words of like lengths together, so that tiles are no wider than needed.
        some = some[np.argsort(length[some], kind="stable")]
        at = 0
        while at < len(some):
            wide = int(length[some[min(at + TILE // (s * s), len(some) - 1)]]) + 1
            part = some[at:at + max(1, TILE // (s * max(s, wide)))]
            at += len(part)
            rows = np.minimum(blocks[part][:, None] + np.arange(s), blocks[part + 1][:, None] - 1)
            real = np.arange(s) < width[part][:, None]
            left, right, size = (m.reshape(*rows.shape, *m.shape[1:]) for m in matrices([words[k] for k in rows.ravel().tolist()]))
            block = left, right, np.where(real, size, -9)
            g, i, j = np.nonzero(tile(block, block, length[part], start[part], end[part]))
            best.add(rows[g, i], rows[g, j])
    for b in np.flatnonzero(width > BLOCK).tolist():
        one = slice(b, b + 1)
        left, right, size = matrices(words[blocks[b]:blocks[b + 1]])
        for i0 in range(0, width[b], BLOCK):
            x = tuple(m[None, i0:i0 + BLOCK] for m in (left, right, size))
            for j0 in range(0, width[b], BLOCK):
                y = tuple(m[None, j0:j0 + BLOCK] for m in (left, right, size))
                _, i, j = np.nonzero(tile(x, y, length[one], start[one], end[one]))
                best.add(i + i0 + blocks[b], j + j0 + blocks[b])
    have = np.flatnonzero(best.count)
    return have, best.count[have], best.order[best.first[have]]


def tiles(batches):
    """Rows sorted by block -> (word, n_near, near_n, near) of its near words there.
    At most ``HELD_WORDS`` rows and one block are held."""
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near_n", pa.int64()), ("near", pa.string())])
    held: list[pa.RecordBatch] = []

    def names(t):
        return np.stack([t.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)], 1)

    def run(t: pa.RecordBatch):
        key = names(t)
        first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(1)))
        blocks = np.append(first, len(key))
        words, n = t.column(4).to_pylist(), t.column(5).to_numpy(zero_copy_only=False)
        have, count, near = compare(words, n, blocks, key[first, 1], key[first, 2], key[first, 3])
        return pa.RecordBatch.from_arrays(
            [pa.array([words[k] for k in have.tolist()], pa.string()), pa.array(count), pa.array(n[near]),
             pa.array([words[k] for k in near.tolist()], pa.string())], schema=schema)

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < HELD_WORDS:
            continue
        t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        key = names(t)
        changes = np.flatnonzero((key[1:] != key[:-1]).any(1))
        if len(changes):                                   # the last block may go on
            end = int(changes[-1]) + 1
            yield run(t.slice(0, end))
            held = [t.slice(end)]
        else:
            held = [t]
    if sum(b.num_rows for b in held):
        yield run(pa.Table.from_batches(held).combine_chunks().to_batches()[0])


def near_words(words: DataFrame) -> DataFrame:
    """(word, n) -> (word, n_near, near_n, near): words that have near words, with
    their number, and the one of largest count (ties: smallest) with its count."""
    ship(words)
    block = ["key", "length", "start", "end"]
    rows = cut(words.mapInArrow(deal(WINDOWS), DEALT))
    done = None
    while True:
        large = (rows.groupBy(*block).agg(F.count(F.lit(1)).alias("size"))
                 .where((F.col("size") > BLOCK) & (F.col("end") - F.col("start") > 1))
                 .select(*[F.col(c).alias("l_" + c) for c in block]))
        large = cut(large)
        if not large.take(1):
            done = done.union(rows) if done else rows
            break
        same = [F.col(c) == F.col("l_" + c) for c in block]
        small = rows.join(large, same, "left_anti")
        done = done.union(small) if done else small
        rows = cut(rows.join(large, same, "left_semi").mapInArrow(halve, DEALT))
    n = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = (done.repartition(n, *block).sortWithinPartitions(*block)
             .mapInArrow(tiles, "word string, n_near long, near_n long, near string"))
    best = F.min(F.struct((-F.col("near_n")).alias("n"), "near"))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", (-F.col("b.n")).alias("near_n"), F.col("b.near").alias("near")))


def follow(forms: DataFrame) -> DataFrame:
    """(word, form) -> (word, root): forms followed to their end, the way
    doubled each round; forms grow in count, so there is an end."""
    hops = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        on = hops.select(F.col("word").alias("w"), F.col("root").alias("next"))
        longer = cut(hops.join(on, F.col("root") == F.col("w"), "left")
                     .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went_on")))
        hops = longer.select("word", "root")
        if not longer.where("went_on").take(1):
            return hops


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = RATIO, **counting) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root."""
    words = cut(vocabulary(docs, id_col, text_col, **counting))
    near = near_words(words).withColumnRenamed("word", "near_of")
    good = F.col("near_n") >= ratio * F.col("n")
    named = cut(words.join(near, F.col("word") == F.col("near_of"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(good, F.col("near")).alias("form"), F.when(good, F.col("near_n")).alias("form_n")))
    roots = follow(named.where("form is not null")).select(F.col("word").alias("from"), "root")
    return (named.join(roots, F.col("word") == F.col("from"), "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
