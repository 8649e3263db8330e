"""Near-duplicates by min-max hashing.

A document's set is its distinct shingles of five words (ASCII blanks between
words, A-Z lower-cased); with fewer words the whole sequence is one shingle.
Two documents are linked if ``100 |A & B| >= least |A | B|``.

Signatures.  Each of ``HASHES`` hash functions is evaluated once per shingle
and gives two values, its minimum and its maximum over the set; a value agrees
between two sets with the probability of their similarity J.  Bands of ``rows``
values make the candidates: a pair with ``J = least / 100`` shares no band with
probability ``(1 - J**rows) ** bands``, and ``rows`` is the largest number that
keeps it below ``MISSED`` (30 bands of 6 for 85, 36 bands of 5 for 80).

Scale.  Documents with equal sets (a 128-bit digest) are one node, so copies
never meet each other.  In a bucket (one key of one band) no pairs are emitted:
first every node is tested against the one bucket minimum it shares most bands
with, and components are formed.  Nodes of buckets that still hold more than one
component pass a lossless prefix filter: they are candidates only if they share
one of their rarest shingles, are of like size and in different components.  So
pages that share a template are no candidates, however many they are.  Only a rare
shingle that more than ``BLOCK`` unsure nodes share is handled in blocks, every two
blocks in one task, which returns just the links that join components.  No
candidate is dropped: it is tested, or both nodes are in one component already.
All tests are exact, on the full sets of both texts.

Texts of candidate nodes are read again by their digest, behind a bitmap of
fixed size (``FILTER_BITS``) that keeps most other texts from being shuffled.

Defined results: null texts and texts without words have an empty set, are
linked with nothing and kept; the smallest id of a component is its
``component_id`` and its row is kept; null ids come after all others, equal
ids and null ids are ordered by a hash of the text; ``near_groups`` marks every
row with the component's id as kept, ``near_dedup`` keeps one row; an empty
table gives an empty result; other columns pass through untouched.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestar.llm.bpe import text_slices
from lodestar.llm.common import cut, fresh, ship
from lodestar.llm.graph import components

WIDTH = 5
LEAST = 85               # per cent of the union that must be shared, unless given
HASHES = 90
MISSED = 1e-6            # probability that a pair at the limit is no candidate
FILTER_BITS = 1 << 23
BLOCK = 256
SLOTS = 1 << 17          # counters of the order of shingles
_RNG = np.random.default_rng(5)
_XOR = _RNG.integers(0, 1 << 64, HASHES, dtype=np.uint64)
_MUL = _RNG.integers(0, 1 << 64, HASHES, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def band_rows(least: int) -> int:
    """Values per band: the most that find a pair at the limit."""
    rows = [n for n in range(1, 2 * HASHES + 1) if (1 - (least / 100) ** n) ** (2 * HASHES // n) < MISSED]
    if not rows or least > 100:
        raise ValueError(f"{HASHES} hash functions cannot find pairs that share {least} per cent")
    return max(rows)


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(docs: list[list[bytes]]) -> list[np.ndarray]:
    """Distinct 64-bit shingle hashes of each word list, sorted."""
    hashes: dict[bytes, int] = {}
    for d in docs:
        for w in d:
            if w not in hashes:
                hashes[w] = xxhash.xxh3_64_intdigest(w)
    out = []
    for d in docs:
        h = np.fromiter(map(hashes.__getitem__, d), np.uint64, len(d))
        n = max(len(h) - WIDTH + 1, min(len(h), 1))
        s = np.full(n, min(len(h), WIDTH), np.uint64)
        for k in range(min(WIDTH, len(h))):
            s = s * _STEP + h[k:k + n]
        out.append(np.unique(mixed(s)))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minimum and maximum of each hash function over each (non-empty) set."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), 2 * HASHES), np.uint64)
    for k in range(HASHES):
        v = ((flat ^ _XOR[k]) * _MUL[k]) >> np.uint64(20)
        out[:, 2 * k] = np.minimum.reduceat(v, starts)
        out[:, 2 * k + 1] = np.maximum.reduceat(v, starts)
    return out


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` values, the band's number mixed in."""
    bands = sig.shape[1] // rows
    parts = sig[:, :bands * rows].reshape(len(sig), bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(sig), bands)).copy()
    for r in range(rows):
        key = mixed(key * _STEP + parts[:, :, r])
    return key.view(np.int64)


def text_key(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def describe(rows: int):
    """(id, row_hash, text) -> (id, row_hash, n, node, text_key, bands)."""
    def run(batches):
        for batch in batches:
            for at, texts in text_slices(batch):
                words = [words_of(t) for t in texts]
                sets = shingle_sets(words)
                full = [k for k, s in enumerate(sets) if len(s)]
                node, key, bands = [None] * len(sets), [None] * len(sets), [None] * len(sets)
                for a in range(0, len(full), 64):
                    part = full[a:a + 64]
                    for k, b in zip(part, band_keys(signatures([sets[k] for k in part]), rows)):
                        node[k] = hashlib.blake2b(sets[k].tobytes(), digest_size=16).digest()
                        key[k] = text_key(words[k])
                        bands[k] = b
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), batch.column(1).slice(at, len(texts)),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array(node, pa.binary()), pa.array(key, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64()))], ["id", "row_hash", "n", "node", "text_key", "bands"])
    return run


def bit_of(key: bytes) -> int:
    return int.from_bytes(key[:8], "little") % FILTER_BITS


def bitmap(keys: DataFrame) -> np.ndarray:
    """Bitmap of the binary column ``text_key``: FILTER_BITS bits, whatever the
    number of keys; bits are joined by Spark, 63 to a row."""
    def run(batches):
        for batch in batches:
            b = np.array([bit_of(x) for x in batch.column(0).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(b // 63), pa.array(np.int64(1) << (b % 63))], ["word", "bits"])

    rows = (keys.select("text_key").mapInArrow(run, "word long, bits long")
            .groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas())  # FILTER_BITS / 63 rows at most
    out = np.zeros(FILTER_BITS // 63 + 1, np.int64)
    out[rows["word"].to_numpy(np.int64)] = rows["bits"]
    return out


def wanted_texts(shared):
    """text -> (text_key, packed words) where the bitmap has its key; once per task."""
    def run(batches):
        bits, z, seen = shared.value, zstandard.ZstdCompressor(level=1), set()
        for batch in batches:
            for _, texts in text_slices(batch):
                keys, packed = [], []
                for t in texts:
                    words = words_of(t)
                    if words:
                        k = text_key(words)
                        b = bit_of(k)
                        if bits[b // 63] >> (b % 63) & 1 and k not in seen:
                            seen.add(k)
                            keys.append(k)
                            packed.append(z.compress(b" ".join(words)))
                if len(seen) > 1_000_000:
                    seen.clear()
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(packed, pa.binary())],
                                                 ["text_key", "words"])
    return run


def similar(x: np.ndarray, y: np.ndarray, least: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= least * (len(x) + len(y) - both)


class Sets:
    """Full sets of packed texts, the last few kept."""

    def __init__(self, keep: int = 1024):
        self.zstd, self.held, self.keep = zstandard.ZstdDecompressor(), OrderedDict(), keep

    def of(self, node: bytes, packed: bytes) -> np.ndarray:
        if node not in self.held:
            self.held[node] = shingle_sets([self.zstd.decompress(packed).split(b" ")])[0]
            if len(self.held) > self.keep:
                self.held.popitem(last=False)
        self.held.move_to_end(node)
        return self.held[node]


def linked(least: int):
    """(a, b, words_a, words_b) -> (a, b) of the pairs whose full sets agree."""
    def run(batches):
        sets = Sets()
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns))
            ok = [(a, b) for a, b, wa, wb in rows if similar(sets.of(a, wa), sets.of(b, wb), least)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in ok], pa.binary()), pa.array([b for _, b in ok], pa.binary())], ["a", "b"])
    return run


def shared_sizes(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of 0/1 matrices over the
    shingles that occur more than once, some columns at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    flat = np.concatenate(sets)
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    often = times[column] > 1
    column, owner = column[often], owner[often]
    column = np.unique(column, return_inverse=True)[1] if len(column) else column
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, 2048):
        i, j = np.searchsorted(column, (a, a + 2048))
        m = np.zeros((len(sets), 2048), np.float32)
        m[owner[i:j], column[i:j] - a] = 1
        out += m @ m.T
    return out.astype(np.int64)


def links_of_block(nodes: list[bytes], roots: list[bytes], sets: list[np.ndarray],
                   least: int) -> list[tuple[bytes, bytes]]:
    """Links between components: as many as it takes to join what is linked."""
    size = np.array([len(x) for x in sets])
    both = shared_sizes(sets)
    ok = 100 * both >= least * (size[:, None] + size[None, :] - both)
    parent = {r: r for r in roots}

    def find(r):
        while parent[r] != r:
            parent[r] = parent[parent[r]]
            r = parent[r]
        return r

    out = []
    for i, j in np.argwhere(np.triu(ok, 1)).tolist():
        x, y = find(roots[i]), find(roots[j])
        if x != y:
            parent[x] = y
            out.append((nodes[i], nodes[j]))
    return out


def block_links(least: int):
    """Rows (key, lo, hi, node, root, words) sorted by the first three, which
    name a block -> links (a, b); at most two blocks' rows are held."""
    def run(batches):
        sets = Sets()
        group, nodes, roots, full = None, [], [], []

        def flush():
            return links_of_block(nodes, roots, full, least) if len(set(roots)) > 1 else []

        for batch in batches:
            out = []
            for key, lo, hi, node, root, words in zip(*(c.to_pylist() for c in batch.columns)):
                if (key, lo, hi) != group:
                    out += flush()
                    group, nodes, roots, full = (key, lo, hi), [], [], []
                nodes.append(node)
                roots.append(root)
                full.append(sets.of(node, words))
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.binary()), pa.array([b for _, b in out], pa.binary())],
                                             ["a", "b"])
        out = flush()
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.binary()), pa.array([b for _, b in out], pa.binary())],
                                         ["a", "b"])
    return run


def confirm(pairs: DataFrame, texts: DataFrame, least: int) -> DataFrame:
    """Checkpointed links among distinct (a, b) pairs of nodes."""
    left = texts.select(F.col("node").alias("a"), F.col("words").alias("words_a"))
    right = texts.select(F.col("node").alias("b"), F.col("words").alias("words_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "words_a", "words_b")
    return cut(both.mapInArrow(linked(least), "a binary, b binary"))


def find_components(nodes: DataFrame, docs_text: DataFrame, least: int) -> DataFrame:
    """(node, root) for linked nodes; ``nodes`` has node, n, text_key, bands."""
    spark = nodes.sparkSession
    buckets = nodes.select(F.explode("bands").alias("key"), "node", "n")
    # Nodes are digests, so their order is a random one.
    heads = (buckets.groupBy("key").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("size"))
             .where("size > 1").select("key", "head"))
    members = cut(buckets.join(heads, "key"))  # nodes that share a bucket, with its minimum
    wanted = cut(members.select("node").distinct().join(nodes.select("node", "text_key"), "node"))
    shared = spark.sparkContext.broadcast(bitmap(wanted))
    found = docs_text.mapInArrow(wanted_texts(shared), "text_key binary, words binary")
    texts = cut(wanted.join(found.groupBy("text_key").agg(F.first("words").alias("words")), "text_key")
                .select("node", "words"))

    # Every node against the bucket minimum that it shares most bands with.
    best = (members.where("node <> head").groupBy("node", "head").count()
            .groupBy("node").agg(F.max(F.struct("count", "head")).getField("head").alias("head")))
    links = confirm(best.select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct(), texts, least)
    roots = components(links)

    # Nodes of buckets that still hold more than one component.
    r = roots.select(F.col("node").alias("linked"), "root")
    left = (members.join(r, members["node"] == r["linked"], "left")
            .select("key", "node", F.coalesce("root", "node").alias("root")))
    still = left.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("key")
    unsure = cut(left.join(still, "key").select("node", "root").distinct())
    known = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    if not unsure.take(1):
        return roots
    pairs, large = prefix_pairs(unsure.join(texts, "node"), least)
    more = confirm(pairs, texts, least)
    if large.take(1):
        more = more.union(large_groups(large, texts, least))
    return components(known.union(more))


def slot_of(shingles: np.ndarray) -> np.ndarray:
    return (shingles % np.uint64(SLOTS)).astype(np.int64)


def prefix_pairs(unsure: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Candidate links among (node, root, words) of different roots, and the
    rows (key, node, root) of groups that are too large for pairs.

    The shingles of all nodes are put in one order, rare ones first (by the
    counts of ``SLOTS`` hash slots).  Sets that share ``least`` per cent share a
    shingle among the first ``n - ceil(least * n / 100) + 1`` of each, so nodes
    that meet on none of these are no candidates.  A shingle alone in its slot
    meets nothing and is left out."""
    spark = unsure.sparkSession

    def count(batches):
        sets, n = Sets(1), np.zeros(SLOTS, np.int64)
        for batch in batches:
            for node, words in zip(*(c.to_pylist() for c in batch.columns)):
                np.add.at(n, slot_of(sets.of(node, words)), 1)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n[used])], ["slot", "n"])

    found = (unsure.select("node", "words").mapInArrow(count, "slot long, n long")
             .groupBy("slot").agg(F.sum("n").alias("n")).toPandas())  # SLOTS rows at most
    n = np.zeros(SLOTS, np.int64)
    n[found["slot"].to_numpy(np.int64)] = found["n"]
    shared = spark.sparkContext.broadcast(n)

    def prefixes(batches):
        sets = Sets(1)
        for batch in batches:
            key, at, size = [], [], []
            for k, (node, words) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 2)))):
                s = sets.of(node, words)
                times = shared.value[slot_of(s)]
                first = np.lexsort((s, times))[:len(s) - (least * len(s) + 99) // 100 + 1]
                first = first[times[first] > 1]
                key.append(s[first].view(np.int64))
                at += [k] * len(first)
                size += [len(s)] * len(first)
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(key) if key else [], pa.int64()), batch.column(0).take(rows), batch.column(1).take(rows),
                 pa.array(size, pa.int64())], ["key", "node", "root", "n"])

    rows = cut(unsure.select("node", "root", "words").mapInArrow(prefixes, "key long, node binary, root binary, n long"))
    groups = cut(rows.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count(F.lit(1)).alias("size"))
                 .where("r0 <> r1").select("key", "size"))
    small = rows.join(groups.where(F.col("size") <= BLOCK).select("key"), "key")
    other = small.select("key", F.col("node").alias("b"), F.col("root").alias("root_b"), F.col("n").alias("n_b"))
    near_size = F.lit(100) * F.least("n", "n_b") >= F.lit(least) * F.greatest("n", "n_b")
    pairs = (small.join(other, "key").where((F.col("root") < F.col("root_b")) & near_size)
             .select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct())
    large = rows.join(groups.where(F.col("size") > BLOCK), "key").select("key", "node", "root", "size")
    return pairs, large


def large_groups(rows: DataFrame, texts: DataFrame, least: int) -> DataFrame:
    """Links within groups of any size: every two blocks of a group meet in one task."""
    other = F.col("other")
    placed = (rows.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
              .select("key", F.least("mine", other).alias("lo"), F.greatest("mine", other).alias("hi"), "node", "root"))
    group = ["key", "lo", "hi"]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(placed.join(texts, "node").select(*group, "node", "root", "words").repartition(n, *group)
               .sortWithinPartitions(*group).mapInArrow(block_links(least), "a binary, b binary"))


def near_rows(docs: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    """(id, row_hash, n, w): w is the smallest (no_id, id, row_hash) of the component."""
    ship(docs)
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("row_hash"), text.alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    rows = cut(rows.mapInArrow(
        describe(band_rows(least)), f"id {kind}, row_hash long, n long, node binary, text_key binary, bands array<long>"))
    me = F.struct(F.col("id").isNull().alias("no_id"), "id", "row_hash")
    nodes = cut(rows.where("n > 0").groupBy("node").agg(
        F.min(me).alias("w"), F.first("n").alias("n"), F.min("text_key").alias("text_key"), F.first("bands").alias("bands")))
    roots = find_components(nodes, docs.select(text.alias("text")), least)
    nodes = nodes.select("node", "w")
    named = nodes.join(roots.withColumnRenamed("node", "linked"), nodes["node"] == F.col("linked"), "left").select(
        "node", "w", F.coalesce("root", "node").alias("root"))
    firsts = named.groupBy("root").agg(F.min("w").alias("first"))
    named = cut(named.join(firsts, "root").select(F.col("node").alias("of"), "first"))
    return (rows.select("id", "row_hash", "n", "node")
            .join(named, F.col("node") == F.col("of"), "left")
            .select("id", "row_hash", "n", F.coalesce("first", me).alias("w")))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept."""
    r = near_rows(docs, id_col, text_col, least)
    kept = F.col("id").eqNullSafe(F.col("w.id"))
    return r.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("w.id").alias("component_id"),
                    kept.alias("kept"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """The rows of ``docs`` that stay, one per component, with the columns of ``docs``."""
    r = near_rows(docs, id_col, text_col, least)
    stay = r.where(F.col("id").eqNullSafe(F.col("w.id")) & (F.col("row_hash") == F.col("w.row_hash")))
    h, n, stay_id, stay_hash = fresh(docs, "row_hash", "nth", "stay_id", "stay_hash")
    wide = docs.withColumn(h, F.xxhash64(F.col(text_col)))
    stay = stay.select(F.col("id").alias(stay_id), F.col("row_hash").alias(stay_hash)).distinct()
    same = F.col(id_col).eqNullSafe(F.col(stay_id)) & (F.col(h) == F.col(stay_hash))
    nth = F.row_number().over(Window.partitionBy(id_col, h).orderBy(F.lit(0)))
    return wide.join(stay, same, "left_semi").withColumn(n, nth).where(F.col(n) == 1).select(*docs.columns)
