r"""Cross-tokenizer alignment: divide and conquer at shared cuts.

Both tokenizers split the bytes of one text, so a token of either ends at a byte
offset.  An interval of both token rows is cut where they have a common end:
the ends of the side with fewer tokens are tried from its middle outwards, each
looked up among the other side's ends by bisection; at the first that is common
the interval falls into two, which are treated likewise, and an interval without
one is a leaf: one group.  All open intervals of a slice of texts advance
together, one probe a step; an interval whose one side is a single token has no
inner end and is a leaf at once.

Parts.  Where a part surely begins for A (``bpe.cuts``) and no piece of B holds the
bytes of both sides next to each other, both tokenizers have an end: A's pattern
splits there, and B, which merges neighbours into pieces only, cannot merge across.
So texts are cut there first, each distinct part is encoded and aligned once, and
a text's tokens, groups and links are those of its parts, one after the other.
Parts are held per Python worker, bounded in number and bytes.  Texts with a part
whose tokens do not give its bytes, and other kinds of models, are aligned whole.

Links are the pairs of an A and a B token whose byte ranges overlap; inside a
group they follow from merging the ends.  The count of an id pair is the number
of documents that hold it linked: pairs are made distinct per document, counted
inside tasks, then by Spark.  The ``HELD`` (about) most frequent pairs are
broadcast as sorted arrays, which bounds them; other pairs are rare by
construction, so the join on them has no hot key.

Defined results: texts that are null or empty, or whose joined A or B bytes
differ from blank + text, have no tokens: zeros, and '' as digest; strings of
special tokens inside texts are plain text; texts of any length are whole;
repeated rows are documents of their own; null ids are rows like others; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.bpe import Codec, codec, cuts, distinct_parts, text_slices
from lodestar.llm.common import cut, ship

HELD = 4_000_000         # id pairs that are broadcast at most
COUNTED = 1 << 22        # id pairs that a task holds before it hands on their counts
HELD_PARTS = 300_000     # aligned parts that a Python worker holds at most,
HELD_BYTES = 48 << 20    # and the bytes of theirs that it holds before it starts again
LEAD = "a"               # stands before a part without a blank, as B sets one before any text


class Pieces:
    """The B side: a sentencepiece model; one per Python worker."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for k in range(self.model.get_piece_size()):
            p = self.model.id_to_piece(k)
            one = self.model.is_byte(k)
            self.bytes.append(bytes([int(p[3:5], 16)]) if one else p.replace("▁", " ").encode())
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)

    def apart(self) -> np.ndarray | None:
        """[x, y]: whether texts can be cut between bytes x and y, as no piece holds
        them so; None if the model does more than merge the characters of its text."""
        try:
            from sentencepiece.sentencepiece_model_pb2 import ModelProto
        except ImportError:
            return None
        m = ModelProto.FromString(self.model.serialized_model_proto())
        n, t = m.normalizer_spec, m.trainer_spec
        if (n.precompiled_charsmap or n.remove_extra_whitespaces or not n.add_dummy_prefix or not n.escape_whitespaces
                or t.model_type != t.BPE or t.treat_whitespace_as_suffix or not t.byte_fallback
                or any(p.type == p.USER_DEFINED for p in m.pieces)):
            return None
        out = np.ones((256, 256), bool)
        for b in self.bytes:
            out[list(b[:-1]), list(b[1:])] = False
        after = out[ord(LEAD)].copy()
        after[32] = True
        return out & after

    def encode_parts(self, parts: list[bytes]) -> list[list[int]]:
        """Ids of each part, which begins with a blank or may stand after ``LEAD``."""
        skip = len(self.model.encode(LEAD))
        bare = [p[0] != 32 for p in parts]
        done = self.encode([LEAD + p.decode() if x else p[1:].decode() for x, p in zip(bare, parts)])
        return [ids[skip:] if x else ids for x, ids in zip(bare, done)]


_PIECES: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def shared_cuts(a: np.ndarray, b: np.ndarray, a_from, a_to, b_from, b_to) -> np.ndarray:
    """Indices into ``a`` of all common ends inside the intervals, sorted.

    ``a`` and ``b`` are ascending ends; interval k has the tokens a_from[k] to
    a_to[k] and b_from[k] to b_to[k] (exclusive), and its last ends are common."""
    found = []
    lo, hi, blo, bhi = (np.asarray(x, np.int64) for x in (a_from, a_to, b_from, b_to))
    while len(lo):
        inner = (hi - lo > 1) & (bhi - blo > 1)
        lo, hi, blo, bhi = lo[inner], hi[inner], blo[inner], bhi[inner]
        if not len(lo):
            break
        # Probe the inner ends of the shorter side, from the middle outwards.
        swap = bhi - blo < hi - lo
        first, size = np.where(swap, blo, lo), np.where(swap, bhi - blo, hi - lo) - 1
        middle = first + size // 2
        cut_a, cut_b = np.full(len(lo), -1), np.full(len(lo), -1)
        still, k = np.arange(len(lo)), 0
        while len(still):
            probe = middle[still] + ((k + 1) // 2 if k % 2 else -(k // 2))
            inside = (probe >= first[still]) & (probe < first[still] + size[still])
            there, at = still[inside], probe[inside]
            s = swap[there]
            other, same = np.empty(len(there), np.int64), np.empty(len(there), bool)
            for mine, side, across in ((~s, a, b), (s, b, a)):
                end = side[at[mine]]
                other[mine] = np.searchsorted(across, end)
                same[mine] = across[np.minimum(other[mine], len(across) - 1)] == end
            hit = there[same]
            cut_a[hit] = np.where(s, other, at)[same]
            cut_b[hit] = np.where(s, at, other)[same]
            k += 1
            still = still[(cut_a[still] < 0) & (k < 2 * size[still] + 1)]
        some = cut_a >= 0
        lo, hi, blo, bhi, cut_a, cut_b = (x[some] for x in (lo, hi, blo, bhi, cut_a, cut_b))
        found.append(cut_a)
        lo, hi = np.concatenate([lo, cut_a + 1]), np.concatenate([cut_a + 1, hi])
        blo, bhi = np.concatenate([blo, cut_b + 1]), np.concatenate([cut_b + 1, bhi])
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)


class Aligned:
    """Tokens, groups and links of a slice of texts.

    Per text: ``a_to`` and ``b_to`` (tokens up to its end), ``groups_to``,
    ``links_to``.  Flat: ids ``a`` and ``b``; ``group_a`` and ``group_b``, the
    tokens up to each group's end; ``link_a`` and ``link_b``, indices of tokens."""

    def __init__(self, texts: list[str], a_path: str, b_path: str):
        left, right = codec(a_path, plain=True), pieces(b_path)
        docs = [b" " + t.encode() if t else b"" for t in texts]
        flat, ends = left.encode_flat([" " + t if t else "" for t in texts])
        self._align(docs, flat, ends, right.encode(texts), left, right)

    @classmethod
    def of_parts(cls, parts: list[bytes], flat: np.ndarray, ends: np.ndarray, left: Codec, right: Pieces) -> Aligned:
        """Parts in place of texts, of which the A ids are known."""
        out = cls.__new__(cls)
        out._align(parts, flat, ends, right.encode_parts(parts), left, right)
        return out

    def _align(self, docs: list[bytes], flat: np.ndarray, ends: np.ndarray, b_ids: list[list[int]], left: Codec,
               right: Pieces) -> None:
        self.a, self.b = flat.astype(np.int64), np.fromiter(chain.from_iterable(b_ids), np.int64)
        self.a_to, self.b_to = ends, np.cumsum([len(b) for b in b_ids], dtype=np.int64)
        sizes = np.array([len(d) for d in docs], np.int64)
        want, reach = b"".join(docs), np.append(0, np.cumsum(sizes))
        if not (all(np.array_equal(np.append(0, np.cumsum(size[ids]))[to], reach[1:])
                    for size, ids, to in ((left.token_sizes, self.a, self.a_to), (right.sizes, self.b, self.b_to)))
                and b"".join(map(left.token_bytes.__getitem__, self.a.tolist())) == want
                and b"".join(map(right.bytes.__getitem__, self.b.tolist())) == want):
            pairs = []
            for d, a_from, a_to, b in zip(docs, [0, *ends[:-1].tolist()], ends.tolist(), b_ids):
                a = flat[a_from:a_to]
                good = (d and b"".join(map(left.token_bytes.__getitem__, a.tolist())) == d
                        and b"".join(map(right.bytes.__getitem__, b)) == d)
                pairs.append((a, b) if good else (a[:0], []))
            self.a = np.concatenate([a for a, _ in pairs]).astype(np.int64)
            self.b = np.fromiter(chain.from_iterable(b for _, b in pairs), np.int64)
            self.a_to, self.b_to = np.cumsum([len(a) for a, _ in pairs]), np.cumsum([len(b) for _, b in pairs])
        a_end, b_end = np.cumsum(left.token_sizes[self.a]), np.cumsum(right.sizes[self.b])
        full = np.flatnonzero(np.diff(self.a_to, prepend=0))
        a_from, b_from = np.append(0, self.a_to)[full], np.append(0, self.b_to)[full]
        inner = shared_cuts(a_end, b_end, a_from, self.a_to[full], b_from, self.b_to[full])
        self.group_a = np.sort(np.concatenate([inner, self.a_to[full] - 1])) + 1
        # A link is a stretch between neighbouring ends of either side.
        of_a, of_b = (np.zeros(int(a_end[-1]) + 1 if len(a_end) else 1, bool) for _ in "ab")
        of_a[a_end], of_b[b_end] = True, True
        every = np.flatnonzero(of_a | of_b)
        before_a, before_b = np.cumsum(of_a), np.cumsum(of_b)  # tokens that end at an offset or before it
        self.link_a, self.link_b = before_a[every - 1], before_b[every - 1]
        self.links_to = np.searchsorted(self.link_a, self.a_to)
        self.group_b = before_b[a_end[self.group_a - 1]] if len(a_end) else self.group_a
        self.groups_to = np.searchsorted(self.group_a, self.a_to, "right")

    def lines(self, a_size: int, b_size: int) -> list[bytes]:
        """Groups of each text as ``a1,a2|b1;a3|b2,b3;``."""
        if not len(self.a):
            return [b""] * len(self.a_to)
        # Tokens in the order of writing, each with the sign that follows it.
        a_place = np.arange(len(self.a)) + np.repeat(np.append(0, self.group_b[:-1]), np.diff(self.group_a, prepend=0))
        b_place = np.arange(len(self.b)) + np.repeat(self.group_a, np.diff(self.group_b, prepend=0))
        sign_a, sign_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        sign_a[self.group_a - 1], sign_b[self.group_b - 1] = 1, 2
        size = max(a_size, b_size)
        name = np.empty(len(self.a) + len(self.b), np.int64)
        name[a_place], name[b_place] = sign_a * size + self.a, sign_b * size + self.b
        words = list(map(signed_decimals(size).__getitem__, name.tolist()))
        ends = (self.a_to + self.b_to).tolist()
        return [b"".join(words[i:j]) for i, j in zip([0, *ends], ends)]

    def sums(self) -> np.ndarray:
        """Tokens of A and B, groups and links of each text."""
        return np.stack([np.diff(x, prepend=0) for x in (self.a_to, self.b_to, self.groups_to, self.links_to)], axis=1).astype(np.int64)


@cache
def signed_decimals(size: int) -> list[bytes]:
    """Decimal numbers below ``size``, followed by each of the three signs."""
    return [b"%d" % k + sign for sign in (b",", b"|", b";") for k in range(size)]


class Parts:
    """Aligned parts of texts; one per Python worker, beside the codec of A."""

    def __init__(self, left: Codec, a_path: str, b_path: str):
        self.left, self.right, self.paths = left, pieces(b_path), (a_path, b_path)
        self.apart = self.right.apart() if left.cuts_known and not left.special else None
        self._forget()

    def _forget(self) -> None:
        self.place: dict[bytes, int] = {}              # part -> its row below
        self.lines: list[bytes] = []
        self.sums = np.zeros((1 << 14, 4), np.int64)   # all zeros: the part's tokens do not give its bytes
        self.pairs = np.zeros(1 << 16, np.int64)       # linked id pairs of all rows, one after the other
        self.ends = np.zeros(1 << 14, np.int64)
        self.held = 0                                  # bytes of parts, lines and pairs

    def _sizes(self) -> tuple[int, int]:
        return len(self.left.token_bytes), len(self.right.bytes)

    def _learn(self, new: list[bytes]) -> None:
        new, ids, ends = self.left.coded(new)
        al = Aligned.of_parts(new, ids, ends, self.left, self.right)
        lines, n, last = al.lines(*self._sizes()), len(self.place), int(self.ends[len(self.place) - 1]) if self.place else 0
        while n + len(new) > len(self.ends):
            self.ends, self.sums = (np.concatenate([x, np.zeros_like(x)]) for x in (self.ends, self.sums))
        to = last + len(al.link_a)
        while to > len(self.pairs):
            self.pairs = np.concatenate([self.pairs, np.zeros_like(self.pairs)])
        self.ends[n:n + len(new)] = last + al.links_to
        self.sums[n:n + len(new)] = al.sums()
        self.pairs[last:to] = al.a[al.link_a] * len(self.right.bytes) + al.b[al.link_b]
        self.lines += lines
        self.place.update(zip(new, range(n, n + len(new))))
        self.held += sum(map(len, new)) + sum(map(len, lines)) + 8 * len(al.link_a)

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, list, list]:
        al = Aligned(texts, *self.paths)
        pair = al.a[al.link_a] * len(self.right.bytes) + al.b[al.link_b]
        to = al.links_to.tolist()
        return al.sums(), al.lines(*self._sizes()), [pair[i:j] for i, j in zip([0, *to], to)]

    def align(self, texts: list[str]) -> tuple[np.ndarray, list, list]:
        """Sums, line and linked id pairs of each text."""
        docs = [b" " + t.encode() if t else b"" for t in texts]
        data = np.frombuffer(b"".join(docs), np.uint8)
        if self.apart is None or not len(data):
            return self._whole(texts)
        text_ends = np.cumsum([len(d) for d in docs])
        first = cuts(data)
        first[1:] &= self.apart[data[:-1], data[1:]]
        first[text_ends[text_ends < len(data)]] = True
        first[0] = True
        starts, names, which = distinct_parts(data, first)
        new = [p for p in names if p not in self.place]
        if new and (len(self.place) + len(new) > HELD_PARTS or self.held > HELD_BYTES):
            self._forget()
            new = names
        if new:
            self._learn(new)
        rows = np.fromiter(map(self.place.__getitem__, names), np.int64, len(names))
        row = rows[which]
        sums, at = self.sums[row], np.searchsorted(starts, text_ends)
        total = np.cumsum(sums[:, 3])
        pair = self.pairs[np.repeat(self.ends[row] - total, sums[:, 3]) + np.arange(int(total[-1]))]
        lines = pa.array([self.lines[r] for r in rows.tolist()], pa.large_binary()).take(pa.array(which))
        _, offsets, written = lines.buffers()
        offsets = np.frombuffer(offsets, np.int64, len(lines) + 1, 8 * lines.offset)
        written = memoryview(written) if written else b""
        bad = np.append(0, np.cumsum(sums[:, 0] == 0))[at]
        sums = np.diff(np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(sums, axis=0)])[at], axis=0, prepend=np.zeros((1, 4), np.int64))
        ends, to = np.append(0, offsets[at]).tolist(), np.append(0, np.append(0, total)[at]).tolist()
        lines, pairs = [written[i:j] for i, j in zip(ends, ends[1:])], [pair[i:j] for i, j in zip(to, to[1:])]
        again = np.flatnonzero(np.diff(bad, prepend=0)).tolist()
        if again:
            whole = self._whole([texts[k] for k in again])
            sums[again] = whole[0]
            for k, line, its in zip(again, *whole[1:]):
                lines[k], pairs[k] = line, its
        return sums, lines, pairs


def aligned_parts(a_path: str, b_path: str) -> Parts:
    left = codec(a_path, plain=True)
    if left.aligned is None or left.aligned.paths != (a_path, b_path):
        left.aligned = Parts(left, a_path, b_path)
    return left.aligned


def describe(a_path: str, b_path: str):
    """(id, text) -> id, n_a, n_b, n_groups, n_links, groups_sha256, and the
    distinct linked id pairs with their occurrences, packed."""
    def run(batches):
        z = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for at, texts in text_slices(batch.select(["text"])):
                sums, lines, pairs = aligned_parts(a_path, b_path).align(texts)
                sha = [hashlib.sha256(x[:-1]).hexdigest() if x else "" for x in lines]
                packed = []
                for pair in pairs:
                    code, times = np.unique(pair, return_counts=True)
                    packed.append(z.compress(np.diff(code, prepend=0).astype("<i8").tobytes() + times.astype("<i8").tobytes())
                                  if len(pair) else b"")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), *[pa.array(np.ascontiguousarray(x)) for x in sums.T],
                     pa.array(sha, pa.string()), pa.array(packed, pa.binary())],
                    ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"])
    return run


def unpack(z: zstandard.ZstdDecompressor, packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, ascending, and their occurrences."""
    if not packed:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    both = np.frombuffer(z.decompress(packed), "<i8")
    return np.cumsum(both[:len(both) // 2]), both[len(both) // 2:]


def count_pairs(batches):
    """Packed pairs -> (pair, n): the number of documents that hold it."""
    z, held, size = zstandard.ZstdDecompressor(), [], 0

    def flush():
        if not held:
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, ["pair", "n"])
        pair, n = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
        total = np.bincount(n, np.concatenate([c for _, c in held]), len(pair)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(total)], ["pair", "n"])

    def squeeze(parts):
        pair, n = np.unique(np.concatenate(parts), return_counts=True)
        return pair, n.astype(np.int64)

    parts, waiting = [], 0
    for batch in batches:
        for x in batch.column(0).to_pylist():
            parts.append(unpack(z, x)[0])
            waiting += len(parts[-1])
            if waiting > COUNTED // 4:
                held.append(squeeze(parts))
                size += len(held[-1][0])
                parts, waiting = [], 0
                if size > COUNTED:
                    yield flush()
                    held, size = [], 0
    if parts:
        held.append(squeeze(parts))
    yield flush()


def weigh(table):
    """(id, pairs) -> (id, n_best, count_sum, rest): sums over the pairs that are
    in the broadcast table, and the others."""
    def run(batches):
        z = zstandard.ZstdDecompressor()
        pair, n, best = table.value
        for batch in batches:
            docs = [unpack(z, x) for x in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *(len(p) for p, _ in docs)])
            code, times = (np.concatenate(x) if docs else np.zeros(0, np.int64) for x in zip(*docs)) if docs else [np.zeros(0, np.int64)] * 2
            at = np.minimum(np.searchsorted(pair, code), max(len(pair) - 1, 0))
            held = pair[at] == code if len(pair) else np.zeros(len(code), bool)
            count = np.where(held, n[at], 0) * times if len(pair) else np.zeros(len(code), np.int64)
            top = np.where(held & best[at], times, 0) if len(pair) else np.zeros(len(code), np.int64)
            sums = [np.append(0, np.cumsum(x))[ends] for x in (top, count)]
            out = np.cumsum(np.append(0, ~held))[ends].astype(np.int32)
            rest = pa.StructArray.from_arrays([pa.array(code[~held]), pa.array(times[~held])], ["pair", "times"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(np.diff(x).astype(np.int64)) for x in sums], pa.ListArray.from_arrays(pa.array(out), rest)],
                ["row", "n_best", "count_sum", "rest"])
    return run


def frequent(counts: DataFrame, held: int) -> int:
    """Smallest power of two so that at most ``held`` pairs have that count or more."""
    step = F.floor(F.log2("n")).cast("int")
    sizes = sorted(((r[0], r[1]) for r in counts.groupBy(step.alias("s")).count().collect()), reverse=True)  # 64 rows at most
    total, least = 0, (1 << 63) - 1
    for s, size in sizes:
        total += size
        if total > held:
            break
        least = 1 << s
    return least


def align_report(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
                 held: int = HELD) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = ship(docs).sparkSession
    wide = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = wide.schema["id"].dataType.simpleString()
    rows = wide.mapInArrow(describe(a_path, b_path), f"id {kind}, n_a long, n_b long, n_groups long, n_links long, "
                                                     "groups_sha256 string, pairs binary")
    rows = cut(rows.withColumn("row", F.monotonically_increasing_id()))
    counts = cut(rows.select("pairs").mapInArrow(count_pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")))
    width = len(pieces(b_path).bytes)
    a_id = F.floor(F.col("pair") / width)
    most = counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("most"))  # at most one row per entry of A's vocabulary
    counts = counts.join(F.broadcast(most), a_id == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    counts = cut(counts)
    least = frequent(counts, held)
    top = counts.where(F.col("n") >= least).toPandas().sort_values("pair")  # at most ``held`` rows
    table = spark.sparkContext.broadcast((top["pair"].to_numpy(np.int64), top["n"].to_numpy(np.int64), top["best"].to_numpy(bool)))
    sums = rows.select("row", "pairs").mapInArrow(
        weigh(table), "row long, n_best long, count_sum long, rest array<struct<pair:long,times:long>>")
    if len(top) < counts.count():
        sums = cut(sums)
        rare = counts.where(F.col("n") < least)
        more = (sums.select("row", F.inline("rest")).join(rare, "pair").groupBy("row")
                .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("m_best"),
                     F.sum(F.col("n") * F.col("times")).alias("m_sum")))
        sums = sums.join(more, "row", "left").select(
            "row", (F.col("n_best") + F.coalesce("m_best", F.lit(0))).alias("n_best"),
            (F.col("count_sum") + F.coalesce("m_sum", F.lit(0))).alias("count_sum"))
    out = rows.drop("pairs").join(sums.drop("rest"), "row")
    return out.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
