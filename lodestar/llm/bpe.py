r"""BPE encoding and decoding with content-defined chunk reuse.

Ids are those of the ``tokenizers`` library for a byte-level BPE file, which
splits text by a fixed pattern and encodes each part by itself.  Two facts
about that pattern make reuse exact:

* A *safe cut* lies before a blank that is followed by a character that is
  surely no white space.  Whatever white space stands before it ends a part
  there, and the blank begins one, so both sides are encoded as in the whole.
  The same holds before a line end between two characters that are none.
* Texts that contain a special token's string are encoded whole, as such a
  string ends parts too.

Chunks.  A rolling (gear) hash over 32 bytes marks chunk borders, so a passage
gives the same chunks in every document.  One pass counts chunk digests over
all documents; of the chunks that occur more than once, those that save most
bytes are encoded once, up to ``DICTIONARY`` entries of at most ``MAX_CHUNK``
bytes, which bounds the broadcast.  Documents are then put together from
encoded chunks.  A join of two chunks is repaired by re-encoding from the last
safe cut of the left chunk to the first safe cut of the right one, growing over
whole chunks that have none: at safe cuts the re-encoding and the chunks agree.
All other chunks are encoded in place, piece by piece between safe cuts, with a
bounded cache of pieces per Python worker.  No text is shuffled.

Defined results: null text counts as empty and has no ids; ids of any length
of text are whole; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import ship, sole

SLICE = 1 << 21          # bytes of text handled at a time
WINDOW = 32              # bytes under the rolling hash
BORDER_BITS = 10         # a border every 2**10 bytes on average
MIN_CHUNK = 256
MAX_CHUNK = 4096
DICTIONARY = 8192
CACHED_PIECES = 300_000  # per Python worker
CALL = 256               # texts that the library gets in one call
JOINED = 64              # new pieces that the library encodes at a time

# Pre-tokenizers whose part borders ``cuts`` knows: byte-level BPE with its own
# pattern.  A file with any other is encoded text by text.
_KNOWN = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}

_LETTER = np.zeros(256, bool)   # ASCII letters
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_PRINT = np.zeros(256, bool)    # surely no white space
_PRINT[33:127] = True
_MARK = np.zeros(256, bool)
_MARK[list(b".,!?;:")] = True


def byte_of_char() -> dict[str, int]:
    """The printable character that byte-level BPE writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def cuts(data: np.ndarray) -> np.ndarray:
    """For each byte, whether a part surely begins there: at a blank before a
    character that is no white space, at a line end between two such, and at a
    mark after a letter."""
    latin = np.zeros(len(data) + 2, bool)       # second byte of a letter of U+00C0 to U+00FF
    latin[1:-2] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    before = np.zeros(len(data), bool)
    before[1:] = _LETTER[data[:-1]] | latin[:len(data) - 1]
    solid_before = np.zeros(len(data), bool)
    solid_before[1:] = _PRINT[data[:-1]] | latin[:len(data) - 1]
    solid_after = np.zeros(len(data), bool)
    solid_after[:-1] = _PRINT[data[1:]] | latin[2:len(data) + 1]
    return (data == 32) & solid_after | (data == 10) & solid_before & solid_after | _MARK[data] & before


def distinct_parts(data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Starts of the parts of ``data``, which begin where ``first`` is set; the distinct
    parts; for each part its place among them."""
    starts = np.flatnonzero(first)
    offsets = np.append(starts, len(data)).astype(np.int32)
    parts = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    coded = parts.dictionary_encode()
    return starts, coded.dictionary.to_pylist(), coded.indices.to_numpy()


class Codec:
    """Encoder and decoder of one tokenizer file; one per Python worker.

    ``plain`` takes the strings of special tokens in a text as ordinary text."""

    def __init__(self, path: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_padding()
        self.tok.no_truncation()
        self.tok.encode_special_tokens = plain
        added = self.tok.get_added_tokens_decoder()
        self.special = [] if plain else [t.content for t in added.values()]
        to_byte = byte_of_char()
        self.token_bytes = [b""] * self.tok.get_vocab_size()
        for token, i in self.tok.get_vocab().items():
            self.token_bytes[i] = (token.encode() if i in added else bytes(to_byte[c] for c in token))
        self.token_sizes = np.array([len(b) for b in self.token_bytes], np.int64)
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        rule = config.get("pre_tokenizer") or {}
        self.aligned = None   # what ``alignment`` holds beside this codec, and drops with it
        self.cuts_known = (config.get("normalizer") is None
                           and all(rule.get(k, v if k == "use_regex" else None) == v for k, v in _KNOWN.items()))
        self._forget()

    def _forget(self) -> None:
        self.place: dict[bytes, int] = {}      # part of a text -> its row below
        self.ids = np.zeros(1 << 16, "<u4")    # ids of all rows, one after the other
        self.ends = np.zeros(1 << 14, np.int64)

    def _library(self, texts: list[str]) -> list[list[int]]:
        out = []
        for a in range(0, len(texts), CALL):               # bounds what the library holds
            out += [e.ids for e in self.tok.encode_batch_fast(texts[a:a + CALL], add_special_tokens=False)]
        return out

    def _parts(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts and the number of each.  The library gets many parts
        at a time; the bytes of the ids tell where a part ends."""
        groups = [b"".join(parts[a:a + JOINED]) for a in range(0, len(parts), JOINED)]
        ids = np.fromiter(chain.from_iterable(self._library([g.decode() for g in groups])), "<u4")
        ends = np.searchsorted(np.cumsum(self.token_sizes[ids]), np.cumsum([len(p) for p in parts])) + 1
        return ids, np.diff(ends, prepend=0)

    def coded(self, new: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The parts in another order, their ids, one after the other, and where
        each part's ids end."""
        # After anything, a part begins at a blank before a printable character.
        joins = [p for p in new if p[0] == 32 and len(p) > 1 and _PRINT[p[1]]]
        alone = [p for p in new if not (p[0] == 32 and len(p) > 1 and _PRINT[p[1]])]
        done = self._library([p.decode() for p in alone])
        ids, sizes = self._parts(joins)
        ids = np.concatenate([ids, np.fromiter(chain.from_iterable(done), "<u4")])
        return joins + alone, ids, np.cumsum([*sizes.tolist(), *map(len, done)], dtype=np.int64)

    def _learn(self, new: list[bytes]) -> None:
        new, ids, ends = self.coded(new)
        n, last = len(self.place), int(self.ends[len(self.place) - 1]) if self.place else 0
        ends = last + ends
        while n + len(new) > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        while int(ends[-1]) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ends[n:n + len(new)] = ends
        self.ids[last:int(ends[-1])] = ids
        self.place.update(zip(new, range(n, n + len(new))))

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's ids end."""
        whole = {k: t for k, t in enumerate(texts) if not self.cuts_known or any(s in t for s in self.special)}
        docs = [b"" if k in whole else t.encode() for k, t in enumerate(texts)]
        data = np.frombuffer(b"".join(docs), np.uint8)
        text_ends = np.cumsum([len(d) for d in docs])
        counts = np.zeros(len(texts), np.int64)
        flat = np.zeros(0, "<u4")
        if len(data):
            first = cuts(data)
            first[text_ends[text_ends < len(data)]] = True
            first[0] = True
            starts, names, which = distinct_parts(data, first)
            new = [p for p in names if p not in self.place]
            if len(self.place) + len(new) > CACHED_PIECES:
                self._forget()
                new = names
            if new:
                self._learn(new)
            row = np.fromiter(map(self.place.__getitem__, names), np.int64, len(names))
            row = row[which]
            last = self.ends[row]
            size = last - np.where(row > 0, self.ends[row - 1], 0)
            total = np.cumsum(size)
            flat = self.ids[np.repeat(last - total, size) + np.arange(int(total[-1]))]
            reach = np.append(0, total)[np.searchsorted(starts, text_ends)]
            counts = np.diff(reach, prepend=0)
        if whole:
            ids = dict(zip(whole, self._library(list(whole.values()))))
            at = np.append(0, np.cumsum(counts))
            flat = np.concatenate([np.array(ids[k], "<u4") if k in ids else flat[at[k]:at[k + 1]] for k in range(len(texts))])
            counts = np.array([len(ids[k]) if k in ids else c for k, c in enumerate(counts)], np.int64)
        return flat, np.cumsum(counts)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        flat, ends = self.encode_flat(texts)
        raw = flat.tobytes()
        return [raw[4 * a:4 * b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


_CODECS: dict[tuple[str, bool], Codec] = {}


def codec(path: str, plain: bool = False) -> Codec:
    held = sole(_CODECS)
    if (path, plain) not in held:
        held[path, plain] = Codec(path, plain)
    return held[path, plain]


def text_slices(batch: pa.RecordBatch, name: str = "text", size: int = SLICE):
    """(offset, texts) slices of a batch, each of about ``size`` bytes; null is empty."""
    col = batch.column(batch.schema.get_field_index(name))
    lengths = pc.binary_length(col).fill_null(0).to_numpy(zero_copy_only=False)
    group = np.cumsum(lengths) // size
    starts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(col)] if len(col) else [0]
    for a, b in zip(starts, starts[1:]):
        yield a, [t or "" for t in col.slice(a, b - a).to_pylist()]


_GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)


def chunk_borders(docs: list[bytes]) -> list[list[int]]:
    """Chunk borders of each document, 0 and its length included."""
    data = np.frombuffer(b"".join(docs), np.uint8)
    h = _GEAR[data]
    for k in (1, 2, 4, 8, 16):  # sums over 2, 4, ... 32 bytes, the newest byte with the least weight
        h[k:] += h[:-k] << np.uint32(k)
    marks = np.flatnonzero(h >> np.uint32(32 - BORDER_BITS) == 0) + 1
    marks = marks[marks < len(data)]
    marks = marks[data[marks] & 0xC0 != 0x80] if len(marks) else marks  # not inside a character
    out, at = [], 0
    for d in docs:
        a, b = np.searchsorted(marks, (at + WINDOW, at + len(d)))
        borders = [0]
        for m in (marks[a:b] - at).tolist():
            if m - borders[-1] >= MIN_CHUNK:
                borders.append(m)
        borders.append(len(d))
        out.append(borders)
        at += len(d)
    return out


def digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


_SAFE = re.compile(rb" (?=[!-~])")


def inner(chunk: bytes) -> tuple[int, int] | None:
    """First and last safe cut in a chunk, if there are two."""
    first = _SAFE.search(chunk)
    if not first:
        return None
    last = len(chunk)
    while (last := chunk.rfind(b" ", 0, last)) > first.start():
        if _SAFE.match(chunk, last):
            return first.start(), last
    return None


def count_chunks(special: list[str]):
    """Per slice of texts: (digest, length, n) of its chunks."""
    def run(batches):
        for batch in batches:
            for _, texts in text_slices(batch):
                docs = [t.encode() for t in texts if not any(s in t for s in special)]
                n: dict[tuple, int] = {}
                for d, borders in zip(docs, chunk_borders(docs)):
                    for a, b in zip(borders, borders[1:]):
                        if MIN_CHUNK <= b - a <= MAX_CHUNK:
                            key = digest(d[a:b]), b - a
                            n[key] = n.get(key, 0) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in n], pa.binary()), pa.array([k[1] for k in n], pa.int32()),
                     pa.array(list(n.values()), pa.int64())], ["digest", "length", "n"])
    return run


def find_chunks(wanted, special: list[str]):
    """(digest, chunk) of the wanted chunks, each once per task."""
    def run(batches):
        left = set(wanted.value)
        for batch in batches:
            for _, texts in text_slices(batch):
                docs = [t.encode() for t in texts if not any(s in t for s in special)]
                found = {}
                for d, borders in zip(docs, chunk_borders(docs) if left else []):
                    for a, b in zip(borders, borders[1:]):
                        if MIN_CHUNK <= b - a <= MAX_CHUNK and (key := digest(d[a:b])) in left:
                            found[key] = d[a:b]
                left -= found.keys()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())], ["digest", "chunk"])
    return run


def encode_chunks(path: str):
    """(digest, chunk) -> (digest, first, last, ids): the part between its outer safe cuts."""
    def run(batches):
        c = codec(path)
        for batch in batches:
            rows = [(k, x, inner(x)) for k, x in zip(*(col.to_pylist() for col in batch.columns))]
            rows = [r for r in rows if r[2]]
            ids = c.encode([x[a:b].decode() for _, x, (a, b) in rows])
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[2][0] for r in rows], pa.int32()),
                 pa.array([r[2][1] for r in rows], pa.int32()), pa.array(ids, pa.binary())],
                ["digest", "first", "last", "ids"])
    return run


def shared_chunks(texts: DataFrame, path: str, dictionary: int = DICTIONARY) -> dict:
    """digest -> (first, last, ids) of at most ``dictionary`` shared chunks."""
    special = codec(path).special
    saved = (F.col("n") - 1) * F.col("length")
    best = (texts.mapInArrow(count_chunks(special), "digest binary, length int, n long")
            .groupBy("digest").agg(F.sum("n").alias("n"), F.first("length").alias("length"))
            .where("n > 1").orderBy(saved.desc(), "digest").limit(dictionary).select("digest"))
    wanted = [bytes(r[0]) for r in best.collect()]  # bounded by the limit
    if not wanted:
        return {}
    share = texts.sparkSession.sparkContext.broadcast(frozenset(wanted))
    rows = (texts.mapInArrow(find_chunks(share, special), "digest binary, chunk binary")
            .dropDuplicates(["digest"])
            .mapInArrow(encode_chunks(path), "digest binary, first int, last int, ids binary").collect())
    return {bytes(r[0]): (r[1], r[2], bytes(r[3])) for r in rows}


def assemble(c: Codec, texts: list[str], shared: dict) -> list[bytes]:
    """Ids of each text, from shared chunks and re-encoded joins."""
    plans: list[list] = []   # per text: ids (bytes) and indices into ``todo``
    todo: list[str] = []
    docs = [t.encode() for t in texts]
    for t, d, borders in zip(texts, docs, chunk_borders(docs) if shared else [None] * len(docs)):
        plan, open_at = [], 0
        if borders and not any(s in t for s in c.special):
            for a, b in zip(borders, borders[1:]):
                hit = shared.get(digest(d[a:b])) if MIN_CHUNK <= b - a <= MAX_CHUNK else None
                if hit:
                    first, last, ids = hit
                    if a + first > open_at:
                        plan.append(len(todo))
                        todo.append(d[open_at:a + first].decode())
                    plan.append(ids)
                    open_at = a + last
        if open_at < len(d):
            plan.append(len(todo))
            todo.append(d[open_at:].decode())
        plans.append(plan)
    done = c.encode(todo)
    return [b"".join(p if isinstance(p, bytes) else done[p] for p in plan) for plan in plans]


def encoder(path: str, shared, carry: list[str]):
    """Columns ``carry`` and ids (little-endian unsigned 32-bit, binary)."""
    def run(batches):
        c = codec(path)
        for batch in batches:
            rest = batch.select(carry)
            for at, texts in text_slices(batch):
                ids = assemble(c, texts, shared.value if shared else {})
                yield pa.RecordBatch.from_arrays(
                    [*rest.slice(at, len(texts)).columns, pa.array(ids, pa.binary())], [*carry, "ids"])
    return run


def share_chunks(texts: DataFrame, path: str, dictionary: int):
    found = shared_chunks(texts, path, dictionary) if dictionary else {}
    return texts.sparkSession.sparkContext.broadcast(found) if found else None


def encode_report(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                  dictionary: int = DICTIONARY) -> DataFrame:
    """One row per document: id, n_tokens, ids_sha256 and, from the ids decoded
    again, decoded_sha256."""
    texts = ship(docs).select(F.col(text_col).alias("text"))
    shared = share_chunks(texts, path, dictionary)
    wide = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = wide.schema["id"].dataType.simpleString()

    def run(batches):
        c = codec(path)
        decimal = [str(i).encode() for i in range(len(c.token_bytes))]
        for batch in encoder(path, shared, ["id"])(batches):
            n, ids_sha, text_sha = [], [], []
            for x in batch.column(1).to_pylist():
                ids = np.frombuffer(x, "<u4")
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(b",".join(map(decimal.__getitem__, ids.tolist()))).hexdigest())
                text_sha.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    out = wide.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
           dictionary: int = DICTIONARY) -> DataFrame:
    """One row per document: id, n_tokens and ids (array of int)."""
    shared = share_chunks(ship(docs).select(F.col(text_col).alias("text")), path, dictionary)
    wide = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = wide.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in encoder(path, shared, ["id"])(batches):
            ids = [np.frombuffer(x, "<u4") for x in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            values = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(ends).astype(np.int64)), pa.ListArray.from_arrays(ends, values)],
                ["id", "n_tokens", "ids"])

    return wide.mapInArrow(run, f"id {kind}, n_tokens long, ids array<int>").withColumnRenamed("id", id_col)


def decode(rows: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with the column ``ids_col`` (array of int) decoded into ``text``."""
    keep = [c for c in rows.columns if c not in (ids_col, "text")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in keep)

    def run(batches):
        c = codec(path)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            text = pa.array([None if x is None else c.decode(np.array(x, np.int64)) for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.select(keep).columns, text], [*keep, "text"])

    return ship(rows).mapInArrow(run, ", ".join(filter(None, [schema, "text string"])))
