r"""Secret scan by a linear-chain conditional random field.

Base scan.  Three patterns give spans that stay whatever the model says:
``assign`` (a key word, a sign and a value), ``access`` and ``hex``; matches of
each are leftmost and do not overlap, and short ones are dropped.

The field.  Tokens are runs of word characters and single other characters.
Each is tagged outside, begin or inside.  A token's score comes from its shape
(kinds of characters, length, changes between kinds), the shape of both
neighbours, the words before and after it, whether it touches the token before,
and features of its file (length, share of tokens with digits); tags follow each
other by a learned matrix in which inside never follows outside.  No feature
holds the token's own text, so that it learns what a secret looks like and where
it stands.  Features are computed by array operations over all tokens of a slice.

Learning.  Values of base matches in a sample of about ``SAMPLE`` rows (chosen
by a hash) are the labels; windows of ``AROUND`` tokens around them, and one
window of every fourth other text, train the field by gradient steps on the exact log
likelihood (forward-backward); at most ``WINDOWS`` distinct windows of either
kind reach the driver.

Decoding.  Viterbi over whole texts.  The tokens of a slice are one chain that
starts anew at each text; it is cut into stretches of ``STRETCH`` tokens, whose
max-plus products are taken side by side, then chained: the result is exact and
a single long text costs no more steps than many short ones.  Decoded spans
of ``LEAST`` characters or more that touch no base span are added as kind ``crf``.

Defined results: null texts are empty and have no spans; without a base match in
the sample only base spans are found; repeated rows are scanned each; texts of
any length are whole; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.bpe import text_slices
from lodestar.llm.common import ship

# The base patterns with the fewest characters of what counts.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN_LEAST = 12
ACCESS = re.compile("AKIA[A-Z0-9]{14,}")   # AKIA[A-Z0-9]+ of 18 characters or more
HEX = re.compile("[0-9a-f]{16,}")          # [0-9a-f]+ of 16 characters or more
KINDS = ("assign", "access", "hex", "crf")

SAMPLE = 20_000          # rows that the field may learn from
WINDOWS = 4_000          # windows with a secret, and as many without
AROUND = 20              # tokens of a window on either side
STEPS = 80              # gradient steps
RATE, PENALTY = 0.15, 1e-4
LEAST = 8                # characters of a span that the field may add
STRETCH = 256            # tokens of a stretch of the Viterbi chain
BUCKETS = 4096           # of neighbouring words

OUT, BEGIN, INSIDE = 0, 1, 2
NEVER = -1e9

# Kinds of characters: 0 blank, 1 digit, 2 lower, 3 upper, 4 other word character, 5 and on: marks.
_KIND = np.array([0 if chr(c).isspace() else 4 if chr(c).isalnum() else 10 for c in range(1 << 16)], np.int8)
_KIND[48:58], _KIND[97:123], _KIND[65:91], _KIND[ord("_")] = 1, 2, 3, 4
for _k, _marks in enumerate(("=:", "\"'`", "+/", ".-", "()[]{}<>"), 5):
    _KIND[[ord(c) for c in _marks]] = _k
_LENGTHS = np.array([2, 4, 6, 9, 12, 16, 20, 32])
_SWITCHES = np.array([1, 2, 4, 8])
SHAPE_KINDS = 16
FILES = 5 * 5
# Feature groups and their sizes; the last value of a neighbour stands for the edge of the text.
GROUPS = {"shape": SHAPE_KINDS * 5, "length": 9, "before": SHAPE_KINDS + 1, "before_2": SHAPE_KINDS + 1,
          "after": SHAPE_KINDS + 1, "word_before": BUCKETS + 1, "word_before_2": BUCKETS + 1, "word_after": BUCKETS + 1,
          "touches": 2 * SHAPE_KINDS, "file": FILES}
OFFSETS = np.cumsum([0, *GROUPS.values()])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in order; code points, end exclusive."""
    low = text.encode().lower()
    out = []
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if b"akia" in low:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def secret_values(text: str) -> list[tuple[int, int]]:
    """What the base matches say is secret: the value of an assignment, all of the others."""
    out = [(a, b) for a, kind, b in base_spans(text) if kind]
    return out + [m.span(2) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]


class Tokens:
    """Tokens of texts and their features.  ``start`` and ``end`` are offsets in
    the joined texts, ``text_of`` the number of a token's text, ``text_from`` the
    offset of each text, ``features`` one index per token and group."""

    def __init__(self, texts: list[str]):
        sizes = np.array([len(t) for t in texts], np.int64)
        self.text_from = np.cumsum(sizes) - sizes
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        kind = np.where(codes < 1 << 16, _KIND[np.minimum(codes, 0xFFFF)], 4)
        solid = (kind >= 1) & (kind <= 4)
        first = kind > 0
        first[1:] &= ~(solid[1:] & solid[:-1])
        at_text = self.text_from[(sizes > 0)]
        first[at_text] = kind[at_text] > 0
        self.start = np.flatnonzero(first)
        n = len(self.start)
        if not n:
            self.end = self.text_of = np.zeros(0, np.int64)
            self.features = np.zeros((0, len(GROUPS)), np.int32)
            return
        here = np.cumsum(first) - 1                         # token of each character, or the one before a blank
        body = kind > 0
        size = np.bincount(here[body], minlength=n)
        self.end = self.start + size
        self.text_of = np.searchsorted(self.text_from, self.start, "right") - 1
        token, what = here[body], kind[body]
        of = [np.bincount(token[what == k], minlength=n) for k in (1, 2, 3, 4)]
        hexes = np.bincount(token[(what == 1) | ((codes[body] >= 97) & (codes[body] <= 102))], minlength=n)
        switch = body.copy()
        switch[1:] &= (kind[1:] != kind[:-1]) & ~first[1:]
        switch[0] = False
        switches = np.bincount(here[switch], minlength=n)
        digits, lower, upper, other = (x > 0 for x in of)
        title = upper & lower & (of[2] == 1) & (kind[self.start] == 3)
        shape = np.select(
            [kind[self.start] >= 5, other, hexes == size, digits & upper & lower, digits & upper, digits & lower, title,
             upper & lower, upper], [kind[self.start] + 5, 9, np.where(of[0] == size, 4, 5), 8, 7, 6, 2, 3, 1], 0)
        hex_letters = (shape == 5) & ~digits                # a word of a to f only
        shape[hex_letters] = 0
        # A hash of the word in lower case, position by position.
        low = codes[body].astype(np.uint64) + np.where(what == 3, 32, 0).astype(np.uint64)
        place = np.flatnonzero(body) - self.start[token]
        power = np.cumprod(np.full(int(size.max()), 0x9E3779B97F4A7C15, np.uint64))
        word = np.add.reduceat(low * power[place], np.cumsum(size) - size)
        word = (word >> np.uint64(40)).astype(np.int64) % BUCKETS

        def shifted(x, k, edge):
            out = np.full(n, edge, np.int64)
            if n > abs(k):
                src, dst = (slice(None, -k), slice(k, None)) if k > 0 else (slice(-k, None), slice(None, k))
                out[dst] = np.where(self.text_of[src] == self.text_of[dst], x[src], edge)
            return out

        touches = np.zeros(n, np.int64)
        touches[1:] = (self.start[1:] == self.end[:-1]) & (self.text_of[1:] == self.text_of[:-1])
        count = np.bincount(self.text_of, minlength=len(texts))
        share = np.bincount(self.text_of[digits], minlength=len(texts)) / np.maximum(count, 1)
        of_file = np.searchsorted([1e-9, .01, .05, .2], share, "right") * 5 + np.searchsorted([20, 100, 500, 2500], count, "right")
        self.features = np.stack([
            shape * 5 + np.searchsorted(_SWITCHES, switches, "right"), np.searchsorted(_LENGTHS, size, "right"),
            shifted(shape, 1, SHAPE_KINDS), shifted(shape, 2, SHAPE_KINDS), shifted(shape, -1, SHAPE_KINDS),
            shifted(word, 1, BUCKETS), shifted(word, 2, BUCKETS), shifted(word, -1, BUCKETS),
            touches * SHAPE_KINDS + shape, of_file[self.text_of]], 1).astype(np.int32)


class Field:
    """Weights: one row per feature value (all groups one after the other) and
    tag; ``first`` scores the tag of a first token, ``follow`` that of the next."""

    def __init__(self):
        self.emit = np.zeros((int(OFFSETS[-1]), 3))
        self.first = np.array([0.0, 0.0, NEVER])
        self.follow = np.array([[0.0, 0.0, NEVER], [0.0, 0.0, 0.0], [0.0, 0.0, 0.0]])

    def scores(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((len(features), 3))
        for g in range(len(GROUPS)):
            out += self.emit[features[:, g] + OFFSETS[g]]
        return out

    def decode(self, scores: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Best tags of chains that stand one after the other; ``begins`` marks first tokens."""
        n = len(scores)
        if not n:
            return np.zeros(0, np.int8)
        k = -(-n // STRETCH)                                # stretches; the last axis of all that follows
        e = np.zeros((k * STRETCH, 3))
        e[:n] = scores
        s = np.zeros(k * STRETCH, bool)
        s[:n] = begins
        e = np.ascontiguousarray(e.reshape(k, STRETCH, 3).transpose(1, 2, 0))
        s = np.ascontiguousarray(s.reshape(k, STRETCH).T)

        def step(t):
            """Scores from tag i to tag j at place t of every stretch."""
            return np.where(s[t], self.first[None, :, None], self.follow[:, :, None]) + e[t]

        def best(a, way):
            """Max-plus product of rows of tag scores with a step, and the tag it came from."""
            x, y, z = (a[..., i, None, :] + way[i] for i in range(3))
            xy = np.maximum(x, y)
            return np.maximum(xy, z), x, y, z, xy

        whole = np.full((3, 3, k), NEVER * STRETCH)
        whole[[0, 1, 2], [0, 1, 2]] = 0
        for t in range(STRETCH):
            whole = best(whole, step(t))[0]
        entry = np.zeros((3, k))
        for b in range(1, k):
            now = (entry[:, b - 1, None] + whole[:, :, b - 1]).max(0)
            entry[:, b] = now - now.max()
        back = np.empty((STRETCH, 3, k), np.int8)
        alpha = entry
        for t in range(STRETCH):
            alpha, x, y, z, xy = best(alpha, step(t))
            back[t] = np.where(z > xy, 2, y > x)
        came = np.repeat(np.arange(3)[:, None], k, 1)       # tag before a stretch, for each tag at its end
        column = np.arange(k)
        for t in range(STRETCH - 1, -1, -1):
            came = back[t][came, column].astype(np.int64)
        last = np.empty(k, np.int64)
        last[-1] = alpha[:, -1].argmax()
        for b in range(k - 1, 0, -1):
            last[b - 1] = came[last[b], b]
        tags = np.empty((k, STRETCH), np.int8)
        for t in range(STRETCH - 1, -1, -1):
            tags[:, t] = last
            last = back[t][last, column].astype(np.int64)
        return tags.reshape(-1)[:n]


def likelihood(field: Field, features: np.ndarray, tags: np.ndarray, size: np.ndarray):
    """Log likelihood of padded windows and its gradients (emit, first, follow),
    by the scaled forward-backward recursion.  ``features`` is (windows, tokens,
    groups), ``tags`` (windows, tokens)."""
    w, t, _ = features.shape
    real = np.arange(t) < size[:, None]
    e = field.scores(features.reshape(w * t, -1)).reshape(w, t, 3)
    top = e.max(2, keepdims=True)
    grow, first, follow_exp = np.exp(e - top), np.exp(field.first), np.exp(field.follow)
    alpha, beta, scale = np.empty((w, t, 3)), np.ones((w, t, 3)), np.ones((w, t))
    now = first * grow[:, 0]
    for k in range(t):
        if k:
            now = np.where(real[:, k, None], (now @ follow_exp) * grow[:, k], now)
        scale[:, k] = np.where(real[:, k], now.sum(1), 1)
        now = now / scale[:, k, None]
        alpha[:, k] = now
    total = (np.log(scale) + top[:, :, 0] * real).sum(1)
    pairs = np.zeros((3, 3))
    for k in range(t - 1, 0, -1):
        ahead = grow[:, k] * beta[:, k] / scale[:, k, None]
        pairs += (alpha[:, k - 1] * real[:, k, None]).T @ ahead * follow_exp
        beta[:, k - 1] = np.where(real[:, k, None], ahead @ follow_exp.T, beta[:, k])
    p = alpha * beta
    gold = np.zeros((w, t, 3))
    np.put_along_axis(gold, tags[:, :, None].astype(np.int64), 1, 2)
    diff = ((gold - p) * real[:, :, None]).reshape(w * t, 3)
    emit = np.zeros_like(field.emit)
    flat = features.reshape(w * t, -1)
    for g, (a, b) in enumerate(zip(OFFSETS, OFFSETS[1:])):
        for j in range(3):
            emit[a:b, j] = np.bincount(flat[:, g], diff[:, j], b - a)
    follow = np.zeros((3, 3))
    both_real = real[:, 1:]
    np.add.at(follow, (tags[:, :-1][both_real], tags[:, 1:][both_real]), 1)
    value = ((e * gold).sum(2) * real).sum() + field.first[tags[:, 0]].sum() + (field.follow * follow).sum() - total.sum()
    return value, emit, (gold[:, 0] - p[:, 0]).sum(0), follow - pairs


def fit(windows: list[tuple[np.ndarray, np.ndarray]], steps: int = STEPS) -> Field | None:
    """A field from (features, tags) windows; None without any secret."""
    field = Field()
    if not any((t == BEGIN).any() for _, t in windows):
        return None
    size = np.array([len(t) for _, t in windows])
    features = np.zeros((len(windows), size.max(), len(GROUPS)), np.int32)
    tags = np.zeros((len(windows), size.max()), np.int8)
    for k, (f, t) in enumerate(windows):
        features[k, :len(t)], tags[k, :len(t)] = f, t
    params = [field.emit, field.first, field.follow]
    moment = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, steps + 1):
        _, *grads = likelihood(field, features, tags, size)
        for p, g, (m, v) in zip(params, grads, moment):     # Adam; impossible transitions stay so
            g = np.where(p > NEVER / 2, g / len(windows) - PENALTY * p, 0)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return field


def tagged_windows(texts: list[str]):
    """(features, tags, has a secret) windows of the texts."""
    tokens = Tokens(texts)
    tags = np.zeros(len(tokens.start), np.int8)
    for k, text in enumerate(texts):
        for a, b in secret_values(text):
            i, j = np.searchsorted(tokens.end, a + tokens.text_from[k], "right"), np.searchsorted(tokens.start, b + tokens.text_from[k])
            tags[i:j] = INSIDE
            tags[i] = BEGIN
    bounds = np.searchsorted(tokens.text_of, np.arange(len(texts) + 1))
    for k, text in enumerate(texts):
        lo, hi = int(bounds[k]), int(bounds[k + 1])
        at = (np.flatnonzero(tags[lo:hi] == BEGIN) + lo).tolist()
        if not at and lo < hi:
            h = int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little")
            at = [lo + h // 4 % (hi - lo)] if h % 4 == 0 else []
        for p in at:
            part = slice(max(lo, p - AROUND), min(hi, p + AROUND))
            yield tokens.features[part], tags[part], bool(tags[part].any())


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Field | None:
    ship(docs)
    text = F.coalesce(F.col(text_col), F.lit(""))
    share = min(1.0, sample / max(docs.count(), 1))
    chosen = docs.where(F.pmod(F.xxhash64(F.col(id_col), text), F.lit(1 << 20)) < int(share * (1 << 20))).select(text.alias("text"))

    def run(batches):
        for batch in batches:
            for _, texts in text_slices(batch):
                rows = list(tagged_windows(texts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f.tobytes() for f, _, _ in rows], pa.binary()), pa.array([t.tobytes() for _, t, _ in rows], pa.binary()),
                     pa.array([s for _, _, s in rows], pa.bool_())], ["features", "tags", "secret"])

    found = chosen.mapInArrow(run, "features binary, tags binary, secret boolean").dropDuplicates(["features", "tags"])
    some = [found.where(is_secret).orderBy(F.xxhash64("features", "tags")).limit(WINDOWS)
            for is_secret in (F.col("secret"), ~F.col("secret"))]
    return fit([(np.frombuffer(r[0], np.int32).reshape(-1, len(GROUPS)), np.frombuffer(r[1], np.int8))
                for part in some for r in part.select("features", "tags").collect()])


def scan(texts: list[str], field: Field | None) -> list[list[tuple[int, int, int]]]:
    """All spans (start, kind, end) of each text, in order."""
    out = [base_spans(t) for t in texts]
    if field is None:
        return out
    tokens = Tokens(texts)
    n = len(tokens.start)
    begins = np.ones(n, bool)
    begins[1:] = tokens.text_of[1:] != tokens.text_of[:-1]
    tags = field.decode(field.scores(tokens.features), begins)
    last = np.ones(n, bool)
    last[:-1] = (tags[1:] != INSIDE) | begins[1:]
    heads, tails = np.flatnonzero(tags == BEGIN), np.flatnonzero(last & (tags != OUT))
    for i, j in zip(heads.tolist(), tails.tolist()):
        k = int(tokens.text_of[i])
        a, b = int(tokens.start[i] - tokens.text_from[k]), int(tokens.end[j] - tokens.text_from[k])
        if b - a >= LEAST and all(b <= x or a >= y for x, kind, y in out[k] if kind < 3):
            out[k].append((a, 3, b))
    return [sorted(x) for x in out]


def find_secrets(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: id, spans (array of kind, start, end)."""
    wide = ship(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = wide.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(field)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            for at, texts in text_slices(batch.select(["text"])):
                spans = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in s] for s in scan(texts, shared.value)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(spans, span)], ["id", "spans"])

    out = wide.mapInArrow(run, f"id {kind}, spans array<struct<kind:string,start:long,end:long>>")
    return out.withColumnRenamed("id", id_col)


def secret_report(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: id, n_assign, n_access, n_hex, base_sha256, spans (``kind:start:end``, comma-joined)."""
    found = find_secrets(docs, field, id_col, text_col)

    def line(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(kind):
        return F.filter("spans", lambda s: s["kind"] == kind)

    base = F.filter("spans", lambda s: s["kind"] != KINDS[3])
    return found.select(id_col, *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
                        F.sha2(line(base).cast("binary"), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))
