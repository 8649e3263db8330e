"""Language identification with spans, by Viterbi over words.

Words are runs of letters, lower-cased.  A word's score for a language is the
log-probability of its 1- to 3-grams (with marks at both ends) under that
language's smoothed n-gram counts, hashed into ``BINS`` bins.

Script ranges narrow the candidates: a language can label a word only if at
least ``SCRIPT_SHARE`` of the language's training letters are of the word's
script; a word in a script that no language uses favours none.  Viterbi then
finds the best labelling of the word sequence, where each change of language
costs ``SWITCH``; runs of one label are the spans of a mixed text.

The document's language is the one whose spans hold most letters, and its score
the share of letters they hold (ties: the first language by name).

Learning aggregates counts per (language, bin) over all labelled rows; the
model has one row of ``BINS`` numbers per language, whatever the corpus size.

Defined results: a null text or one without letters is ``und`` with score 0
and no spans, and so is every text if nothing could be learned; texts of any
length are read whole; rows with a null language are not learned from; empty
tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.bpe import text_slices
from lodestar.llm.common import ship, sole

UND = "und"
BINS = 1 << 15
SMOOTH = 0.1
SWITCH = 12.0
SCRIPT_SHARE = 0.001
FLOOR = -200.0           # score of a word for a language that does not use its script
SLICE = 1 << 22
KNOWN_WORDS = 200_000    # scored words kept per Python worker

# First code points of Unicode script ranges ("" between them).
SCRIPTS = [
    (0x0041, "Latin"), (0x0250, ""), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"),
    (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0700, "Syriac"), (0x0750, "Arabic"), (0x0780, ""),
    (0x08A0, "Arabic"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"),
    (0x0B00, "Oriya"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"),
    (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"),
    (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, ""), (0x1780, "Khmer"),
    (0x1800, "Mongolian"), (0x18B0, ""), (0x1C80, "Cyrillic"), (0x1C90, "Georgian"), (0x1CC0, ""),
    (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, ""), (0x2C60, "Latin"), (0x2C80, ""), (0x2DE0, "Cyrillic"),
    (0x2E00, ""), (0x2E80, "Han"), (0x3040, "Kana"), (0x3100, "Bopomofo"), (0x3130, "Hangul"), (0x3190, ""),
    (0x31F0, "Kana"), (0x3200, ""), (0x3400, "Han"), (0xA000, ""), (0xA640, "Cyrillic"), (0xA6A0, ""),
    (0xA720, "Latin"), (0xA800, ""), (0xAC00, "Hangul"), (0xD7B0, ""), (0xF900, "Han"), (0xFB00, "Latin"),
    (0xFB07, ""), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, ""), (0xFE70, "Arabic"), (0xFF00, "Latin"),
    (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0xFFE0, ""), (0x20000, "Han"), (0x32000, ""),
]
SCRIPT_NAMES = sorted({n for _, n in SCRIPTS if n})
_STARTS = np.array([0, *(s for s, _ in SCRIPTS)])
_SCRIPT_OF = np.array([-1, *(SCRIPT_NAMES.index(n) if n else -1 for _, n in SCRIPTS)])

WORDS = re.compile(r"[^\W\d_]+")


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words with a 0 around each, and the word of each place."""
    c = np.frombuffer(("\0" + "\0".join(words) + "\0").encode("utf-32-le"), np.uint32).astype(np.int64)
    return c, np.cumsum(c == 0) - 1


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, bin) of every 1- to 3-gram of the words."""
    c, owner = code_points(words)
    inside = c != 0
    at, bins = [owner[inside]], [c[inside] * 40503]
    two = c[:-1] * 31321 + c[1:] * 65599 + 7
    ok = inside[:-1] | inside[1:]
    at.append(np.where(c[1:] == 0, owner[:-1], owner[1:])[ok])
    bins.append(two[ok])
    if len(c) >= 3:
        mid = inside[1:-1]
        bins.append((c[:-2] * 92821 + c[1:-1] * 68917 + c[2:] * 75997 + 13)[mid])
        at.append(owner[1:-1][mid])
    mixed = (np.concatenate(bins).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(49)
    return np.concatenate(at), mixed.astype(np.int64)


def word_scripts(words: list[str]) -> np.ndarray:
    """Script number of each word's first character, -1 for none."""
    first = np.array([ord(w[0]) for w in words], np.int64)
    return _SCRIPT_OF[np.searchsorted(_STARTS, first, side="right") - 1]


def count_task(batches):
    """Per task: (lang, bin, n); script numbers follow the bins."""
    counts: dict[str, Counter] = {}
    sums: dict[str, np.ndarray] = {}

    def fold():
        for lang, words in counts.items():
            keys = list(words)
            n = np.array(list(words.values()), np.float64)
            at, bins = grams(keys)
            total = sums.setdefault(lang, np.zeros(BINS + len(SCRIPT_NAMES)))
            total += np.bincount(bins, n[at], len(total))
            s = word_scripts(keys)
            size = np.array([len(w) for w in keys])
            total += np.bincount(BINS + s[s >= 0], (n * size)[s >= 0], len(total))
        counts.clear()

    for batch in batches:
        langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
        for at, texts in text_slices(batch, size=SLICE):
            for lang, t in zip(langs[at:at + len(texts)], texts):
                counts.setdefault(lang, Counter()).update(WORDS.findall(t.lower()))
            if sum(map(len, counts.values())) > KNOWN_WORDS:
                fold()
    fold()
    for lang, total in sums.items():
        bins = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(bins), pa.string()), pa.array(bins, pa.int64()), pa.array(total[bins])],
            ["lang", "bin", "n"])


class Model:
    """Scores of words and labelling of texts; built from the count table."""

    def __init__(self, langs: list[str], n: np.ndarray):
        self.langs = langs
        g = n[:, :BINS]
        self.log_p = np.log((g + SMOOTH) / (g.sum(1, keepdims=True) + SMOOTH * BINS)).astype(np.float32)
        s = n[:, BINS:]
        used = s >= SCRIPT_SHARE * np.maximum(s.sum(1, keepdims=True), 1)
        self.uses = np.concatenate([used, np.zeros((len(langs), 1), bool)], axis=1)  # last: no script
        self.index: dict[str, int] = {}
        self.scores = np.zeros((0, len(langs)), np.float32)
        self.letters = np.zeros(0, np.int64)
        self.likely = np.zeros((0, len(langs)), bool)   # languages that use the word's script

    def score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        at, bins = grams(words)
        out = np.stack([np.bincount(at, p[bins], len(words)) for p in self.log_p], axis=1).astype(np.float32)
        out -= out.max(1, keepdims=True)
        can = self.uses[:, word_scripts(words)].T
        out[~can] = FLOOR
        out[~can.any(1)] = 0
        return out, can

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.index]
        if len(self.index) + len(new) > KNOWN_WORDS:
            self.index, self.scores, self.letters, self.likely = {}, self.scores[:0], self.letters[:0], self.likely[:0]
            new = list(words)
        if new:
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
            scores, likely = self.score(new)
            self.scores = np.concatenate([self.scores, scores])
            self.likely = np.concatenate([self.likely, likely])
            self.letters = np.concatenate([self.letters, [len(w) if w.isalpha() else sum(map(str.isalpha, w)) for w in new]])

    def numbers(self, texts: list[str]) -> list[np.ndarray]:
        """Numbers of the words of each text; they hold until more words are learned."""
        words = [WORDS.findall(t.lower()) for t in texts]
        self.learn(set().union(*words))
        get = self.index.__getitem__
        return [np.fromiter(map(get, w), np.int32, len(w)) for w in words]

    def label(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Language number of each word, and letters of each word, per text."""
        ids = self.numbers(texts)
        return viterbi(ids, self.scores, SWITCH), [self.letters[i] for i in ids]

    def supported(self, texts: list[str]) -> list[float]:
        """Share of a text's letters that lie in words whose label is a language
        that uses the word's script; 0 without letters."""
        ids = self.numbers(texts)
        out = []
        for i, path in zip(ids, viterbi(ids, self.scores, SWITCH)):
            size = self.letters[i]
            total = int(size.sum())
            out.append(float(size[self.likely[i, path]].sum() / total) if total else 0.0)
        return out


def viterbi(docs: list[np.ndarray], scores: np.ndarray, switch: float) -> list[np.ndarray]:
    """Best labelling of each sequence of word numbers; all documents advance
    together, the longest first, so that the active ones are a prefix."""
    lengths = np.array([len(d) for d in docs])
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    steps = int(lengths[0]) if len(lengths) else 0
    if not steps:
        return [np.zeros(0, np.int64) for _ in docs]
    flat = np.concatenate([docs[k] for k in order])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")  # documents longer than t
    v = np.zeros((int(active[0]), scores.shape[1]), np.float32)
    jumped = np.zeros((len(flat), scores.shape[1]), bool)
    source = np.zeros(len(flat), np.int8 if scores.shape[1] < 128 else np.int32)
    ends: list = [None] * steps
    for t in range(steps):
        a = int(active[t])
        if a < len(v):
            ends[t - 1] = v[a:]
            v = v[:a]
        place = starts[:a] + t
        best = v.argmax(1)
        top = v[np.arange(a), best] - switch
        jump = top[:, None] > v
        jumped[place], source[place] = jump, best
        v = np.maximum(v, top[:, None]) + scores[flat[place]]
    ends[steps - 1] = v
    path = np.zeros(len(flat), np.int64)
    state = np.zeros(int(active[0]), np.int64)
    for t in range(steps - 1, -1, -1):
        a = int(active[t])
        if ends[t] is not None:
            state[a - len(ends[t]):a] = ends[t].argmax(1)
        place = starts[:a] + t
        path[place] = state[:a]
        if t:
            state[:a] = np.where(jumped[place, state[:a]], source[place], state[:a])
    out: list = [None] * len(docs)
    for k, (s, n) in zip(order, zip(starts, lengths)):
        out[k] = path[s:s + n]
    return out


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and their counts, from all rows of ``docs`` with a language."""
    rows = (ship(docs).where(F.col(lang_col).isNotNull())
            .select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
            .mapInArrow(count_task, "lang string, bin long, n double")
            .groupBy("lang", "bin").agg(F.sum("n").alias("n")).toPandas())  # languages x bins
    langs = sorted(rows["lang"].unique())
    n = np.zeros((len(langs), BINS + len(SCRIPT_NAMES)))
    n[np.searchsorted(langs, rows["lang"]) if langs else [], rows["bin"].to_numpy(np.int64)] = rows["n"]
    return langs, n


_MODELS: dict[int, Model] = {}


def model_of(shared) -> Model:
    langs, packed = shared.value
    key = zlib.crc32(packed)
    if key not in sole(_MODELS):
        _MODELS.clear()
        _MODELS[key] = Model(langs, np.frombuffer(packed, np.float64).reshape(len(langs), BINS + len(SCRIPT_NAMES)))
    return _MODELS[key]


def identify(docs: DataFrame, learned: tuple[list[str], np.ndarray], id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row per document: id, lang_pred, score, and spans (array of lang,
    first_word, n_words)."""
    langs, n = learned
    shared = docs.sparkSession.sparkContext.broadcast((langs, n.tobytes()))
    wide = ship(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    span = pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64())])

    def run(batches):
        m = model_of(shared)
        for batch in batches:
            for at, texts in text_slices(batch, size=SLICE):
                paths, letters = m.label(texts) if m.langs else ([np.zeros(0, np.int64)] * len(texts),) * 2
                lang, score, spans = [], [], []
                for path, size in zip(paths, letters):
                    total = size.sum()
                    if not total:
                        lang.append(UND)
                        score.append(0.0)
                        spans.append([])
                        continue
                    share = np.bincount(path, size, len(m.langs))
                    k = int(share.argmax())
                    lang.append(m.langs[k])
                    score.append(float(share[k] / total))
                    new = np.concatenate([[0], np.flatnonzero(np.diff(path)) + 1, [len(path)]])
                    spans.append([{"lang": m.langs[path[a]], "first_word": a, "n_words": b - a}
                                  for a, b in zip(new.tolist(), new[1:].tolist())])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                     pa.array(spans, pa.list_(span))], ["id", "lang_pred", "score", "spans"])

    kind = wide.schema["id"].dataType.simpleString()
    out = wide.mapInArrow(run, f"id {kind}, lang_pred string, score double, "
                               "spans array<struct<lang: string, first_word: long, n_words: long>>")
    return out.withColumnRenamed("id", id_col)


def with_language(docs: DataFrame, learned: tuple[list[str], np.ndarray], text_col: str = "text",
                  least: float = 0.2) -> DataFrame:
    """The rows of ``docs`` whose language is found, columns as they are.

    A text is kept if words labelled with a language that uses their script hold
    ``least`` of its letters: texts without letters go, and texts in scripts of
    no learned language.  Where nothing could be learned, texts with letters stay."""
    langs, n = learned
    shared = docs.sparkSession.sparkContext.broadcast((langs, n.tobytes()))

    def run(batches):
        m = model_of(shared)
        for batch in batches:
            for at, texts in text_slices(batch, text_col, SLICE):
                found = ([x >= least for x in m.supported(texts)] if m.langs
                         else [any(map(str.isalpha, t)) for t in texts])
                yield batch.slice(at, len(texts)).filter(pa.array(found, pa.bool_()))

    return ship(docs).mapInArrow(run, docs.schema)
