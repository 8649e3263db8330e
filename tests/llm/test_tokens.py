"""BPE and token files: exact agreement with the library, exact round trips."""

import hashlib
import random
import struct
import zlib

import numpy as np
import pytest
import zstandard
from lodestar.llm import bpe, token_files
from lodestar.llm.common import shared_folder

PARTS = [" ", "  ", "\n", "\n\n", "\t", "a", "b", "é", "don't", "'s", "<|endoftext|>", "1", "23", "!!", "。", "中文",
         " ", "\x1c", "\x85", " ", ".", ",", "x.y", " z", "\r\n", "²", "٣", "\U0001f642", "‍", "́"]


def library_ids(library, texts):
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, 60))) for _ in range(n)] + [
        "".join(rng.choices(PARTS, k=300)) * 4 for _ in range(10)]


def test_encoder_agrees_with_the_library_on_odd_texts(library, bpe_path):
    texts = odd_texts(1500, 1)
    got = bpe.Codec(bpe_path).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == library_ids(library, texts)


def test_small_cache_gives_the_same_ids(library, bpe_path, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 50)
    texts = odd_texts(200, 2)
    c = bpe.Codec(bpe_path)
    got = [c.encode(texts[k:k + 7])[j] for k in range(0, len(texts), 7) for j in range(len(texts[k:k + 7]))]
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == library_ids(library, texts)


def test_chunk_borders_depend_on_content_only():
    rng = random.Random(5)
    passage = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(2000)).encode()
    a, b = bpe.chunk_borders([passage, b"some other start " * 9 + passage])
    shift = 17 * 9
    assert len({x + shift for x in a} & set(b)) > 0.7 * len(a) > 5


def test_report_with_shared_chunks_matches_the_library(spark, library, bpe_path):
    rng = random.Random(6)
    passage = " ".join("".join(rng.choices("abcdefghé", k=rng.randint(1, 9))) for _ in range(3000))
    texts = odd_texts(60, 3) + [f"doc {k} " + passage[k * 7:] + odd_texts(1, k)[0] for k in range(20)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert bpe.shared_chunks(docs.select("text"), bpe_path)
    ids = library_ids(library, texts)
    text = library.decode_batch(ids, skip_special_tokens=False)
    got = {r.doc_id: r for r in bpe.encode_report(docs, bpe_path).collect()}
    for k, x in enumerate(ids):
        assert got[k].n_tokens == len(x)
        assert got[k].ids_sha256 == hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256(text[k].encode()).hexdigest()


def test_encode_and_decode_odd_rows(spark, odd, empty, bpe_path):
    got = bpe.decode(bpe.encode(odd, bpe_path), bpe_path).collect()
    assert sorted(r.text for r in got) == sorted(r.text or "" for r in odd.collect())
    assert bpe.encode(empty, bpe_path).count() == 0 and bpe.encode_report(empty, bpe_path).count() == 0


def test_token_files_round_trip(spark, odd, library, bpe_path):
    rows = sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    files = token_files.write_tokens(odd, bpe_path, shared_folder(spark, "t"), 2, files=4)
    got = sorted(token_files.read_tokens(files).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [r.doc_id for r in rows]
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    want = {(r.doc_id, zlib.crc32(np.array(x + [2], "<u4").tobytes()), len(x) + 1)
            for r, x in zip(rows, library_ids(library, [r.text for r in rows]))}
    assert {(r.doc_id, r.ids_crc32, r.n_tokens) for r in got} == want
    one = token_files.fetch(files, [3, 10, 999]).collect()
    assert sorted(r.doc_id for r in one) == [3, 10]


def test_file_is_plain_zstandard_and_damage_is_found(spark, odd, bpe_path, tmp_path):
    files = token_files.write_tokens(odd, bpe_path, str(tmp_path / "t"), 2, files=1).collect()
    raw = open(files[0].file, "rb").read()
    content = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert len(content) == 2 * files[0].n_tokens
    n, flag, magic = struct.unpack("<IBI", raw[-9:])
    assert (n, flag, magic) == (files[0].n_docs, 0x80, 0x8F92EAB1)
    bad = tmp_path / "bad.zst"
    bad.write_bytes(raw[:-9 - 12 * n + 8] + b"\0\0\0\0" + raw[-9 - 12 * n + 12:])  # first checksum
    with pytest.raises(ValueError):
        token_files.Reader(str(bad)).read(0)


def test_token_files_of_an_empty_table(spark, empty, bpe_path):
    files = token_files.write_tokens(empty, bpe_path, shared_folder(spark, "t"), 2)
    assert files.count() == 0 and token_files.read_tokens(files).count() == 0
