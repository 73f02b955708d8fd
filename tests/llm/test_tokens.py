"""Token operators against the public libraries run on whole texts."""

from __future__ import annotations

import hashlib
import io
import random
import weakref
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from orderloom.llm import bpe, packing, queries, rans, vocab
from tests.llm.fixtures import documents, empty, pairs


def tokenizer(name: str) -> Tokenizer:
    made = Tokenizer.from_file(public_tokenizers.path(name))
    made.encode_special_tokens = True
    return made


@pytest.mark.parametrize(("name", "drops"), [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_vocabulary_equals_whole_texts(name, drops, monkeypatch):
    monkeypatch.setattr(vocab, "MOST_PARTS", 300)
    made, plain, dice = vocab.Vocabulary(public_tokenizers.path(name), drops), tokenizer(name), random.Random(3)
    texts = ["".join(dice.choice("ab  \n\t'srelvd.,!éİ̇😀Ж1234\x1f ") for _ in range(dice.randint(0, 80))) for _ in range(1500)]
    for start in range(0, len(texts), 100):
        some = texts[start : start + 100]
        for text, got in zip(some, made.encode(pa.array(some)), strict=True):
            assert np.frombuffer(got, "<u2").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize(("name", "drops"), [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_vocabulary_equals_library_defaults(name, drops, monkeypatch):
    monkeypatch.setattr(vocab, "MOST_PARTS", 300)
    path, dice = public_tokenizers.path(name), random.Random(4)
    made, plain = vocab.Vocabulary(path, drops, plain_names=False), Tokenizer.from_file(path)
    signs = [*"ab  \n\t's.,!<|>é\u03011", "<|endoftext|>", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext"]
    texts = ["".join(dice.choice(signs) for _ in range(dice.randint(0, 40))) for _ in range(1500)]
    for start in range(0, len(texts), 100):
        some = texts[start : start + 100]
        for text, got in zip(some, made.encode(pa.array(some)), strict=True):
            assert np.frombuffer(got, "<u2").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_registered_queries_use_library_defaults(spark, tmp_path):
    rows = [(1, "a <|endoftext|> b"), (2, "plain"), (3, "x<|startoftext|>.\n\n<|endoftext|>")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    at, want, lengths = 0, [], {}
    for doc, text in rows:
        ids = np.array([*Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids, 0], "<u4")
        want.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
        own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode(text, add_special_tokens=False).ids
        lengths[doc] = len(own) + 1, zlib.crc32(np.array([*own, 2], "<u4").tobytes())
    assert sorted(tuple(r) for r in queries.op6_rans(spark, str(tmp_path)).collect()) == want
    packed = corpus_pipeline.packed(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), str(tmp_path))
    for got in (queries.op7_packing(spark, str(tmp_path)), packed):
        assert {r["doc_id"]: (r["doc_tokens"], r["ids_crc32"]) for r in got.collect()} == lengths


@pytest.mark.parametrize("n", [1, 5, 1023, 1024, 1025, 70_000, 300_000])
def test_rans_roundtrip(n):
    ids = (np.random.default_rng(n).zipf(1.3, n) % 50_257).astype("<u2")
    cut = n // 3
    data = rans.file_bytes([7, None], [ids[:cut].tobytes(), ids[cut:].tobytes()])
    reader = rans.Reader(io.BytesIO(data))
    crcs = [zlib.crc32(part.astype("<u4").tobytes()) for part in (ids[:cut], ids[cut:])]
    assert list(reader.documents()) == [(7, cut, crcs[0]), (None, n - cut, crcs[1])]
    last = len(reader.byte) - 1
    assert (reader.block(last) == ids[last * rans.BLOCK :]).all()  # a block by itself


def test_rans_finds_damage():
    ids = (np.random.default_rng(1).zipf(1.3, 5000) % 1000).astype("<u2")
    data = bytearray(rans.file_bytes([1], [ids.tobytes()]))
    data[-9] ^= 4
    with pytest.raises(ValueError):
        list(rans.Reader(io.BytesIO(bytes(data))).documents())


def test_rans_files(spark):
    docs, plain = documents(spark), tokenizer("byte_bpe_50k.json")
    want, at = [], 0
    for doc, text in sorted(pairs(docs), key=lambda r: (-1 if r[0] is None else r[0], r[1] or "")):
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = [tuple(r) for r in rans.roundtrip(docs).collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    assert rans.roundtrip(empty(spark)).count() == 0


def test_rans_small_files(spark, tmp_path):
    docs = documents(spark)
    manifest = rans.write(docs, f"file://{tmp_path}/out", file_ids=100)
    assert manifest.count() > 5
    assert rans.read(spark, f"file://{tmp_path}/out").count() == docs.count()


@pytest.mark.parametrize("window", [16, 4096])
def test_packing(spark, window):
    docs, plain = documents(spark), tokenizer("word_bpe_49k.json")
    want = defaultdict(list)
    for doc, text in pairs(docs):
        want[doc].append([*plain.encode(text or "", add_special_tokens=False).ids, 2])
    rows = packing.pack(docs, window=window).collect()
    sequences, own = defaultdict(list), defaultdict(dict)
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        own[r["doc_id"]].setdefault(r["start"], []).append((ids, r["doc_tokens"]))
    for doc, starts in own.items():
        for at, pieces in starts.items():
            for ids, total in pieces:
                assert any(ids == full[at : at + len(ids)] and total == len(full) for full in want[doc])
    assert sum(r["length"] for r in rows) == sum(len(ids) for all_ids in want.values() for ids in all_ids)
    for k, runs in sequences.items():
        at = 0
        for offset, length in sorted(runs):
            assert offset == at
            at += length
        assert at == window or k == max(sequences)
    assert sorted(sequences) == list(range(len(sequences)))


def test_packing_digest_and_empty(spark):
    for r in packing.digest(packing.pack(documents(spark)).select("*", "ids")).limit(0).collect():
        raise AssertionError(r)
    pieces = packing.pack(documents(spark))
    sums = sorted(zlib.crc32(r["ids"]) for r in pieces.collect())
    assert sorted(r["ids_crc32"] for r in packing.digest(pieces).collect()) == sums
    assert packing.pack(empty(spark)).count() == 0


def test_lean_workers_remember_less():
    path, parts = public_tokenizers.path("word_bpe_49k.json"), [f"w{k} x{k}." for k in range(2000)]
    made, lean = vocab.Vocabulary(path, True), vocab.Vocabulary(path, True, most_parts=100)
    held = []
    for k in range(0, 2000, 50):
        texts = pa.array(parts[k : k + 50])
        assert lean.encode(texts) == made.encode(texts)
        held.append(len(lean.young) + len(lean.elder))
    assert max(held) <= 2 * (100 + 150) < len(made.young)


def test_the_last_stage_packs_with_lean_workers(spark, monkeypatch):
    asked = []
    pack = packing.pack
    monkeypatch.setattr(packing, "pack", lambda docs, **more: asked.append(more) or pack(docs, **more))
    docs = documents(spark).coalesce(1)
    got = corpus_pipeline.packed(spark, docs, "").collect()
    assert asked == [{"plain_names": False, "lean": True}]
    assert vocab.LEAN_PARTS < vocab.MOST_PARTS and vocab.LEAN_ROWS < vocab.ROWS
    assert got == packing.digest(pack(docs, plain_names=False)).collect()


def library() -> tiktoken.Encoding:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_pieces():
    coder, plain, dice = bpe.encoder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN), library(), random.Random(5)
    texts = ["".join(dice.choice("ab  \n\t'srelvd.!é😀Ж1234") for _ in range(dice.randint(0, 150))) for _ in range(800)]
    for text in [*texts, "a" * 3000, "ab" * 2000, " " * 2000, "é" * 1500]:
        assert np.frombuffer(coder.encode(text), coder.kind).tolist() == plain.encode_ordinary(text)


@pytest.mark.parametrize(("chunk", "overlap"), [(1 << 18, 1 << 10), (300, 40), (40, 39)])
def test_bpe_chunks(spark, chunk, overlap):
    docs, plain = documents(spark), library()
    want = []
    for doc, text in pairs(docs):
        ids = plain.encode_ordinary(text or "")
        want.append((doc, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), text or ""))))
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    got = [tuple(r) for r in bpe.digests(docs, chunk=chunk, overlap=overlap).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert bpe.digests(empty(spark)).count() == 0


def test_given_texts_are_cut_and_stitched(spark):
    """Whole texts of the table are longer than a chunk, and their ids are those of the library."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where(f"length(text) > {bpe.CHUNK + bpe.OVERLAP}")
    rows, plain = docs.select("doc_id", "text").collect(), library()
    assert len(rows) > 10
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digests(docs).collect()}
    for doc, text in rows:
        ids = plain.encode_ordinary(text)
        assert got[doc] == (len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), text)))


def test_a_stitched_text_is_held_two_chunks_at_a_time():
    coder, plain = bpe.encoder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN), library()
    text = "".join(f"Word {k * 7919} it's  {'é' * (k % 90)}\n" for k in range(3000))
    chunk, overlap, alive = 500, 60, []

    def chunks():
        count = -(-(len(text) - overlap) // chunk)
        for k in range(count):
            alive.append(weakref.ref(own := bpe.Chunk.cut(coder, text[k * chunk : (k + 1) * chunk + overlap], k * chunk, k + 1 == count)))
            yield own
            del own
            assert sum(ref() is not None for ref in alive) <= 3

    ids = b"".join(bpe.stitched(coder, chunks()))
    assert np.frombuffer(ids, coder.kind).tolist() == plain.encode_ordinary(text)
