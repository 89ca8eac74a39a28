"""Token counts, piece encoding and token files against the libraries themselves."""

import random
import zlib
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import cases
from snapledger.llm.pieces import encode_pieces, piece_table
from snapledger.llm.token_counts import counter, token_counts
from snapledger.llm.token_files import PerfectHash, ShardIndex, encoder, read_token_files, token_files, write_token_files

ODD = ["a", "B", "Σ", "ς", " ", "  ", "\n", "\t", "\r", "'s", "'t", "é", "é", "<|endoftext|>", "<|startoftext|>", "<|", "1", "½", "中",
       "\x1c", "\x85", "\xa0", "　", "😀", "ﬁ", "!!", "...", "$%", "the", "ing", "̸", "\x00", "﻿", "’s", "▁", "<s>", "<0x0A>", "   "]


def odd_texts(n: int) -> list[str]:
    rng = random.Random(2)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 14))) for _ in range(n)] + [t or "" for t in cases.texts()]


def test_counts_equal_the_library():
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    own = counter("word_bpe_49k.json")
    for t in odd_texts(3000):
        assert own.of_text(t) == len(lib.encode(t, add_special_tokens=False).ids), repr(t)


def test_pieces_equal_the_library_and_decode_back():
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    own = piece_table("piece_bpe_32k.model")
    for t in odd_texts(3000):
        ids = lib.encode(t)
        n, joined, back = own.of_text(t)
        assert (n, own.encode(t), back) == (len(ids), ids, lib.decode(ids)), repr(t)


def test_byte_ids_equal_the_library():
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own = encoder("byte_bpe_50k.json")
    texts = odd_texts(3000)
    for t, raw in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(raw, own.dtype).tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)


def test_perfect_hash_is_minimal_and_knows_strangers():
    keys = np.unique(np.random.default_rng(3).integers(-2**62, 2**62, 5000))
    slots = PerfectHash.of(keys).slots(keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))
    index = ShardIndex.from_bytes(ShardIndex.build(keys, np.ones(len(keys), np.int64), 2).to_bytes())
    first, count = index.rows(keys)
    assert first.tolist() == list(range(len(keys))) and set(count) == {1}
    assert index.rows(keys[:200] + 1)[1].sum() <= 1  # a stranger passes with probability 2**-32
    assert len(PerfectHash.of(keys[:0]).slots(keys[:3])) == 3


@pytest.mark.parametrize("data", [cases.rows(), []], ids=["rows", "empty"])
def test_queries_digest_every_row(spark, data):
    docs = cases.table(spark, data)
    by_id = lambda r: (r[0] is None, r[0] or 0, r[1:])
    words = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted(((d[0], len((d[1] or "").encode()), n := len(words.encode(d[1] or "", add_special_tokens=False).ids), n > 2048) for d in data), key=by_id)
    assert sorted(map(tuple, token_counts(docs).collect()), key=by_id) == want
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = []
    for d in data:
        ids = model.encode(d[1] or "")
        want.append((d[0], len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256(model.decode(ids).encode()).hexdigest(), ids, model.decode(ids)))
    assert sorted(map(tuple, encode_pieces(docs).collect()), key=by_id) == sorted(want, key=by_id)


@pytest.mark.parametrize("data", [cases.rows(), []], ids=["rows", "empty"])
def test_token_files_round_trip(spark, data):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, want = 0, []
    for d in sorted(data, key=lambda d: (d[0] is None, d[0] or 0, d[1] or "")):
        ids = [*lib.encode(d[1] or "", add_special_tokens=False).ids, 2]
        want.append((d[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = token_files(cases.table(spark, data), shard_bytes=2000)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == want


def test_files_are_keyed(spark, tmp_path):
    docs = cases.table(spark, cases.rows(ids=False))
    manifest = write_token_files(docs, str(tmp_path))
    shards = sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith("."))
    assert len(shards) == 2 * manifest.count()
    for name in shards[1::2]:
        index = ShardIndex.from_bytes((tmp_path / name.replace(".ids", ".idx")).read_bytes())
        assert (index.rows(np.unique(index.keys))[1] == 1).all()
    assert read_token_files(manifest, str(tmp_path)).count() == docs.count()


def test_word_ends_are_pieces_of_their_own():
    """Words put together from a known word and its end have the library's ids."""
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(8)
    signs = "ab cZ9'.,;:!?#$%&*()[]{}<>|/\\\"+-=_~ \né中२Ⅷ²½\u0301"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 50))) for _ in range(3000)]
    texts += ["don't. don'ts, ab's! x's's. 12. 12.5. a-b- '' a' a'. word word. word.. word,", "end " + "w" * 70 + ". " + "v" * 63 + ".,"]
    enc = encoder("byte_bpe_50k.json")
    got = [raw for i in range(0, len(texts), 500) for raw in enc.encode(texts[i:i + 500])]
    assert got == [np.array(lib.encode(t, add_special_tokens=False).ids, enc.dtype).tobytes() for t in texts]


@pytest.mark.parametrize("key", [5, None])
def test_a_hot_key_runs_over_several_shards(spark, tmp_path, key):
    data = [(key, "the same words") for _ in range(300)] + [(key, "z" * 200 + str(i)) for i in range(300)] + [(i, "other") for i in range(600, 1200)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    manifest = write_token_files(docs, str(tmp_path), shard_bytes=4000)
    shards = [r["n_docs"] for r in manifest.collect()]
    assert sum(shards) == 1200 and max(shards) < 200
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((str(k), zlib.crc32(np.array([*lib.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes())) for k, t in data)
    got = sorted(read_token_files(manifest, str(tmp_path)).collect(), key=lambda r: r["start"])
    assert sorted((str(r["doc_id"]), r["ids_crc32"]) for r in got) == want
    assert [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got[:-1]]]).tolist()
    assert [r["doc_id"] for r in got] == sorted((k for k, _ in data), key=lambda k: (k is None, k or 0))
