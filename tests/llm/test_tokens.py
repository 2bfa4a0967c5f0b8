from __future__ import annotations

import base64
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seatlens.llm import bpe, packing
from seatlens.llm import words as W
from tests.llm import helpers as H

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def _fuzz(seed: int, many: int) -> list[str]:
    rng = random.Random(seed)
    alphabet = "ab aabb\n\t '’é😀ßñΣİ0129%$.,ABxyz　\x1c\x85\x0b中文́don't"
    out = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(200))) for _ in range(many)]
    out += ["".join(chr(rng.randrange(0x20, 0x2FFF)) for _ in range(100)) for _ in range(many // 10)]
    out += [base64.b64encode(rng.randbytes(200)).decode() for _ in range(many // 10)]
    return [*out, "a" * 5000, "ab" * 3000, " " * 2000, "\n \n\n  x", "ababababa abcabcabc aaaaaaa " * 50]


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.vocabulary(RANKS).ranks
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_equals_tiktoken_and_decodes(spark, sf_dir, reference):
    own = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(_fuzz(1, 300))], "doc_id long, text string")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").union(own)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    coded = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in coded} == {
        i: reference.encode_ordinary(t) for i, t in texts.items()
    }
    assert all(bytes(r.decoded) == texts[r.doc_id].encode() for r in coded)


def test_forgetting_and_order_change_nothing(monkeypatch):
    texts = _fuzz(2, 200)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])

    def ids() -> list[bytes]:
        return [x for b in bpe._encode(iter([batch]), RANKS, public_tokenizers.PATTERN) for x in b.column(1).to_pylist()]

    whole = ids()
    monkeypatch.setattr(bpe, "REPLAY_BYTES", 500)
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    assert ids() == whole


def test_irregular_ranks_are_merged_piece_by_piece(tmp_path):
    """A vocabulary in which a merge brings up a pair of lower rank, against the plain rule."""
    tokens = [bytes([b]) for b in range(256)] + [b"yx", b"xyx", b"xy", b"xyxy", b"yxy", b"ab", b"abab", b"bab"]
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens)))
    words, rng = bpe.Vocabulary(str(path)), random.Random(3)

    def plain(piece: bytes) -> list[int]:
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: words.ranks.get(parts[i] + parts[i + 1], 1 << 40))
            if parts[best] + parts[best + 1] not in words.ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [words.ranks[p] for p in parts]

    pieces = ["".join(rng.choice("xyab") for _ in range(rng.randrange(1, 15))).encode() for _ in range(2000)]
    ids, ends = bpe.replay(pieces, words)
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == [plain(p) for p in pieces]
    assert [words.one_by_one(p) for p in pieces] == [plain(p) for p in pieces]


@pytest.mark.parametrize("clashes", [False, True])
def test_bpe_on_odd_rows(spark, clashes):
    rows = bpe.encode(H.odd_docs(spark, clashes), RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(H.ODD)
    assert {r.doc_id for r in rows if not r.ids} == {1, 2, None}
    assert bpe.encode(H.no_docs(spark), RANKS, public_tokenizers.PATTERN).collect() == []
    nulls = spark.createDataFrame([(1, None), (2, bytearray(b"\x01\0\0\0"))], "doc_id long, ids binary")
    assert {r.doc_id: r.decoded for r in bpe.decode(nulls, RANKS).collect()} == {1: None, 2: bytearray(b'"')}


def test_words_equal_the_whole_text():
    tokenizer = Tokenizer.from_file(WORDS)
    texts = [*_fuzz(4, 500), "<|endoftext|>", "x<|endoftext|>y z <|startoftext|>", "é ́e a ́", "Σας ΟΔΟΣ ΟΔΟΣ. ΑΣ"]
    texts += ["<|ENDOFTEXT|> A<|endoftext|>B,<|endoftext|>.", "It's it'S x-'s a.'s '.s IT'RE,don't", "a.b,c 5%x 10,000.5 (A)"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    own, got = packing.Words(WORDS), []
    for _ in range(2):  # the second time all words are known
        got += [ids.tolist() for part in W.slices(batch) for ids in own.encode(part)]
    assert got == 2 * [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_capitals_with_combining_marks():
    """A lower-case letter may compose with a mark where its capital doesn't."""
    marks = [chr(c) for c in range(0x300, 0x370)]
    texts = ["H\u0331 J\u030c T\u0308 W\u030a Y\u030a", "J\u030cala", "aJ\u030cB.c=J\u030c<J\u030c x\u030cJ"]
    texts += [" ".join(f"{c}{m}ala {c}{m} x{c}{m},{c}" for c in map(chr, range(33, 127))) for m in marks]
    tokenizer, own = Tokenizer.from_file(WORDS), packing.Words(WORDS)
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    got = [ids.tolist() for part in W.slices(batch) for ids in own.encode(part)]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def _regular(size: int, a: str, b: str) -> str:
    """The Thue-Morse word, which sums over powers don't tell from its complement."""
    return "".join(a if i.bit_count() % 2 == 0 else b for i in range(size))


@pytest.mark.parametrize("size", [256, 257, 1024, 4096, 65536])
def test_regular_words_have_hashes_of_their_own(size):
    x, y = _regular(size, "a", "b"), _regular(size, "b", "a")
    batch = pa.RecordBatch.from_arrays([pa.array([f"{x} {y}\n{x}", y, "", x * 2, y + x])], names=["text"])
    (texts,) = W.slices(batch)
    found = W.words(texts)
    hashed = W.hashes(texts.data, found.start, found.end).tolist()
    assert hashed[0] == hashed[2] and hashed[1] == hashed[3] and len(set(hashed)) == 4
    assert W.hashes(texts.data[1:], found.start[:1], found.end[:1] - 1)[0] not in hashed
    tokenizer, own = Tokenizer.from_file(WORDS), packing.Words(WORDS)
    got = [ids.tolist() for part in W.slices(batch) for ids in own.encode(part)]
    assert got == [tokenizer.encode(t.as_py(), add_special_tokens=False).ids for t in batch.column(0)]


def test_forgotten_words_are_looked_up_again(monkeypatch):
    batch = pa.RecordBatch.from_arrays([pa.array(_fuzz(5, 100))], names=["text"])
    whole = [ids.tolist() for part in W.slices(batch) for ids in packing.Words(WORDS).encode(part)]
    monkeypatch.setattr(W, "SLICE_BYTES", 300)
    monkeypatch.setattr(packing, "REMEMBERED", 200)
    monkeypatch.setattr(packing._Known, "FRESH", 3)
    own = packing.Words(WORDS)
    assert [ids.tolist() for part in W.slices(batch) for ids in own.encode(part)] == whole


def _check(pieces, texts: list[tuple]) -> float:
    """All ids once, checksums, sequences without gaps; the share of the sequences that is filled."""
    tokenizer = Tokenizer.from_file(WORDS)
    coded = sorted(
        (str(i), *[int(x) for x in tokenizer.encode(t or "", add_special_tokens=False).ids], 1) for i, t in texts
    )
    starts = [p for p in pieces if p.start == 0]
    assert sorted((str(p.doc_id), p.doc_tokens) for p in starts) == sorted((c[0], len(c) - 1) for c in coded)
    tokens = _by_id(coded)
    for p in pieces:
        assert any(
            len(c) - 1 == p.doc_tokens
            and p.ids_crc32 == zlib.crc32(np.array(c[1 + p.start : 1 + p.start + p.length], "<u4").tobytes())
            for c in tokens[str(p.doc_id)]
        )
    assert sum(p.length for p in pieces) == sum(len(c) - 1 for c in coded)
    sequences: dict[int, list] = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        own = sequences.setdefault(p.sequence_id, [])
        assert p.offset == sum(q.length for q in own) and p.length > 0
        own.append(p)
    assert all(sum(p.length for p in own) <= packing.LENGTH for own in sequences.values())
    return sum(p.length for p in pieces) / (packing.LENGTH * len(sequences))


def _by_id(coded: list[tuple]) -> dict[str, list[tuple]]:
    out: dict[str, list[tuple]] = {}
    for c in coded:
        out.setdefault(c[0], []).append(c)
    return out


@pytest.mark.parametrize("fan_in", [32, 2])
def test_packing(spark, monkeypatch, fan_in):
    monkeypatch.setattr(packing, "FAN_IN", fan_in)  # two: several rounds of merging
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(6)
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    assert _check(packing.pack(docs, WORDS).collect(), texts) > 0.97


@pytest.mark.parametrize("clashes", [False, True])
def test_packing_odd_rows(spark, clashes):
    docs = H.odd_docs(spark, clashes)
    pieces = packing.pack(docs, WORDS).collect()
    _check(pieces, [(r[0], r[1]) for r in H.ODD])
    assert [p.doc_tokens for p in pieces if p.doc_id == 1] == [1]
    assert packing.pack(H.no_docs(spark), WORDS).collect() == []


def test_windows_keep_their_bound():
    windows = packing.Windows(10, 2)
    assert windows.put(windows.best(6), 6, ["a"]) is None
    assert windows.best(5) is None and windows.best(4) == 0
    assert windows.put(None, 7, ["b"]) is None and windows.full()
    assert windows.best(3) == 1  # the fullest with room
    assert windows.put(1, 3, ["c"]) == ["b", "c"]
    assert list(windows.rest()) == [["a"]]


def test_digest_columns(spark, sf_dir):
    from seatlens.llm import queries

    row = queries.op9_byte_bpe(spark, sf_dir).where(F.col("n_tokens") > 0).first()
    assert len(row.ids_sha256) == len(row.decoded_sha256) == 64
