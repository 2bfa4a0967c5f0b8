"""Operator 11 against a plain version that encodes whole texts and lists every link."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seatlens.llm import alignment as A
from seatlens.llm import queries
from tests.llm import helpers as H

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _fuzz(seed: int, many: int) -> list[str]:
    rng = random.Random(seed)
    alphabet = "ab aabb  \n\t '’é😀ßñ0129%$.,ABxyz　\x1c\x85\x0b中文́don't▁"
    out = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(120))) for _ in range(many)]
    out += ["".join(chr(rng.randrange(0x20, 0x2FFF)) for _ in range(60)) for _ in range(many // 5)]
    out += ["a" * 3000, "ab" * 1500, " " * 500, " ", "  ", "x ", " x", "x  ", "\n \n\n  x", "▁", "a ▁b", "\x00 \x00"]
    return [*out, "<|endoftext|> a<|endoftext|>", "<s> </s><unk>", "Hello  world \n it's 5%  ", "é è  à ."]


class Plain:
    """Whole texts, token by token."""

    def __init__(self) -> None:
        self.a = Tokenizer.from_file(BYTES)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
        letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
        of = {chr(b): b for b in letters}
        of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in letters)}
        self.token = {i: bytes(of[c] for c in t) for t, i in self.a.get_vocab().items() if t != "<|endoftext|>"}

    def groups(self, text: str | None) -> list[tuple[list[int], list[int]]]:
        if not text:
            return []
        ids_a, ids_b = self.a.encode(f" {text}", add_special_tokens=False).ids, self.b.encode(text)
        piece = lambda i: bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()  # noqa: E731,E501
        bytes_a, bytes_b = [self.token[i] for i in ids_a], [piece(i) for i in ids_b]
        if b"".join(bytes_a) != b" " + text.encode() or b"".join(bytes_b) != b" " + text.encode():
            return []
        end_a, end_b = np.cumsum([len(t) for t in bytes_a]).tolist(), np.cumsum([len(t) for t in bytes_b]).tolist()
        out, i, j = [], 0, 0
        for end in sorted(set(end_a) & set(end_b)):
            x, y = end_a.index(end, i) + 1, end_b.index(end, j) + 1
            out.append((ids_a[i:x], ids_b[j:y]))
            i, j = x, y
        return out


def _expected(texts: list[str | None]) -> tuple[list[tuple], dict[tuple, tuple]]:
    plain = Plain()
    each = [plain.groups(t) for t in texts]
    links = [Counter((a, b) for x, y in g for a in x for b in y) for g in each]
    documents = Counter(p for one in links for p in one)
    most: dict[int, int] = defaultdict(int)
    for (a, _), n in documents.items():
        most[a] = max(most[a], n)
    rows = []
    for g, own in zip(each, links, strict=True):
        line = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in g)
        rows.append((
            sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(own.values()),
            sum(m for p, m in own.items() if documents[p] == most[p[0]]), sum(m * documents[p] for p, m in own.items()),
            hashlib.sha256(line.encode()).hexdigest() if line else "",
        ))
    total = sum(links, Counter())
    return rows, {p: (n, total[p], n == most[p[0]]) for p, n in documents.items()}


@pytest.mark.parametrize("small", [False, True])
def test_alignment_equals_whole_texts(spark, sf_dir, monkeypatch, small):
    """Also with segments, memory and hot pairs so small that everything is split."""
    if small:
        rows = [(i, t) for i, t in enumerate([*_fuzz(1, 60), None, "", H.PROSE, H.PROSE])]
        monkeypatch.setattr(A, "HOT_SEGMENTS", 1)
        monkeypatch.setattr(A, "BROADCAST_ROWS", 5)
    else:
        rows = [(i, t) for i, t in enumerate(_fuzz(2, 200))]
        rows += [(1000 + r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = A.align(docs, BYTES, PIECES, keep_groups=small)
    want, pairs = _expected([t for _, t in rows])
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in found.documents.collect()}
    assert got == dict(zip([i for i, _ in rows], want, strict=True))
    assert {(r.a, r.b): (r.documents, r.links, r.best) for r in found.pairs.collect()} == pairs
    written = found.documents.where(F.sha2("groups", 256) != F.col("groups_sha256")).where("groups <> ''").count()
    assert written == 0 and found.documents.where("groups IS NOT NULL").count() == (len(rows) if small else 0)


def test_forgetting_and_small_segments_change_nothing(monkeypatch):
    """The batches of one task, put together again, whatever is cut where."""
    texts = _fuzz(3, 150) + [H.PROSE] * 40
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])

    class Task:
        partitionId = staticmethod(lambda: 3)

    monkeypatch.setattr(A.TaskContext, "get", staticmethod(lambda: Task))

    def postings() -> tuple[dict, Counter]:
        facts, links, place = {}, Counter(), {}
        held = []
        for out in A._align(iter([batch]), BYTES, PIECES, False):
            for r in out.to_pylist():
                if r["pair"] is None:
                    facts[r["id"]] = tuple(r[c] for c in [*A._FACTS, "groups_sha256"])
                    place[r["segment"], r["low"]] = r["id"]
                else:
                    held.append((r["segment"], r["pair"], r["plane"], r["docs"]))
        for segment, pair, plane, docs in held:
            for low in A.unpacked(pa.array([docs], pa.binary()))[0].tolist():
                links[place[segment, low], pair] += 1 << max(plane - 1, 0)
        return facts, links

    whole = postings()
    monkeypatch.setattr(A, "SEGMENT_BYTES", 1000)
    monkeypatch.setattr(A, "REMEMBERED", 3000)
    monkeypatch.setattr(A.W, "SLICE_BYTES", 400)
    assert postings() == whole


def test_bitmaps_keep_every_document_and_count():
    rng = np.random.default_rng(1)
    many = {7: 60_000, 8: 4096, 9: 4095, 10: 1, 11: 65_536}
    pair = np.concatenate([np.full(n, p) for p, n in many.items()])
    low = np.concatenate([np.sort(rng.permutation(65_536)[:n]) for n in many.values()])
    times = rng.integers(1, 40, len(pair)) ** 5
    total = np.zeros((12, 65_536), dtype=np.int64)
    for own, plane, docs in A.bitmaps(pair, low, times):
        at, owner = A.unpacked(docs)
        np.add.at(total, (own[owner], at), (1 << np.maximum(plane - 1, 0))[owner])
        assert all(len(d) <= 8192 for d in docs.to_pylist())
    want = np.zeros_like(total)
    want[pair, low] = times
    assert (total == want).all()


@pytest.mark.parametrize("clashes", [False, True])
def test_alignment_of_odd_rows(spark, clashes):
    rows = [(r[0], r[1]) for r in H.ODD]
    want, _ = _expected([t for _, t in rows])
    found = A.align(H.odd_docs(spark, clashes), BYTES, PIECES).documents.collect()
    key = lambda r: tuple(map(str, r))  # noqa: E731 - ids may be null or repeat
    got = sorted(((r.doc_id, *[r[c] for c in COLUMNS]) for r in found), key=key)
    assert got == sorted(((i, *w) for (i, _), w in zip(rows, want, strict=True)), key=key)
    nothing = A.align(H.no_docs(spark), BYTES, PIECES)
    assert nothing.documents.collect() == [] and nothing.pairs.collect() == []


def test_registered_query(spark, sf_dir):
    found = queries.queries()["op11_tokenizer_alignment"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert set(found.columns) == {"doc_id", *COLUMNS}
    assert found.count() == docs.count() and found.where("n_links > 0").count() > 100
