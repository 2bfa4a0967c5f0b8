from __future__ import annotations

import datetime as dt
import random

import pytest

from seatlens.llm import hamming, revisits


def _brute(base, queries, k):
    out = set()
    pairs = sorted({(i, c) for i, c in base if i is not None and c is not None}, key=str)
    for q, code in {(i, c) for i, c in queries if i is not None and c is not None}:
        near = sorted((bin((code ^ c) & (2**64 - 1)).count("1"), i) for i, c in pairs)[:k]
        out |= {(q, i, d, r + 1) for r, (d, i) in enumerate(near)}
    return out


def _codes(spark, rows):
    return spark.createDataFrame(rows, "id long, code long")


@pytest.mark.parametrize(("many", "k"), [(400, 10), (30, 5), (3, 10)])
def test_top_k_equals_brute_force(spark, many, k):
    rng = random.Random(many)
    centres = [rng.getrandbits(64) - 2**63 for _ in range(5)]
    rows = []
    for i in range(many):
        code = rng.choice(centres)
        for _ in range(rng.choice([0, 0, 1, 3, 9, 25])):
            code ^= 1 << rng.randrange(63)
        rows.append((i, code))
    queries = rows[:: max(1, many // 8)] + [(9999, 0), (9999, 0), (None, 5), (8, None)]
    got = hamming.nearest_codes(_codes(spark, rows), _codes(spark, queries), k).collect()
    assert {tuple(r) for r in got} == _brute(rows, queries, k)
    assert len(got) == len(set(got))


def test_one_code_that_most_rows_have(spark):
    rows = [(i, 77) for i in range(500)] + [(1000 + i, 77 ^ (1 << (i % 60))) for i in range(30)] + [(None, 77), (3, None)]
    got = hamming.nearest_codes(_codes(spark, rows), _codes(spark, [(1005, 77 ^ 32)]), 4).collect()
    assert {tuple(r) for r in got} == _brute(rows, [(1005, 77 ^ 32)], 4)


def test_nothing_to_search(spark):
    none, one = _codes(spark, []), _codes(spark, [(1, 5)])
    assert hamming.nearest_codes(none, one).collect() == []
    assert hamming.nearest_codes(one, none).collect() == []


def test_sign_codes(spark):
    rows = [(1, [1.0, -1.0, 0.0, 2.0]), (2, [0.5] * 65), (3, None), (4, []), (5, [None, 3.0])]
    df = spark.createDataFrame(rows, "id long, v array<float>")
    got = {r.id: r.code for r in df.select("id", hamming.sign_code(df.v).alias("code")).collect()}
    assert got == {1: 9, 2: -1, 3: None, 4: 0, 5: 2}


_RECORD = (
    "record_id long, url string, captured timestamp, record_type string, headers map<string,string>,"
    " payload_digest string, status int, target string"
)


def _at(hours: float) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours)


def _resolve(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], _RECORD)
    return {r.record_id: r for r in revisits.resolve_revisits(df).collect()}


def test_revisits(spark):
    url, tag = "http://Site.example.org:80/a/?b=2&utm_source=x&a=1#top", {"ETag": '"t"', "X-Own": "1", "Date": "d0", "Content-Length": "9"}
    same = "https://site.example.org/a?a=1&b=2"
    got = _resolve(
        spark,
        [
            (1, url, _at(0), "response", tag, "body1"),
            (2, same, _at(0), "revisit", {"etag": '"t"'}, None),  # not strictly later
            (3, same, _at(0.5), "revisit", {"etag": 'W/"t"', "date": "d3", "content-length": "0", "x-other": "2"}, "lies"),
            (4, same, _at(100), "revisit", {"etag": '"u"'}, None),
            (5, same, _at(200), "response", {"Last-Modified": "m"}, "body5"),
            (6, same, _at(200), "response", {"Last-Modified": "n"}, "body6"),  # ties go to the larger id
            (7, same, _at(300), "revisit", {"last-modified": "n"}, None),
            (8, same, _at(300), "revisit", {"last-modified": "m"}, None),
            (9, same, _at(300), "revisit", {}, None),
            (10, same, _at(300), "revisit", None, None),
            (11, "http://other.example.org/", _at(300), "revisit", {"etag": '"t"'}, None),
            (12, None, _at(300), "revisit", {"etag": '"t"'}, None),
            (13, same, None, "revisit", {"etag": '"t"'}, None),
            (14, same, _at(301), None, {"etag": '"t"'}, None),
            (15, "", _at(301), "response", {}, "b"),
        ],
    )
    status = {i: r.status for i, r in got.items()}
    assert status == {
        1: "full", 2: "no response", 3: "resolved", 4: "mismatch", 5: "full", 6: "full", 7: "resolved", 8: "mismatch",
        9: "no validator", 10: "no validator", 11: "no response", 12: "no response", 13: "no response", 14: "other", 15: "full",
    }
    assert (got[3].target_id, got[3].payload_digest) == (1, "body1")
    assert [tuple(h) for h in got[3].headers] == [("content-length", "9"), ("date", "d3"), ("etag", 'W/"t"'), ("x-own", "1")]
    assert (got[7].target_id, got[7].payload_digest) == (6, "body6")
    assert (got[4].target_id, got[4].payload_digest) == (None, None)
    assert got[1].canonical_url == got[3].canonical_url == "site.example.org/a?a=1&b=2"


def test_many_captures_of_one_url_and_repeated_rows(spark):
    rows = []
    for i in range(400):
        kind = "response" if i % 7 == 0 else "revisit"
        rows.append((i, "http://hot.example.org/", _at(i / 3), kind, {"etag": f'"{i // 7}"'}, str(i) if kind == "response" else None))
    got = _resolve(spark, rows)
    assert all(got[i].target_id == i - i % 7 and got[i].payload_digest == str(i - i % 7) for i in range(400))
    df = spark.createDataFrame([(*r, 1, "x") for r in rows[:3] * 2], _RECORD)
    assert revisits.resolve_revisits(df).count() == 6
    assert revisits.resolve_revisits(df.limit(0)).collect() == []
