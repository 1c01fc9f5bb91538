"""Importance resampling against a plain version, and its Arrow kernels against plain loops."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sluiceway.llm.arrow_words import words_of
from sluiceway.llm.resampling import features, resampled
from tests.llm.test_documents import prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [None, "", " ", "a", "A b", "  Ünï coDé İ ß 漢字 x", "a\x00b\x7fc", "x" * 5000, "a " * 300, "tie tie", "tie tie"]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def runs(text, longest):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def plain(docs, target, longest=2, buckets=10_000, percent=25, least=20, seed=7):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(bucket(f) for _, d in docs for f in runs(d, longest)), Counter(bucket(f) for d in target for f in runs(d, longest))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    rows = []
    for i, d in docs:
        found = [gain(bucket(f)) for f in runs(d, longest)]
        weight = sum(found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(words(d))))
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    rank = Counter()
    drawn = Counter()
    for place, r in enumerate(able[: len(able) * percent // 100], 1):
        rank[(*r[:4], place)] += 1
        drawn[r[:4]] += 1
    left = Counter(r[:4] for r in rows) - drawn
    return rank + Counter({(*r, None): n for r, n in left.items()})


def test_words_are_those_of_the_pattern():
    found, parents = words_of(pa.array(ODD))
    got = [[] for _ in ODD]
    for w, p in zip(found.to_pylist(), parents, strict=True):
        got[p].append(w)
    assert got == [words(t) for t in ODD]


@pytest.mark.parametrize("longest", [1, 2, 3, 5])
def test_features_against_plain_runs(longest):
    draw = random.Random(longest)
    texts = [*ODD, *(prose(draw, draw.randrange(40), 9) for _ in range(60))]
    found, parents = words_of(pa.array(texts))
    got = [Counter() for _ in texts]
    for buckets, owner in features(found, parents, longest, 997):
        assert len(buckets) == len(owner)
        for b, p in zip(buckets.tolist(), owner.tolist(), strict=True):
            got[p][b] += 1
    assert got == [Counter(zlib.crc32(f.encode()) % 997 for f in runs(t, longest)) for t in texts]
    nothing = list(features(*words_of(pa.array([None, ""])), longest, 10))
    assert all(len(b) == 0 for b, _ in nothing)


def test_against_a_plain_version(session, docs):
    draw = random.Random(4)
    texts = [*enumerate(ODD), *((100 + i, prose(draw, draw.randrange(60), 30)) for i in range(200))]
    texts += [(100, "again " * 30), (100, "again " * 30), (None, "no id " * 30), (None, "no id " * 30), (7, prose(draw, 50_000, 500))]
    target = [prose(draw, 40, 12) for _ in range(5)] + [None, ""]
    frame = session.createDataFrame([(t,) for t in target], "text string")
    for options in ({}, {"longest": 3, "buckets": 50, "percent": 60, "least_words": 1, "seed": 9}):
        got = Counter(tuple(r) for r in resampled(docs(texts), frame, **options).collect())
        names = {"least_words": "least"}
        assert got == plain(texts, target, **{names.get(k, k): v for k, v in options.items()})


def test_empty_tables_and_kept_columns(session, docs, rows):
    empty, target = session.createDataFrame([], "text string"), session.createDataFrame([("w1 w2",)], "text string")
    assert rows(resampled(docs([]), target)) == []
    texts = [(i, "a b c " * 10) for i in range(8)]
    found = resampled(docs(texts), empty, keep=["text", "bucket"])
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank", "text", "bucket"]
    assert sorted(r["rank"] for r in found.filter("rank IS NOT NULL").collect()) == [1, 2]
    assert {r["text"] for r in found.collect()} == {"a b c " * 10}


def test_ranks_are_whole_over_many_ranges(session):
    draw = random.Random(1)
    many = session.createDataFrame([(i % 500, prose(draw, 25, 5)) for i in range(1500)], "doc_id bigint, text string").repartition(13)
    found = resampled(many, many.limit(20), percent=100)
    ranks = np.array(sorted(r["rank"] for r in found.collect()))
    assert (ranks == np.arange(1, 1501)).all()
    ordered = [tuple(r) for r in found.orderBy("rank").select("score", "doc_id").collect()]
    assert ordered == sorted(ordered, key=lambda r: (-r[0], r[1]))
