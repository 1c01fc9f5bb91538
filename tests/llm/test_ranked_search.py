"""Ranked lexical search against a plain version of the formula."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sluiceway.llm.ranked_search import classes, ranked
from tests.llm.test_documents import prose
from tests.llm.test_resampling import LOWER


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(docs, items, k=10):
    held = [(i, Counter(words(t)), len(words(t))) for i, t in docs if words(t)]
    n_docs, n_words = len(held), sum(n for *_, n in held)
    df = Counter(w for _, bag, _ in held for w in bag)
    out = Counter()
    for item, text in items:
        wanted, found = Counter(words(text)), []
        for i, bag, n in held:
            m = 25 + (75 * n * n_docs) // n_words
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * bag[w]) // (1000 * bag[w] + 8 * m))
                for w, times in wanted.items() if bag[w]
            )
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out.update((item, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found)[:k], 1))
    return out


def texts(draw, n):
    """Prose, and copies of a few: some equal, some with the same words in another order, some with more of other words."""
    base = [prose(draw, draw.randrange(1, 60), 40) for _ in range(n)]
    mixed = [" ".join(draw.sample(t.split(), len(t.split()))) for t in base[:10]]
    return base + base[:5] * 30 + mixed + [t + " other" * 3 for t in base[:10]] + [None, "", "...", "W1, w2!", "only other words", "x" * 3000, "w1 " * 20_000]


@pytest.mark.parametrize(("pairs", "cells"), [(1 << 18, 1 << 21), (20, 64)])
def test_against_a_plain_version(session, docs, pairs, cells):
    draw = random.Random(3)
    rows = list(enumerate(texts(draw, 60)))
    draw.shuffle(rows)
    rows += [(3, "w1 w2 w3"), (3, "w1 w2 w3"), (None, "w1 w2 w3"), (None, "w1")]
    items = [(i, prose(draw, draw.randrange(1, 12), 45)) for i in range(12)] + [(0, "w1 W1 w2"), (0, "w1 W1 w2"), (20, None), (21, "?"), (22, "unseen"), (None, "w3")]
    frame = session.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "'x' AS terms", "'y' AS item", "'z' AS doc_id")
    found = ranked(docs(rows).repartition(5), frame, pairs_at_once=pairs, cells=cells)
    assert found.schema.simpleString() == "struct<item_id:bigint,rank:int,doc_id:bigint,score:bigint>"
    assert Counter(tuple(r) for r in found.collect()) == plain(rows, items)


def test_empty_tables(session, docs, rows):
    items = session.createDataFrame([(1, "w1")], "item_id bigint, text string")
    assert rows(ranked(docs([]), items)) == []
    assert rows(ranked(docs([(1, "w1")]), items.limit(0))) == []
    assert rows(ranked(docs([(1, None), (2, "!")]), items)) == []


def test_a_class_holds_its_first_members_and_other_vectors_stay_apart(session):
    held = [(i, 30, [1, 2], [1, 1]) for i in range(5000, 0, -1)] + [(7, 30, [1, 2], [1, 2]), (8, 31, [1, 2], [1, 1]), (None, 30, [1, 2], [1, 1])]
    found = classes(session.createDataFrame(held, "doc_id bigint, m bigint, terms array<int>, tfs array<bigint>").repartition(8), 3)
    assert {(r["m"], tuple(r["tfs"]), tuple(d["doc_id"] for d in r["members"])) for r in found.collect()} == {
        (30, (1, 1), (1, 2, 3)), (30, (1, 2), (7,)), (31, (1, 1), (8,)),
    }


def test_copies_cross_the_network_as_few_rows(session):
    """Of a class that holds all documents, a map task sends on no more than ``k``."""
    many = session.range(20_000).select(F.col("id").alias("doc_id"), F.expr("id div 100000 AS m"), F.expr("array(cast(id div 100000 AS int)) AS terms"), F.expr("array(id div 100000) AS tfs"))
    plan = classes(many, 10)._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle and plan.count("Exchange hashpartitioning") == 1
