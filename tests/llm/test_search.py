"""Ranked search against a plain scoring of every document."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from icuriver.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k):
    """Rows (item, rank, id, score) by scoring everything; equal rows by id, missing ids last."""
    texts = [(name, Counter(terms(t))) for name, t in docs]
    texts = [(name, c, sum(c.values())) for name, c in texts if c]
    total, held = sum(n for *_, n in texts), Counter(t for _, c, _ in texts for t in c)
    asked = {}
    for name, t in items:
        asked.setdefault(name, Counter()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        scored = []
        for name, c, n in texts:
            m = 75 + 25 * n * len(texts) // total
            score = 0
            for t, times in wanted.items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * len(texts) + 2) / (2 * held[t] + 1)))
                    score += times * w * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, name is None, name))
        out += [(item, r, name, -s) for r, (s, _, name) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def ranked(docs, items, k, **options):
    return sorted(((r[0], r[1], r[2], r[3]) for r in ranked_search.rank_documents(docs, items, k, **options).collect()), key=str)


def made(rng, n, length):
    words = ["été", "Ab", "ab", "x1", "世界", "naïve", *[f"w{k}" for k in range(60)]]
    weights = 1 / np.arange(1, len(words) + 1)
    return [" ".join(rng.choice(words, rng.integers(0, length), p=weights / weights.sum())) for _ in range(n)]


@pytest.mark.parametrize("width, together, chunk", [(4096, 1024, 48), (8, 7, 2), (1, 3, 1)])
def test_equals_scoring_everything(spark, monkeypatch, width, together, chunk):
    monkeypatch.setattr(ranked_search, "TOGETHER", together)
    monkeypatch.setattr(ranked_search, "CHUNK", chunk)
    rng = np.random.default_rng(width)
    docs = [(k // 2 if k % 10 == 0 else k, t) for k, t in enumerate(made(rng, 160, 40))] + [(None, "ab w1 w2"), (500, None), (501, ""), (502, "--- !!"), (503, "W1,w1;W2-w3 " * 900)]
    items = [(k, t) for k, t in enumerate(made(rng, 12, 9))] + [(3, "w5 w5 é"), (None, "w7 x1"), (None, "W8"), (90, None), (91, ""), (92, "nowhere")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert ranked(frame, asked, 6, width=width) == plain(docs, items, 6)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", 5)
    rng = np.random.default_rng(4)
    docs, items = list(enumerate(made(rng, 50, 30))), list(enumerate(made(rng, 9, 6)))
    got = ranked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), 3)
    assert got == plain(docs, items, 3)


def test_hot_texts_tie_by_id(spark):
    docs = [(k, "same words here") for k in range(200, 0, -1)] + [(1000 + k, f"other {k}") for k in range(50)]
    got = ranked(spark.createDataFrame(docs, "doc_id long, text string").repartition(7), spark.createDataFrame([(1, "Words HERE")], "item_id long, text string"), 20)
    assert [(r, d) for _, r, d, _ in sorted(got, key=lambda x: x[1])] == [(r, r) for r in range(1, 21)]


def test_defined_results(spark, odd_docs, no_docs):
    pairs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    items = [("a", "plain words w16 été"), (None, "another text"), ("b", "aaaa")]
    asked = spark.createDataFrame([(*i, "x", 1, 2.0) for i in items], "item_id string, text string, name string, term int, score double")
    clashing = odd_docs.withColumnsRenamed({"score": "item", "cut": "task", "lines": "rank"})
    assert ranked(clashing, asked, 4) == plain(pairs, items, 4)
    for docs, wanted in ((no_docs, asked), (odd_docs, asked.limit(0)), (odd_docs.where("text is null"), asked)):
        out = ranked_search.rank_documents(docs, wanted)
        assert out.count() == 0 and out.columns == ["item_id", "rank", "doc_id", "score"]


def test_bounds_are_never_too_small():
    rng = np.random.default_rng(1)
    doc = np.sort(rng.integers(0, 20, 3000))
    hashes = rng.integers(0, 1 << 63, 40, dtype=np.uint64)[rng.integers(0, 40, 3000)]
    m = rng.integers(75, 300, 20)
    for width in (1, 5, 64):
        sketch = ranked_search.max_sketches(hashes, doc, m, width)
        where = ranked_search._coordinate(hashes >> np.uint64(10), width)
        for d in range(20):
            for h in np.unique(hashes):
                tf = int(((doc == d) & (hashes == h)).sum())
                assert sketch[where[hashes == h][0], d] >= (ranked_search.impacts(np.array(tf), m[d]) if tf else 0)
