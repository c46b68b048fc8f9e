"""Best-fit packing by rounds."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from icuriver.llm import residual_packing
from icuriver.llm.catalog import QUERIES
from tests.llm.made_texts import SF

JSON = public_tokenizers.path("byte_bpe_50k.json")


def lower_bound(sizes, most):
    """Sequences that no packing can do without: by sum, and by items of over half a sequence and what does not fit beside them."""
    sizes, best = np.sort(np.array(sizes)), -(-int(sum(sizes)) // most)
    for k in range(1, most // 2 + 1, max(1, most // 64)):
        large, half = sizes[sizes > most - k], sizes[(sizes <= most - k) & (sizes > most / 2)]
        small = sizes[(sizes <= most / 2) & (sizes >= k)]
        best = max(best, len(large) + len(half) + max(0, -(-int(small.sum() - (len(half) * most - half.sum())) // most)))
    return best


def check(rows, texts, most=1024, end=2, near=1.0):
    """Every document's ids, once and in order, in sequences without gaps; returns the number of sequences."""
    tokenizer = Tokenizer.from_file(JSON)
    wanted, got, sequences = defaultdict(list), defaultdict(list), defaultdict(list)
    for name, text in texts:
        wanted[name].append([*tokenizer.encode(text or "", add_special_tokens=False).ids, end])
    for r in rows:
        got[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    sizes = []
    assert set(got) == set(wanted)
    for name, lists in wanted.items():
        pieces = []
        for ids in lists:
            first, at = (len(ids) - 1) % most + 1, 0
            for k, length in enumerate([first] + [most] * ((len(ids) - first) // most)):
                pieces.append((k, at, length, zlib.crc32(np.array(ids[at : at + length], "<u4").tobytes())))
                at += length
            assert at == len(ids)
        assert sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got[name]) == sorted(pieces)
        sizes += [p[2] for p in pieces]
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= most
    bound = lower_bound(sizes, most)
    assert len(sequences) <= near * bound + 2, (len(sequences), bound)
    return len(sequences)


def test_whole_documents_in_few_sequences(spark, few_docs):
    check(QUERIES["op13_best_fit_packing"](spark, SF).collect(), few_docs[1], near=1.005)
    many = residual_packing.pack_best_fit(few_docs[0].repartition(16), JSON)
    rows = many.collect()
    check(rows, few_docs[1], near=1.005)
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in rows)


@pytest.mark.parametrize("window", [7, 40])
def test_rounds_with_small_windows_lose_nothing(spark, few_docs, window, monkeypatch):
    monkeypatch.setattr(residual_packing, "WINDOW", window)
    rows = residual_packing.pack_best_fit(few_docs[0].repartition(8), JSON, tokens=300).collect()
    check(rows, few_docs[1], most=300, near=1.15)


def test_sequences_that_fit_nowhere_end_the_rounds(spark, monkeypatch):
    monkeypatch.setattr(residual_packing, "WINDOW", 20)
    bins = spark.range(500).select(F.col("id").alias("bin"), F.lit(600).cast("long").alias("fill"))
    placed = residual_packing.merge_rounds(bins, 1024, 30).collect()
    assert sorted(r.bin for r in placed) == sorted(r.sequence_id for r in placed) == list(range(500))
    mixed = spark.range(500).select(F.col("id").alias("bin"), F.expr("if(id % 2 = 0, 600L, 424L)").alias("fill"))
    placed = residual_packing.merge_rounds(mixed, 1024, 30).collect()
    assert sorted(r.bin for r in placed) == list(range(500)) and len({r.sequence_id for r in placed}) <= 300
    assert residual_packing.merge_rounds(bins.limit(0), 1024, 3).count() == 0


def test_defined_results(spark, odd_docs, no_docs):
    texts = [(r.doc_id, r.text) for r in odd_docs.collect()]
    check(residual_packing.pack_best_fit(odd_docs, JSON).collect(), texts)
    check(residual_packing.pack_best_fit(odd_docs.repartition(5), JSON, tokens=1, ids=False).collect(), texts[:0] or texts, most=1)
    out = residual_packing.pack_best_fit(no_docs, JSON)
    assert out.count() == 0 and out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"]
    named = spark.createDataFrame([("a", "some text"), (None, None)], "doc_id string, text string").repartition(6)
    assert {r.doc_id for r in residual_packing.pack_best_fit(named, JSON).collect()} == {"a", None}
    with pytest.raises(ValueError):
        residual_packing.pack_best_fit(no_docs, JSON, tokens=0)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60))
def test_best_fit_leaves_the_least_room(sizes):
    bins, places, fills = residual_packing.best_fit_decreasing(np.array(sizes, np.int64), 30)
    room, plain = [], []
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        fitting = [(r, b) for b, r in enumerate(room) if r >= sizes[k]]
        if fitting:
            b = min(fitting)[1]
        else:
            b = len(room)
            room.append(30)
        room[b] -= sizes[k]
        plain.append(b)
    assert len(fills) == len(room) and sorted(fills.tolist()) == sorted(30 - r for r in room)
    for b in range(len(fills)):
        inside = sorted((places[k], sizes[k]) for k in np.flatnonzero(bins == b))
        assert [p for p, _ in inside] == [0, *np.cumsum([s for _, s in inside])[:-1]]
        assert sum(s for _, s in inside) == fills[b] <= 30
