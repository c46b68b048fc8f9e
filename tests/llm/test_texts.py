"""Operators that look at one text at a time: quality, BPE, licenses, fingerprints, packing, shards."""

import base64
import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from icuriver.llm import bpe, edit_fingerprint, licenses, packing, quality, sharding
from icuriver.llm.catalog import QUERIES
from tests.llm.made_texts import SF

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


def rank_encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


# quality

def test_quality_separates_held_out_labels(spark):
    got = {r.doc_id: r for r in QUERIES["op1_quality"](spark, "/root/testdata/sf0.01").collect()}
    labels = [r for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(got[r.doc_id].held_out for r in labels)
    right = np.mean([got[r.doc_id].predicted == r.quality for r in labels])
    assert right > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())


def test_quality_features_match_a_plain_count():
    texts = ["Und Und und!! 12 ab", "", "x"]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    kinds, among = quality.features(data, np.cumsum([0, *map(len, raw)]))
    assert np.diff(among).tolist() == [6, 0, 1]
    literal = kinds[0][:6].tolist()
    assert literal[0] == literal[1] == literal[2] and len(set(literal)) == 4
    assert kinds[2][1] != kinds[2][0]  # a repeated word has another shape


def test_quality_defined_results(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (4, 0), (4, 1), (None, 1), (6, None), (11, 1)], "doc_id long, quality int")
    weights = quality.fit_quality(odd_docs, labels)
    rows = odd_docs.select("doc_id", "text", quality.quality_score(odd_docs, weights).alias("s"), quality.held_out().alias("h")).collect()
    assert len(rows) == odd_docs.count()
    blank = {r.s for r in rows if not (r.text or "").strip()}
    assert len(blank) == 1 and all(r.h is False for r in rows if r.doc_id is None)
    assert quality.keep_good(odd_docs, weights, least=0.0).columns == odd_docs.columns
    none = quality.fit_quality(no_docs, labels)
    assert not none.any() and quality.keep_good(no_docs, none).count() == 0
    assert {r[0] for r in odd_docs.select(quality.quality_score(odd_docs, none)).collect()} == {0.5}


# pieces and BPE

@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from(list("ab s'tdrevlm'  \n\t12é…ñ世　 😀!?")), max_size=40))
def test_pieces_match_the_pattern(text):
    from icuriver.llm.pieces import piece_starts

    raw = text.encode()
    want, at = [], 0
    for piece in regex.findall(public_tokenizers.PATTERN, text):
        want.append(at)
        at += len(piece.encode())
    assert piece_starts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])).tolist() == want


def test_bpe_matches_the_library_and_round_trips(spark, few_docs, odd_docs):
    encoding = rank_encoding()
    for docs, rows in (few_docs, (odd_docs, [(r.doc_id, r.text) for r in odd_docs.collect()])):
        got = sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids) for r in bpe.encode_texts(docs, RANKS).collect())
        want = []
        for name, text in rows:
            ids = encoding.encode_ordinary(text or "")
            want.append((name or -1, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest(), ids))
        assert got == sorted(want)


def test_bpe_empty_table(no_docs):
    assert bpe.encode_texts(no_docs, RANKS, ids=False).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=40), st.binary(max_size=8), st.integers(0, 40), st.integers(0, 40))
def test_prefix_states_append_and_edit(data, new, i, j):
    encoder = _encoder()
    data = bytes(b"theionaly rst"[b % 13] for b in data)
    i, j = sorted((min(i, len(data)), min(j, len(data))))
    last = encoder.extend([], data)
    assert encoder.tokens(last) == encoder.merged(data)
    assert encoder.extend(encoder.extend([], data[:i]), data) == last
    assert encoder.edit(list(last), data, i, j, new) == (encoder.extend([], data[:i] + new + data[j:]), data[:i] + new + data[j:])


def _encoder(cache=[]):
    if not cache:
        cache.append(bpe.PrefixEncoder(bpe.read_ranks(open(RANKS, "rb").read())))
    return cache[0]


# licenses

def test_license_places_match_a_plain_search(spark, few_docs):
    got = {r.doc_id: r for r in QUERIES["op4_licenses"](spark, SF).collect()}
    for name, text in few_docs[1]:
        words = licenses.words(text)
        places = [(k, label) for p, label in licenses.PHRASES.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        r = got[name]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1


@pytest.mark.parametrize("text, label", [
    ("Licensed under the Apache License, Version 2.0 (the thing)", "apache-2.0"),
    ("licensed under the APACHE license 2", "apache-2.0"),
    ("Licensed under the Apache Public License 2.0", None),
    ("Copyright (c) 2019, 2020 Some Person and others. All rights reserved.", "copyright"),
    ("Copyright Some Person. All rights reserved.", None),
    ("Licensed under CC BY-NC 4.0.", "creative-commons"),
    ("Licensed under CC BY-NC", None),
    ("is licensed under the terms of the GNU General Public License, version 3.", "gpl-notice"),
])
def test_templates_want_their_mandatory_wording(text, label):
    scanner = licenses.Scanner({}, licenses.TEMPLATES)
    raw = text.encode()
    _, spans, covered = scanner.scan(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert {s[0] for s in spans[0]} == ({label} if label else set())
    assert covered[0] == sum(s[2] - s[1] + 1 for s in spans[0])


def test_template_regions():
    template = licenses.TemplateAutomaton("grant of <<optional>>full <<words 1 2>><<end>> rights <<numbers 0 2>>")
    expression = re.compile(r"grant of (full \S+( \S+)? )?rights( \d+){0,2}")
    for text in ("grant of rights", "grant of full a rights 1 2 3", "grant of full a b rights", "grant of full a b c rights", "grant of full rights", "grant of full rights rights 7"):
        words = text.split()
        number = {w: k + 1 for k, w in enumerate(sorted({*words, "grant", "of", "full", "rights"}))}
        ids = np.array([number[w] for w in words])
        digits = np.array([w.isdigit() for w in words])
        found = expression.match(text)
        assert template.longest(ids, digits, 0, len(ids), number) == (len(found[0].split()) if found else -1), text


def test_licenses_defined_results(odd_docs, no_docs):
    rows = licenses.scan_licenses(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r.spans == [] and r.score == 0 for r in rows)
    assert licenses.scan_licenses(no_docs).count() == 0


# fingerprints

def _expected_with_next(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    out = []
    for k, (name, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = map(edit_fingerprint.fingerprint, (text, edited, after))
        digest = hashlib.sha256(edited.encode()).hexdigest()
        out.append((name or -1, len(text), digest, a.hex(), b.hex(), edit_fingerprint.likeness(a, b), edit_fingerprint.likeness(a, c)))
    return sorted(out)


def test_fingerprints_of_neighbours(spark, few_docs, odd_docs, no_docs):
    for docs, rows in (few_docs, (odd_docs, [(r.doc_id, r.text) for r in odd_docs.collect()])):
        got = edit_fingerprint.compare_with_next(docs).collect()
        mine = sorted((r.doc_id or -1, r.n_chars, r.edited_sha256, bytes(r.cells).hex(), bytes(r.edited_cells).hex(), r.near_edited, r.near_next) for r in got)
        assert mine == _expected_with_next(rows)
    assert edit_fingerprint.compare_with_next(no_docs).count() == 0
    one = spark.createDataFrame([(1, "alone here")], "doc_id long, text string")
    assert edit_fingerprint.compare_with_next(one).collect()[0].near_next == 1.0


def test_few_edits_keep_most_samples(few_docs):
    rng = np.random.default_rng(5)
    near, far = [], []
    texts = [t for _, t in few_docs[1] if len(t) > 300][:40]
    for k, text in enumerate(texts):
        at = int(rng.integers(0, len(text)))
        edited = text[:at] + "x" + text[at + int(rng.integers(0, 2)) :]
        near.append(edit_fingerprint.likeness(edit_fingerprint.fingerprint(text), edit_fingerprint.fingerprint(edited)))
        far.append(edit_fingerprint.likeness(edit_fingerprint.fingerprint(text), edit_fingerprint.fingerprint(texts[k - 1])))
    assert np.mean(near) > 0.8 and np.mean(far) < 0.2


def test_near_edits_are_found_and_verified(spark):
    from tests.llm.made_texts import sentence

    base = [" ".join(sentence(k + j, 30) for j in range(4)) + f" {k * 7919}" for k in range(12)]
    rows = [(k, t) for k, t in enumerate(base)] + [(100 + k, t[:50] + "!" + t[51:]) for k, t in enumerate(base)] + [(200, None), (None, base[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.a, r.b): r.distance for r in edit_fingerprint.near_edits(docs, least=0.9).collect()}
    assert all(got.get((k, 100 + k)) == 1 for k in range(12))
    texts = dict(r for r in rows if r[0] is not None)
    for (a, b), d in got.items():
        assert d == edit_fingerprint.edit_distance(texts[a], texts[b]) <= 0.1 * max(len(texts[a]), len(texts[b]))


@pytest.mark.parametrize("kind", ["replaced", "inserted", "deleted"])
def test_near_edits_recall_at_the_limit(spark, kind):
    """Edits of almost one character in fifty at even random places, against the distances of all pairs."""
    rng = np.random.default_rng(["replaced", "inserted", "deleted"].index(kind))
    texts = []
    for k in range(30):
        words = ["".join(rng.choice(list("etaoinshrdlu"), int(rng.integers(2, 9)))) for _ in range(int(rng.integers(40, 400)))]
        text = " ".join(words)
        edited = list(text)
        for _ in range(len(text) // 51):
            at = int(rng.integers(0, len(edited)))
            edited[at : at + (kind != "inserted")] = [] if kind == "deleted" else ["#"]
        texts += [text, "".join(edited)]
    pairs = set()
    for a, x in enumerate(texts):
        for b in range(a + 1, len(texts)):
            if abs(len(x) - len(texts[b])) <= 0.02 * max(len(x), len(texts[b])) and edit_fingerprint.edit_distance(x, texts[b]) <= 0.02 * max(len(x), len(texts[b])):
                pairs.add((a, b))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.a, r.b) for r in edit_fingerprint.near_edits(docs).collect()}
    assert len(pairs) == 30 and got <= pairs and len(got) >= 0.9 * len(pairs)


def test_near_edits_of_empty_tables_copies_and_equal_ids(spark):
    schema = "doc_id long, text string, vertex string, keys string"
    assert edit_fingerprint.near_edits(spark.createDataFrame([], schema)).count() == 0
    text = " ".join(f"word{k * k % 97}" for k in range(60))
    rows = [(k, text, "x", "y") for k in (7, 3, 3, 9)] + [(k, text[:-1] + "!", None, None) for k in (5, 8)] + [(11, "", "", ""), (12, None, "", "")]
    got = edit_fingerprint.near_edits(spark.createDataFrame(rows, schema)).collect()
    assert [tuple(r) for r in got] == [(3, 5, 1)]


@settings(max_examples=60, deadline=None)
@given(st.text("abc", max_size=12), st.text("abc", max_size=12))
def test_edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row = [i + 1, *_next_row(row, x, b, i)]
    assert edit_fingerprint.edit_distance(a, b) == row[-1]


def _next_row(row, x, b, i):
    out, left = [], i + 1
    for j, y in enumerate(b):
        left = min(left + 1, row[j + 1] + 1, row[j] + (x != y))
        out.append(left)
    return out


# packing

def check_packing(rows, texts):
    tokenizer = Tokenizer.from_file(JSON)
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
        by_doc[r.doc_id].append(r)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding == 0
    wanted = defaultdict(list)
    for name, text in texts:
        wanted[name].append([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1])
    for name, lists in wanted.items():
        assert sum(r.length for r in by_doc[name]) == sum(map(len, lists))
        if len(lists) == 1:
            at, ids = 0, lists[0]
            for r in sorted(by_doc[name], key=lambda r: r.start):
                raw = np.array(ids[at : at + r.length], "<u4").tobytes()
                assert (r.start, r.doc_tokens, r.ids_crc32, bytes(r.ids)) == (at, len(ids), zlib.crc32(raw), raw)
                at += r.length


def test_packing_holds_every_id_once(few_docs, odd_docs, no_docs):
    check_packing(packing.pack_documents(few_docs[0], JSON).collect(), few_docs[1])
    check_packing(packing.pack_documents(odd_docs, JSON).collect(), [(r.doc_id, r.text) for r in odd_docs.collect()])
    assert packing.pack_documents(no_docs, JSON).count() == 0


def test_added_tokens_are_those_of_the_library(spark):
    texts = ["one <|endoftext|> two", "<|endoftext|><|endoftext|>", "x <|endof", "text|> y", "<|endoftext |>", "plain"] * 3
    rows = list(enumerate(texts))
    got = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), JSON).collect()
    check_packing(got, rows)
    assert 50256 in np.frombuffer(b"".join(bytes(r.ids) for r in got if r.doc_id == 0), "<u4")


def test_turns_are_packed_under_their_loss_bearing_tokens(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    tokenizer = Tokenizer.from_file(JSON)
    given = [(k, r.text, len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 if r.role == "assistant" else 0) for k, r in enumerate(turns.collect())]
    docs = spark.createDataFrame(given, "doc_id long, text string, bearing int").repartition(2, "doc_id")
    rows = packing.pack_documents(docs, JSON, tokens=512, segments=16, loss=96, loss_column="bearing").collect()
    bearing, by_sequence = {k: b for k, _, b in given}, defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
    for pieces in by_sequence.values():
        assert sum(r.length for r in pieces) <= 512 and len(pieces) <= 16
        assert sum(r.length * bearing[r.doc_id] / r.doc_tokens for r in pieces) <= 96 + 1e-6
    done = defaultdict(int)
    for r in rows:
        done[r.doc_id] += r.length
    assert all(done[k] == len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for k, t, _ in given)
    # prompts fill up what the answers' limit leaves empty
    assert len(by_sequence) <= 1.3 * max(sum(bearing.values()) / 96, sum(done.values()) / 512, len(rows) / 16) + 20


def test_packer_keeps_all_limits_without_cutting():
    rng = np.random.default_rng(2)
    lengths, losses = rng.integers(1, 60, 300), rng.integers(0, 20, 300)
    losses = np.minimum(lengths, losses)
    packer = packing.Packer(100, 5, 40, cut=False)
    bins = [b for b in [*packer.pack(list(range(300)), lengths, losses), *packer.rest()] if b]
    assert sorted(p[0] for b in bins for p in b) == list(range(300))
    for b in bins:
        at = [p[0] for p in b]
        assert len(b) <= 5 and lengths[at].sum() <= 100 and losses[at].sum() <= 40
    assert len(bins) <= 1.25 * max(lengths.sum() / 100, losses.sum() / 40, 60)


# shards

def test_shards_are_even_and_keep_equal_texts(spark, few_docs, odd_docs, no_docs):
    rows = sharding.balanced_shards(few_docs[0], 7).collect()
    text = dict(few_docs[1])
    groups, loads, slots = defaultdict(set), defaultdict(int), defaultdict(list)
    for r in rows:
        raw = text[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
        groups[text[r.doc_id]].add(r.shard)
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(rows) == len(text) and all(len(s) == 1 for s in groups.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(loads.values()) - min(loads.values()) < 0.02 * sum(loads.values())
    odd = sharding.balanced_shards(odd_docs, 3).collect()
    assert len(odd) == odd_docs.count() and {r.size for r in odd if r.doc_id in (2, 3)} == {8}
    assert len({r.shard for r in odd if r.size == 8}) == 1
    assert sharding.balanced_shards(no_docs, 3).count() == 0


def test_longest_first_places_the_largest_first():
    placed = sharding.longest_first([("a", 7), ("b", 6), ("c", 5), ("d", 4), ("e", 4)], 2)
    assert placed == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 0}


def test_pieces_take_little_memory_beside_the_text():
    """A worker holds arrays for a slice of the batch, not for all of it."""
    import tracemalloc

    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        content = f.read()
    text = "".join(f"row {k % 997} of the table, and so on; " for k in range(300)).encode()
    n = 4_000_000 // len(text)
    data, borders = np.frombuffer(text * n, np.uint8), np.arange(n + 1) * len(text)
    alone = next(packing.token_lists(data[: len(text)], borders[:2], content))
    tracemalloc.start()
    try:
        assert all(np.array_equal(ids, alone) for ids in packing.token_lists(data, borders, content))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 32e6
