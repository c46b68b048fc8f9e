"""Operators that compare documents or vectors: repeats, lines, near-duplicates, links, and the pipeline."""

import os
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from icuriver.llm import dart_minhash, line_templates, pq_dedup, suffix_dedup
from icuriver.llm.common import components
from tests.llm.made_texts import SF, sentence


def _key(name):
    return -1 if name is None else name


class Forest:
    def __init__(self, names):
        self.up = {n: n for n in names}

    def top(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, x, y):
        a, b = self.top(x), self.top(y)
        self.up[max(a, b)] = min(a, b)


# suffix dedup

def expected_repeats(rows, match):
    first, out = {}, []
    for name, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        raw = (text or "").encode()
        for k in range(len(raw) - match + 1):
            w = raw[k : k + match]
            first[w] = min(first.get(w, name), name)
    for name, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - match + 1) if name is not None else ():
            if first[raw[k : k + match]] < name:
                gone[k : k + match] = b"\1" * match
        spans = sum(1 for k in range(len(raw)) if gone[k] and (not k or not gone[k - 1]))
        out.append((_key(name), len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone, strict=True) if not g)))
    return sorted(out)


def found_repeats(docs, match):
    out = suffix_dedup.without_repeats(docs, match)
    return sorted((_key(r[0]), r[-1].n_bytes, r[-1].n_removed, r[-1].n_spans, bytes(r[-1].kept)) for r in out.collect())


def test_repeats_on_all_documents(few_docs):
    assert found_repeats(few_docs[0].select("doc_id", "text"), 50) == expected_repeats(few_docs[1], 50)


@pytest.mark.parametrize("match", [3, 8, 20])
def test_repeats_of_short_strings_over_few_letters(spark, match, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "COMPARED", 100 * match)
    rng = np.random.default_rng(match)
    rows = [(int(k), "".join(rng.choice(list("ab"), int(rng.integers(0, 90))))) for k in rng.integers(0, 25, 40)]
    rows += [(30, "ab" * 400), (31, "ab" * 300 + "b"), (32, "a" * 700), (33, "a" * 500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found_repeats(docs, match) == expected_repeats(rows, match)


def test_repeats_defined_results(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    out = suffix_dedup.without_repeats(odd_docs)
    assert out.columns[:-1] == odd_docs.columns
    got = sorted((_key(r.doc_id), r[-1].n_bytes, r[-1].n_removed, r[-1].n_spans, bytes(r[-1].kept)) for r in out.collect())
    assert got == expected_repeats(rows, 50)
    clashing = odd_docs.withColumnsRenamed({"id": "number", "late": "own_row", "removed": "wanted_row", "lines": "spans", "score": "wanted_runs"})
    assert suffix_dedup.without_repeats(clashing).columns[:-1] == clashing.columns
    assert suffix_dedup.without_repeats(no_docs).count() == 0


def test_longest_previous_factors_against_all_suffixes():
    rng = np.random.default_rng(1)
    for _ in range(50):
        text = "".join(rng.choice(list("ab"), 30))
        value = rng.integers(0, 6, 30)
        order = sorted(range(30), key=lambda k: text[k:])

        def shared(i, j):
            return len(os.path.commonprefix([text[i:], text[j:]]))

        lcp = [0] + [shared(order[k - 1], order[k]) for k in range(1, 30)]
        got = suffix_dedup.longest_previous_factors([int(value[k]) for k in order], lcp)
        assert got == [max((shared(k, j) for j in range(30) if value[j] < value[k]), default=0) for k in order]


# lines

def expected_lines(rows, recurs, alike):
    """Lines left by the definition: fields by votes in a leaf, templates counted in different documents."""
    def tokens(line):
        return tuple(t for t in re.split("[\t\x0b\x0c\r ]+", line) if t)

    def shape(line):
        return tuple(re.sub("[0-9]+", "0", t) for t in line)

    def word(t):
        return not re.search("[0-9]", t) and bool(re.search("[A-Za-z\x80-\U0010ffff]", t))

    def leaf_of(line):
        return len(line), shape(line)[:3]

    first_line, lines = {}, defaultdict(set)
    for name, text in rows:
        for place, line in enumerate((text or "").split("\n")) if name is not None else ():
            if key := tokens(line):
                lines[key].add(name)
                first_line.setdefault((leaf_of(key), name), (place, key))
                first_line[leaf_of(key), name] = min(first_line[leaf_of(key), name], (place, key), key=lambda x: x[0])
    votes = defaultdict(Counter)
    for (leaf, _), (_, key) in first_line.items():
        votes[leaf].update(enumerate(shape(key)))

    def template(key):
        leaf, shaped = leaf_of(key), shape(key)
        literal = [k < 3 or votes[leaf][k, t] >= recurs for k, t in enumerate(shaped)]
        words = sum(x and word(t) for x, t in zip(literal, key, strict=True))
        if sum(literal) >= alike * len(key) - 1e-9 and words >= 0.5 * len(key) and words >= 3:
            return leaf, tuple(t if x else None for x, t in zip(literal, shaped, strict=True))
        return key

    holders, of = defaultdict(set), {key: template(key) for key in lines}
    for key, names in lines.items():
        holders[of[key]] |= names
    first = {t: min(names) for t, names in holders.items() if len(names) >= recurs}
    out = []
    for name, text in rows:
        own = (text or "").split("\n")
        kept = [x for x in own if name is None or not tokens(x) or first.get(of[tokens(x)], name) >= name]
        out.append((_key(name), len(own), len(own) - len(kept), "\n".join(kept)))
    return sorted(out)


def found_lines(docs, **options):
    out = line_templates.without_recurring_lines(docs, **options)
    return sorted((_key(r.doc_id), r[-1].n_lines, r[-1].n_dropped, r[-1].kept) for r in out.collect())


def test_lines_on_all_documents(few_docs):
    for recurs in (3, line_templates.RECURS):
        assert found_lines(few_docs[0].select("doc_id", "text"), recurs=recurs) == expected_lines(few_docs[1], recurs, line_templates.ALIKE)


def test_lines_with_fields_come_under_one_template(spark):
    own = ["alpha beta", "gamma delta epsilon", "zeta", "eta theta", "iota", "kappa lambda mu", "nu xi"]
    rows = [(k + 1, f"{own[k]}\n\npage {k} of {k + 3} in the record\nuser {'abcdefg'[k]} has now left the open room\r\n") for k in range(7)]
    rows += [(20, "page one of many"), (None, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = found_lines(docs)
    assert got == expected_lines(rows, 6, 0.8)
    assert [r[2] for r in got if r[0] >= 0] == [0] + [1] * 6 + [0]  # the second word differs, so its leaf does


def test_lines_defined_results(odd_docs, no_docs):
    out = line_templates.without_recurring_lines(odd_docs, recurs=2)
    assert out.columns[:-1] == odd_docs.columns
    got = sorted((_key(r.doc_id), r[-1].n_lines, r[-1].n_dropped, r[-1].kept) for r in out.collect())
    assert got == expected_lines([(r.doc_id, r.text) for r in odd_docs.collect()], 2, 0.8)
    clashing = odd_docs.withColumnsRenamed({"row": "own_row", "id": "own_id", "late": "line_id", "removed": "line_row"})
    assert line_templates.without_recurring_lines(clashing).columns[:-1] == clashing.columns
    assert line_templates.without_recurring_lines(no_docs).count() == 0


def test_lines_that_only_look_alike_stay(spark):
    names = ["aaaa", "cqtq", "gqgl", "hunb", "kzxs", "ludw"]
    rows = [(k, f"{k} {k * 7} {k * k}\n20{10 + k}\nhttp://a.b/{k}\nAB-{k}-X\n世界{k}世界") for k in range(1, 11)]
    rows += [(20 + k, f"posted by user {n}") for k, n in enumerate(names)]
    table = "\n".join(f"entry {k} of the long list" for k in range(5))
    rows += [(40, table), (41, "entry 77 of the long list")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = found_lines(docs)
    assert got == expected_lines(rows, 6, 0.8) and not any(r[2] for r in got)
    more = rows + [(50 + k, f"entry {k} of the long list\nown words {names[k]}") for k in range(4)]
    got = found_lines(spark.createDataFrame(more, "doc_id long, text string"))
    assert got == expected_lines(more, 6, 0.8)
    assert [r[2] for r in got if r[0] >= 40] == [0, 1, 1, 1, 1, 1]  # six documents have it now


def test_a_wide_leaf_and_few_filter_bits(spark, monkeypatch):
    monkeypatch.setattr(line_templates, "FILTER_BITS", 16)
    rng = np.random.default_rng(3)
    words = [f"{a}{b}{c}" for a in "abc" for b in "def" for c in "ghi"]
    rows = [(k, "\n".join(" ".join(["now the", "user", *rng.choice(words, 1 + k % 3), "left", "the", *rng.choice(words[:2], 2)]) for _ in range(int(rng.integers(0, 9))))) for k in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = found_lines(docs)
    assert got == expected_lines(rows, 6, 0.8) and any(r[2] for r in got)


# near-duplicates

def shingles(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[0-9a-z\x80-\U0010ffff]+", lowered)
    return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter()


def expected_classes(rows, least=0.8):
    sets = [(n, shingles(t), t or "") for n, t in rows if n is not None]
    forest = Forest(n for n, _, _ in sets)
    for k, (n, a, t) in enumerate(sets):
        for m, b, u in sets[:k]:
            if (not a and not b and t == u) or (a and b and (a & b).total() >= least * (a | b).total()):
                forest.join(n, m)
    return {n: forest.top(n) for n, _, _ in sets}


def test_near_duplicates_on_all_documents(few_docs):
    got = {r.doc_id: r for r in dart_minhash.near_duplicates(few_docs[0]).collect()}
    want = expected_classes(few_docs[1])
    assert {n: r.class_id for n, r in got.items()} == want
    sizes = Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] and r.kept == (n == r.class_id) for n, r in got.items())


def test_a_hub_joins_copies_that_are_not_alike(spark):
    hub = sentence(3, 120).split()
    rows = [(50, " ".join(hub))]
    for k in range(40):
        words = list(hub)
        words[3 * k % 118] = f"x{k}"
        words[(3 * k + 59) % 118] = f"y{k}"
        rows.append((k, " ".join(words)))
    rows += [(100 + k, sentence(k + 11, 60) + f" n{k}") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in dart_minhash.near_duplicates(docs).collect()}
    assert got == expected_classes(rows)


def test_near_duplicates_defined_results(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = dart_minhash.near_duplicates(odd_docs).collect()
    assert len(got) == len(rows)
    want = expected_classes(rows)
    assert all(r.class_id == want[r.doc_id] if r.doc_id is not None else r.kept and r.class_id is None for r in got)
    kept = dart_minhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    names = [r.doc_id for r in kept.collect()]
    assert sorted(n for n in names if n is not None) == kept_ids(rows) and names.count(None) == 2
    clashing = odd_docs.withColumnsRenamed({"row": "chosen_id", "id": "chosen_own", "late": "component"})
    assert dart_minhash.keep_one(clashing).columns == clashing.columns
    assert dart_minhash.near_duplicates(no_docs).count() == 0 and dart_minhash.keep_one(no_docs).count() == 0


def kept_ids(rows, least=0.8):
    """Ids of one row for each class, classes made of rows."""
    apart = [((n, k), t) for k, (n, t) in enumerate(rows) if n is not None]
    return sorted(n for n, _ in set(expected_classes(apart, least).values()))


def test_a_row_whose_id_is_shared_keeps_its_own_text(spark):
    a, b = sentence(3, 80), sentence(7, 70)
    rows = [(3, a), (6, a), (6, b), (6, b), (9, b), (2, sentence(11, 60))]
    for _ in range(2):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        assert sorted((r.doc_id, r.text) for r in dart_minhash.keep_one(docs).collect()) == sorted({(3, a), (6, b), (2, rows[-1][1])})


def test_signatures_estimate_the_weighted_similarity():
    texts = [" ".join(f"w{(k * j) % 97}" for j in range(1, 200 + 5 * k)) for k in range(1, 9)] + ["a b", "", "a b c d e f"]
    raw = [t.encode() for t in texts]
    cell, cut = dart_minhash.shingle_cells(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert np.diff(cut).tolist() == [shingles(t).total() for t in texts]
    marks = dart_minhash.signatures(cell, cut, 2000)
    assert not marks[9].any() and marks[8].all()
    for a in range(8):
        for b in range(a):
            x, y = shingles(texts[a]), shingles(texts[b])
            true = (x & y).total() / (x | y).total()
            assert dart_minhash.similarity(cell[cut[a] : cut[a + 1]], cell[cut[b] : cut[b + 1]]) == pytest.approx(true)
            assert abs((marks[a] == marks[b]).mean() - true) < 0.06


def test_components(spark):
    rng = np.random.default_rng(4)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (160, 2))] + [(k, k + 1) for k in range(400, 440)] + [(500, 500), (None, 3)]
    forest = Forest(range(501))
    for a, b in pairs:
        if a is not None:
            forest.join(a, b)
    got = {r.id: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    linked = {x for p in pairs if None not in p and p[0] != p[1] for x in p}
    assert got == {x: forest.top(x) for x in linked}


# vectors

def near_groups(seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(60, 24))
    vectors = [b * s + rng.normal(size=24) * scale * np.linalg.norm(b) / np.sqrt(24) for b in base for s, scale in ((1, 0), (2, 0.2), (0.5, 0.3), (1, 0.34))]
    return vectors + [base[0] + rng.normal(size=24) * 0.1 for _ in range(60)]


def test_vector_links_and_components(spark):
    vectors = near_groups()
    rows = [(k, [float(np.float32(x)) for x in v]) for k, v in enumerate(vectors)]
    odd = [(900, None), (901, []), (902, [0.0] * 24), (903, [float("nan")] * 24), (904, [None] + [1.0] * 23), (905, [1.0, 2.0]), (5, rows[5][1]), (None, rows[7][1])]
    frame = spark.createDataFrame([(*r, k) for k, r in enumerate(rows + odd)], "vec_id long, embedding array<float>, row int")
    got = pq_dedup.near_vectors(frame).collect()
    assert len(got) == len(rows) + len(odd)
    x = np.array([v for _, v in rows] + [rows[7][1]])
    x /= np.sqrt((x**2).sum(axis=1))[:, None]
    links = (x @ x.T) >= 0.95
    np.fill_diagonal(links, False)
    forest = Forest(range(len(x)))
    for a, b in zip(*np.nonzero(links), strict=True):
        forest.join(int(a), int(b))
    by_id = {r.vec_id: r for r in got if r.vec_id is not None}
    for k in range(len(rows)):
        assert (by_id[k].n_links, by_id[k].component_id, by_id[k].kept) == (links[k].sum(), forest.top(k), forest.top(k) == k)
    assert all(by_id[k].n_links == 0 and by_id[k].component_id == k for k in range(900, 906))
    assert sum(r.vec_id == 5 for r in got) == 2


def test_vectors_of_all_tables_have_full_recall(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = sorted((r.vec_id, r.embedding) for r in frame.collect())
    x = np.array([v for _, v in rows], float)
    x /= np.sqrt((x**2).sum(axis=1))[:, None]
    want = {n: int(c) - 1 for (n, _), c in zip(rows, ((x @ x.T) >= 0.95).sum(axis=1), strict=True)}
    got = {r.vec_id: r.n_links for r in pq_dedup.near_vectors(frame).collect()}
    assert got == want


def test_table_lookup_distances_bound_the_true_ones():
    x = pq_dedup.unit(np.random.default_rng(3).normal(size=(500, 16)))
    index = pq_dedup.Index.fit(x, 6, 0.95)
    lists = pq_dedup.nearest(x, index.centres)
    codes, square, error = index.encode(x, lists)
    back = index.centres[lists] + np.concatenate([index.books[m][codes[:, m]] for m in range(len(index.books))], axis=1)
    assert np.allclose(square, (back**2).sum(axis=1)) and np.allclose(error, np.sqrt(((x - back) ** 2).sum(axis=1)))
    assert index.probes(x, lists)[np.arange(500), lists].all()
    past = index.beyond(x, lists, np.arange(len(index.centres)))
    apart = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    assert (past[:, lists] + past[:, lists].T <= apart + 1e-9).all()


def links_by_brute_force(x):
    x = x / np.sqrt((x**2).sum(axis=1))[:, None]
    links = (x @ x.T) >= 0.95
    np.fill_diagonal(links, False)
    forest = Forest(range(len(x)))
    for a, b in zip(*np.nonzero(np.triu(links)), strict=True):
        forest.join(int(a), int(b))
    return [(int(links[k].sum()), forest.top(k)) for k in range(len(x))]


@pytest.mark.parametrize("shape", ["main_axis", "circle", "copies"])
def test_no_link_is_lost_whatever_the_shape(spark, shape, monkeypatch):
    monkeypatch.setattr(pq_dedup, "PER_LIST", 60)
    monkeypatch.setattr(pq_dedup, "LEAST_BLOCK", 256)
    rng = np.random.default_rng(5)
    if shape == "main_axis":  # copies shifted along the axis that sets the centres apart
        base = rng.normal(size=(1200, 64)) * np.r_[6.0, np.full(63, 0.6)]
        x = np.concatenate((base, base + np.outer(rng.uniform(-2.5, 2.5, len(base)), np.eye(64)[0])))
    elif shape == "circle":
        turn = rng.uniform(0, 2 * np.pi, 2500)
        x = np.stack((np.cos(turn), np.sin(turn)), axis=1) @ rng.normal(size=(2, 64)) + rng.normal(size=(2500, 64)) * 0.05
    else:  # a third of all rows is one vector, another third is near it
        x = np.concatenate((np.tile(rng.normal(size=64), (1400, 1)), rng.normal(size=(700, 64))))
        x[700:1400] += rng.normal(size=(700, 64)) * 0.1
    x = x.astype(np.float32).astype(float)
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in pq_dedup.near_vectors(frame).collect()}
    want = links_by_brute_force(x)
    assert sum(n for n, _ in want) > 500
    assert [got[k] for k in range(len(x))] == want


def test_no_vectors(spark):
    assert pq_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    only = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<double>")
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in pq_dedup.near_vectors(only).collect()) == [(1, 0, 1), (2, 0, 2)]


# pipeline

def test_pipeline_stages_against_brute_force(spark, few_docs):
    docs, columns = few_docs[0], few_docs[0].columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "minhash", "suffix_dedup", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        out = stage(spark, docs, SF)
        assert out.columns == columns
        rows = out.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        after = {r.doc_id: r.text for r in rows}
        if name == "quality":
            assert all(dict(before)[k] == t for k, t in after.items())
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            assert np.mean([(k in after) == q for k, q in labels.items() if k in dict(before)]) > 0.9
        elif name == "line_dedup":
            want = {n: t for n, _, d, t in expected_lines(before, 6, 0.8) if not d or t.strip()}
            assert after == {n: want[n] for n in want}
        elif name == "minhash":
            assert sorted(after) == kept_ids(before)
        else:
            want = {n: raw.decode("utf-8", "ignore") for n, _, gone, _, raw in expected_repeats(before, 50) if not gone or raw.decode("utf-8", "ignore").strip()}
            assert after == want
        assert all(r.n_chars == len(r.text) for r in rows if r.text != dict(before)[r.doc_id])
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == set(after)


    def texts_of(rows):
        out = defaultdict(bytes)
        for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
            assert len(out[r.doc_id]) == 4 * r.start
            out[r.doc_id] += bytes(r.ids)
        return out

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {n: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes() for n, t in after.items()}
    assert texts_of(packed) == want == texts_of(corpus_pipeline.run(spark, SF).collect())
