"""Shingle and vector joins against all-pairs comparison, components, and the pipeline."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from tripmart.llm import near_vectors, ngram_join, packing
from tripmart.llm.common import connected_components, ready, table

SF_DIR = "/root/testdata/sf0.001"


def union_components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, width):
    data = (text or "").encode()
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in data)
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute_components(rows, width, num, den):
    sets = {i: shingles(t, width) for i, t in rows}
    ids = sorted(sets)
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[k + 1 :]
        if sets[a] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])
    ]
    return {i: (len(sets[i]), c) for i, c in union_components(ids, links).items()}


def variants(seed):
    """Families of near copies of different length, some around the threshold, and strangers."""
    rng = random.Random(seed)
    rows = []
    for family in range(12):
        base = [f"v{rng.randrange(400)}" for _ in range(rng.choice([1, 2, 8, 40, 120, 400]))]
        for _ in range(rng.choice([1, 2, 12])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, len(words) // 30 + 1])):
                words[rng.randrange(len(words))] = f"n{rng.randrange(1000)}"
            rows.append(" ".join(w.upper() if rng.random() < 0.2 else w for w in words))
    passage = " ".join(f"p{k}" for k in range(60))
    rows += [f"{passage} " + " ".join(f"s{rng.randrange(5000)}" for _ in range(rng.randrange(20, 90))) for _ in range(25)]
    return list(enumerate(rows))


@pytest.mark.parametrize("width, num", [(3, 90), (5, 80)])
def test_components_are_those_of_all_pairs(spark, width, num):
    rows = variants(width)
    docs = ready(spark).createDataFrame(rows, "doc_id long, text string")
    out = ngram_join.ngram_components(docs, width, num, 100, block=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute_components(rows, width, num, 100)


def test_query_over_the_small_table(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").collect()]
    out = driver.queries()["op4_signature_ngrams"](spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute_components(rows, 3, 90, 100)


def test_odd_texts(spark):
    rows = [(1, "a b c d", "x"), (1, "a b c d", "x"), (2, "A B c d", "x"), (3, None, "x"), (4, "", "x"), (5, " \t", "x"),
            (6, "one", "x"), (7, "ONE", "x"), (None, "one", "x"), (8, "w " * 20_000, "x")]
    docs = ready(spark).createDataFrame(rows, "doc_id long, text string, component_id string")
    out = [tuple(r) for r in ngram_join.ngram_components(docs, 3, 90, 100).collect()]
    assert sorted(out, key=str) == sorted(
        [(1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 1, 6), (7, 1, 6), (None, 1, 6), (8, 1, 8)],
        key=str,
    )
    assert ngram_join.ngram_components(docs.limit(0)).count() == 0


def test_traversal_prunes_and_loses_nothing():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 2**63, rng.integers(20, 300), dtype=np.uint64) for _ in range(150)]
    sets += [s[: int(len(s) * 0.97)] for s in sets[:40]]
    sets = [np.unique(s) for s in sets]
    bitmaps = ngram_join.folded([ngram_join.signature(s) for s in sets])
    tree = ngram_join.SignatureTree(bitmaps, np.array([len(s) for s in sets]), np.arange(len(sets)))
    found = {(min(a, b), max(a, b)) for x, y in ngram_join.dual_traversal(tree, tree, 90, 100) for a, b in zip(x.tolist(), y.tolist())}
    linked = {
        (a, b)
        for a in range(len(sets))
        for b in range(a + 1, len(sets))
        if 100 * len(np.intersect1d(sets[a], sets[b])) >= 90 * len(np.union1d(sets[a], sets[b]))
    }
    assert linked and linked <= found and len(found) < 2 * len(linked) + 20


def near_copies_of_one_text(count):
    """Copies of one text with up to four words changed: many pairs are linked, many almost."""
    rng = random.Random(7)
    base = [f"b{k}" for k in range(150)]
    rows = []
    for i in range(count):
        words = list(base)
        for _ in range(i % 5):
            words[rng.randrange(len(words))] = f"c{rng.randrange(100)}"
        rows.append((i, " ".join(words)))
    return rows


def test_a_group_of_near_copies_is_joined_by_few_pairs(spark, monkeypatch):
    rows = near_copies_of_one_text(500)
    checked, stored = [], ngram_join.stored

    def counting(df, label):
        out = stored(df, label)
        if label.endswith("-pairs"):
            checked.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "stored", counting)
    docs = ready(spark).createDataFrame(rows, "doc_id long, text string")
    out = ngram_join.ngram_components(docs, 3, 90, 100).collect()
    expected = brute_components(rows, 3, 90, 100)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == expected
    assert len({c for _, c in expected.values()}) > 50
    assert sum(checked) < 8 * len(rows)  # over 30,000 pairs of rows are linked


def test_partitions_without_buckets_have_no_candidates():
    columns = ["node", "n", "component", "bits", "home", "member", "is_home", *ngram_join._TREE]
    for frames in ([], [pd.DataFrame(columns=columns)]):
        for spanning in (True, False):
            assert list(ngram_join._traverse(iter(frames), 90, 100, spanning)) == []


def test_bitmaps_differ_in_no_more_places_than_sets():
    rng = np.random.default_rng(3)
    whole = np.unique(rng.integers(0, 2**63, 3000, dtype=np.uint64))
    for n, cut in ((40, 2), (600, 30), (2900, 200), (1030, 20)):
        a, b = whole[:n], whole[cut : n - 5]
        for length in (None, 4):
            x, y = ngram_join.folded([ngram_join.signature(s) for s in (a, b)], length)
            assert np.bitwise_count(x ^ y).sum() <= cut + 5
        x, y = ngram_join.folded([ngram_join.signature(s) for s in (a, b)])
        assert np.bitwise_count(x ^ y).sum() >= 0.7 * (cut + 5)


def test_spanning_pairs_join_what_all_pairs_join():
    rng = np.random.default_rng(5)
    x, y = rng.integers(0, 400, (2, 900))
    share = rng.random(900)
    few = ngram_join.spanning_pairs(x, y, share, 400)
    pairs = list(zip(x.tolist(), y.tolist()))
    whole = union_components(range(400), pairs)
    assert union_components(range(400), [pairs[k] for k in few]) == whole
    assert len(few) == 400 - len(set(whole.values()))
    # the nearest ones: a tree of pairs taken in ascending order has the same length
    total, root = 0.0, {n: n for n in range(400)}
    for k in np.argsort(share):
        a, b = root[pairs[k][0]], root[pairs[k][1]]
        if a != b:
            total += share[k]
            root = {n: a if r == b else r for n, r in root.items()}
    assert math.isclose(share[few].sum(), total)
    assert not len(ngram_join.spanning_pairs(x[:0], y[:0], share[:0], 400))


def test_components_of_long_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7777, 5)] + [(3, 3)]
    out = connected_components(ready(spark).createDataFrame(links, "a long, b long"), "test").collect()
    expected = union_components({n for p in links for n in p}, links)
    assert {r.node: r.component for r in out} == expected and len(out) == len(expected)


# vectors


def brute_vectors(ids, x, cosine):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= cosine
    links = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(np.triu(near, 1)))]
    return dict(zip(ids, near.sum(1) - 1)), union_components(ids, links)


def test_vectors_in_groups_of_near_copies(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 64))
    x = np.vstack([x, x[:40] + rng.normal(size=(40, 64)) * 0.2, x[:1] + rng.normal(size=(80, 64)) * 0.1, x[5:6].repeat(30, 0)])
    ids = list(range(len(x)))
    docs = ready(spark).createDataFrame([(i, v.tolist(), 0) for i, v in zip(ids, x)], "vec_id long, embedding array<double>, n_links int")
    out = near_vectors.near_vectors(docs, block=16).collect()
    links, components = brute_vectors(ids, x, 0.9)
    got = {r.vec_id: r for r in out}
    assert len(out) == len(x)
    assert all(got[i].n_links <= links[i] for i in ids)
    assert sum(r.n_links for r in out) >= 0.97 * sum(links.values())
    assert sum(got[i].component_id == components[i] for i in ids) >= 0.97 * len(ids)
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)


def test_recall_on_the_table(spark):
    rows = table(spark, "/root/testdata/sf0.01", "embeddings").toPandas()
    x = np.stack(rows.embedding).astype("f8")
    x = np.vstack([x, x + np.random.default_rng(0).normal(size=x.shape) * 0.05])
    ids = list(range(len(x)))
    docs = ready(spark).createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    links, _ = brute_vectors(ids, x, 0.9)
    out = near_vectors.near_vectors(docs).collect()
    assert sum(links.values()) > 100
    assert sum(r.n_links for r in out) >= 0.9 * sum(links.values())


def test_nearest_lattice_points():
    x = np.random.default_rng(4).normal(size=(400, 8)) * 2
    near, other = near_vectors.decode_e8(x)
    for point in (near, other):
        assert np.allclose(np.mod(2 * point, 1), 0) and np.all(np.mod(point.sum(-1), 2) == 0)
        assert np.all((np.mod(point, 1) == np.mod(point[:, :1], 1)))
    steps = [np.array(v) for v in np.vstack([np.eye(8)[i] * a + np.eye(8)[j] * b for i in range(8) for j in range(i) for a in (1, -1) for b in (1, -1)])]
    distance = ((x - near) ** 2).sum(-1)
    assert all(np.all(((x - near - s) ** 2).sum(-1) >= distance - 1e-9) for s in steps)
    assert np.all(distance <= 1 + 1e-9)  # the covering radius


def test_odd_vectors(spark):
    nan, inf = math.nan, math.inf
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
            (8, [None, 1.0]), (9, [1e200, 0.0]), (10, [1e-200, 1e-203]), (None, [1.0, 0.0]), (11, [1.0, 0.0, 0.0]), (2, [1.0, 0.0])]
    docs = ready(spark).createDataFrame(rows, "vec_id long, embedding array<double>")
    out = near_vectors.near_vectors(docs).collect()
    assert len(out) == len(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in out}
    assert all(got[i] == (0, i) for i in (3, 4, 5, 6, 7, 8, 11))
    assert all(got[i] == (4, 1) for i in (1, 2, 9, 10)) and got[None] == (0, None)
    assert near_vectors.near_vectors(docs.limit(0)).count() == 0


# pipeline


def test_stages_keep_columns_and_take_effect(spark):
    docs = table(ready(spark), SF_DIR, "documents")
    columns, counts = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF_DIR), "test")
        counts.append((name, docs.count(), docs.select("doc_id").distinct().count()))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    sizes = [n for _, _, n in counts]
    assert 200 > sizes[0] > sizes[1] > sizes[2] == sizes[3] == sizes[4]
    assert docs.groupBy("sequence_id").agg({"length": "sum"}).agg({"sum(length)": "max"}).first()[0] <= 1024


def test_run_gives_the_pieces_of_what_the_stages_keep(spark):
    out = driver.queries()["pipeline"](spark, SF_DIR)
    assert set(out.columns) >= {"doc_id", "piece", "length", "sequence_id", "offset"}
    first = corpus_pipeline.reject_toxic(spark, table(spark, SF_DIR, "documents"), SF_DIR)
    near = corpus_pipeline.one_of_near_copies(spark, first, SF_DIR)
    rows = [(r.doc_id, r.text) for r in first.collect()]
    kept = {i for i, (_, c) in brute_components(rows, 5, 80, 100).items() if i == c}
    assert {r.doc_id for r in near.collect()} == kept
    assert {r.doc_id for r in out.select("doc_id").collect()} <= kept


def test_stages_on_odd_documents(spark):
    rows = [(1, "a b c d e f g", None, None, None), (2, None, "en", "s", 0), (3, "", "en", "s", 0), (None, "x y z", "en", "s", 5),
            (4, "a b c d e f g", "en", "s", 13), (4, "a b c d e f g", "en", "s", 13)]
    docs = ready(spark).createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SF_DIR), "test")
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in docs.collect()) == [(False, 1), (False, 2), (False, 3), (True, 0)]
    assert packing.pack(packing.token_pieces(docs)).count() == 4
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = corpus_pipeline.stored(stage(spark, empty, SF_DIR), "test")
    assert empty.count() == 0


def test_near_copies_and_passages_are_decided_by_row(spark):
    copied, own = " ".join(f"c{k}" for k in range(30)), " ".join(f"o{k}" for k in range(30))
    orphan, late = " ".join(f"n{k}" for k in range(30)), " ".join(f"l{k}" for k in range(30))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, copied), (None, copied), (None, own), (None, orphan), (None, orphan),
            (2, copied), (2, late), (3, late), (3, "x " + own[:20]), (4, None), (4, None), (None, None)]
    docs = ready(spark).createDataFrame([(i, t, "en", "s", k) for k, (i, t) in enumerate(rows)], schema)
    kept = corpus_pipeline.one_of_near_copies(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    left = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    expected = [(1, copied), (None, own), (None, orphan), (2, late), (3, "x " + own[:20]), (4, None), (4, None), (None, None)]
    assert left == sorted(expected, key=str)

    equal = docs.where("doc_id = 1").union(docs.where("doc_id = 1"))
    assert corpus_pipeline.one_of_near_copies(spark, equal, SF_DIR).count() == 1

    passage = table(spark, SF_DIR, "benchmark").orderBy("item_id").first().text
    rows = [(None, passage), (None, own), (5, passage), (5, own), (6, own), (6, own), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], schema)
    clean = corpus_pipeline.decontaminate(spark, docs, SF_DIR)
    assert clean.columns == docs.columns
    left = sorted(((r.doc_id, r.text) for r in clean.collect()), key=str)
    assert left == sorted([(None, own), (5, own), (6, own), (6, own), (None, None)], key=str)
