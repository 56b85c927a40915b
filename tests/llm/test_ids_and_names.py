"""Ids kept as they are, columns of any name, names after collisions, and whole queries against brute force."""

from __future__ import annotations

import re
import time
import zlib
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from tests.llm.test_near_copies import brute_components
from tripmart.llm import language, ngram_join, packing, surrogates, tiling, toxicity
from tripmart.llm.common import ready, table
from tripmart.llm.tokens import vocabulary_path

SF_DIR = "/root/testdata/sf0.001"
BIG = [2**60 + 1, 2**60 + 3, None, 2**60 + 5, None]
SHARED = " ".join(f"w{k}" for k in range(60))

ID_CASES = [
    ("bigint", BIG),
    ("string", ["01", "1", None, "x" * 40, None]),
    ("decimal(38,0)", [None if i is None else Decimal(i * 10**15 + 1) for i in BIG]),
    ("binary", [b"\xff\x00", b"\xfe", None, b"", None]),
]


def plain(value):
    return bytes(value) if isinstance(value, bytearray) else value


def with_ids(spark, kind, ids, texts):
    rows = [(i, t) for i, t in zip(ids, texts)]
    return ready(spark).createDataFrame(rows, f"doc_id {kind}, text string").coalesce(1)


@pytest.mark.parametrize(("kind", "ids"), ID_CASES)
def test_ids_beside_nulls_stay_as_they_are(spark, kind, ids):
    docs = with_ids(spark, kind, ids, [SHARED, SHARED, "other words here", "scum. fine", None])
    expected = sorted(map(str, ids))
    model = toxicity.SentenceModel({"scum": 12.0}, -6.0)
    scored = toxicity.score(docs, model)
    labelled = language.label(docs, None)
    joined = ngram_join.ngram_components(docs, 5, 80, 100)
    for out in (scored, labelled, joined):
        assert dict(out.dtypes)["doc_id"] == kind
        assert sorted(str(plain(r.doc_id)) for r in out.collect()) == expected
    components = {str(plain(r.doc_id)): plain(r.component_id) for r in joined.collect() if r.doc_id is not None}
    assert components[str(ids[0])] == components[str(ids[1])] == min(ids[0], ids[1])
    items = spark.createDataFrame([(ids[1], SHARED), (None, "nothing of that kind")], f"item_id {kind}, text string")
    found = tiling.find_passages(docs, items.coalesce(1)).collect()
    assert sorted((str(plain(r.doc_id)), str(plain(r.item_id))) for r in found) == sorted((str(i), str(ids[1])) for i in ids[:2])


def test_a_link_between_large_ids_is_found(spark):
    near = SHARED.replace("w59", "other")
    docs = with_ids(spark, "long", [2**60 + 1, 2**60 + 3, None], [SHARED, near, "x y z"])
    out = {r.doc_id: r.component_id for r in ngram_join.ngram_components(docs, 3, 90, 100).collect()}
    assert out == {2**60 + 1: 2**60 + 1, 2**60 + 3: 2**60 + 1, None: None}


@pytest.mark.parametrize("ids", [BIG])
def test_packing_keeps_ids_and_columns_of_any_name(spark, ids):
    names = ["__row", "__group", "__fill", "__ROW", "note"]
    rows = [(i, 0, 0, 300 + k, *[f"{n}{k}" for n in names]) for k, i in enumerate(ids)]
    with_names = ", ".join(f"`{n}` string" for n in names[:3] + names[4:])
    rows = [(*r[:7], r[8]) for r in rows]
    pieces = ready(spark).createDataFrame(rows, f"doc_id long, piece int, start long, length long, {with_names}").coalesce(1)
    out = packing.pack(pieces)
    assert out.columns == [*pieces.columns, "sequence_id", "offset"]
    assert sorted(map(str, out.select(pieces.columns).collect())) == sorted(map(str, pieces.collect()))


def test_personal_data_with_columns_of_any_name(spark):
    row = (1, "Mail a.b@c.org now", "k", "t", "f")
    docs = ready(spark).createDataFrame([row], "doc_id long, text string, __id_key string, __text_key string, __found string")
    out = surrogates.replace_personal_data(docs, "key", found_col="found")
    assert out.columns == [*docs.columns, "found"]
    got = out.first()
    assert tuple(got)[2:5] == ("k", "t", "f") and "a.b@c.org" not in got.text and got.found[0].kind == "email"


def test_family_names_stay_together_after_collisions(spark, monkeypatch):
    # so few made-up words that first attempts must collide
    monkeypatch.setitem(surrogates._SYLLABLES, "latin", ["ba", "be"])
    monkeypatch.setitem(surrogates._ENDINGS, "latin", {"f": ["na"], "m": ["no"], "family": ["ler", "lin"]})
    families = ["smith", "jones", "brown", "white", "green", "black", "stone", "wood", "hill", "lake"]
    given = ["john", "jack", "paul", "carl"]
    names = [f"mr {f}" for f in families] + [f"mr {g} {f}" for g in given for f in families]
    values = ready(spark).createDataFrame([("name", n) for n in names], "kind string, value string")
    made = {r.value: r.made for r in surrogates.distinct_surrogates(values, "k").collect()}
    assert len(made) == len(set(made.values())) == len(names)
    assert not set(made.values()) & set(names)
    for family in families:
        alone = made[f"mr {family}"].split()[-1]
        assert {made[f"mr {g} {family}"].split()[-1] for g in given} == {alone}
    for g in given:
        assert len({made[f"mr {g} {f}"].split()[1] for f in families}) == 1
    assert len({made[f"mr {f}"] for f in families}) == len(families)


# benchmark passages


def test_a_stock_phrase_makes_no_pairs(spark):
    phrase = " ".join(f"stock{k}" for k in range(10))
    docs = [(i, f"{phrase} " + " ".join(f"d{i}x{k}" for k in range(30))) for i in range(600)]
    items = [(i, f"{phrase} " + " ".join(f"i{i}y{k}" for k in range(30))) for i in range(300)]
    docs.append((1000, docs[5][1] + " " + items[7][1]))
    docs = ready(spark).createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    began = time.monotonic()
    found = tiling.find_passages(docs, items).collect()
    assert [(r.doc_id, r.item_id, r.coverage) for r in found] == [(1000, 7, 1.0)]
    assert time.monotonic() - began < 60


def test_items_made_of_stock_phrases_are_found(spark):
    phrase = " ".join(f"stock{k}" for k in range(10))
    items = [(i, f"{phrase} own{i} words{i} only{i}") for i in range(40)]
    docs = [(1, f"x {phrase} y"), (2, phrase[:30]), (3, "nothing")]
    docs, items = ready(spark).createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = tiling.find_passages(docs, items).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, i) for i in range(40)]
    assert {r.matched_words for r in found} == {10}


def plain_words(text):
    return [w.decode("utf-8") for w in re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())]


def tiled_words(doc, item, least=5):
    """Words of the item under greedy tiles, by looking at all common starts again and again."""
    least = min(least, len(item))
    grams = {}
    for b in range(len(item) - least + 1):
        grams.setdefault(tuple(item[b : b + least]), []).append(b)
    starts = [(a, b) for a in range(len(doc) - least + 1) for b in grams.get(tuple(doc[a : a + least]), ())]
    used_d, used_i, covered = set(), set(), 0
    while starts:
        best = (0, 0, 0)
        for a, b in starts:
            n = 0
            while (a + n < len(doc) and b + n < len(item) and doc[a + n] == item[b + n]
                   and a + n not in used_d and b + n not in used_i):
                n += 1
            best = max(best, (n, -a, -b))
        n, a, b = best[0], -best[1], -best[2]
        if n < least:
            break
        covered += n
        used_d.update(range(a, a + n))
        used_i.update(range(b, b + n))
    return covered


def contaminated(docs, items):
    """(doc, item): matched words, of the pairs that reach half of the item."""
    items = [(i, plain_words(t)) for i, t in items]
    out = {}
    for doc, text in docs:
        words = plain_words(text)
        for item, wanted in items:
            if wanted:
                n = tiled_words(words, wanted)
                if n >= 0.5 * len(wanted):
                    out[doc, item] = n
    return out


def test_query_equals_an_independent_tiler(spark):
    docs = [(r.doc_id, r.text) for r in table(ready(spark), SF_DIR, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF_DIR, "benchmark").collect()]
    rows = driver.queries()["op3_tiled_benchmark"](spark, SF_DIR).collect()
    expected = contaminated(docs, items)
    assert expected and {(r.doc_id, r.item_id): r.matched_words for r in rows} == expected


def test_random_texts_equal_an_independent_tiler(spark):
    rng = np.random.default_rng(11)
    some = [f"v{k}" for k in range(12)]
    pool = [" ".join(rng.choice(some, 6)) for _ in range(6)]  # phrases that many of both share
    make = lambda n: " ".join(rng.choice([*pool, *some], n))
    docs = [(i, make(12)) for i in range(60)]
    items = [(i, make(5)) for i in range(60)]
    found = tiling.find_passages(
        ready(spark).createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert {(r.doc_id, r.item_id) for r in found} == set(contaminated(docs, items))


# the pipeline


def test_pipeline_gives_exactly_the_pieces_of_what_should_stay(spark):
    from tokenizers import Tokenizer

    out = driver.queries()["pipeline"](spark, SF_DIR).collect()
    calm = corpus_pipeline.reject_toxic(spark, table(ready(spark), SF_DIR, "documents"), SF_DIR)
    rows = [(r.doc_id, r.text) for r in calm.collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF_DIR, "benchmark").collect()]
    near = {i for i, (_, c) in brute_components(rows, 5, 80, 100).items() if i == c}
    dirty = {d for d, _ in contaminated([r for r in rows if r[0] in near], items)}
    kept = near - dirty
    assert dirty and {r.doc_id for r in out} == kept
    clean = surrogates.replace_personal_data(calm.where(F.col("doc_id").isin(sorted(kept))), corpus_pipeline.KEY)
    encode = Tokenizer.from_file(vocabulary_path()).encode
    for row in clean.collect():
        ids = [*encode(row.text or "", add_special_tokens=False).ids, 2]
        pieces = sorted((r for r in out if r.doc_id == row.doc_id), key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert sum(r.length for r in pieces) == len(ids) and (len(ids) > 1024 or len(pieces) == 1)
        for r in pieces:
            part = np.array(ids[r.start : r.start + r.length], dtype="<u4")
            assert len(part) == r.length <= 1024 and zlib.crc32(part.tobytes()) == r.ids_crc32


def test_a_stage_keeps_a_column_named_like_its_helper(spark):
    schema = "doc_id long, text string, __row string"
    docs = ready(spark).createDataFrame([(1, SHARED, "a"), (2, SHARED, "b"), (3, "own words of it", "c")], schema)
    for stage in (corpus_pipeline.one_of_near_copies, corpus_pipeline.decontaminate):
        left = stage(spark, docs, SF_DIR)
        assert left.columns == docs.columns
    kept = corpus_pipeline.one_of_near_copies(spark, docs, SF_DIR)
    assert sorted((r.doc_id, r["__row"]) for r in kept.collect()) == [(1, "a"), (3, "c")]
