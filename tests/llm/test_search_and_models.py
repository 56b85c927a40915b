"""Lexical search, the class model and the conversation trie against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as driver
from checks.compare import _rows, duck
from tripmart.llm import class_model, conversation_trie, lexical_search, words
from tripmart.llm.common import is_held_out, ready, table

SF_DIR = "/root/testdata/sf0.001"
CHECKED = "op11_max_sketch_search", "op13_truncated_trie"


@pytest.mark.parametrize("name", CHECKED)
def test_query_agrees_with_sql(spark, name):
    df = driver.queries()[name](spark, SF_DIR)
    result = duck(SF_DIR).execute(driver.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    ours = _rows(df.columns, df.collect())
    assert ours and ours == _rows(columns, result.fetchall())


# words


@pytest.mark.parametrize("piece", [1, 7, 1 << 20])
def test_words_and_terms_in_pieces(monkeypatch, piece):
    monkeypatch.setattr(words, "PIECE", piece)
    text = "Ein Wort,\tÄpfel\x0b\x0c x1y2  école deux\r\n ABC abc " * 5
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    assert [w for p in words.words(text.encode()) for w in p] == [
        w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", lower)
    ]
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)
    assert words.term_counts(text.encode()) == Counter(w.encode() for w in found)


# search

DOCS = "doc_id long, text string, score long, term string, row long, item long"


def documents(spark, *rows):
    return ready(spark).createDataFrame([(i, t, 1, "t", 2, 3) for i, t in rows], DOCS)


def items(spark, *rows):
    return spark.createDataFrame([(i, t, 9) for i, t in rows], "item_id long, text string, rank int")


def ranked_plainly(docs, asked, k=10):
    counts = [(i, words.term_counts((t or "").encode())) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    total = sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in dict.fromkeys(asked):
        scored = []
        for doc, c in counts:
            m = 25 + (75 * c.total() * len(counts)) // total
            score = sum(
                n * math.floor(1000 * math.log((2 * len(counts) + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t, n in words.term_counts((text or "").encode()).items()
                if t in c
            )
            scored.append((-score, doc is None, doc or 0))
        best = sorted(s for s in scored if s[0] < 0)[:k]
        out += [(item, r, None if null else doc, -s) for r, (s, null, doc) in enumerate(best, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("sketch", [3, 4096])
def test_search_equals_scoring_all(spark, monkeypatch, sketch):
    monkeypatch.setattr(lexical_search, "ITEMS_PER_BLOCK", 4)
    rng = random.Random(5)
    some = ["Ab", "cd", "é", "x1", "rare" + str(rng.random())[2:5], "AB", "zz", "the", "the"]
    docs = [(rng.choice([None, 2**60 + 1, 2**60 + 3, i]), " ".join(rng.choices(some, k=rng.randrange(30)))) for i in range(120)]
    docs += [(5, None), (6, ""), (7, "ab cd " * 4000), (8, "?!"), (9, "ab cd"), (9, "ab cd"), (2**60 + 5, "ab cd")]
    asked = [(1, "ab the é"), (2, "rare x1 x1"), (3, None), (4, "?"), (None, "zz cd"), (1, "ab the é"), (2, "CD"), (7, "absent")]
    found = lexical_search.search(documents(spark, *docs).repartition(3), items(spark, *asked), sketch=sketch)
    assert sorted(map(tuple, found.collect()), key=str) == ranked_plainly(docs, asked)


def test_bounds_are_above_scores():
    rng = random.Random(1)
    corpus = lexical_search.Corpus(50, 900, {b"a": 3, b"b": 40, b"c": 1})
    terms = [[(t, corpus.weight(t)) for t in (b"a", b"b", b"c")], [(b"c", 5 * corpus.weight(b"c"))]]
    queries = lexical_search.Queries(corpus, terms)
    docs = [Counter({t: rng.randrange(1, 9) for t in rng.sample([b"a", b"b", b"c", b"d", b"e"], 3)}) for _ in range(40)]
    parts = np.array([corpus.length_part(d.total()) for d in docs])
    bounds = queries.bounds(docs, parts)
    scores = [[queries.score(i, d, int(m)) for i in range(2)] for d, m in zip(docs, parts)]
    assert (bounds >= np.array(scores)).all()


def test_search_of_nothing(spark):
    none, one = documents(spark), documents(spark, (1, "a b"))
    assert lexical_search.search(none, items(spark, (1, "a"))).count() == 0
    assert lexical_search.search(one, items(spark)).count() == 0


# class model


def plain_scores(docs, training, model):
    """Base score, score, tokens and known tokens of each text, one token after the other."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) for t in training]
    counts = Counter(w for ws in split for w in ws)
    counts[None] = len(split)
    if not split:
        del counts[None]
    n, v = counts.total(), len(counts)
    units = {w: 0 if w is None else model.units.of(w.encode()) for w in counts}
    tokens, distinct = defaultdict(int), defaultdict(int)
    for w, c in counts.items():
        tokens[model.classes[units[w]]] += c
        distinct[model.classes[units[w]]] += 1
    follow = Counter()
    for ws in split:
        path = [model.classes[u] for u in [0, *(units[w] for w in ws), 0]]
        follow.update(zip(path, path[1:]))
    k = len(model.transition)
    into, out = Counter(), Counter()
    for (a, b), c in follow.items():
        out[a] += c
        into[b] += c
    rows = []
    for text in docs:
        ws = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        base = score = 0.0
        before = model.classes[0]
        for w in [*ws, None]:
            own = model.classes[0 if w is None else model.units.of(w.encode())]
            share = (into[own] + 1) / (follow.total() + k)
            moved = (follow[before, own] + k * share) / (out[before] + k)
            base += math.log10((counts[w] + 1) / (n + v + 1))
            score += math.log10(moved) + math.log10((counts[w] + 1) / (tokens[own] + distinct[own] + 1))
            before = own
        rows.append((len(ws) + 1, sum(counts[w] > 0 for w in [*ws, None]), n, base, score))
    return rows


@pytest.mark.parametrize("known", [0, 4, 1000])
def test_class_scores_equal_plain_ones(spark, known):
    rng = random.Random(3)
    vocabulary = ["Der", "der", "haus", "häuser", "x", "of", "the", "Bäume hoch", "q1", "zzz"]
    training = [" \t\n".join(rng.choices(vocabulary, k=rng.randrange(25))) for _ in range(40)] + [None, "", "of " * 5000]
    texts = training + ["unseen words the", "unseen" * 1000, "the unseen of"]
    rows = [(rng.choice([None, 2**60 + 1, 2**60 + 3]), t) for t in texts]
    train = documents(spark, *[(1, t) for t in training])
    model = class_model.train(train, head_words=4, endings=3, n_classes=4, known_words=known)
    found = class_model.score(documents(spark, *rows).repartition(3), model).collect()
    expected = [(i, *r) for (i, _), r in zip(rows, plain_scores(texts, training, model))]

    def order(rows):
        return sorted(((str(r[0]), r[1], r[2], r[3], round(r[4], 6), round(r[5], 6)) for r in rows))

    assert order(found) == order(expected)


def test_most_frequent_words_of_one_count_stay_together(spark):
    counts = spark.createDataFrame([(b"a", 5), (b"c", 3), (b"b", 3), (b"d", 1)], "word binary, n long")
    found = [list(class_model.most_frequent(counts, most)) for most in range(5)]
    assert found == [[], [b"a"], [b"a"], [b"a", b"b", b"c"], [b"a", b"b", b"c", b"d"]]


def test_head_words_are_there_where_too_many_words_have_one_count(spark):
    train = documents(spark, (1, "b a d c"), (2, "f e"))
    model = class_model.train(train, head_words=3, endings=2, n_classes=4, known_words=5)
    assert model.known == {} and list(model.units.head) == [b"a", b"b", b"c"]


def test_probabilities_add_up_to_one(spark):
    train = documents(spark, (1, "a b a c a b"), (2, "b a d"), (3, None))
    model = class_model.train(train, head_words=2, endings=2, n_classes=4)
    assert np.allclose((10**model.transition).sum(1), 1)
    # words of a class and one place for unknown ones
    assert model.tokens.sum() == model.n_tokens == 12 and model.distinct.sum() == model.n_words == 5


def test_without_training_texts_and_without_documents(spark):
    model = class_model.train(documents(spark), head_words=4, endings=3, n_classes=4)
    row = class_model.score(documents(spark, (1, "a b")), model).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)
    assert math.isfinite(row.score)
    assert class_model.score(documents(spark), model).count() == 0


def test_exchange_gains_at_every_move_and_finds_planted_classes():
    rng = np.random.default_rng(0)
    kind = np.concatenate([[0], 1 + np.arange(30) % 3])
    # words of a class are followed by words of the next one, mostly
    rate = np.where(kind[None, :] == (kind[:, None] % 3) + 1, 20.0, 0.2)
    pairs = rng.poisson(rate).astype(float)
    start = class_model.exchange(pairs, 4, 0)
    found = class_model.exchange(pairs, 4)
    values = [class_model.likelihood(pairs, class_model.exchange(pairs, 4, s), 4) for s in range(5)]
    assert values == sorted(values) and values[-1] > class_model.likelihood(pairs, start, 4)
    assert len({(a, b) for a, b in zip(kind[1:], found[1:])}) == 3
    for unit in range(1, len(pairs)):  # no single move is better
        for other in range(1, 4):
            moved = found.copy()
            moved[unit] = other
            assert class_model.likelihood(pairs, moved, 4) <= class_model.likelihood(pairs, found, 4) + 1e-6


def test_class_model_predicts_held_out_texts_better_than_single_words(spark):
    docs = table(ready(spark), "/root/testdata/sf0.01", "documents")
    held_out = is_held_out("doc_id", 7, 2)
    model = class_model.train(docs.where(~held_out))
    sums = class_model.score(docs.where(held_out), model).groupBy().sum("base_score", "score").first()
    assert sums["sum(score)"] > sums["sum(base_score)"]


# conversation trie

TURNS = "conv_id long, turn long, role string, text string, depth int, ka long"


def turns(spark, *rows):
    return ready(spark).createDataFrame([(*r, 1, 2) for r in rows], TURNS)


def plain_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            both = hashlib.md5((hashlib.md5(role.encode()).hexdigest() + hashlib.md5(text.encode()).hexdigest()).encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, both, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    nodes = defaultdict(list)
    lengths = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        path = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + ts[h:])
        lengths[c] = len(path)
        for d in range(len(path) + 1):
            nodes[path[:d]].append(c)
    children, leaves, saved = Counter(), Counter(), Counter()
    for path, members in nodes.items():
        if path:
            children[path[:-1]] += 1
    for path, members in nodes.items():
        gain = (len(members) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += gain
    return sorted(
        (
            min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
            hashlib.sha256(",".join(str(c) for c in sorted(m) if lengths[c] == len(p)).encode()).hexdigest(),
        )
        for p, m in nodes.items()
    )


ODD_TURNS = [
    (None, 0, "user", "no conversation"), (-3, 0, "user", "a"), (-3, 1, None, "é"), (2**60 + 5, 0, "user", "a"),
    (2**60 + 7, None, None, None), (2**60 + 7, 0, "user", "a"), (2**60 + 7, 0, "user", "a"), (2**60 + 7, 0, "user", "b"),
    (10, 0, "user", "x" * 100_000), (11, 5, "user", "x" * 100_000), (11, 5, "", "x"), (11, 7, "u", None),
]


def test_trie_equals_plain_one(spark):
    rng = random.Random(2)
    rows = list(ODD_TURNS)
    for c in range(20, 140):
        rows += [(c, t, rng.choice(["user", None]), rng.choice("ab")) for t in range(rng.randrange(1, 11))]
    found = conversation_trie.conversation_trie(turns(spark, *rows).repartition(3))
    assert sorted(map(tuple, found.collect()), key=lambda r: (r[0], r[1])) == plain_trie(rows)


def test_levels_peeled_in_blocks_give_the_same(spark, monkeypatch):
    rng = random.Random(4)
    rows = list(ODD_TURNS)
    for c in range(20, 60):
        rows += [(c, t, "user", rng.choice("ab") if t > 20 else "a") for t in range(rng.randrange(1, 40))]
    for levels, keys in ((2, 300), (0, 10**6), (10, 10)):
        monkeypatch.setattr(conversation_trie, "SINGLE_LEVELS", levels)
        monkeypatch.setattr(conversation_trie, "BLOCK_KEYS", keys)
        if keys == 10:
            rows = [r for r in rows if r[1] is None or r[1] < 14]
        found = conversation_trie.conversation_trie(turns(spark, *rows))
        assert sorted(map(tuple, found.collect()), key=lambda r: (r[0], r[1])) == plain_trie(rows)


def test_a_long_conversation_takes_few_levels():
    lengths = {5000: 1, 4999: 2, 7: 1000, 3: 10}
    depths = list(conversation_trie._depths(lengths))
    assert depths[0][1] == 5000 and depths[-1] == (0, 0)
    assert [high for _, high in depths[1:]] == [low - 1 for low, _ in depths[:-1]]
    assert len(depths) < 60


def test_trie_of_nothing_and_ids_over_many_runs(spark):
    assert conversation_trie.conversation_trie(turns(spark)).count() == 0
    rows = [(c * 2111, 0, "user", "same") for c in range(-40, 400)]
    found = conversation_trie.conversation_trie(turns(spark, *rows))
    assert sorted(map(tuple, found.collect()), key=lambda r: (r[0], r[1])) == plain_trie(rows)
