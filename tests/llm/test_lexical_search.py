import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from clickloom.llm import lexical_search
from clickloom.llm.common import utf8, word_hashes
from clickloom.llm.lexical_search import build_index, packed, ranked, search, unpacked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    own = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n_docs, n_terms = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, asked in items.items():
        found = []
        for d, c in own:
            m = 75 + 25 * sum(c.values()) * n_docs // n_terms
            score = sum(r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m))
                        for t, r in asked.items() if t in c)
            if score > 0:
                found.append((-score, d is None, d, score))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, n + 1, d, s) for n, (_, _, d, s) in enumerate(found[:k])]
    return sorted(out, key=repr)


def test_variable_length_bytes():
    values = np.array([0, 1, 127, 128, 300, 1 << 20, 1 << 40, 5])
    data, ends = packed(values)
    assert unpacked(data).tolist() == values.tolist() and ends[-1] == len(data)


def test_against_all_scores(spark, monkeypatch):
    """Several shards and blocks of items; ties, copies and edges."""
    monkeypatch.setattr(lexical_search, "ITEM_BYTES", 150)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "Straße", "١"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, rng.choice([" ", ", ", "\n"]).join(rng.choices(vocabulary, weights, k=rng.randrange(1, 60)))) for i in range(600)]
    docs += [(900, None), (901, ""), (902, "..."), (903, docs[0][1]), (3, docs[3][1]), (None, docs[7][1]), (904, "w1 " * 5000)]
    rng.shuffle(docs)
    items = [(i, " ".join(rng.choices(vocabulary, k=n))) for i, n in enumerate([1, 2, 5, 9, 30, 12])]
    items += [(50, None), (51, ""), (52, "absent words"), (2, items[2][1]), (3, "W1 w1"), (None, "w2 É")]
    asked = {}
    for i, text in dict.fromkeys(items):
        if text is not None:
            asked.setdefault(i, Counter()).update(terms(text))
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, score int").repartition(3)
    bench = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, doc_id int")
    index = build_index(df, shard_bytes=5_000)
    assert index.where("term is null").count() > 3
    for k in (1, 7, 20):
        got = [tuple(r) for r in search(index, bench, k).collect()]
        assert sorted(got, key=repr) == brute(docs, asked, k)


def test_one_shard_of_many_blocks_and_strips(monkeypatch):
    """Bounds that give up candidates and blocks lose no document."""
    monkeypatch.setattr(lexical_search, "BLOCK", 8)
    monkeypatch.setattr(lexical_search, "STRIP", 32)
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(1, 80)))) for i in range(2000)]
    own = [Counter(terms(t)) for _, t in docs]
    data, ends = utf8(pa.array([t for _, t in docs]))
    rows = pa.Table.from_batches([lexical_search._shard(0, np.arange(len(docs)), data, ends)])
    n_terms, df = sum(sum(c.values()) for c in own), Counter(t for c in own for t in c)
    hashes, _ = word_hashes(*utf8(pa.array(vocabulary)), lexical_search.APART)
    named = dict(zip(vocabulary, hashes.view(np.int64).tolist()))
    weight = {named[t]: math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * n + 1))) for t, n in df.items()}
    opened = total = 0
    for size in (1, 2, 4, 12):
        for _ in range(4):
            asked = Counter(rng.choices(vocabulary, k=size))
            lists = lexical_search.Lists(rows, weight, len(docs), n_terms)
            ids, scores = lists.best([(named[t], n) for t, n in asked.items()], 10)
            found = [(0, n + 1, d, s) for n, (d, s) in enumerate(zip(ids.tolist(), scores.tolist()))]
            assert sorted(found, key=repr) == brute(docs, {0: asked}, 10)
            used = [lists.lists[named[t]] for t in asked if named[t] in lists.lists]
            opened, total = opened + sum(len(x.opened) for x in used), total + sum(len(x.bounds) for x in used)
    assert opened < 0.8 * total


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    nothing, no_items = docs.where("doc_id > 9"), bench.where("item_id > 9")
    assert ranked(nothing, bench).count() == 0
    assert ranked(docs, no_items).count() == 0
    # a term that every document holds has no weight
    assert ranked(docs, bench).count() == 1
    assert ranked(docs, bench).schema.simpleString() == "struct<item_id:bigint,rank:int,doc_id:bigint,score:bigint>"
