import random
import re

from clickloom.llm.spaced_seeds import MASKS, clean, overlaps


def words(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())


def brute(docs, items):
    """All alignments that share a seed, by slicing; items under 15 words at every place."""
    seeds, short = {}, []
    for i, item in items:
        v = words(item)
        if len(v) < 15:
            short.append((i, v))
            continue
        for m in MASKS:
            for q in range(len(v) - len(m) + 1):
                seeds.setdefault((m, *(v[q + k] for k in range(len(m)) if m[k] == "1")), []).append((i, q, v))
    out = set()
    for d, text in docs:
        w = words(text)
        for i, v in short:
            needed = len(v) if len(v) < 8 else len(v) - 1
            if v and any(sum(x == y for x, y in zip(w[s:s + len(v)], v)) >= needed for s in range(len(w) - len(v) + 1)):
                out.add((d, i))
        for m in {key[0] for key in seeds}:
            for p in range(len(w) - len(m) + 1):
                for i, q, v in seeds.get((m, *(w[p + k] for k in range(len(m)) if m[k] == "1")), []):
                    s = p - q
                    same = [w[s + k] == v[k] for k in range(len(v)) if 0 <= s + k < len(w)]
                    best = max(((sum(same[a:b]) - 2 * (b - a - sum(same[a:b])), sum(same[a:b]))
                                for a in range(len(same)) for b in range(a + 1, len(same) + 1)))
                    if best[1] >= 13 and best[0] >= 10:
                        out.add((d, i))
    return out


def test_edges_against_brute_force(spark):
    rng = random.Random(4)
    vocabulary = ["the", "of", "and", "é1", "to"] + [f"v{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(n))) for i, n in enumerate([15, 20, 30, 14, 13, 12, 9, 8, 7, 5, 0])]
    items.append((40, "v39"))
    items += [(50, None), (51, "")]
    docs = [(0, None), (1, ""), (2, "...")]
    for k in range(120):
        own = [rng.choice(vocabulary) for _ in range(rng.randrange(30))]
        planted = rng.choice(items)[1] or ""
        planted = planted.split()
        for _ in range(rng.choice([0, 1, 2, 4])):
            if planted:
                planted[rng.randrange(len(planted))] = rng.choice(vocabulary)
        at = rng.randrange(len(own) + 1)
        docs.append((10 + k, rng.choice([" ", ", ", "\n"]).join(own[:at] + planted + own[at:]).upper()))
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, doc_id int")
    wanted = brute(docs, items)
    assert wanted
    assert {(r.doc_id, r.item_id) for r in overlaps(df, bench).collect()} == wanted
    kept = {r.doc_id for r in clean(df, bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in wanted}
    assert clean(df, bench).columns == df.columns


def test_short_items_with_a_replaced_word(spark):
    for size in range(1, 15):
        item = [f"w{i}" for i in range(size)]
        texts = [["a"] * 3 + item[:p] + ["x"] + item[p + 1:] + ["b"] for p in range(size)]
        texts += [item, item[1:], item[:-1], ["w0", "x", *item[1:]]]
        docs = spark.createDataFrame([(d, " ".join(t)) for d, t in enumerate(texts)], "doc_id long, text string")
        bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
        got = sorted(tuple(r) for r in overlaps(docs, bench).collect())
        replaced = [(d, 1, 3, 2 + size, size - 1) for d in range(size)] if size >= 8 else []
        # a word put in behind the first leaves a window with one word replaced only for these two
        put_in = [(size + 3, 1, 0, 0, 1)] if size == 1 else [(size + 3, 1, 1, size, size - 1)] if size >= 8 else []
        assert got == [*replaced, (size, 1, 0, size - 1, size), *put_in], size


def test_empty_tables_and_repeated_rows(spark):
    item = " ".join(f"w{i}" for i in range(20))
    df = spark.createDataFrame([(1, item), (1, item), (None, item)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (7, item)], "item_id long, text string")
    assert [tuple(r) for r in overlaps(df, bench).orderBy("doc_id").collect()] == [
        (None, 7, 0, 19, 20), (1, 7, 0, 19, 20), (1, 7, 0, 19, 20)]
    assert overlaps(df.limit(0), bench).count() == 0
    assert overlaps(df, bench.limit(0)).count() == 0


def test_given_benchmark_is_found_where_its_text_stands(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    verbatim = {d.doc_id for d in docs.collect() for i in items.collect() if i.text in (d.text or "")}
    found = {r.doc_id for r in overlaps(docs, items).collect()}
    assert verbatim and verbatim <= found
    assert len(found - verbatim) < 0.02 * docs.count()
