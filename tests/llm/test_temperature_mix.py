import math

import pytest
from clickloom.llm.temperature_mix import exponent, mixture, weights


def sources(spark, tokens):
    return spark.createDataFrame([(f"s{k}" if k else None, t) for k, t in enumerate(tokens)], "source string, tokens long")


def brute(tokens, a):
    p = [t / sum(tokens) for t in tokens]
    z = sum(x ** a for x in p)
    w = [x ** a / z for x in p]
    return w, -sum(x * math.log(x) for x in w)


def test_exponent_meets_its_target(spark):
    tokens = [900, 50, 30, 20]
    df = sources(spark, tokens)
    a = exponent(df, 1000, target_entropy=0.8)
    assert brute(tokens, a)[1] >= 0.8 * math.log(4) - 1e-9 > brute(tokens, a + 1e-6)[1] - 1e-9
    b = exponent(df, 1000, max_repeats=3)
    most = [max(w * 1000 / t for w, t in zip(brute(tokens, x)[0], tokens)) for x in (b, b - 1e-6)]
    assert most[0] <= 3 + 1e-9 < most[1] + 1e-9
    assert exponent(df, 1000, target_entropy=0.1) == 1 and exponent(df, 10, max_repeats=3) == 0
    assert exponent(df, 10 ** 6, max_repeats=2) == 1
    rows = weights(df, 1000, max_repeats=3).collect()
    assert sum(r.weight for r in rows) == pytest.approx(1) and max(r.passes for r in rows) == pytest.approx(3)


def test_budget_and_order(spark):
    rows = [(d, "big" if d % 10 else "small" if d % 20 else None, " ".join(["w"] * (1 + d % 7)), 0) for d in range(3000)]
    rows += [(5000, "small", None, 0), (5001, "small", "", 0), (None, "none", "a b", 0), (7, "big", "w " * 6 + "w", 0)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, epoch int")
    got = mixture(df, target_entropy=None, max_repeats=3.0).collect()
    tokens, drawn = {}, {}
    for d, s, t, _ in rows:
        tokens[s] = tokens.get(s, 0) + (len(t.split(" ")) if t else 0)
    total = sum(tokens.values())
    for r in got:
        drawn[r.source] = drawn.get(r.source, 0) + r.n_tokens
    shares = weights(spark.createDataFrame(list(tokens.items()), "source string, tokens long"), total, max_repeats=3.0).collect()
    for r in shares:
        assert r.weight * total - 1e-6 <= drawn[r.source] <= r.weight * total + 7
    uses = {}
    for r in got:
        uses.setdefault((r.source, r.epoch), []).append(r.doc_id)
    for (s, e), docs in uses.items():
        assert len(docs) == len(set(docs)) or s == "big"
        if (s, e + 1) in uses:  # a whole pass
            assert sorted(docs, key=str) == sorted((d for d, x, t, _ in rows if x == s and t), key=str)
    assert 5000 not in {r.doc_id for r in got} and 5001 not in {r.doc_id for r in got}
    assert all(0 <= r.mix_at < 1 for r in got)


def test_empty_table(spark):
    assert mixture(spark.createDataFrame([], "doc_id long, source string, text string")).count() == 0
    assert mixture(spark.createDataFrame([(1, "a", None)], "doc_id long, source string, text string")).count() == 0
