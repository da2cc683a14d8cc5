import base64

import tiktoken

from clickloom.llm.token_lengths import length_histogram, length_quantile, token_counts, totals_at, vocabulary_path


def test_every_context_limit_against_plain_sums(spark):
    lengths = [0, 0, 1, 5, 5, 5, 1023, 1024, 1025, 9000]
    histogram = length_histogram(spark.createDataFrame([(n,) for n in lengths], "n_tokens long"))
    rows = {r.n_tokens: r for r in histogram.collect()}
    assert set(rows) == set(lengths)
    for n, r in rows.items():
        assert (r.n_docs, r.docs_ge) == (lengths.count(n), sum(x >= n for x in lengths))
        assert r.tokens_ge == sum(x for x in lengths if x >= n)
        assert r.truncated_total == sum(min(x, n) for x in lengths)
        assert r.share_le == sum(x <= n for x in lengths) / len(lengths)
    for limit in (0, 3, 1024, 10 ** 6):
        assert tuple(totals_at(histogram, limit).first()) == (
            10, sum(lengths), sum(min(x, limit) for x in lengths), sum(x > limit for x in lengths))
    assert [length_quantile(histogram, q).first()[0] for q in (0.1, 0.5, 1.0)] == [0, 5, 9000]
    empty = length_histogram(spark.createDataFrame([], "n_tokens long"))
    assert empty.count() == 0 and tuple(totals_at(empty, 5).first()) == (0, 0, 0, 0)


def test_counts_against_the_tokenizer(spark):
    import public_tokenizers
    with open(vocabulary_path(), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [(1, None), (2, ""), (3, "Hello, wörld!"), (4, "<|endoftext|>"), (5, "ab " * 50_000), (3, "Hello, wörld!"), (None, "x")]
    df = spark.createDataFrame([(d, t, 9) for d, t in rows], "doc_id long, text string, n_tokens int")
    got = sorted(((r.doc_id, r.n_tokens) for r in token_counts(df).collect()), key=str)
    assert got == sorted(((d, len(plain.encode_ordinary(t or ""))) for d, t in rows), key=str)


def test_round_trip_of_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    counts = token_counts(docs)
    histogram = length_histogram(counts)
    assert totals_at(histogram, 10 ** 9).first().n_tokens == sum(r.n_tokens for r in counts.collect())
    assert totals_at(histogram, 10 ** 9).first().n_docs == docs.count()
