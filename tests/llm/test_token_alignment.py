import hashlib
from collections import Counter

import numpy as np

from clickloom.llm import token_alignment
from clickloom.llm.token_alignment import SIDE_A, SIDE_B, alignments, groups, sides, vocabulary


def plain_encodings():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(public_tokenizers.path(SIDE_A))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(SIDE_B))
    return (lambda t: a.encode(" " + t, add_special_tokens=False).ids), (lambda t: b.encode(t))


def brute(rows):
    """Links and groups token by token."""
    encode_a, encode_b = plain_encodings()
    a, b = sides(vocabulary(SIDE_A), vocabulary(SIDE_B))
    counts, found = Counter(), []
    for _, text in rows:
        ids = (encode_a(text), encode_b(text)) if text else ([], [])
        parts = [[s.data[s.begin[i]:s.begin[i] + s.size[i]].tobytes() for i in x] for s, x in zip((a, b), ids)]
        if not text or any(b"".join(p) != (" " + text).encode() for p in parts):
            found.append(None)
            continue
        ends = [np.cumsum([len(p) for p in x]).tolist() for x in parts]
        begins = [[0, *e[:-1]] for e in ends]
        links = [(x, y) for x in range(len(ids[0])) for y in range(len(ids[1]))
                 if begins[0][x] < ends[1][y] and begins[1][y] < ends[0][x]]
        shared = sorted(set(ends[0]) & set(ends[1]))
        text_of = ";".join("|".join(",".join(str(i) for i, e in zip(ids[s], ends[s]) if low < e <= high) for s in (0, 1))
                           for low, high in zip([0, *shared[:-1]], shared))
        pairs = [(ids[0][x], ids[1][y]) for x, y in links]
        counts.update(pairs)
        found.append((len(ids[0]), len(ids[1]), len(shared), pairs, text_of))
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    out = []
    for (name, _), f in zip(rows, found):
        out.append((name, 0, 0, 0, 0, 0, 0, "") if f is None else (
            name, f[0], f[1], f[2], len(f[3]), sum(counts[p] == best[p[1]] for p in f[3]), sum(counts[p] for p in f[3]),
            hashlib.sha256(f[4].encode()).hexdigest()))
    return sorted(out, key=repr)


ROWS = [
    (1, "The quick brown fox, the QUICK fox."), (2, None), (3, ""), (4, " "), (5, "  two  blanks \n\n lines\t"), (6, "The quick brown fox"),
    (6, "The quick brown fox"), (None, "no id"), (7, "<|endoftext|> and </s> <s> <unk> <0x41>"), (8, "Größe déjà vu ñandú ćma ﬁ ①"),
    (9, "日本語のテキスト 🙂🙂 é"), (10, "a" * 900), (11, "x1 22 333 4444 55555 it's we'll"), (12, "▁ sign"), (13, "\x00\x01 nul"),
    (14, " nbsp​"), (15, "The the THE fox " * 300)]


def got(df):
    return sorted((tuple(r) for r in alignments(df).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=repr)


def test_against_every_pair_of_tokens(spark, monkeypatch):
    df = spark.createDataFrame([(i, t, 1) for i, t in ROWS], "doc_id long, text string, n_a int").repartition(3)
    wanted = brute(ROWS)
    assert got(df) == wanted
    # memory that is given up often, and pair counts sent in several blocks
    monkeypatch.setattr(token_alignment, "MEMO", 5)
    monkeypatch.setattr(token_alignment, "SLICE", 200)
    monkeypatch.setattr(token_alignment, "PAIRS_HELD", 10)
    monkeypatch.setattr(token_alignment, "PAIRS_SENT", 40)
    assert got(df) == wanted


def test_groups_join_to_the_text(spark):
    a, b = sides(vocabulary(SIDE_A), vocabulary(SIDE_B))
    df = spark.createDataFrame([r for r in ROWS if r[0]], "doc_id long, text string")
    texts = {i: t for i, t in ROWS}
    for r in groups(df).collect():
        if r.groups:
            for side, name in ((a, "a"), (b, "b")):
                ids = np.array([i for g in r.groups for i in g[name]])
                assert side.joined(ids).tobytes() == (" " + texts[r.doc_id]).encode()


def test_given_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 1500")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(docs) == brute(rows)


def test_empty_table(spark):
    assert alignments(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_pair_sums_from_stored_pairs_alone():
    """The second pass sums from each row's pairs and their repeats; it needs no vocabulary."""
    import pyarrow as pa
    from types import SimpleNamespace

    links = [np.array([3, 7, 9], np.int64), np.array([], np.int64), np.array([7], np.int64)]
    times = [np.array([2, 1, 4], np.int32), np.array([], np.int32), np.array([5], np.int32)]
    binary = lambda xs: pa.array([x.tobytes() for x in xs], pa.binary())
    batch = pa.RecordBatch.from_arrays(
        [pa.array([0, 1, 2], pa.int64()), *[pa.array([1, 2, 3], pa.int64()) for _ in range(5)],
         pa.array(["", "", ""]), binary(links), binary(times)],
        ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links", "times"])
    sums = SimpleNamespace(value=(np.array([3, 7], np.int64), np.array([10, 20], np.int64), np.array([True, False])))
    out = pa.Table.from_batches(list(token_alignment._pair_sums(sums)([batch])))
    assert out.column("n_best").to_pylist() == [2, 0, 0]
    assert out.column("count_sum").to_pylist() == [2 * 10 + 20, 0, 5 * 20]
