import hashlib
import random
import re

from clickloom.llm.shape_crf import KINDS, Tokens, added_spans, base_spans, fitted, labelled_examples, luhn, personal_data

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == 0 or kind == 1 and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == 2 and 14 <= len(digits) <= 19 and luhn(digits) or kind == 3 and 10 <= len(digits) <= 15):
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def test_base_patterns_against_plain_search():
    rng = random.Random(3)
    parts = ["a", "@", ".", "b.c", "1", "25", "256", "0001", " ", "-", "+", "(", ")", "é", "%", "4465758382889437", "\n",
             "1.2.3.4", "x_y@z.d", "+1 (743) 555-3824", "١", "٣.٤.٥.٦", "@@", "..", "4785 3805 9239 1139"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert base_spans(text) == brute(text), text
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "a@" * 100_000, "+1 " * 100_000):
        base_spans(text)  # linear, or this would not end


def test_luhn():
    assert luhn("4539578763621486") and not luhn("4539578763621487")


def test_tokens_of_texts():
    t = Tokens(["Ab 12,é", "", "x\n255"])
    spans = [(int(s), int(e)) for s, e in zip(t.start, t.end)]
    assert spans == [(0, 2), (3, 5), (5, 6), (6, 7), (9, 10), (11, 14)]
    assert t.row_at.tolist() == [0, 8, 9, 15] and t.line_at.tolist() == [0, 4, 5]


def test_best_path_against_all_paths():
    from itertools import product
    field = fitted(labelled_examples(60))
    for text in ("mail x@y", "1 (0)", "a\nb 1.2"):
        tokens = Tokens([text])
        score, labels = field.scores(tokens.around()), field.labels(tokens)
        ends = [*tokens.line_at.tolist(), len(score)]
        for first, stop in zip(ends[:-1], ends[1:]):
            def total(path):
                return field.step[-1, path[0]] + sum(score[first + k, y] for k, y in enumerate(path)) + sum(
                    field.step[a, b] for a, b in zip(path, path[1:]))
            best = max(product(range(9), repeat=stop - first), key=total)
            assert tuple(labels[first:stop]) == best


def test_held_out_examples():
    field = fitted(labelled_examples())
    held = labelled_examples(600, seed=77)
    wrong = right = found = 0
    out = added_spans([t for t, _ in held], [[] for _ in held], field)
    for (_, spans), own in zip(held, out):
        gold = set(filter(None, spans.split(",")))
        got = {f"{KINDS[k]}:{s}:{e}" for s, k, e in own}
        right, wrong, found = right + len(gold & got), wrong + len(got - gold), found + len(gold)
    assert right / found > 0.95 and wrong / (right + wrong) < 0.03


def test_rows_and_edges(spark):
    runs = "x 4465758382889437 4465758382889437 y"
    rows = [(1, "mail hein.19@mail5.example.com or 10.0.0.1", 7), (2, None, 7), (3, "", 7), (None, runs, 7),
            (4, runs, 7), (4, runs, 7), (5, "no data here. 2.0.1 in 2024-01-05", 7), (6, "wort " * 200_000, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    got = sorted(personal_data(df).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    one = by_id[1]
    assert (one.n_email, one.n_ip, one.n_card, one.n_phone) == (1, 1, 0, 0)
    assert one.spans == "email:5:30,ip:34:42"
    assert one.base_sha256 == hashlib.sha256(one.spans.encode()).hexdigest()
    for name in (2, 3, 5, 6):
        assert by_id[name].spans == "" and by_id[name].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert by_id[4].n_card == 0 and by_id[4].spans == "card:2:18,card:19:35" and by_id[4].n_added == 2
    assert by_id[None].spans == by_id[4].spans
    assert personal_data(df.limit(0)).count() == 0


def test_own_labelled_table(spark):
    rows = [(f"code zz{k} here", "card:5:8") for k in range(100, 140)] + [("no code here", None), (None, None)]
    labelled = spark.createDataFrame(rows, "text string, spans string")
    df = spark.createDataFrame([(1, "a@b.cd and code zz555 here")], "doc_id long, text string")
    assert personal_data(df, labelled).first().spans == "email:0:6"  # found, but no card number


def test_whole_table_against_plain_search(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: r for r in personal_data(docs).collect()}
    for r in docs.select("doc_id", "text").toLocalIterator():
        base = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in brute(r.text or ""))
        row = got.pop(r.doc_id)
        assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(row.spans.split(","))
    assert not got
