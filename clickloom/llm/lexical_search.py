"""Ranked lexical search with Block-Max MaxScore over a sharded inverted index.

The index holds, for every shard of documents and every term, the postings in blocks of 128:
document numbers as differences and term frequencies, both as variable-length bytes, and for
each block its last document, its largest frequency and its shortest document. Scores grow
with the frequency and fall with the length, so these two give a bound for a block once the
corpus statistics are known, and the index needs no second pass when these change.

A search orders the lists of an item's terms by their bounds. Lists whose bounds together
cannot reach the score of the k-th document found so far are not essential: candidates come
from the others only. A candidate is given up as soon as its score so far, the maxima of its
blocks in the non-essential lists and the bounds of the lists still to come cannot beat that
score; a block is decompressed only for candidates that are left. Every shard keeps the best
k documents of every item, and these heaps are merged at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import slices, stored, utf8, word_hashes

SHARD = 8 << 20         # bytes of text of a shard; a longer text is a shard of its own
BLOCK = 128             # postings
STRIP = 4096            # documents of a shard that are scored at once, fewer at its begin
ITEM_BYTES = 4 << 20    # bytes of item text that go to the tasks at once
NO_ID = np.iinfo(np.int64).max

# Bytes that are no part of a term: ASCII without digits and letters.
APART = np.ones(256, bool)
APART[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

INDEX = "shard long, term long, n long, postings binary, blocks binary"
FOUND = "item long, doc_id long, score long"


# --- index ----------------------------------------------------------------------------------


def _lengths(values: np.ndarray) -> np.ndarray:
    """Bytes that each value takes, seven bits to a byte."""
    size = np.ones(len(values), np.int64)
    for bits in (7, 14, 21, 28, 35, 42, 49, 56):
        size += values >= (1 << bits)
    return size


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Variable-length bytes of ``values``, the last byte of each with its high bit set, and
    where each value ends."""
    size = _lengths(values)
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(int(size.max()) if len(size) else 0):
        more = size > k
        out[(ends - size)[more] + k] = (values[more] >> (7 * k)) & 127
    out[ends - 1] |= 128
    return out, ends


def unpacked(data: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(data >= 128)
    begin = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(begin, ends - begin + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), begin)


def _binaries(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.binary())


def _shard(number: int, ids: np.ndarray, data: np.ndarray, ends: np.ndarray) -> pa.RecordBatch | None:
    """All postings of some documents; a row without term has their ids and lengths."""
    terms, at = word_hashes(data, ends, APART)
    length = np.diff(at)
    # documents are numbered by id, so that of two equal scores the first is the smaller id
    order = np.argsort(ids, kind="stable")
    order = order[length[order] > 0]
    if not len(order):
        return None
    number_of = np.zeros(len(ids), np.int64)
    number_of[order] = np.arange(len(order))
    doc = np.repeat(number_of, length)
    by = np.lexsort((doc, terms))
    terms, doc = terms[by], doc[by]
    first = np.ones(len(terms), bool)
    first[1:] = (terms[1:] != terms[:-1]) | (doc[1:] != doc[:-1])
    start = np.flatnonzero(first)
    tf = np.diff(np.append(start, len(terms)))
    terms, doc = terms[start], doc[start]
    length = length[order]

    list_start = np.flatnonzero(np.append(True, terms[1:] != terms[:-1]))
    n = np.diff(np.append(list_start, len(terms)))
    rank = np.arange(len(terms)) - np.repeat(list_start, n)
    delta = np.diff(doc, prepend=0)
    opens = rank % BLOCK == 0
    delta[opens] = doc[opens]
    data, value_ends = packed(np.stack([delta, tf], 1).ravel())
    posting_ends = value_ends[1::2]

    block_start = np.flatnonzero(opens)
    block_last = np.append(block_start[1:], len(terms)) - 1
    n_blocks = -(-n // BLOCK)
    list_byte = np.concatenate([[0], posting_ends])[list_start]
    block_byte = posting_ends[block_last] - np.repeat(list_byte, n_blocks)
    blocks = np.stack([doc[block_last], block_byte, np.maximum.reduceat(tf, block_start),
                       np.minimum.reduceat(length[doc], block_start)], 1).astype(np.int64)
    head = np.stack([ids[order], length], 1).astype(np.int64)
    rows = len(list_start) + 1
    lists = _binaries(data, posting_ends[np.append(list_start[1:], len(terms)) - 1])
    sizes = _binaries(blocks.view(np.uint8).ravel(), np.cumsum(n_blocks) * 4 * 8)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(rows, number), pa.int64()),
        pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(terms[list_start].view(np.int64), pa.int64())]),
        pa.array(np.append(len(order), n), pa.int64()),
        pa.concat_arrays([pa.array([head.tobytes()], pa.binary()), lists]),
        pa.concat_arrays([pa.nulls(1, pa.binary()), sizes])], ["shard", "term", "n", "postings", "blocks"])


def _shards(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        size = 0

        def done():
            table = pa.Table.from_batches(held).combine_chunks()
            ids = table.column("doc_id").combine_chunks().fill_null(NO_ID).to_numpy()
            return _shard(number, ids, *utf8(table.column("text")))

        for batch in slices(batches, "text", most):
            own = len(utf8(batch.column("text"))[0])
            if held and size + own > most:
                yield from _cut(done())
                number, held, size = number + 1, [], 0
            held.append(batch)
            size += own
        if held:
            yield from _cut(done())
    return run


def _cut(batch: pa.RecordBatch | None, most: int = 20_000) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows if batch else 0, most):
        yield batch.slice(start, most)


def build_index(docs: DataFrame, shard_bytes: int = SHARD) -> DataFrame:
    """The inverted index of ``docs(doc_id, text)``, written to the shared scratch folder.

    Rows without a term, null texts among them, are in no list and in no statistic. A shard is
    a run of documents of one input partition with about ``shard_bytes`` of text. Nothing is
    shuffled.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(texts.mapInArrow(_shards(shard_bytes), INDEX), "lexical-index")


# --- search ---------------------------------------------------------------------------------


class Lists:
    """The lists of one shard, with bounds and scores under the statistics of the corpus."""

    def __init__(self, rows: pa.Table, weights: dict[int, int], n_docs: int, n_terms: int):
        terms = rows.column("term").to_pylist()
        head = terms.index(None)
        ids = np.frombuffer(rows.column("postings")[head].as_py(), np.int64).reshape(-1, 2)
        self.ids, self.m = ids[:, 0], _norms(ids[:, 1], n_docs, n_terms)
        self.lists = {}
        for term, postings, blocks in zip(terms, rows.column("postings"), rows.column("blocks")):
            if term is not None:
                table = np.frombuffer(blocks.as_py(), np.int64).reshape(-1, 4)
                bounds = _scores(weights[term], table[:, 2], _norms(table[:, 3], n_docs, n_terms))
                self.lists[term] = _List(weights[term], np.frombuffer(postings.as_py(), np.uint8), table, bounds)

    def best(self, query: list[tuple[int, int]], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and scores of the ``k`` best documents for terms and their repeats."""
        known = [(int(self.lists[t].bounds.max()) * r, self.lists[t], r) for t, r in query if t in self.lists]
        known = sorted((x for x in known if x[0] > 0), key=lambda x: x[0])
        reach = np.cumsum([0] + [bound for bound, _, _ in known])
        docs, scores, least = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        stop = 0
        while stop < len(self.ids):
            # the first strips are short, so that later ones know a score to beat
            begin, stop = stop, min(stop + min(stop + 256, STRIP), len(self.ids))
            essential = int(np.searchsorted(reach[1:], least, "right"))
            if essential == len(known):
                break
            total = np.zeros(stop - begin, np.int64)
            for _, postings, repeats in known[essential:]:
                there, score = postings.between(begin, stop, self.m)
                total[there - begin] += score * repeats
            some = np.flatnonzero((total > 0) & (total + reach[essential] > least))
            total = total[some]
            some = some + begin
            for n in range(essential - 1, -1, -1):
                _, postings, repeats = known[n]
                block, bound = postings.bounds_of(some)
                left = total + bound * repeats + reach[n] > least
                some, total, block = some[left], total[left], block[left]
                if not len(some):
                    break
                total += postings.scores_of(some, block, self.m) * repeats
            left = total > least
            docs, scores = np.append(docs, some[left]), np.append(scores, total[left])
            order = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[order], scores[order]
            if len(docs) == k:
                least = int(scores[-1])
        return self.ids[docs], scores


class _List:
    def __init__(self, weight: int, data: np.ndarray, table: np.ndarray, bounds: np.ndarray):
        self.weight, self.data, self.last, self.bounds = weight, data, table[:, 0], bounds
        self.ends = np.concatenate([[0], table[:, 1]])
        self.opened: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def opened_block(self, block: int, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of a block, decompressed when first asked for."""
        found = self.opened.get(block)
        if found is None:
            values = unpacked(self.data[self.ends[block]:self.ends[block + 1]])
            docs = np.cumsum(values[::2])
            found = self.opened[block] = docs, _scores(self.weight, values[1::2], m[docs])
        return found

    def between(self, begin: int, stop: int, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        blocks = range(int(np.searchsorted(self.last, begin)), min(int(np.searchsorted(self.last, stop)) + 1, len(self.last)))
        parts = [self.opened_block(b, m) for b in blocks]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        docs, scores = (np.concatenate(p) for p in zip(*parts))
        inside = slice(*np.searchsorted(docs, [begin, stop]))
        return docs[inside], scores[inside]

    def bounds_of(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The block in which each document would be, and the most it could score there."""
        block = np.searchsorted(self.last, docs)
        return block, np.where(block < len(self.last), self.bounds[np.minimum(block, len(self.last) - 1)], 0)

    def scores_of(self, docs: np.ndarray, block: np.ndarray, m: np.ndarray) -> np.ndarray:
        out = np.zeros(len(docs), np.int64)
        for b in np.unique(block[block < len(self.last)]).tolist():
            own, scores = self.opened_block(b, m)
            here = np.flatnonzero(block == b)
            at = np.minimum(np.searchsorted(own, docs[here]), len(own) - 1)
            hit = own[at] == docs[here]
            out[here[hit]] = scores[at[hit]]
        return out


def _norms(length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """100 times 1 - b + b * length / mean length, for b a quarter."""
    return 75 + (25 * length * n_docs) // n_terms


def _scores(weight: int, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's part of a document's score, for k1 of 1.2."""
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


def search(index: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents for each of ``items(item_id, text)``.

    With N documents that have a term, L terms in all of them, n in the document, df documents
    with a term and tf times that term in the document, a document's score is the sum of
    w * (10^9 tf div (1000 tf + 12 m)) over the item's terms, repeats included, where w is
    floor(1000 ln((2N + 2) / (2 df + 1))) and m is 75 + 25 n N div L. Only scores above 0
    count; of equal scores the smaller ``doc_id`` comes first, a missing one last. Terms are
    compared as 64-bit hashes of the runs of letters, digits and non-ASCII characters, A to Z
    in lower case.

    Items of one id are one query; null texts have no terms and find nothing; rows of ``docs``
    that repeat are documents of their own. Items go to the tasks in blocks of
    ``ITEM_BYTES``, each a search of its own. A task searches one shard at a time, from the
    lists of the items' terms only; a shard sends ``k`` rows for each item at most.
    """
    shards = index.where("term is null").select("shard", "n", "postings")
    sums = shards.mapInArrow(_sizes, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).head()
    n_docs, n_terms = sums[0] or 0, sums[1] or 0
    found = None
    for names, queries in _blocks(items):
        part = _searched(index, names, queries, n_docs, n_terms, k)
        found = part if found is None else found.unionByName(part)
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def _sizes(batches):
    for batch in batches:
        totals = [int(np.frombuffer(p.as_py(), np.int64)[1::2].sum()) for p in batch.column("postings")]
        yield pa.RecordBatch.from_arrays([batch.column("n"), pa.array(totals, pa.int64())], ["docs", "terms"])


def _blocks(items: DataFrame):
    """Item ids, and for each the hashes of its terms with their repeats."""
    named = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where(
        "text is not null").distinct()
    size = named.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    blocks = max(1, -(-size // ITEM_BYTES))
    for block in range(blocks):
        # ids, not rows, are dealt out, so the texts of one id stay together
        rows = named.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).sort("item_id", "text").toArrow().to_pydict()
        texts: dict[int | None, list[str]] = {}
        for item, text in zip(rows["item_id"], rows["text"]):
            texts.setdefault(item, []).append(text)
        terms, at = word_hashes(*utf8(pa.array([" ".join(t) for t in texts.values()], pa.string())), APART)
        queries = [list(zip(*(x.tolist() for x in np.unique(terms[i:j].view(np.int64), return_counts=True))))
                   for i, j in zip(at[:-1], at[1:])]
        yield list(texts), queries


def _searched(index: DataFrame, names: list, queries: list, n_docs: int, n_terms: int, k: int) -> DataFrame:
    spark = index.sparkSession
    asked = sorted({t for q in queries for t, _ in q})
    wanted = spark.createDataFrame([(t,) for t in asked], "term long")
    lists = index.join(wanted, "term")
    df = {r.term: r.df for r in lists.groupBy("term").agg(F.sum("n").alias("df")).toLocalIterator()}
    terms = np.array(sorted(df), np.int64)
    known = np.array([df[t] for t in terms.tolist()], np.float64)
    weights = np.floor(1000 * np.log((2.0 * n_docs + 2) / (2 * known + 1))).astype(np.int64)
    sent = spark.sparkContext.broadcast((queries, dict(zip(terms.tolist(), weights.tolist()))))

    def run(rows: pa.Table) -> pa.Table:
        queries, weights = sent.value
        shard = Lists(rows, weights, n_docs, n_terms)
        out = [[], [], []]
        for item, query in enumerate(queries):
            ids, scores = shard.best(query, k)
            out[0].append(np.full(len(ids), item))
            out[1].append(ids)
            out[2].append(scores)
        item, ids, scores = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)
        return pa.table({"item": pa.array(item, pa.int64()), "doc_id": pa.array(ids, pa.int64(), mask=ids == NO_ID),
                         "score": pa.array(scores, pa.int64())})

    heads = index.where("term is null")
    found = (lists.select(heads.columns).unionByName(heads).groupBy("shard").applyInArrow(run, FOUND))
    named = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "item int, item_id long")
    return found.join(named, "item").select("item_id", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """:func:`search` over the index of ``docs``."""
    return search(build_index(docs), items, k)
