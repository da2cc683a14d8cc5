"""Language identification as a mixture: EM over n-gram likelihoods, penalised choice of languages.

A document is a sequence of units of four words. Every language has a table of log
probabilities of hashed byte trigrams; a unit's likelihood under a language is the product
over its trigrams. Expectation-maximisation gives the proportions of the languages in the
document. The nested sets of its one, two, ... most frequent languages are fitted in turn,
and the set with the largest log likelihood less ``0.5 * languages * log(units)`` is taken.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import LOWER, SPACE, slices, utf8

BUCKETS = 1 << 17
SAMPLE = 1000      # documents of each language that the tables are fitted on
LARGEST_SET = 4    # languages that one document may mix
STEPS = 12
UNIT_WORDS = 4
PIECE = 1 << 20


def trigrams(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Bucket of the trigram beginning at each byte; ``BUCKETS`` where it would leave the row."""
    text = LOWER[data].astype(np.uint32)
    code = np.full(len(text), BUCKETS, np.int64)
    if len(text) > 2:
        raw = text[:-2] | (text[1:-1] << np.uint32(8)) | (text[2:] << np.uint32(16))
        code[:-2] = (raw * np.uint32(0x9E3779B1)) >> np.uint32(15)
    last = ends[1:][np.diff(ends) > 0]
    code[last - 1] = BUCKETS
    code[np.maximum(last - 2, 0)] = BUCKETS
    return code


def units(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where units begin, and the n + 1 places where the rows' units begin; none for an empty row."""
    word = ~SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    starts = np.flatnonzero(first)
    row_words = np.searchsorted(starts, ends)
    row = np.searchsorted(ends, starts, "right") - 1
    starts = starts[(np.arange(len(starts)) - row_words[row]) % UNIT_WORDS == 0]
    begins = np.union1d(ends[:-1][np.diff(ends) > 0], starts)
    # the blank head of a row belongs to its first unit
    head = np.searchsorted(starts, ends[:-1])
    late = (head < len(starts)) & (np.diff(ends) > 0)
    late[late] = (starts[head[late]] > ends[:-1][late]) & (starts[head[late]] < ends[1:][late])
    begins = np.setdiff1d(begins, starts[head[late]])
    return begins, np.searchsorted(begins, ends)


def _em(likely: np.ndarray, row: np.ndarray, at: np.ndarray, allowed: np.ndarray) -> tuple:
    """Proportions and log likelihood per row; ``likely`` is scaled to a maximum of 1 per unit."""
    share = allowed / allowed.sum(axis=1, keepdims=True)
    count = np.diff(at)[:, None]
    for _ in range(STEPS):
        part = likely * share[row]
        total = part.sum(axis=1, keepdims=True)
        share = np.add.reduceat(part / np.maximum(total, 1e-300), at[:-1]) / count
    total = (likely * share[row]).sum(axis=1)
    return share, np.add.reduceat(np.log(np.maximum(total, 1e-300)), at[:-1])


def mixtures(data: np.ndarray, ends: np.ndarray, tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the chosen languages (rows without bytes: zeros), and which rows have any."""
    n_languages = tables.shape[1]
    shares = np.zeros((len(ends) - 1, n_languages))
    begins, at = units(data, ends)
    some = np.flatnonzero(np.diff(at))
    if not len(some):
        return shares, some
    logs = np.add.reduceat(tables[trigrams(data, ends)], begins).astype(np.float64)
    likely = np.exp(logs - logs.max(axis=1, keepdims=True))
    likely = np.maximum(likely, 1e-30)
    at = np.append(at[:-1][some], at[-1])
    row = np.repeat(np.arange(len(some)), np.diff(at))
    share, _ = _em(likely, row, at, np.ones((len(some), n_languages)))
    place = np.argsort(np.argsort(-share, axis=1, kind="stable"), axis=1)
    best, best_share = np.full(len(some), -np.inf), share
    for size in range(1, min(n_languages, LARGEST_SET) + 1):
        fitted, log = _em(likely, row, at, (place < size).astype(float))
        log = log - 0.5 * size * np.log(np.diff(at) + 1)
        better = log > best
        best = np.where(better, log, best)
        best_share = np.where(better[:, None], fitted, best_share)
    shares[some] = best_share
    return shares, some


def fit(train: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages and their table of log probabilities, from ``train(doc_id, text, lang)``.

    Counts the trigrams of at most ``sample`` whole documents of each language, those with
    the smallest hash of their id, so the fit is bounded and repeatable. The result has
    one value per bucket and language.
    """
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (train.where("lang is not null and text is not null").select("doc_id", "text", "lang")
              .withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample))

    def run(batches):
        for batch in slices(batches, "text"):
            names = batch.column("lang").to_pylist()
            data, ends = utf8(batch.column("text"))
            code = trigrams(data, ends)
            for name in sorted(set(names)):
                mine = np.repeat(np.array([x == name for x in names]), np.diff(ends))
                counts = np.bincount(code[mine], minlength=BUCKETS + 1)[:BUCKETS]
                used = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(used), pa.string()), pa.array(used, pa.int32()),
                     pa.array(counts[used], pa.int64())], ["lang", "bucket", "n"])

    counted = (chosen.select("text", "lang").mapInArrow(run, "lang string, bucket int, n long")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow().to_pydict())
    languages = sorted(set(counted["lang"]))
    place = {name: k for k, name in enumerate(languages)}
    tables = np.full((BUCKETS + 1, len(languages)), 0.5)
    tables[counted["bucket"], [place[x] for x in counted["lang"]]] += counted["n"]
    tables[BUCKETS] = 0
    tables[:BUCKETS] = np.log(tables[:BUCKETS] / tables[:BUCKETS].sum(axis=0))
    return languages, tables.astype(np.float32)


def _judge(names: list[str], logs: np.ndarray, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the languages, and which texts have letters and so a language."""
    letters = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False)
    shares = mixtures(*utf8(text), logs)[0] if names else np.zeros((len(text), 1))
    shares[~letters] = 0
    return shares, letters & bool(names)


def predict(docs: DataFrame, languages: list[str], tables: np.ndarray) -> DataFrame:
    """``(doc_id, lang_pred, score, langs)`` of every row of ``docs(doc_id, text)``.

    ``lang_pred`` has the largest proportion (ties: the first name) and ``score`` is that
    proportion; ``langs`` lists all chosen languages by name. Texts that are null or have
    no letter, and all texts if nothing was learned, get ``und``, score 0 and an empty
    list. Repeated rows are judged alike; other columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast((languages, tables))

    def run(batches):
        names, logs = model.value
        for batch in slices(batches, "text", PIECE):
            shares, known = _judge(names, logs, batch.column("text"))
            top = shares.argmax(axis=1)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.int64()),
                pa.array([names[k] if ok else "und" for k, ok in zip(top, known)], pa.string()),
                pa.array(np.clip(shares[np.arange(len(top)), top], 0, 1)),
                pa.array([[names[k] for k in np.flatnonzero(own > 1e-3)] for own in shares], pa.list_(pa.string()))],
                ["doc_id", "lang_pred", "score", "langs"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, lang_pred string, score double, langs array<string>")


def held_out(doc_id: Column) -> Column:
    """Whether a document belongs to the quarter that is never learned from; no, if it has no id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Fit on the documents that are not held out, predict all; adds ``held_out``."""
    languages, tables = fit(docs.where(~held_out(F.col("doc_id"))))
    predicted = predict(docs, languages, tables)
    return predicted.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "langs")


def accepted(docs: DataFrame, wanted: list[str] | None = None, least: float = 0.0) -> DataFrame:
    """The rows of ``docs`` whose language, as in :func:`predict`, is one of ``wanted`` (None: any
    but ``und``) with a score of at least ``least``, with all their columns.

    Fitted on ``docs`` itself, as in :func:`identify`; nothing is shuffled.
    """
    languages, tables = fit(docs.where(~held_out(F.col("doc_id"))))
    model = docs.sparkSession.sparkContext.broadcast((languages, tables))

    def run(batches):
        names, logs = model.value
        good = np.array([wanted is None or name in wanted for name in names] or [False])
        for batch in slices(batches, "text", PIECE):
            shares, known = _judge(names, logs, batch.column("text"))
            top = shares.argmax(axis=1)
            score = np.clip(shares[np.arange(len(top)), top], 0, 1)
            yield batch.filter(pa.array(known & good[top] & (score >= least)))

    return docs.mapInArrow(run, docs.schema)
