"""Benchmark decontamination by spaced seeds.

A seed is the hash of 8 of 12 neighbouring words; three fixed masks say which positions
count, so a replaced word spoils only the seeds that look at it. Seeds of the benchmark
are kept sorted and probed with those of every document. Each hit fixes an alignment of
item and document, in which the segment with the best score (one for an equal word, less
two for another) is the verified overlap.

Items of fewer than 15 words have masks as long as themselves: two that count every other
word, so that one of them misses a replaced word wherever it is, or from 7 words down a
single one that counts them all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import mixed, slices, utf8, word_hashes

# The masks; 1 marks a position that counts.
MASKS = ("111010110101", "110110011011", "101101101011")
SPAN = 12
SHORT = 15          # items of fewer words are looked for as wholes
WHOLE = 8           # items of fewer words must match in every word, those up to SHORT in all but one
SCORE = 10          # least score of an overlap
MATCHED = 13        # least number of equal words
PENALTY = 2
BLOCK_BYTES = 8 << 20  # benchmark text that goes to the tasks at once

APART = np.ones(256, bool)
APART[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _places(at: np.ndarray, span: int) -> np.ndarray:
    """All places from which ``span`` words fit in their row."""
    fit = np.maximum(np.diff(at) - span + 1, 0)
    ends = np.cumsum(fit)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(at[:-1] - ends + fit, fit)


def _seeds(words: np.ndarray, places: np.ndarray, mask: str) -> np.ndarray:
    value = np.full(len(places), int("1" + mask, 2), np.uint64)
    for k, used in enumerate(mask):
        if used == "1":
            value = mixed(value) + words[places + k]
    return mixed(value)


def own_masks(size: int) -> tuple[str, ...]:
    """The masks of a short item of ``size`` words."""
    return ("1" * size,) if size < WHOLE else (("10" * size)[:size], ("01" * size)[:size])


class Benchmark:
    """Seeds and words of some items."""

    def __init__(self, ids: list[int], texts: list[str]):
        column = pa.array(texts, pa.string())
        self.ids = np.array(ids, np.int64)
        self.words, self.at = word_hashes(*utf8(column), APART)
        counts = np.diff(self.at)
        short = np.unique(counts[(counts > 0) & (counts < SHORT)]).tolist()
        long = np.repeat(counts >= SHORT, np.maximum(counts - SPAN + 1, 0))
        self.masks, seeds, places = [], [], []
        for mask, own in [*((mask, _places(self.at, SPAN)[long]) for mask in MASKS),
                          *((mask, self.at[:-1][counts == n]) for n in short for mask in own_masks(n))]:
            if len(own):
                self.masks.append(mask)
                seeds.append(_seeds(self.words, own, mask))
                places.append(own)
        seeds = np.concatenate([np.zeros(0, np.uint64), *seeds])
        places = np.concatenate([np.zeros(0, np.int64), *places])
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.places = seeds[order], places[order]
        self.item = np.searchsorted(self.at, self.places, "right") - 1
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[self.seeds >> np.uint64(44)] = True

    def overlaps(self, words: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """Row, item, first and last word in the row, equal words; the best of each row and item."""
        found: set[tuple[int, int, int]] = set()
        for mask in self.masks:
            places = _places(at, len(mask))
            seeds = _seeds(words, places, mask)
            maybe = np.flatnonzero(self.sieve[seeds >> np.uint64(44)])
            low = np.searchsorted(self.seeds, seeds[maybe], "left")
            high = np.searchsorted(self.seeds, seeds[maybe], "right")
            hit = np.flatnonzero(low < high)
            row = np.searchsorted(at, places[maybe[hit]], "right") - 1
            if "0" not in mask:  # a hit is the whole item: its first place in a row will do
                first = np.unique(np.stack([row, low[hit]]), axis=1, return_index=True)[1]
                hit, row = hit[first], row[first]
            for i, r in zip(hit, row):
                for k in range(low[i], high[i]):
                    found.add((int(r), int(self.item[k]), int(places[maybe[i]] - self.places[k])))
        best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        for row, item, shift in sorted(found):
            overlap = self._verified(words, at, row, item, shift)
            if overlap and overlap > best.get((row, item), (0, 0, 0, 0)):
                best[row, item] = overlap
        return [(row, item, first, last, same) for (row, item), (same, _, first, last) in sorted(best.items())]

    def _verified(self, words, at, row: int, item: int, shift: int):
        """Equal words, score, first and last word of the best segment, or None."""
        begin = max(int(self.at[item]), int(at[row]) - shift)
        end = min(int(self.at[item + 1]), int(at[row + 1]) - shift)
        same = words[begin + shift:end + shift] == self.words[begin:end]
        size = int(self.at[item + 1] - self.at[item])
        if size < SHORT:
            matched, first = int(same.sum()), begin + shift - int(at[row])
            if end - begin < size or matched < size - (size >= WHOLE):
                return None
            return matched, matched - PENALTY * (size - matched), first, first + size - 1
        total = np.cumsum(np.append(0, np.where(same, 1, -PENALTY)))
        lowest = np.minimum.accumulate(total)
        stop = len(total) - 1 - int(np.argmax((total - lowest)[::-1]))  # of equal scores the longest segment
        start = int(np.argmin(total[:stop + 1]))
        matched, score = int(same[start:stop].sum()), int(total[stop] - total[start])
        if matched < MATCHED or score < SCORE:
            return None
        first = begin + shift + start - int(at[row])
        return matched, score, first, first + stop - start - 1


def overlaps(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``(doc_id, item_id, first_word, last_word, n_equal)``: one row for each document of
    ``docs(doc_id, text)`` and each item of ``items(item_id, text)`` that it holds.

    A document holds an item if an alignment has a segment with at least 13 equal words
    and a score of 10. An item of 8 to 14 words is held if as many neighbouring words are
    equal to it but for one at most, a shorter one if they are equal throughout, even where
    it is one frequent word: leave such items out of ``items`` if they mean nothing. An item
    without words is nowhere. Words are runs of ASCII letters and digits and non-ASCII bytes, in lower
    case. Of several alignments the longest is given. Items and documents that are null or
    empty hold nothing; repeated rows repeat their results; rows without ``doc_id`` are
    judged too and keep the null.

    The benchmark goes to the tasks in blocks of about 8 MB of text, each checked against
    all documents in a pass of its own, so any benchmark can be searched.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    result = None
    for benchmark in _blocks(items):
        part = _against(texts, benchmark)
        result = part if result is None else result.unionByName(part)
    return result


def _blocks(items: DataFrame):
    named = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where(
        "text is not null and item_id is not null").distinct()
    size = named.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    for block in range(blocks):
        rows = named.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).toArrow().to_pydict()
        yield Benchmark(rows["item_id"], rows["text"])


def _against(texts: DataFrame, benchmark: Benchmark) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(benchmark)

    def run(batches):
        known = shared.value
        for batch in slices(batches, "text"):
            hits = known.overlaps(*word_hashes(*utf8(batch.column("text")), APART))
            docs = batch.column("doc_id").take(pa.array([h[0] for h in hits], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [docs, pa.array([int(known.ids[h[1]]) for h in hits], pa.int64()),
                 *(pa.array([h[k] for h in hits], pa.int64()) for k in (2, 3, 4))],
                ["doc_id", "item_id", "first_word", "last_word", "n_equal"])

    return texts.mapInArrow(run, "doc_id long, item_id long, first_word long, last_word long, n_equal long")


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns; nothing is shuffled."""
    for benchmark in _blocks(items):
        docs = _without(docs, benchmark)
    return docs


def _without(docs: DataFrame, benchmark: Benchmark) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(benchmark)

    def run(batches):
        for batch in slices(batches, "text"):
            keep = np.ones(batch.num_rows, bool)
            keep[[h[0] for h in shared.value.overlaps(*word_hashes(*utf8(batch.column("text")), APART))]] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
