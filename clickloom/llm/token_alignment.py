"""Alignment of two tokenizers by whitespace-token anchors.

Both tokenizers encode a text in full. Byte offsets where tokens of both end and where both
go on with a token that begins with a space are anchors; that the offsets are equal is
verified on the joined bytes. Anchors cut a text into windows of token ids. What a window's
alignment looks like depends on its ids alone, so it is kept under the pair of id tuples and
computed once for each task.

Within a window, offsets where a token of each side ends cut groups, and every two tokens
whose byte ranges overlap are a link.
"""

from __future__ import annotations

import hashlib
import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import SPACE, mixed, slices, stored, utf8

SIDE_A, SIDE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
SLICE = 1 << 20         # bytes of text encoded at once
MEMO = 200_000          # windows a task remembers before it starts anew
LONGEST = 64            # tokens of a window that is remembered
PLAIN_BELOW = 0xC9      # UTF-8 bytes, those of U+0240 on, that leave a text to the slower encoder
PLAIN_RUN = 400         # bytes without white space that do so too
PAIRS_HELD = 4 << 20    # pair counts a task gathers before it sends their sums
PAIRS_SENT = 4 << 20    # pair counts that go to the tasks at once, 17 bytes each

PLAIN = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
ALIGNED = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "links binary, times binary, pair long, n long")


def vocabulary(name: str, path: str | None = None) -> bytes:
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(name)
    with open(path, "rb") as file:
        return file.read()


class Side:
    """One tokenizer: ``encode`` and the bytes of its tokens."""

    def __init__(self, entries: list[bytes], encode):
        self.encode = encode
        self.size = np.array([len(e) for e in entries], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.data = np.frombuffer(b"".join(entries), np.uint8)
        self.spaced = np.array([e.startswith(b" ") for e in entries])
        self.kind = np.uint16 if len(entries) <= 1 << 16 else np.uint32

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all ``ids``, one after the other."""
        size = self.size[ids]
        place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        return self.data[np.repeat(self.begin[ids], size) + place]


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it is
    printable, else the next one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@lru_cache(maxsize=1)
def sides(a_file: bytes, b_file: bytes) -> tuple[Side, Side]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import sentencepiece
    from tokenizers import Tokenizer

    byte_level = Tokenizer.from_buffer(a_file)
    byte_level.encode_special_tokens = True
    special = set(byte_level.get_added_tokens_decoder())
    letters = _byte_letters()
    names = {i: s for s, i in byte_level.get_vocab().items()}
    entries = [s.encode() if i in special else bytes(letters[c] for c in s)
               for i, s in ((i, names.get(i, "")) for i in range(max(names) + 1))]
    a = Side(entries, _byte_encoder(byte_level, {e: i for i, e in enumerate(entries) if e and i not in special}))

    pieces = sentencepiece.SentencePieceProcessor(model_proto=b_file)
    entries = [bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i)
               else pieces.id_to_piece(i).replace("▁", " ").encode() for i in range(pieces.get_piece_size())]
    return a, Side(entries, lambda texts: pieces.encode(texts, num_threads=1))


def _byte_encoder(byte_level, ranks: dict[bytes, int]):
    """Encodes a space and each text with a byte-level tokenizer.

    Its ids are the order of its merges, so the entries are ranks too, and a rank encoder gives
    the same ids in a fifth of the time. Where the two could differ, in letters whose class
    depends on the edition of Unicode, or where ranks take long, in long unbroken runs, the
    tokenizer itself encodes.
    """
    import public_tokenizers
    import tiktoken

    by_rank = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(texts: list[str]) -> list[list[int]]:
        data, ends = utf8(pa.array(texts, pa.string()))
        # white space and the ends of texts cut runs; no text is empty here
        cuts = np.union1d(np.flatnonzero(SPACE[data]), ends)
        longest = np.maximum.reduceat(np.diff(cuts), np.searchsorted(cuts, ends[:-1]))
        plain = ((np.maximum.reduceat(data, ends[:-1]) < PLAIN_BELOW) & (longest <= PLAIN_RUN)).tolist()
        others = iter(byte_level.encode_batch(
            [" " + t for t, p in zip(texts, plain) if not p], add_special_tokens=False))
        return [by_rank.encode_ordinary(" " + t) if p else next(others).ids for t, p in zip(texts, plain)]

    return encode


def _flat(lists, kind) -> tuple[np.ndarray, np.ndarray]:
    at = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)])
    return np.fromiter(chain.from_iterable(lists), kind, int(at[-1])), at


def encoded(texts: list[str | None], a: Side, b: Side):
    """``(ids, starts)`` of both sides; rows that have no tokens by the rule are empty.

    A text that is null or empty, or whose tokens of either side do not join to a space and
    the text, has none.
    """
    some = [k for k, t in enumerate(texts) if t]
    plain = [texts[k] for k in some]
    data, ends = utf8(pa.array([" " + t for t in plain], pa.string()))
    found = []
    same = np.ones(len(some), bool)
    for side in (a, b):
        ids, at = _flat(side.encode(plain) if plain else [], side.kind)
        size = np.concatenate([[0], np.cumsum(side.size[ids])])[at]
        same &= np.diff(size) == np.diff(ends)
        found.append((ids, at))
    for (ids, at), side in zip(found, (a, b)):
        # only rows of equal length can be compared byte by byte
        keep = np.repeat(same, np.diff(at))
        wrong = side.joined(ids[keep]) != data[np.repeat(same, np.diff(ends))]
        rows = np.repeat(np.flatnonzero(same), np.diff(ends)[same])
        same[rows[wrong]] = False
    out = []
    for ids, at in found:
        counts = np.zeros(len(texts), np.int64)
        counts[np.array(some, np.int64)[same]] = np.diff(at)[same]
        out.append((ids[np.repeat(same, np.diff(at))], np.concatenate([[0], np.cumsum(counts)])))
    return out


def _hashes(ids: np.ndarray, begin: np.ndarray, salt: int) -> np.ndarray:
    """One hash for each run of ``ids`` that begins at ``begin``."""
    size = np.diff(np.append(begin, len(ids)))
    place = np.arange(len(ids)) - np.repeat(begin, size)
    powers = np.cumprod(np.full(int(size.max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
    return mixed(np.add.reduceat(mixed(ids.astype(np.uint64) + np.uint64(salt)) * powers[place], begin))


def _same_runs(ids: np.ndarray, begin: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Is each run of ``ids`` equal to the run number ``model`` of it?"""
    size = np.diff(np.append(begin, len(ids)))
    same = size == size[model]
    run = np.repeat(np.arange(len(begin)), size)
    place = np.arange(len(ids)) - begin[run]
    there = np.minimum(begin[model[run]] + place, len(ids) - 1)
    same[run[ids[there] != ids]] = False
    return same


class Store:
    """Arrays that grow at the end; ``begin`` says where each entry's values begin."""

    def __init__(self, kind):
        self.values, self.begin, self.size = np.zeros(1 << 16, kind), np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.used = self.entries = 0

    def add(self, values: np.ndarray, size: np.ndarray) -> None:
        for name, used, new in (("values", self.used, len(values)), ("begin", self.entries, len(size)),
                                ("size", self.entries, len(size))):
            old = getattr(self, name)
            if used + new > len(old):
                grown = np.zeros(2 * (used + new), old.dtype)
                grown[:used] = old[:used]
                setattr(self, name, grown)
        self.values[self.used:self.used + len(values)] = values
        self.size[self.entries:self.entries + len(size)] = size
        self.begin[self.entries:self.entries + len(size)] = self.used + np.cumsum(size) - size
        self.used += len(values)
        self.entries += len(size)

    def of(self, entries: np.ndarray) -> np.ndarray:
        """The values of all ``entries``, one after the other."""
        return self.values[_spread(self.begin[entries], self.size[entries])]


def _spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of runs of ``size`` that begin at ``begin``."""
    return np.repeat(begin - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


class Aligner:
    """Windows of token ids and their remembered alignments."""

    def __init__(self, a: Side, b: Side, texts: bool = True):
        self.a, self.b, self.with_texts = a, b, texts
        numbers = [b"%d," % i for i in range(max(len(a.size), len(b.size)))]
        self.digits = np.frombuffer(b"".join(numbers), np.uint8)
        self.digit_size = np.array([len(x) for x in numbers], np.int64)
        self.digit_begin = np.cumsum(self.digit_size) - self.digit_size
        self.forget()

    def forget(self) -> None:
        self.memo: dict[tuple[bytes, bytes], int] = {}
        self.pairs, self.texts, self.groups = Store(np.int64), Store(np.uint8), Store(np.int64)

    def windows(self, a_ids, a_at, b_ids, b_at) -> tuple[np.ndarray, np.ndarray]:
        """The entry of each window's alignment, and where each row's windows begin.

        Entries hold until the next call: ``pairs`` numbers of linked id pairs, ``texts`` the
        groups, each window's ending with a semicolon, ``groups`` their number.
        """
        if len(self.memo) > MEMO:
            self.forget()
        if not len(a_ids):
            return np.zeros(0, np.int64), np.zeros(len(a_at), np.int64)
        ends, opens = [], []
        for ids, at, side in ((a_ids, a_at, self.a), (b_ids, b_at, self.b)):
            end = np.cumsum(side.size[ids])
            open_ = np.append(side.spaced[ids[1:]], True)
            open_[at[1:][at[1:] > 0] - 1] = True
            ends.append(end)
            opens.append(end[open_])
        anchors = np.intersect1d(*opens, assume_unique=True)
        stop = [np.searchsorted(end, anchors) + 1 for end in ends]
        begin = [np.concatenate([[0], x[:-1]]) for x in stop]
        name = _hashes(a_ids, begin[0], 1) * np.uint64(31) + _hashes(b_ids, begin[1], 1 << 32)
        _, model, which = np.unique(name, return_index=True, return_inverse=True)
        same = _same_runs(a_ids, begin[0], model[which]) & _same_runs(b_ids, begin[1], model[which])
        other = np.flatnonzero(~same)  # equal hashes of different windows: each on its own
        which[other] = len(model) + np.arange(len(other))
        model = np.append(model, other)
        entries = self._entries(a_ids, b_ids, begin[0][model], stop[0][model], begin[1][model], stop[1][model])
        row_ends = np.concatenate([[0], ends[0]])[a_at]
        return entries[which], np.searchsorted(anchors, row_ends, "right")

    def _entries(self, a_ids, b_ids, i, j, k, m) -> np.ndarray:
        """Looks windows up by their two id tuples, and adds those that are not known."""
        a_bytes, b_bytes = a_ids.tobytes(), b_ids.tobytes()
        wide_a, wide_b = a_ids.itemsize, b_ids.itemsize
        keys = [(a_bytes[p:q], b_bytes[r:s]) for p, q, r, s in zip(
            (i * wide_a).tolist(), (j * wide_a).tolist(), (k * wide_b).tolist(), (m * wide_b).tolist())]
        entries = np.array([self.memo.get(key, -1) for key in keys], np.int64)
        new = np.flatnonzero(entries < 0)
        if len(new):
            first = self.groups.entries
            self._add(a_ids[_spread(i[new], (j - i)[new])], (j - i)[new], b_ids[_spread(k[new], (m - k)[new])], (m - k)[new])
            entries[new] = first + np.arange(len(new))
            for n, size in zip(new.tolist(), (j - i + m - k)[new].tolist()):
                if size <= LONGEST:
                    self.memo[keys[n]] = int(entries[n])
        return entries

    def _add(self, a, n_a, b, n_b) -> None:
        """Aligns windows of ``n_a`` and ``n_b`` tokens, all at once."""
        end_a, end_b = np.cumsum(self.a.size[a]), np.cumsum(self.b.size[b])
        cuts = np.union1d(end_a, end_b)
        at_a, at_b = np.searchsorted(end_a, cuts), np.searchsorted(end_b, cuts)
        shared = cuts[(end_a[at_a] == cuts) & (end_b[at_b] == cuts)]
        window_ends = end_a[np.cumsum(n_a) - 1]
        self.pairs.add(a[at_a].astype(np.int64) * len(self.b.size) + b[at_b],
                       np.diff(np.searchsorted(cuts, window_ends, "right"), prepend=0))
        n_groups = np.diff(np.searchsorted(shared, window_ends, "right"), prepend=0)
        self.groups.add(n_groups, np.ones(len(n_groups), np.int64))
        if not self.with_texts:
            return
        group_a, group_b = np.searchsorted(shared, end_a), np.searchsorted(shared, end_b)
        place_a = np.arange(len(a)) + np.searchsorted(group_b, group_a, "left")
        place_b = np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")
        ids, after = np.zeros(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[place_a], ids[place_b] = a, b
        after[place_a[np.isin(end_a, shared, assume_unique=True)]] = ord("|")
        after[place_b[np.isin(end_b, shared, assume_unique=True)]] = ord(";")
        size = self.digit_size[ids]
        text = self.digits[_spread(self.digit_begin[ids], size)]
        text[np.cumsum(size) - 1] = after
        self.texts.add(text, np.diff(np.cumsum(size)[place_b[np.cumsum(n_b) - 1]], prepend=0))

    def row_texts(self, entries: np.ndarray, row_at: np.ndarray) -> list[bytes]:
        """The groups of every row, as ``a1,a2|b1;a3|b2,b3``."""
        text = self.texts.of(entries).tobytes()
        ends = np.concatenate([[0], np.cumsum(self.texts.size[entries])])[row_at].tolist()
        return [text[i:max(i, j - 1)] for i, j in zip(ends[:-1], ends[1:])]


def _aligned_rows(a_file, b_file):
    def run(batches):
        a, b = sides(a_file.value, b_file.value)
        aligner = Aligner(a, b)
        held, n_held = [], 0
        for batch in slices(batches, "text", SLICE):
            (a_ids, a_at), (b_ids, b_at) = encoded(batch.column("text").to_pylist(), a, b)
            entries, row_at = aligner.windows(a_ids, a_at, b_ids, b_at)
            links, times, links_at = _row_pairs(aligner, entries, row_at)
            pair, back = np.unique(links, return_inverse=True)
            held.append((pair, np.bincount(back, times, len(pair)).astype(np.int64)))
            n_held += len(held[-1][0])
            digests = [hashlib.sha256(t).hexdigest() if t else "" for t in aligner.row_texts(entries, row_at)]
            yield _batch(batch.num_rows, doc_id=batch.column("doc_id"), n_a=np.diff(a_at), n_b=np.diff(b_at),
                         n_groups=_per_row(aligner.groups.values[entries], row_at),
                         n_links=_per_row(aligner.pairs.size[entries], row_at),
                         groups_sha256=digests, links=_binary(links, links_at), times=_binary(times, links_at))
            if n_held > PAIRS_HELD:
                pair, n = _summed(held)
                held, n_held = [], 0
                yield _batch(len(pair), pair=pair, n=n)
        if n_held:
            pair, n = _summed(held)
            yield _batch(len(pair), pair=pair, n=n)
    return run


def _row_pairs(aligner: Aligner, entries: np.ndarray, row_at: np.ndarray):
    """The different linked id pairs of each row, how many links of the row hold each, and
    where each row's pairs begin."""
    rows = len(row_at) - 1
    size = aligner.pairs.size[entries]
    row = np.repeat(np.repeat(np.arange(rows, dtype=np.int64), np.diff(row_at)), size)
    every = np.int64(len(aligner.a.size) * len(aligner.b.size))
    key, times = np.unique(row * every + aligner.pairs.of(entries), return_counts=True)
    return key % every, times.astype(np.int32), np.searchsorted(key // every, np.arange(rows + 1))


def _per_row(values: np.ndarray, row_at: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values)])[row_at])


def _summed(held):
    pair, back = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
    n = np.zeros(len(pair), np.int64)
    np.add.at(n, back, np.concatenate([n for _, n in held]))
    return pair, n


def _binary(ids: np.ndarray, at: np.ndarray) -> pa.Array:
    data = ids.tobytes()
    offsets = (at * ids.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])


def _batch(rows: int, **columns) -> pa.RecordBatch:
    kinds = {"groups_sha256": pa.string(), "links": pa.binary(), "times": pa.binary()}
    names = [c.split()[0] for c in ALIGNED.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[c], kinds.get(c, pa.int64())) if c in columns and not isinstance(columns[c], pa.Array)
         else columns[c] if c in columns else pa.nulls(rows, kinds.get(c, pa.int64())) for c in names], names)


def _pair_sums(sums):
    """For each row of link pairs: links whose pair is in ``sums``: the best ones and the sum
    of counts."""
    def run(batches):
        known, count, best = sums.value
        for batch in slices(batches, "links", 4 << 20):
            data, ends = utf8(batch.column("links"))
            pair, row_at = np.frombuffer(data.tobytes(), np.int64), ends // 8
            times = np.frombuffer(utf8(batch.column("times"))[0].tobytes(), np.int32).astype(np.int64)
            at = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
            hit = known[at] == pair if len(known) else np.zeros(len(pair), bool)
            columns = [batch.column(c) for c in ("row", *PLAIN)]
            for values in (best, count):
                own = np.zeros(len(pair), np.int64)
                own[hit] = values[at[hit]].astype(np.int64) * times[hit]
                columns.append(pa.array(_per_row(own, row_at), pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, ["row", *PLAIN, "n_best", "count_sum"])
    return run


def alignments(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` for each row
    of ``docs(doc_id, text)``.

    ``n_groups`` groups and ``n_links`` links are those of the two encodings of a space and the
    text; a pair of ids counts how many links of all rows hold it. ``count_sum`` adds these
    counts over a row's links; ``n_best`` are the links whose pair has the highest count of all
    pairs with that B id. ``groups_sha256`` is the digest of the groups as
    ``a1,a2|b1;a3|b2,b3``. Null and empty texts, and texts that either tokenizer does not give
    back byte for byte, have zeros and an empty digest. Rows without ``doc_id`` and repeated
    rows are rows like others; other columns are ignored; an empty table gives no row.

    The vocabulary files (about 2 MB, of fixed size) go to all tasks; a task encodes about 1 MB
    of text at once, or one longer text. Texts are encoded and aligned once; each row keeps its
    different linked id pairs and how often it links each. Pair counts
    are summed in the tasks first. They go out again in blocks of ``PAIRS_SENT`` pairs, each
    one pass over the ids, so their number needs no bound.
    """
    spark = docs.sparkSession
    a_file, b_file = (spark.sparkContext.broadcast(vocabulary(name, path)) for name, path in (
        (SIDE_A, a_path), (SIDE_B, b_path)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    both = stored(texts.mapInArrow(_aligned_rows(a_file, b_file), ALIGNED)
                  .withColumn("row", F.monotonically_increasing_id()), "alignment")
    n_b = len(sides(a_file.value, b_file.value)[1].size)
    of_b = Window.partitionBy("b_id")
    pairs = stored(
        both.where("pair is not null").groupBy("pair").agg(F.sum("n").alias("n"))
        .withColumn("b_id", F.col("pair") % n_b)
        .select("pair", "n", (F.col("n") == F.max("n").over(of_b)).alias("best")), "alignment-pairs")
    rows = both.where("pair is null").select("row", *PLAIN, "links", "times")
    schema = rows.drop("links", "times").schema.add("n_best", "long").add("count_sum", "long")
    blocks = max(1, -(-pairs.count() // PAIRS_SENT))
    result = None
    for block in range(blocks):
        part = pairs.where(F.pmod(F.xxhash64("pair"), F.lit(blocks)) == block).sort("pair").toArrow()
        sent = spark.sparkContext.broadcast(tuple(
            part.column(c).to_numpy().astype(k) for c, k in (("pair", np.int64), ("n", np.int64), ("best", np.bool_))))
        found = rows.mapInArrow(_pair_sums(sent), schema)
        result = found if result is None else result.unionByName(found)
    if blocks > 1:
        result = result.groupBy("row", *PLAIN).agg(
            F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return result.select(*PLAIN, "n_best", "count_sum")


def groups(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """``(doc_id, groups)``: the aligned groups themselves as an array of ``(a, b)`` id arrays.

    As in :func:`alignments`; texts without tokens have an empty array.
    """
    spark = docs.sparkSession
    a_file, b_file = (spark.sparkContext.broadcast(vocabulary(name, path)) for name, path in (
        (SIDE_A, a_path), (SIDE_B, b_path)))

    def run(batches):
        a, b = sides(a_file.value, b_file.value)
        aligner = Aligner(a, b)
        for batch in slices(batches, "text", SLICE):
            (a_ids, a_at), (b_ids, b_at) = encoded(batch.column("text").to_pylist(), a, b)
            rows = aligner.row_texts(*aligner.windows(a_ids, a_at, b_ids, b_at))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([t.decode() for t in rows], pa.string())], ["doc_id", "text"])

    def ids(part):
        return F.split(part, ",").cast("array<int>")

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, text string").select(
        "doc_id", F.when(F.col("text") == "", F.array()).otherwise(F.transform(
            F.split("text", ";"), lambda g: F.struct(
                ids(F.split_part(g, F.lit("|"), F.lit(1))).alias("a"),
                ids(F.split_part(g, F.lit("|"), F.lit(2))).alias("b")))).alias("groups"))
