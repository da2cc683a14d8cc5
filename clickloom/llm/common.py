"""Helpers shared by the operators of this folder: scratch tables, links, byte arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read from there.

    The shuffle files of the write go when it ends, so that a chain of such writes takes the
    disk of its largest one and not of all.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, label), spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


# --- links and components -------------------------------------------------------------


def components(links: DataFrame, label: str = "links") -> DataFrame:
    """``(id, component)`` of every id in the undirected links ``(a, b)``.

    The smallest id names a component. Alternates two steps until nothing changes: each
    node hands its larger neighbours, then its smaller ones, to the smallest node it
    knows. Every step is one aggregation and one equality join; nothing is gathered.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v").distinct(), label)
    state = _fingerprint(edges)
    while True:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(smallest, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u")
                 .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
                 .select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct())
        edges = stored(small, label)
        now = _fingerprint(edges)
        if now == state:
            break
        state = now
    members = edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
    roots = edges.select(F.col("v").alias("id")).distinct()
    return members.unionByName(
        roots.join(members, "id", "left_anti").select("id", F.col("id").alias("component")))


def _fingerprint(edges: DataFrame):
    """Count and order-free checksum of the edges: one row."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
    return tuple(row)


def shared_keys(keys: DataFrame, label: str) -> DataFrame:
    """The rows of ``keys(key, id)``, which has no row twice, whose key has at least two ids;
    written once. The keys are moved once."""
    counted = keys.withColumn("n", F.count("*").over(Window.partitionBy("key")))
    return stored(counted.where("n > 1").drop("n"), label)


BLOCK_ITEMS = 1 << 16
BLOCK_ROWS = 1 << 12


def linked(keys: DataFrame, sets: DataFrame, percent: int, label: str, rounds: int = 2,
           expand: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]] | None = None,
           in_spark: bool = False) -> DataFrame:
    """``(id, component)`` of the ids that are linked to another one.

    Ids that share a key are linked if 100 * common >= ``percent`` * all elements of their
    two sets. ``keys(key, id)`` comes from :func:`shared_keys`; ``sets(id, items)`` holds
    arrays of distinct longs. With ``expand``, ``sets(id, items, n)`` holds texts and the sizes
    of their sets, which ``expand`` makes: for an array of texts, ascending distinct values
    under 2 ** 44 of each, and where each begins. Sets larger than their texts are not moved.

    Each round compares one member of each key with those members that are not yet in its
    component. Keys whose members are then still apart are settled in full: their members
    outside the largest component of a cluster are compared with all its members, block by
    block: each pair of blocks is one small group of its own, and no pair becomes a row
    unless it is a link.

    With ``in_spark``, ``expand`` is a Spark function from a text column to its set as an array,
    and everything runs as Spark joins and aggregations, with no Python on the executors.
    ``sets`` then also has ``marks``, an array of longs in which each element of the set has set
    one bit chosen by its hash, and ``n`` may be more than the set has. Pairs whose marks differ
    in too many bits to be alike (:func:`_maybe_alike`) are left out before any text is moved.
    """
    sets = sets if expand else sets.withColumn("n", F.size("items"))
    known = ["id", "n", *(["marks"] if in_spark else [])]
    sizes = sets.select(known)
    size_of = {side: sizes.toDF(side, *(f"{c}_{side}" for c in known[1:])) for side in "ab"}
    fits = _maybe_alike(percent, MARKS) if in_spark else f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"
    links, groups = None, None
    for turn in range(rounds + 1):
        here = keys.withColumn("component", F.col("id")) if groups is None else keys.join(
            groups, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
        pick, pick_by = (F.min, F.min_by) if turn % 2 == 0 else (F.max, F.max_by)
        leads = (here.groupBy("key").agg(
            pick("id").alias("lead"), pick_by("component", "id").alias("ahead"),
            F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi"))
        apart = here.join(leads, "key").where("component <> ahead")
        if turn == rounds:
            still = stored(here.join(leads.select("key", "lead"), "key"), label)
            if still.isEmpty():
                break
            pairs = _pairs_in_spark(still, sets, percent, label, expand) if in_spark else None
        else:
            pairs = (apart.select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b")).distinct()
                     .join(size_of["a"], "a").join(size_of["b"], "b").where(fits).select("a", "b"))
        if pairs is None:
            found = _settled(still, sets, percent, label, expand)
        else:
            items = sets.select("id", "items")
            found = pairs.join(items.toDF("a", "sa"), "a").join(items.toDF("b", "sb"), "b")
            if expand and in_spark:
                # exploded, so that each set is made once for the pair and not once for each use
                both = F.struct(expand(F.col("sa")).alias("x"), expand(F.col("sb")).alias("y"))
                found = found.select("a", "b", F.explode(F.array(both)).alias("both"))
                found = found.where(_alike(F.col("both.x"), F.col("both.y"), percent)).select("a", "b")
            elif expand:
                found = found.mapInArrow(_alike_pairs(expand, percent), "a long, b long")
            else:
                found = found.where(_alike(F.col("sa"), F.col("sb"), percent)).select("a", "b")
        found = stored(found, label)
        if groups is not None and found.isEmpty():
            continue
        links = found if links is None else links.unionByName(found)
        groups = components(links, label)
    return groups


def _alike(x, y, percent: int):
    common = F.size(F.array_intersect(x, y))
    return 100 * common >= percent * (F.size(x) + F.size(y) - common)


def _maybe_alike(percent: int, words: int) -> str:
    """Whether sets with these ``marks`` of so many longs and at most ``n`` elements can be alike.

    Each bit that one of two sets has and the other has not stands for an element of its own
    outside the other, and sets that are alike have few of these.
    """
    apart = " + ".join(f"bit_count(marks_a[{k}] ^ marks_b[{k}])" for k in range(words))
    return f"{100 + percent} * ({apart}) <= {100 - percent} * (n_a + n_b)"


MARKS, FINE_MARKS = 8, 64   # longs of marks of all sets, and of those compared block by block


def _alike_pairs(expand, percent: int):
    """Keeps the pairs ``(a, b)`` whose sets, made of ``sa`` and ``sb``, are alike."""
    def run(batches):
        for batch in slices(batches, "sa", 1 << 20):
            known = pa.concat_arrays([batch.column(batch.schema.get_field_index(c)) for c in ("sa", "sb")]).dictionary_encode()
            values, at = expand(known.dictionary)
            place = known.indices.to_numpy().astype(np.int64)
            size = np.diff(at)[place]
            pair = np.repeat(np.tile(np.arange(batch.num_rows, dtype=np.uint64), 2), size)
            within = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
            marks = np.sort((pair << np.uint64(44)) | values[np.repeat(at[:-1][place], size) + within])
            twice = marks[1:][marks[1:] == marks[:-1]] >> np.uint64(44)
            common = np.bincount(twice.astype(np.int64), minlength=batch.num_rows)
            total = size.reshape(2, -1).sum(axis=0) - common
            yield batch.select(["a", "b"]).filter(pa.array(100 * common >= percent * total))
    return run


def _settled(still: DataFrame, sets: DataFrame, percent: int, label: str, expand) -> DataFrame:
    """Links across components of ``still(key, id, component, lead)``, from outside the
    largest component of each cluster of keys; at least one for each linked component."""
    clusters = components(still.select(F.col("id").alias("a"), F.col("lead").alias("b")), label)
    members = stored(
        still.select("id", "component").distinct()
        .join(clusters.withColumnRenamed("component", "cluster"), "id").join(sets, "id"), label)
    parts = members.groupBy("cluster", "component").agg(F.count("*").alias("members"), F.sum("n").alias("n"))
    totals = parts.groupBy("cluster").agg(
        F.max_by("component", "members").alias("largest"), F.max_by("n", "members").alias("n_largest"), F.sum("n").alias("n_all"))
    totals = totals.select(
        "cluster", "largest", F.ceil(F.col("n_all") / BLOCK_ITEMS).alias("blocks"),
        F.ceil((F.col("n_all") - F.col("n_largest")) / BLOCK_ITEMS).alias("outer")).where("outer > 0")
    members = members.join(totals, "cluster").withColumns(
        {"block": F.pmod(F.xxhash64("id"), "blocks"), "row": F.pmod(F.xxhash64("id", F.lit(1)), "outer")})
    outside = members.where("component <> largest").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    other = members.withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("outer") - 1)))
    place, columns = ["cluster", "block", "row"], ["cluster", "block", "row", "id", "component", "n", "items"]
    return (outside.select(columns).groupBy(*place).cogroup(other.select(columns).toDF(*columns).groupBy(*place))
            .applyInPandas(lambda x, y: _links_of_blocks(x, y, percent, expand), "a long, b long"))


def _pairs_in_spark(still: DataFrame, sets: DataFrame, percent: int, label: str, expand) -> DataFrame:
    """The pairs ``(a, b)`` that :func:`_settled` compares and that can be alike by their sizes and
    finer marks, in which each element turns one bit: the same blocks, joined without the texts."""
    clusters = components(still.select(F.col("id").alias("a"), F.col("lead").alias("b")), label)
    own = still.select("id", "component").distinct().join(clusters.withColumnRenamed("component", "cluster"), "id")
    element = sets.join(own.select("id"), "id").select("id", F.explode(expand(F.col("items"))).alias("s"))
    marked = element.groupBy("id").agg(F.count("*").alias("n"), *[
        F.expr(f"bit_xor(if(s & {FINE_MARKS - 1} = {k}, shiftleft(1L, cast(shiftright(s, 8) & 63 as int)), 0L)) as w{k}")
        for k in range(FINE_MARKS)])
    marked = marked.select("id", "n", F.array(*[f"w{k}" for k in range(FINE_MARKS)]).alias("marks"))
    members = stored(own.join(marked, "id"), label)
    parts = members.groupBy("cluster", "component").agg(F.count("*").alias("members"))
    totals = parts.groupBy("cluster").agg(
        F.max_by("component", "members").alias("largest"), F.max("members").alias("n_largest"), F.sum("members").alias("n_all"))
    totals = totals.select(
        "cluster", "largest", F.ceil(F.col("n_all") / BLOCK_ROWS).alias("blocks"),
        F.ceil((F.col("n_all") - F.col("n_largest")) / BLOCK_ROWS).alias("outer")).where("outer > 0")
    members = members.join(totals, "cluster").withColumns(
        {"block": F.pmod(F.xxhash64("id"), "blocks"), "row": F.pmod(F.xxhash64("id", F.lit(1)), "outer")})
    outside = members.where("component <> largest").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    other = members.withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("outer") - 1)))
    place, columns = ["cluster", "block", "row"], ["id", "component", "n", "marks"]
    x = outside.select(*place, *columns).toDF(*place, "a", "from_", "n_a", "marks_a").alias("x")
    y = other.select(*place, *columns).toDF(*place, "b", "to_", "n_b", "marks_b").alias("y")
    met = x.join(y, F.expr(" and ".join([
        *(f"x.{c} = y.{c}" for c in place), "from_ <> to_",
        f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)", _maybe_alike(percent, FINE_MARKS)])))
    return stored(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), label)


def _links_of_blocks(x: pd.DataFrame, y: pd.DataFrame, percent: int, expand=None) -> pd.DataFrame:
    """Links from each row of ``x`` to each other component in ``y``, one of each."""
    if not len(x) or not len(y):
        return pd.DataFrame({"a": [], "b": []}, dtype=np.int64)
    vx, vy = (expand(pa.array(f["items"]))[0] if expand else np.concatenate(f["items"].to_numpy()) for f in (x, y))
    both = np.intersect1d(vx, vy)
    common = np.zeros((len(x), len(y)), np.float32)
    for start in range(0, len(both), 2048):
        part = both[start:start + 2048]
        marks = []
        for f, v in ((x, vx), (y, vy)):
            at = np.minimum(np.searchsorted(part, v), len(part) - 1)
            hit = part[at] == v
            mark = np.zeros((len(f), len(part)), np.float32)
            mark[np.repeat(np.arange(len(f)), f["n"].to_numpy())[hit], at[hit]] = 1
            marks.append(mark)
        common += marks[0] @ marks[1].T
    total = x["n"].to_numpy()[:, None] + y["n"].to_numpy()[None, :] - common
    alike = (100 * common >= percent * total) & (x["component"].to_numpy()[:, None] != y["component"].to_numpy()[None, :])
    i, j = np.nonzero(alike)
    found = pd.DataFrame({"a": x["id"].to_numpy()[i], "b": y["id"].to_numpy()[j], "to": y["component"].to_numpy()[j]})
    return found.drop_duplicates(["a", "to"])[["a", "b"]]


# --- texts as byte arrays -------------------------------------------------------------


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the n + 1 places where its rows begin; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64, len(column) + 1 + column.offset)[column.offset:]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[ends[0]:ends[-1]], ends - ends[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of one piece have about ``most`` bytes.

    A single longer text stays whole, so the size of a piece is bounded by it.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        _, ends = utf8(batch.column(batch.schema.get_field_index(column)))
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + most, "right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix of every value, so that all bits of the result depend on all bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64))


def word_hashes(data: np.ndarray, ends: np.ndarray,
                apart: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words of all rows, and where each row's words begin.

    Words are runs of bytes not marked in ``apart``, by default 0x20 and 0x09 to 0x0D; only
    A-Z is lower-cased.
    """
    word = ~apart[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    inner = ends[(ends > 0) & (ends < len(data))]
    first[inner] = word[inner]  # a word never runs into the next row
    at = np.flatnonzero(word)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(len(ends), np.int64)
    opens = first[at]
    begins = np.flatnonzero(opens)
    place = np.arange(len(at)) - np.repeat(begins, np.diff(np.append(begins, len(at))))
    powers = np.cumprod(np.full(int(place.max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
    sums = np.add.reduceat(BYTE_CODES[LOWER[data[at]]] * powers[place], begins)
    return mixed(sums), np.searchsorted(at[begins], ends)

