"""Exact histogram of encoded lengths, and what follows from it for every context limit."""

from __future__ import annotations

import base64
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import slices, stored

VOCABULARY = "byte_bpe_50k.tiktoken"
BLOCK = 1024


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _encoding(ranks_file: bytes, pattern: str):
    import tiktoken
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks_file.splitlines())}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counts(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``(doc_id, n_tokens)`` of every row of ``docs(doc_id, text)``, whole texts.

    ``path`` is a file of byte-pair ranks, by default a public vocabulary of 50,256 tokens;
    its bytes (under 1 MB, of fixed size) go to the tasks. Strings of special tokens count
    as ordinary text. A null text has no tokens. Other columns are ignored.
    """
    if pattern is None:
        import public_tokenizers
        pattern = public_tokenizers.PATTERN
    with open(path or vocabulary_path(), "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches):
        encoding = _encoding(ranks.value, pattern)
        for batch in slices(batches, "text", 1 << 20):
            counts = [len(encoding.encode_ordinary(t)) if t else 0 for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64())], ["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long")


def length_histogram(counts: DataFrame) -> DataFrame:
    """One row per length that occurs in ``counts(n_tokens)``.

    ``n_docs`` documents have exactly ``n_tokens`` tokens; ``docs_ge`` and ``tokens_ge``
    are the suffix sums of documents and tokens over this and longer lengths;
    ``truncated_total`` is the number of tokens left if every document is cut to
    ``n_tokens``; ``share_le`` is the share of documents that fit whole.

    The sums run within blocks of 1,024 lengths plus the totals of the later blocks, so
    one task sorts at most 1,024 rows, or one row per block. An empty table gives none.
    """
    histogram = stored(counts.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))
                       .withColumn("block", (F.col("n_tokens") / BLOCK).cast("long")), "token-lengths")
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    blocks = histogram.groupBy("block").agg(
        F.sum("n_docs").alias("docs"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("tokens"))
    blocks = blocks.select(
        "block", F.coalesce(F.sum("docs").over(later), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("tokens").over(later), F.lit(0)).alias("tokens_after"),
        F.sum("docs").over(everything).alias("all_docs"), F.sum("tokens").over(everything).alias("all_tokens"))
    own = Window.partitionBy("block").orderBy(F.desc("n_tokens"))
    summed = histogram.join(blocks, "block").select(
        "n_tokens", "n_docs",
        (F.col("docs_after") + F.sum("n_docs").over(own)).alias("docs_ge"),
        (F.col("tokens_after") + F.sum(F.col("n_docs") * F.col("n_tokens")).over(own)).alias("tokens_ge"),
        "all_docs", "all_tokens")
    return summed.select(
        "n_tokens", "n_docs", "docs_ge", "tokens_ge",
        (F.col("all_tokens") - F.col("tokens_ge") + F.col("n_tokens") * F.col("docs_ge")).alias("truncated_total"),
        ((F.col("all_docs") - F.col("docs_ge") + F.col("n_docs")) / F.col("all_docs")).alias("share_le"))


def totals_at(histogram: DataFrame, limit: int) -> DataFrame:
    """One row for any context limit: documents, tokens, tokens left after truncation,
    documents longer than ``limit``. Answered from the histogram alone."""
    longer = F.col("n_tokens") > limit
    return histogram.agg(
        F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"),
        F.coalesce(F.sum(F.col("n_docs") * F.col("n_tokens")), F.lit(0)).alias("n_tokens"),
        F.coalesce(F.sum(F.col("n_docs") * F.least("n_tokens", F.lit(limit))), F.lit(0)).alias("truncated_total"),
        F.coalesce(F.sum(F.when(longer, F.col("n_docs")).otherwise(0)), F.lit(0)).alias("n_longer"))


def length_quantile(histogram: DataFrame, q: float) -> DataFrame:
    """One row: the smallest length that at least the share ``q`` of documents does not exceed."""
    return histogram.where(F.col("share_le") >= q).agg(F.min("n_tokens").alias("n_tokens"))
