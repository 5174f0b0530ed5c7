"""Token counts of documents from a digest cache.

The cache is a Parquet table of (content digest, tokens), partitioned by the
tokenizer's version (digest of its file and of the library's version).

1. Every text gets the SHA-256 of its normalised content: null counts as the
   empty text, all else is taken as it is, as the tokenizer has no normaliser
   of its own and any rewriting could change a count.
2. Distinct digests without a stored count are the misses; each names one
   document that carries it, so copies (one text may be a third of all rows)
   are encoded once and no key of the join that fetches the texts is hot.
3. Only the misses are encoded, by the tokenizer's library, and appended to
   the cache by Spark's writer; a job that is lost leaves no part behind, and
   entries that two jobs append at a time count once.
4. All rows are joined to the cache by digest.

A text is encoded in segments that begin at a blank after a character that is
no white space.  The tokenizer's pattern never matches across such a place, and
no special token holds a blank, so counts of segments add up to the count of
the text; a worker remembers counts of segments, and very long texts need no
more memory than others.

Defined results: null and empty texts have no bytes and no tokens; very long
texts are counted whole; repeated rows give equal rows; a null id stays null
and is counted like any other; an empty table gives an empty table and leaves
the cache as it is; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.llm.common import halve, keys, table, worker_state

MEMO = 300_000
BLOCK_CHARS = 1_000_000
#: Blanks and what follows up to the next blank that stands after no white space.
SEGMENT = re.compile(r" *[^ ]+(?:(?<=\s) +[^ ]*)*| +")


def tokenizer_file(path: str) -> tuple[str, str]:
    """Text of a tokenizer file and its version digest."""
    import tokenizers
    with open(path, encoding="utf-8") as f:
        text = f.read()
    return text, hashlib.sha256(f"{tokenizers.__version__}\0{text}".encode()).hexdigest()


def _load(text: str):
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer
    tok = Tokenizer.from_str(text)
    tok.no_truncation()
    tok.no_padding()
    return tok


def counter(text: str, version: str):
    """Function from a list of texts to their numbers of tokens."""
    tok = worker_state(f"tokenizer-{version}", lambda: _load(text))
    memo: dict[str, int] = worker_state(f"counts-{version}", dict)

    def count(texts: list[str]) -> list[int]:
        found = [SEGMENT.findall(t) for t in texts]
        halve(memo, MEMO)
        new = list({s for f in found for s in f if s not in memo})
        for n in range(0, len(new), 4096):
            part = new[n: n + 4096]
            memo.update(zip(part, (len(e.ids) for e in tok.encode_batch_fast(part, add_special_tokens=False))))
        return [sum(map(memo.__getitem__, f)) for f in found]

    return count


def encoded(texts: DataFrame, path: str) -> DataFrame:
    """``texts(digest, text)`` -> ``(digest, n_tokens)``."""
    text, version = tokenizer_file(path)
    shared = texts.sparkSession.sparkContext.broadcast(text)

    def run(batches):
        count = counter(shared.value, version)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                block, size, end = [], 0, at
                while end < batch.num_rows and (end == at or size < BLOCK_CHARS):
                    block.append(batch.column(1)[end].as_py() or "")
                    size += len(block[-1])
                    end += 1
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), pa.array(count(block), pa.int64())],
                                                 names=["digest", "n_tokens"])
                at = end

    return texts.select("digest", "text").mapInArrow(run, "digest binary, n_tokens long")


def cache_table(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Stored ``(digest, n_tokens)`` of one tokenizer version."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{cache}/tokenizer={version}")
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], "digest binary, n_tokens long")
    return spark.read.schema("digest binary, n_tokens long").parquet(at.toString()).dropDuplicates(["digest"])


def token_counts(docs: DataFrame, cache: str, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)`` of every row; ``cache`` is a folder that
    the cluster shares, ``path`` the tokenizer's file (read on the driver)."""
    spark = docs.sparkSession
    version = tokenizer_file(path)[1]
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("digest", F.unhex(F.sha2("text", 256)))
    rows = table(docs.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest"))
    distinct = rows.groupBy("digest").agg(F.min("doc_id").alias("carrier"))
    misses = keys(distinct.join(cache_table(spark, cache, version), "digest", "left_anti"))
    if not misses.isEmpty():
        miss = misses.withColumnRenamed("digest", "miss")
        texts = docs.join(miss, F.col("doc_id").eqNullSafe(F.col("carrier")) & (F.col("digest") == F.col("miss")))
        (encoded(texts, path).dropDuplicates(["digest"]).withColumn("tokenizer", F.lit(version))
         .write.mode("append").partitionBy("tokenizer").parquet(cache))
    stored = cache_table(spark, cache, version)
    return rows.join(stored, "digest").select("doc_id", "n_bytes", "n_tokens")
