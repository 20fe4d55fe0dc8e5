"""Token counts through a digest cache.

The digest of a text's content and the digest of the tokenizer's file name a stored count.
Documents are joined to the cache by digest; each distinct content the cache lacks is encoded
once, and its count is appended.
"""

from __future__ import annotations

import hashlib
import os
import re
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from slipmatch.llm.tables import to_utf8

CACHE_SCHEMA = "digest binary, version string, n_tokens long"
# Pieces of text whose counts a task remembers; the memory is emptied when full.
MEMO_PIECES = 400_000
# Where a text may not be cut at blanks and line ends: next to other white space, or to
# characters that some Unicode versions count as white space, or at either end.
UNSAFE = re.compile(r"[\s\u180e\u200b\u2060\ufeff][ \n]|[ \n][\s\u180e\u200b\u2060\ufeff]|\A[ \n]|[ \n]\Z")


def version_of(tokenizer: str) -> str:
    return hashlib.sha256(Path(tokenizer).read_bytes()).hexdigest()


def _loaded(path: str):
    """The library's counts of a list of texts, and whether texts may be cut at blanks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)], False
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    # A space starts a new piece only where the pre-tokenizer splits before spaces.
    cuts = '"type":"ByteLevel","add_prefix_space":false' in model.to_str().replace(" ", "") and model.normalizer is None
    return lambda texts: [len(e) for e in model.encode_batch_fast(texts, add_special_tokens=False)], cuts


class Counter:
    """Counts as the library gives them, remembering the pieces between blanks and line ends.

    The byte-level pre-tokenizer always splits before a blank, and around a line end, that
    stands between two characters which aren't white space; counts of the pieces then add up.
    Other texts and other tokenizers go to the library whole.
    """

    def __init__(self, path: str):
        self.encode, self.cuts = _loaded(path)
        self.memo: dict[str, int] = {}

    def counts(self, texts: list[str]) -> list[int]:
        pieces = [self._pieces(t) for t in texts]
        memo = self.memo
        new = list({p for parts in pieces for p in parts if p not in memo})
        if len(memo) + len(new) > MEMO_PIECES:
            memo.clear()
            new = list({p for parts in pieces for p in parts})
        for at in range(0, len(new), 2000):
            some = new[at : at + 2000]
            memo.update(zip(some, self.encode(some), strict=True))
        out = [sum(map(memo.__getitem__, parts)) for parts in pieces]
        return out

    def _pieces(self, text: str) -> list[str]:
        if not text:
            return []
        if not self.cuts or UNSAFE.search(text):
            return [text]
        out: list[str] = []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            out += [first, *[" " + piece for piece in rest], "\n"]
        return out[:-1]


class TokenCache:
    """Counts by digest and version, appended to a table below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def read(self, version: str) -> DataFrame:
        try:
            stored = self.spark.read.schema(CACHE_SCHEMA).parquet(self.folder)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            stored = self.spark.createDataFrame([], CACHE_SCHEMA)
        # An append repeated after a lost driver leaves equal rows.
        return stored.where(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    def append(self, counted: DataFrame) -> None:
        counted.write.mode("append").parquet(self.folder)


def digest(column: str = "text"):
    """SHA-256 of the UTF-8 bytes; null counts as empty. Nothing else is normalised, since
    any other change of a text can change its tokens."""
    return F.unhex(F.sha2(to_utf8(column), 256))


def encoded(texts: DataFrame, tokenizer: str, version: str) -> DataFrame:
    """Counts of rows ``digest``, ``content``."""

    def encode(batches):
        counter = Counter(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                counts = counter.counts([t or "" for t in part.column("content").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("digest"), pa.array([version] * len(part)), pa.array(counts, pa.int64())],
                    ["digest", "version", "n_tokens"],
                )

    return texts.select("digest", "content").mapInArrow(encode, CACHE_SCHEMA)


def token_counts(docs: DataFrame, tokenizer: str, cache: TokenCache, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document; other columns are left out.

    One row of each distinct missing content is chosen by its smallest id, so that copies
    neither travel nor are encoded. Null and empty texts have no tokens; rows repeated under
    one id share its count if their texts are equal and have their own otherwise.
    """
    version = version_of(tokenizer)
    known = cache.read(version)
    marked = docs.select("doc_id", digest().alias("digest"), F.octet_length(to_utf8("text")).cast("long").alias("n_bytes"))
    chosen = (
        marked.groupBy("digest")
        .agg(F.min("doc_id").alias("doc_id"), F.bool_or(F.col("doc_id").isNull()).alias("unnamed"))
        .join(known, "digest", "left_anti")
    )
    content = docs.select("doc_id", digest().alias("digest"), F.coalesce("text", F.lit("")).alias("content"))
    named = chosen.where(F.col("doc_id").isNotNull()).select("doc_id", F.col("digest").alias("wanted"))
    misses = (
        content.join(named, "doc_id")
        .where(F.col("digest") == F.col("wanted"))
        .select("digest", "content")
    )
    cache.append(encoded(misses, tokenizer, version))
    # Contents that only rows without an id have.
    unnamed = chosen.where(F.col("doc_id").isNull()).select(F.col("digest").alias("wanted"))
    if not unnamed.isEmpty():
        orphans = content.where(F.col("doc_id").isNull()).join(unnamed, F.col("digest") == F.col("wanted"))
        cache.append(encoded(orphans.select("digest", "content"), tokenizer, version))
    known = cache.read(version)
    return marked.join(known, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
