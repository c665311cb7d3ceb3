"""Token counts through a cache of content digests."""

from __future__ import annotations

import hashlib
import json
import re
import sys
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.llm.common import by_value, texts
from rentlens.sources.store import Store

by_value(sys.modules[__name__])

CACHE = "tokenizer string, digest binary, n_tokens long"
BATCH = 64


def tokenizer_version(path: str) -> tuple[bytes, str]:
    """The tokenizer file and its digest; another file or version is another key of the cache."""
    data = Path(path).read_bytes()
    return data, hashlib.sha256(data).hexdigest()


#: Fixed values. How a byte-level BPE file of this kind splits texts, with Latin-1 letters, numbers and white space.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?[L]+| ?[N]+| ?[^LNS]+|[S]+(?![^S])|[S]+"
CLASSES = {"L": "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "N": "0-9\xb2\xb3\xb9\xbc-\xbe",
           "S": "\t-\r \x85\xa0"}
SEEN = 1 << 18  #: pieces whose counts a task keeps; beyond it starts again


class Counter:
    """Counts tokens as the tokenizers library does.

    No token reaches over two pieces of a byte-level BPE, so a text's count is the sum of its pieces', and a
    piece seen before in the task is not encoded again. Texts beyond Latin-1, texts that may hold a special token, and
    tokenizers of another kind go to the library whole.
    """

    def __init__(self, spec: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(spec)
        self.tok.no_truncation()
        self.tok.no_padding()
        parts = json.loads(spec)
        before = parts["pre_tokenizer"] or {}
        self.by_piece = (before.get("type") == "ByteLevel" and before.get("use_regex", True)
                         and not before["add_prefix_space"] and not parts["normalizer"] and not parts["post_processor"])
        special = "|".join(re.escape(t["content"]) for t in parts["added_tokens"])
        self.special = re.compile(special or "(?!)").search
        self.split = re.compile(re.sub("[LNS]", lambda m: CLASSES[m[0]], PIECES)).findall
        self.seen: dict[str, int] = {}

    def _learn(self, pieces: list[str]) -> None:
        if len(self.seen) > SEEN:
            self.seen.clear()
        new = list(dict.fromkeys(p for p in pieces if p not in self.seen))
        self.seen.update(zip(new, (len(e) for e in self.tok.encode_batch(new, add_special_tokens=False))))

    def count(self, text: str) -> int:
        if self.by_piece and not self.special(text):
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                pass
            else:
                pieces = self.split(text)
                total = 0
                for k in range(0, len(pieces), 1 << 16):  # bounded memory for very long texts
                    part = pieces[k:k + (1 << 16)]
                    try:
                        total += sum(map(self.seen.__getitem__, part))
                    except KeyError:
                        self._learn(part)
                        total += sum(self.seen.get(p) or len(self.tok.encode(p, add_special_tokens=False)) for p in part)
                return total
        return len(self.tok.encode(text, add_special_tokens=False))


def _counter(name: str, data: bytes):
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=data)
        return lambda batch: [len(x) for x in model.encode(batch, num_threads=1)]
    counter = Counter(data.decode())
    return lambda batch: [counter.count(x) for x in batch]


def _count(rows: DataFrame, name: str, data: bytes) -> DataFrame:
    """(digest, n_tokens) of (digest, text) rows, a few texts at a time."""
    def run(batches):
        count = _counter(name, data)
        for batch in batches:
            for k in range(0, batch.num_rows, BATCH):
                part = batch.slice(k, BATCH)
                n = count(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("digest"), pa.array(n, pa.int64())],
                                                 ["digest", "n_tokens"])

    return rows.select("digest", "text").mapInArrow(run, "digest binary, n_tokens long")


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, cache: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document.

    A text is normalised only in ways that cannot change its count (null becomes the empty text) and keyed by its
    SHA-256 and that of the tokenizer file. Keys found in ``cache`` (a folder of parquet) are not encoded; of the rest
    each distinct text is encoded once and appended there. Without ``cache`` a new one is made in the shared folder.

    The map side keeps one text per digest before the shuffle, so copies do not move; the counts are joined back
    to (doc_id, digest) rows, which hold no text. Special strings in a text count as the tokenizer's library has
    it by default. Empty texts have 0 bytes and the library's count of nothing. Repeated rows each give a row, a null
    doc_id stays null, and an empty table gives an empty result.
    """
    spark = docs.sparkSession
    data, version = tokenizer_version(tokenizer)
    where = cache or Store(spark, "token-cache").path("counts")
    spark.createDataFrame([], CACHE).write.mode("append").parquet(where)  # so that a new cache can be read
    known = spark.read.schema(CACHE).parquet(where).filter(F.col("tokenizer") == version).select("digest", "n_tokens")
    keyed = texts(docs).withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    keyed = keyed.withColumn("digest", F.unhex("digest"))
    distinct = keyed.groupBy("digest").agg(F.first("text").alias("text"))
    misses = distinct.join(known, "digest", "left_anti")
    (_count(misses, tokenizer, data).select(F.lit(version).alias("tokenizer"), "digest", "n_tokens")
     .write.mode("append").parquet(where))
    # two runs at once may both append a key; its counts are equal
    counts = (spark.read.schema(CACHE).parquet(where).filter(F.col("tokenizer") == version)
              .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))
    rows = keyed.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest")
    return rows.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens",
                                              (F.col("n_tokens") > limit).alias("over_limit"))
