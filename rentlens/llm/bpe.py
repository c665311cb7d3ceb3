"""BPE encoding through a table of distinct words, and decoding through a table of pieces."""

from __future__ import annotations

import hashlib
import json
import re
import sys
import zlib
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.llm.common import by_value, chunk_count, texts, total_bytes

by_value(sys.modules[__name__])

ENCODED = "ids array<long>"
BUCKET = 8        #: chunks for each bucket of the distinct-word table
#: Fixed values. White space as tokenizers know it; letters and numbers of Latin-1 after lower-casing.
SPACE = "\\t-\\r \\x85\\xa0"
LETTER = "a-z\\xaa\\xb5\\xba\\xdf-\\xf6\\xf8-\\xff"
NUMBER = "0-9\\xb2\\xb3\\xb9\\xbc-\\xbe"
#: The one word pattern and normalizer that are known here; another tokenizer file is refused.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_letters() -> dict[int, str]:
    """The letter of each byte in a byte-level vocabulary: itself if it shows, else the next one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


BYTE_LETTERS = _byte_letters()


class Words:
    """Splits texts into the words of a tokenizer file, and encodes single words.

    Words never reach over a special token, which is a word of its own. Texts inside Latin-1 take a compiled
    pattern; all others take the tokenizer's own normalizer and splitter.
    """

    def __init__(self, spec: str):
        self.spec = spec
        special = [t["content"] for t in json.loads(spec)["added_tokens"]]
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")
        self.specials = frozenset(special)
        self.latin = re.compile(PATTERN.replace(r"[\p{L}]", f"[{LETTER}]").replace(r"[\p{N}]", f"[{NUMBER}]")
                                .replace(r"\s\p{L}\p{N}", SPACE + LETTER + NUMBER)).findall

    @cached_property
    def tok(self):
        """The library's tokenizer, loaded where it is needed: most chunks are split without it."""
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        tok = Tokenizer.from_str(self.spec)
        tok.no_truncation()
        tok.no_padding()
        return tok

    def split(self, text: str) -> list[str]:
        if "<|" in text and self.special.search(text):
            return [w for part in self.special.split(text)
                    for w in ([part] if part in self.specials else self._plain(part))]
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            text = self.tok.normalizer.normalize_str(text)
            return [text[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]
        return self.latin(text.lower())

    def encode(self, word: str) -> list[int]:
        """Ids of a word that ``split`` gave: it is normalised already, so the library's merges take it as it is."""
        if word in self.specials:
            return [self.tok.token_to_id(word)]
        plain = word.isascii() and word.isprintable()
        letters = word if plain else word.encode().decode("latin-1").translate(BYTE_LETTERS)
        return [t.id for t in self.tok.model.tokenize(letters)]


def load(path: str) -> str:
    """The text of a tokenizer file, after a check that its words are the kind that can be encoded alone."""
    spec = Path(path).read_text()
    parts = json.loads(spec)
    split = parts["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    if split != PATTERN or not parts["model"].get("end_of_word_suffix") or parts["post_processor"]:
        raise ValueError("not a word BPE of the known pattern")
    return spec


def _bucket(word: str, buckets: int) -> int:
    return zlib.crc32(word.encode()) % buckets


def _dictionary(found: set[str], buckets: int) -> dict[int, list[str]]:
    """The distinct words of a chunk by bucket, in a fixed order, which is their position in the bucket."""
    out: dict[int, list[str]] = {}
    for word in sorted(found):
        out.setdefault(_bucket(word, buckets), []).append(word)
    return out


def _pack(rows: list[bytes]) -> bytes:
    """Each word's ids, little-endian unsigned 32-bit integers, behind their number and their lengths."""
    lengths = np.array([len(rows), *(len(r) // 4 for r in rows)], "<u4")
    return zstandard.compress(lengths.tobytes() + b"".join(rows), 1)


def _unpack(data: bytes) -> list[bytes]:
    """Each word's ids as little-endian unsigned 32-bit integers."""
    data = zstandard.decompress(data)
    n = int.from_bytes(data[:4], "little")
    ends = 4 * (n + 1) + 4 * np.cumsum(np.frombuffer(data, "<u4", n, 4), dtype=np.int64)
    starts = np.concatenate(([4 * (n + 1)], ends[:-1]))
    return [data[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


def _encoded(docs: DataFrame, spec: str, chunk_bytes: int, finish: Callable[[pa.ChunkedArray, Iterable[bytes]], pa.Table],
             schema: str) -> DataFrame:
    """The documents with their ids, as ``finish`` makes rows of doc_ids and packed ids. See ``encode``."""
    rows = texts(docs)
    chunks = chunk_count(total_bytes(rows), chunk_bytes)
    buckets = -(-chunks // BUCKET)
    words = Words(spec)  # sent with the task, where its tokenizer is loaded once
    kind = rows.schema["doc_id"].dataType.simpleString()

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # texts travel compressed: the shuffle's own codec saves far less
        press = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            data = pa.array([press(t.as_buffer().to_pybytes()) for t in b.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("chunk"), b.column("doc_id"), data], ["chunk", "doc_id", "data"])

    def words_of(table: pa.Table) -> Iterator[list[str]]:
        grow = zstandard.ZstdDecompressor().decompress
        for data in table.column("data"):
            yield words.split(grow(data.as_buffer()).decode())

    def ask(table: pa.Table) -> pa.Table:
        chunk, found = table.column("chunk")[0].as_py(), set()
        for some in words_of(table):
            found.update(some)
        parts = _dictionary(found, buckets)
        return pa.table({"bucket": pa.array(parts, pa.int64()), "chunk": pa.array([chunk] * len(parts), pa.int64()),
                         "words": pa.array([zstandard.compress("\n".join(p).encode(), 3) for p in parts.values()],
                                           pa.binary())})

    def answer(table: pa.Table) -> pa.Table:
        # the distinct-word table of this bucket: each word once, however many chunks hold it
        ids: dict[str, bytes] = {}
        answers = []
        for data in table.column("words"):
            asked = zstandard.decompress(data.as_buffer()).decode().split("\n")
            for word in asked:
                if word not in ids:
                    ids[word] = np.array(words.encode(word), "<u4").tobytes()
            answers.append(_pack([ids[word] for word in asked]))
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"),
                         "ids": pa.array(answers, pa.binary())})

    def assemble(docs: pa.Table, answers: pa.Table) -> pa.Table:
        place: defaultdict[str, int] = defaultdict()
        place.default_factory = place.__len__  # a word's position in the chunk's dictionary
        split = [array("i", map(place.__getitem__, some)) for some in words_of(docs)]
        parts, ids = _dictionary(set(place), buckets), [b""] * len(place)
        for bucket, data in zip(answers.column("bucket").to_pylist(), answers.column("ids")):
            for word, coded in zip(parts.pop(bucket), _unpack(data.as_buffer())):
                ids[place.pop(word)] = coded
        return finish(docs.column("doc_id"), (b"".join(map(ids.__getitem__, spots)) for spots in split))

    packed = (rows.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).alias("chunk"), "doc_id",
                          F.col("text").cast("binary").alias("text"))
              .mapInArrow(squeeze, f"chunk long, doc_id {kind}, data binary"))
    asked = packed.groupBy("chunk").applyInArrow(ask, "bucket long, chunk long, words binary")
    answers = asked.groupBy("bucket").applyInArrow(answer, "chunk long, bucket long, ids binary")
    return packed.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(assemble, f"doc_id {kind}, {schema}")


def _lists(ids: list[bytes]) -> pa.LargeListArray:
    """Bytes of little-endian unsigned 32-bit integers as lists."""
    ends = np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids])))
    return pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()),
                                         pa.array(np.frombuffer(b"".join(ids), "<u4").astype("i8")))


def encode(docs: DataFrame, tokenizer: str, chunk_bytes: int = 4 << 20) -> DataFrame:
    """(doc_id, ids) of every document, as the library encodes the whole text without added special tokens.

    Documents go to chunks of a few MiB by hash. A chunk's words are its distinct words, each sent once to the bucket of
    its hash; a bucket holds the distinct-word table of its words, encodes each once, and answers every chunk that
    asked. The ids come back to the chunk by bucket and position, and are laid out along each document. The texts
    are shuffled once, as both the question and the answer use the same partitioning; a frequent word costs a chunk
    one row. A bucket gets the words of ``BUCKET`` chunks on average, and holds the ids of distinct ones only. A chunk and
    a bucket are bounded, and their number follows the corpus.

    Null and empty texts have no ids. Special tokens in a text give their id. Repeated rows each give a row, a null
    doc_id stays null, other columns are left out, and an empty table gives an empty result.
    """
    def lists(doc_ids: pa.ChunkedArray, ids: Iterable[bytes]) -> pa.Table:
        return pa.table({"doc_id": doc_ids, "ids": _lists(list(ids)).cast(pa.list_(pa.int64()))})

    return _encoded(docs, load(tokenizer), chunk_bytes, lists, ENCODED)


def pieces(tokenizer: str) -> pa.Array:
    """The id-to-piece table: the piece of id i at position i. Its size is the vocabulary's; a hole is null."""
    from tokenizers import Tokenizer

    vocabulary = Tokenizer.from_file(tokenizer).get_vocab(with_added_tokens=True)
    table: list[str | None] = [None] * (max(vocabulary.values()) + 1)
    for piece, k in vocabulary.items():
        table[k] = piece
    return pa.array(table, pa.large_string())


def _joined(ids: pa.Array, table: pa.Array) -> pa.Array:
    """Texts of lists of ids: each id takes its piece, and pieces are put together with a space (no decoder)."""
    taken = table.take(ids.flatten())
    if taken.null_count:
        raise ValueError("an id is not in the vocabulary")
    lists = pa.LargeListArray.from_arrays(ids.offsets.cast(pa.int64()), taken)
    return pc.binary_join(lists, pa.scalar(" ", pa.large_string()))


def _decoder(tokenizer: str) -> pa.Array:
    if json.loads(Path(tokenizer).read_text())["decoder"]:
        raise ValueError("only tokenizers without a decoder are known, whose pieces are joined with a space")
    return pieces(tokenizer)


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids, decoded) of (doc_id, ids) rows, as the library decodes them with special tokens kept.

    Ids meet the id-to-piece table (as long as the vocabulary, sent with the task) by position, a batch at a time.
    Null and empty ids decode to the empty text; an unknown id is an error.
    """
    table = _decoder(tokenizer)

    def run(batches):
        for b in batches:
            ids = pc.fill_null(b.column("ids").cast(pa.large_list(pa.int64())), pa.scalar([], pa.large_list(pa.int64())))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("ids"),
                                              _joined(ids, table).cast(pa.string())], ["doc_id", "ids", "decoded"])

    rows = encoded.select("doc_id", F.col("ids").cast("array<long>").alias("ids"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {ENCODED}, decoded string")


def round_trip(docs: DataFrame, tokenizer: str, chunk_bytes: int = 4 << 20) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: ``encode`` and then ``decode``, with their results as digests.

    A chunk's ids are decoded where they are put together. Rows and nulls as in ``encode``.
    """
    spec, table = load(tokenizer), _decoder(tokenizer)
    sha = lambda b: hashlib.sha256(b).hexdigest()

    def digests(doc_ids: pa.ChunkedArray, ids: Iterable[bytes]) -> pa.Table:
        rows: list[tuple[int, str, str]] = []
        part: list[bytes] = []

        def put() -> None:
            decoded = _joined(_lists(part), table)
            rows.extend((len(x) // 4, sha(x), sha(t.as_buffer())) for x, t in zip(part, decoded))
            part.clear()

        held = 0
        for x in ids:
            part.append(x)
            held += len(x)
            if held > 1 << 20:  # bounded memory, whatever the length of the texts
                put()
                held = 0
        put()
        n, coded, decoded = zip(*rows)
        return pa.table({"doc_id": doc_ids, "n_tokens": pa.array(n, pa.int64()),
                         "ids_sha256": pa.array(coded, pa.string()), "decoded_sha256": pa.array(decoded, pa.string())})

    return _encoded(docs, spec, chunk_bytes, digests, "n_tokens long, ids_sha256 string, decoded_sha256 string")
