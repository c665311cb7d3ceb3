"""Alignment of the tokens of two tokenizers over the same text, and how often their tokens end together.

Tokenizer A is a byte-level BPE file of the tokenizers library, B a sentencepiece model. Where a token ends follows from the
decoded bytes of the tokens up to it; whether these give back the text's bytes is checked for every stretch.

A text is cut where no token of either tokenizer can reach over, before a single space between two words. Both have a cut there, so
the groups of a text are those of its stretches one after the other, and a stretch that a task has seen is not aligned again.

Corpus-wide counts go through chunks of a few MiB. A chunk counts its own distinct pairs of ids; the sums over all chunks come
back to each chunk by position, and are added up along its documents. No table of pairs is broadcast, and the texts are
read once.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, count
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.llm.common import by_value, stage, texts

by_value(sys.modules[__name__])

CHUNK = 4 << 20  #: bytes of text from which a chunk is closed
BATCH = 64  #: texts that are cut at a time
SEEN = 400_000  #: stretches that a task keeps; beyond it goes on with those that were asked for again
SHORT = 64  #: longer stretches are not kept
UNSEEN = ()  #: in place of a stretch that is not kept
Stretch = tuple[int, int, int, str, tuple[int, ...]]  # tokens of A and of B, groups, their text, linked pairs


def _byte_letters() -> dict[str, int]:
    """The byte of each letter of a byte-level vocabulary: itself if it shows, else the next letter from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class _Side:
    """The tokens of many stretches by one tokenizer, one after the other, and where each ends in bytes of its stretch."""

    def __init__(self, ids: list[int], counts: np.ndarray, lengths: np.ndarray):
        self.ends = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
        self.list, self.ids = ids, np.array(ids, np.int64)
        self.row = np.repeat(np.arange(len(counts)), counts)
        self.bytes = lengths[self.ids]
        total = np.concatenate(([0], np.cumsum(self.bytes)))
        self.keys = (self.row << 40) + total[1:] - total[self.ends[:-1]][self.row]


class Aligner:
    """Groups and links of texts under two tokenizers."""

    def __init__(self, spec: str, proto: bytes):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(spec)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.b_size = self.b.get_piece_size()
        letters = _byte_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        special = {t["content"] for t in json.loads(spec)["added_tokens"]}
        self.a_bytes: list[bytes] = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            self.a_bytes[k] = token.encode() if token in special else bytes(letters[c] for c in token)
        pieces = [self.b.id_to_piece(k) for k in range(self.b_size)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode()
                        for k, p in enumerate(pieces)]
        self.a_lengths, self.b_lengths = (np.array(list(map(len, x))) for x in (self.a_bytes, self.b_bytes))
        self.is_byte = np.array([self.b.is_byte(k) for k in range(self.b_size)])
        self.width = max(len(self.a_bytes), self.b_size)
        self.names = [f"{k}{after}" for after in (",", "|", ";", "") for k in range(self.width)]
        self.name_sizes = np.array(list(map(len, self.names)))
        parts = json.loads(spec)
        before = parts["pre_tokenizer"] or {}
        words_alone = (before.get("type") == "ByteLevel" and before.get("use_regex", True) and not parts["normalizer"]
                       and not parts["post_processor"] and not before["add_prefix_space"]
                       and not any(re.search("[^▁]▁", p) for p in pieces))
        self.words_alone = words_alone
        # white space as Python knows it holds all that either tokenizer takes for it; a pattern that begins with its space is
        # looked for at spaces only
        self.split = re.compile(r" (?<=\S )(?=\S)").split if words_alone else lambda text: [text]
        self.seen: dict[str, Stretch | None] = {}
        self.often: dict[str, Stretch | None] = {}  # those that chunks have asked for again

    def _tokens_a(self, stretches: list[str], flat: bytes, sizes: np.ndarray) -> _Side:
        """A's tokens of space + each stretch. Words go in as one text, where each begins a token; the bytes tell whose it is."""
        if self.words_alone and not any(s[0].isspace() for s in stretches):
            ids = self.a.encode(flat.decode(), add_special_tokens=False).ids
            if b"".join(map(self.a_bytes.__getitem__, ids)) == flat:
                ends, borders = np.cumsum(self.a_lengths[np.array(ids, np.int64)]), np.cumsum(sizes)
                after = np.searchsorted(ends, borders, "right")
                return _Side(ids, np.diff(after, prepend=0), self.a_lengths)
        rows = [x.ids for x in self.a.encode_batch([" " + s for s in stretches], add_special_tokens=False)]
        return _Side(list(chain.from_iterable(rows)), np.array(list(map(len, rows))), self.a_lengths)

    def align(self, stretches: list[str]) -> list[Stretch | None]:
        """The groups of space + each stretch; None where the tokens of A or B don't give back its bytes."""
        flat = (" " + " ".join(stretches)).encode()
        sizes = np.array(list(map(len, stretches)), np.int64) + 1
        if sizes.sum() != len(flat):  # a character of several bytes
            sizes = np.array([len(s.encode()) for s in stretches], np.int64) + 1
        a = self._tokens_a(stretches, flat, sizes)
        rows = self.b.encode(stretches, out_type=int, num_threads=1)
        b = _Side(list(chain.from_iterable(rows)), np.array(list(map(len, rows))), self.b_lengths)
        sides = [a, b]
        bad = self._not_given_back(flat, sizes, sides)
        cuts = [np.isin(a.keys, b.keys, assume_unique=True), np.isin(b.keys, a.keys, assume_unique=True)]
        group = [np.cumsum(c) - c + side.row for c, side in zip(cuts, sides)]  # grows with each cut and each stretch
        # a group's tokens of A, then those of B; after each "," or, at a cut, "|" and ";" (nothing after a stretch's last)
        order = [np.arange(len(a.ids)) + np.searchsorted(group[1], group[0], "left"),
                 np.arange(len(b.ids)) + np.searchsorted(group[0], group[1], "right")]
        last = np.zeros(len(b.ids), bool)
        last[b.ends[1:][b.ends[1:] > b.ends[:-1]] - 1] = True
        names = np.empty(len(a.ids) + len(b.ids), np.int64)
        names[order[0]] = a.ids + self.width * cuts[0]
        names[order[1]] = b.ids + self.width * np.where(last, 3, 2 * cuts[1])
        text = "".join(map(self.names.__getitem__, names.tolist()))
        ends = np.concatenate(([0], np.cumsum(self.name_sizes[names])))[a.ends + b.ends].tolist()
        links = (a.ids[cuts[0]] * self.b_size + b.ids[cuts[1]]).tolist()
        groups = np.concatenate(([0], np.cumsum(np.bincount(a.row[cuts[0]], minlength=len(stretches))))).tolist()
        out: list[Stretch | None] = [
            (x, y, h - g, text[i:j], tuple(links[g:h]))
            for x, y, g, h, i, j in zip(np.diff(a.ends).tolist(), np.diff(b.ends).tolist(), groups, groups[1:], ends, ends[1:])]
        for k in bad:
            out[k] = None
        return out

    def _not_given_back(self, flat: bytes, sizes: np.ndarray, sides: list[_Side]) -> list[int]:
        """Places of the stretches whose bytes are not those of their tokens, looked for one by one only where there are any."""
        pairs = list(zip(sides, (self.a_bytes, self.b_bytes)))
        if all(np.array_equal(np.bincount(side.row, side.bytes, len(sizes)), sizes)
               and b"".join(map(table.__getitem__, side.list)) == flat for side, table in pairs):
            return []
        ends = [0, *np.cumsum(sizes).tolist()]
        return [i for i in range(len(sizes))
                if any(b"".join(map(table.__getitem__, side.list[side.ends[i]:side.ends[i + 1]])) != flat[ends[i]:ends[i + 1]]
                       for side, table in pairs)]

    def learn(self, new: list[str]) -> list[Stretch | None]:
        """The aligned stretches of ``new``, all different; those not seen before are encoded."""
        out = [self.seen.get(s, UNSEEN) for s in new]
        self.often.update((s, x) for s, x in zip(new, out) if x is not UNSEEN)
        spots = [k for k, x in enumerate(out) if x is UNSEEN]
        asked = [new[k] for k in spots]
        now = list(chain.from_iterable(self.align(asked[k:k + (1 << 12)]) for k in range(0, len(asked), 1 << 12)))
        for k, x in zip(spots, now):
            out[k] = x
        if len(self.seen) + len(now) > SEEN:  # go on with what was asked for again; most others never are
            self.seen, self.often = (self.often if len(self.often) < SEEN // 2 else {}), {}
        self.seen.update((s, x) for s, x in zip(asked, now) if len(s) <= SHORT)
        return out


_ROW = "chunk string, doc_id array<{}>, n_a array<long>, n_b array<long>, n_groups array<long>, " \
       "groups_sha256 array<string>, words binary, links binary, pairs array<long>, times array<long>"


def _packed(arrays: list[np.ndarray]) -> bytes:
    head = np.array([len(arrays), *map(len, arrays)], "<u4")
    return zstandard.compress(head.tobytes() + b"".join(x.astype("<u4").tobytes() for x in arrays), 1)


def _unpacked(data: bytes) -> list[np.ndarray]:
    flat = np.frombuffer(zstandard.decompress(data), "<u4")
    ends = np.cumsum(flat[1:flat[0] + 1], dtype=np.int64) + flat[0] + 1
    return [flat[a:b] for a, b in zip([flat[0] + 1, *ends[:-1]], ends)]


class _Chunk:
    """Documents of a chunk as places in a list of its distinct stretches."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.ids, self.shas, self.words, self.bytes = [], [], [], 0
        self.place: dict[str, int] = {}
        self.entries: list[Stretch] = []
        self.groups: list[str] = []
        self.bad: set[int] = set()  # stretches that tokens don't give back

    def add(self, docs: list[tuple[object, str]]) -> None:
        parts = [self.aligner.split(text) if text else [] for _, text in docs]
        new = [s for s in dict.fromkeys(chain.from_iterable(parts)) if s not in self.place]
        found = self.aligner.learn(new)
        self.bad.update(k for k, x in enumerate(found, len(self.place)) if x is None)
        found = [x or (0, 0, 0, "", ()) for x in found]
        self.place.update(zip(new, count(len(self.place))))
        self.entries += found
        self.groups += [x[3] for x in found]
        for (doc_id, text), part in zip(docs, parts):
            spots = array("I", map(self.place.__getitem__, part))
            if self.bad and not self.bad.isdisjoint(spots):
                spots = array("I")
            self.ids.append(doc_id)
            self.bytes += len(text) + 1024
            self.words.append(np.frombuffer(spots, np.uint32))
            self.shas.append(self._digest(spots) if spots else "")

    def _digest(self, spots: array) -> str:
        """The groups as text go into the digest a part at a time: those of a long text are never whole in memory."""
        sha = hashlib.sha256()
        for k in range(0, len(spots), 1 << 14):
            sha.update(((";" if k else "") + ";".join(map(self.groups.__getitem__, spots[k:k + (1 << 14)]))).encode())
        return sha.hexdigest()

    def row(self, name: str, kind: pa.DataType) -> pa.RecordBatch:
        links = [s[4] for s in self.entries]
        times = sum((np.bincount(w, minlength=len(links)) for w in self.words), np.zeros(len(links), np.int64))
        flat, sizes = np.fromiter(chain.from_iterable(links), np.int64), np.array(list(map(len, links)), np.int64)
        pairs, spots = np.unique(flat, return_inverse=True)
        total = np.bincount(spots, np.repeat(times, sizes), len(pairs)).astype(np.int64)
        sums = [np.array([s[k] for s in self.entries], np.int64) for k in range(3)]
        counts = [pa.array([[int(x[w].sum()) for w in self.words]], pa.list_(pa.int64())) for x in sums]
        return pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([self.ids], pa.list_(kind)), *counts, pa.array([self.shas], pa.list_(pa.string())),
             pa.array([_packed(self.words)], pa.binary()), pa.array([_packed([sizes, spots])], pa.binary()),
             pa.array([pairs.tolist()], pa.list_(pa.int64())), pa.array([total.tolist()], pa.list_(pa.int64()))],
            ["chunk", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "words", "links", "pairs", "times"])


def _chunks(docs: DataFrame, spec: str, proto: bytes, chunk_bytes: int) -> DataFrame:
    """One row for each chunk: its documents, and its distinct pairs with how often they are linked."""
    rows = texts(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gc

        gc.disable()  # many small tuples that live on, and no cycles among them
        aligner, number, part = Aligner(spec, proto), 0, TaskContext.get().partitionId()
        chunk = _Chunk(aligner)
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for k in range(0, batch.num_rows, BATCH):
                some = batch.slice(k, BATCH)
                chunk.add(list(zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist())))
                if chunk.bytes > chunk_bytes:
                    yield chunk.row(f"{part}-{number}", id_type)
                    chunk, number = _Chunk(aligner), number + 1
        if chunk.ids:
            yield chunk.row(f"{part}-{number}", id_type)

    return rows.mapInArrow(run, _ROW.format(kind))


def pair_counts(chunks: DataFrame, b_size: int) -> DataFrame:
    """(pair, total, best): links of each id pair in the corpus, and whether no pair of the same B id has more."""
    single = chunks.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("x.pairs", "x.times")
    totals = single.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("total"))
    totals = totals.withColumn("b", F.col("pair") % b_size)
    most = totals.groupBy("b").agg(F.max("total").alias("most"))
    return totals.join(most, "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def read_tokenizers(a: str, b: str) -> tuple[str, bytes]:
    return Path(a).read_text(), Path(b).read_bytes()


def alignment_pairs(docs: DataFrame, a: str, b: str, chunk_bytes: int = CHUNK) -> DataFrame:
    """(a_id, b_id, total, best) of all linked pairs of token ids of the corpus: a translation table of two vocabularies."""
    import sentencepiece

    spec, proto = read_tokenizers(a, b)
    size = sentencepiece.SentencePieceProcessor(model_proto=proto).get_piece_size()
    counted = pair_counts(stage(_chunks(docs, spec, proto, chunk_bytes), "align-chunks"), size)
    return counted.select(F.expr(f"pair div {size}").alias("a_id"), (F.col("pair") % size).alias("b_id"), "total", "best")


def align(docs: DataFrame, a: str, b: str, chunk_bytes: int = CHUNK) -> DataFrame:
    """How the tokens of each document align: numbers of tokens, groups and links, and the digest of the groups.

    A encodes a space and the text, B the text, before which it puts a space itself; strings of special tokens are plain text.
    The byte offsets where tokens of both end cut the tokens into groups, and each is the link of the two tokens that end
    there. ``n_best`` counts the links whose pair of ids has the corpus-wide highest count of its B id (ties included),
    ``count_sum`` adds the counts of all links up.

    Null and empty texts, and texts that the tokens of A or B don't give back, have zeros, the empty digest, and no links.
    Repeated rows each count and each give a row, a null doc_id stays null, other columns are left out, and an empty
    table gives an empty result. Chunks are written to the shared folder: later steps do not tokenise again.
    """
    import sentencepiece

    spec, proto = read_tokenizers(a, b)
    size = sentencepiece.SentencePieceProcessor(model_proto=proto).get_piece_size()
    chunks = stage(_chunks(docs, spec, proto, chunk_bytes), "align-chunks")
    asked = chunks.select("chunk", F.posexplode(F.col("pairs")).alias("place", "pair"))
    answers = asked.join(pair_counts(chunks, size), "pair").select(F.col("chunk").alias("asked_by"), "place", "total", "best")
    kind = chunks.schema["doc_id"].dataType.elementType.simpleString()
    names = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]

    def add_up(rows: pa.Table, counts: pa.Table) -> pa.Table:
        order = np.argsort(counts.column("place").to_numpy())
        total, best = (counts.column(c).to_numpy(zero_copy_only=False)[order].astype(np.int64) for c in ("total", "best"))
        words, (sizes, spots) = (_unpacked(rows.column(c)[0].as_py()) for c in ("words", "links"))
        ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        sums = []
        for values in (best, total):
            run = np.concatenate(([0], np.cumsum(values[spots])))
            by_word = run[ends[1:]] - run[ends[:-1]]
            sums.append([int(by_word[w].sum()) for w in words])
        lists = {c: rows.column(c).combine_chunks().flatten() for c in names}
        return pa.table({**lists, "n_best": pa.array(sums[0], pa.int64()), "count_sum": pa.array(sums[1], pa.int64())})

    found = (chunks.select("chunk", *names, "words", "links").groupBy("chunk").cogroup(answers.groupBy("asked_by"))
             .applyInArrow(add_up, f"doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, "
                                   "n_best long, count_sum long"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum",
                        "groups_sha256")
