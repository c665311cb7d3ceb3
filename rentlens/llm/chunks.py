"""Repeated passages: content-defined chunks by a gear rolling hash, deduplicated by digest."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.llm.common import by_value, stage, texts

by_value(sys.modules[__name__])

WINDOW = 16       #: bytes that the rolling hash sees: it has 16 bits and moves up one bit per byte
REACH = 24        #: a cut has the smallest hash within so many bytes on both sides, so chunks have 49 bytes on average
LEAST = 100       #: bytes of neighbouring repeated chunks that make a repeated passage: more than a common line
SEGMENT = 1 << 22
GEAR = np.random.default_rng(64).integers(0, 1 << 16, 256).astype(np.uint16)


def _rolled(data: np.ndarray) -> np.ndarray:
    """Gear hash at every byte: sum of GEAR[byte k back] << k over the window, in four doublings."""
    h = GEAR[data]
    for width in (1, 2, 4, 8):
        older = np.zeros_like(h)
        older[width:] = h[:-width] << np.uint16(width)
        h = h + older
    return h


def _least_ahead(h: np.ndarray, reach: int) -> np.ndarray:
    """Smallest of the next ``reach`` values after each place."""
    top = np.full(reach + 1, np.iinfo(np.uint16).max, np.uint16)
    m, width = np.concatenate((h[1:], top)), 1
    while width * 2 <= reach:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    rest = reach - width
    return (np.minimum(m[:len(m) - rest], m[rest:]) if rest else m)[:len(h)]


def cuts(data: bytes, reach: int = REACH) -> np.ndarray:
    """Places after which a UTF-8 text is cut: the end of every chunk, the last one the end of the text.

    A byte is a cut if its hash is below all within ``reach`` before it and not above any within ``reach`` behind it, so
    whether it is one depends on the bytes next to it only: an insertion moves the cuts behind it and changes none
    beyond that reach. No cut falls inside a character. Long texts go in overlapping segments, with the same result.
    """
    whole = np.frombuffer(data, np.uint8)
    found, margin = [], WINDOW + reach + 8
    for a in range(0, len(whole), SEGMENT):
        first, last = max(0, a - margin), min(len(whole), a + SEGMENT + margin)
        part = whole[first:last]
        h = _rolled(part)
        inside = np.zeros(len(part), bool)
        inside[:-1] = (part[1:] & 0xC0) == 0x80
        h[inside] = np.iinfo(np.uint16).max
        ahead = _least_ahead(h, reach)
        behind = _least_ahead(h[::-1], reach)[::-1]
        low = np.flatnonzero((h < behind) & (h <= ahead) & ~inside) + first
        found.append(low[(low >= a) & (low < a + SEGMENT)] + 1)
    ends = np.concatenate(found) if found else np.zeros(0, np.int64)
    return ends if not len(whole) or len(ends) and ends[-1] == len(whole) else np.append(ends, len(whole))


def chunk_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, k, at, h1, h2) of every chunk: ``at`` holds the start byte and the length, h1 and h2 a 128-bit digest."""
    def run(batches):
        for b in batches:
            for doc_id, k, text in zip(b.column("doc_id").to_pylist(), b.column("k").to_pylist(), b.column("text")):
                data = text.as_buffer().to_pybytes()
                ends = cuts(data)
                starts = np.concatenate((np.zeros(min(1, len(ends)), np.int64), ends[:-1]))
                digest = xxhash.xxh3_128_digest
                hashes = b"".join([digest(data[i:j]) for i, j in zip(starts.tolist(), ends.tolist())])
                h = np.frombuffer(hashes, "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id] * len(ends), pa.int64()), pa.array(np.full(len(ends), k, np.int64)),
                     pa.array((starts << 32) | (ends - starts)), pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy())],
                    ["doc_id", "k", "at", "h1", "h2"])

    rows = texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("k"),
                              F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, k long, at long, h1 long, h2 long")


def _runs(chunks: list[tuple[int, int]], least: int) -> list[tuple[int, int]]:
    """Runs of neighbouring chunks (start, end), in order, of at least ``least`` bytes."""
    out: list[list[int]] = []
    for start, end in chunks:
        if out and out[-1][1] == start:
            out[-1][1] = end
        else:
            out.append([start, end])
    return [(a, b) for a, b in out if b - a >= least]


def repeats(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """One row for every document with a repeated passage.

    Columns: doc_id, k (digest of the text), n_passages and repeated_bytes (runs of chunks that occur elsewhere too, of
    ``least`` bytes or more), dropped_bytes and dropped (those of them that an earlier document, or an earlier place in
    this one, holds: start:end in bytes, comma-joined), first_ids (the documents that hold them first).

    The first holder of a chunk is its smallest doc_id; it keeps the passage and is listed with nothing dropped. A chunk's
    occurrences are counted before the shuffle and never gathered; the join back to places may be split by Spark where a
    chunk is frequent. Documents without a repeated passage give no row; null and empty texts have no chunks. Rows with
    equal id and text are one document. A null doc_id comes after all others and stays null. An empty table gives none.
    """
    rows = chunk_rows(docs)
    last = F.lit((1 << 63) - 1)
    marked = rows.withColumn("doc", F.coalesce("doc_id", last)).drop("doc_id")
    shared = (marked.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("first"))
              .filter("n > 1").select("h1", "h2", "first"))
    places = marked.join(shared, ["h1", "h2"]).groupBy("doc", "k").agg(
        F.collect_list(F.struct("at", "h1", "h2", "first")).alias("chunks"))

    def run(batches):
        for b in batches:
            out = []
            for doc, k, chunks in zip(*(b.column(c).to_pylist() for c in ("doc", "k", "chunks"))):
                # rows that repeat id and text give each place twice
                found = sorted({(c["at"] >> 32, c["at"] & 0xFFFFFFFF, c["h1"], c["h2"], c["first"]) for c in chunks})
                runs = _runs([(s, s + n) for s, n, *_ in found], least)
                if not runs:
                    continue
                seen, later = set(), []
                for s, n, h1, h2, first in found:
                    if first != doc or (h1, h2) in seen:
                        later.append((s, s + n, first))
                    seen.add((h1, h2))
                drop = _runs([x[:2] for x in later], least)
                # copies only of itself, as a row may be the only one that holds a passage twice
                firsts = sorted({f for s, e, f in later if any(a <= s and e <= z for a, z in drop)})
                out.append((None if doc == (1 << 63) - 1 else doc, k, len(runs), sum(z - a for a, z in runs),
                            sum(z - a for a, z in drop), ",".join(f"{a}:{z}" for a, z in drop), firsts))
            names = ["doc_id", "k", "n_passages", "repeated_bytes", "dropped_bytes", "dropped", "first_ids"]
            kinds = [pa.int64()] * 5 + [pa.string(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names)

    return places.mapInArrow(run, "doc_id long, k long, n_passages long, repeated_bytes long, dropped_bytes long, "
                                  "dropped string, first_ids array<long>")


def drop_repeats(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """The documents with every repeated passage left in its first place only, with all columns; n_chars is made right.

    Null texts stay null, and documents without a repeated passage stay as they are.
    """
    names = docs.columns
    found = stage(repeats(docs, least).filter("dropped_bytes > 0").select("doc_id", "k", "dropped"), "repeats").alias("r")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")).alias("d")
    same = (F.col("d.row.doc_id").eqNullSafe(F.col("r.doc_id"))
            & (F.xxhash64(F.coalesce("d.row.text", F.lit(""))) == F.col("r.k")))
    spans = F.transform(F.split("__dropped", ","), lambda s: F.struct(
        F.split(s, ":")[0].cast("int").alias("start"), F.split(s, ":")[1].cast("int").alias("end")))
    data = F.col("text").cast("binary")
    kept = F.aggregate(spans, F.struct(F.lit(b"").alias("out"), F.lit(0).alias("at")), lambda a, s: F.struct(
        F.concat(a["out"], F.substring(data, a["at"] + 1, s["start"] - a["at"])).alias("out"), s["end"].alias("at")),
        lambda a: F.concat(a["out"], F.substring(data, a["at"] + 1, F.octet_length("text"))))
    out = rows.join(found, same, "left").select("d.row.*", F.col("r.dropped").alias("__dropped"))
    out = out.withColumn("text", F.when(F.col("__dropped").isNull(), F.col("text")).otherwise(kept.cast("string")))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col("__dropped").isNull(), F.col("n_chars")).otherwise(
            F.char_length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*[F.col(f"`{c}`") for c in names])
