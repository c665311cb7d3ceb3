"""SimHash near-duplicates: fingerprints, links by pigeonhole blocks, and their components."""

from __future__ import annotations

import sys
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.llm.common import by_value, hex_of, stage, texts
from rentlens.llm.components import components

by_value(sys.modules[__name__])

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
BITS = 64
#: A block table larger than this is linked through flipped bits, not by pairs. Both ways give every link.
PAIRS_TO = 512


def fingerprint(text: bytes, width: int = 3, seed: int = 42) -> int:
    """SimHash of the word shingles of a UTF-8 text, as a signed 64-bit integer.

    Words are split at ASCII white space after A-Z become lower case; fewer words than ``width`` make one shingle, and
    no word gives 0. Repeated shingles count each time. A bit is 1 if it is set in over half of the shingle hashes.
    """
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        hash_of = xxhash.xxh64_intdigest
        hashes = [hash_of(joined[a:b], seed)
                  for a, b in zip(starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist())]
    half = len(hashes) / 2
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        part = np.array(hashes[k:k + (1 << 16)], dtype=">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(ones > half).view(">i8")[0])


def _keys(doc_id: Column, text: Column) -> list[Column]:
    """128 bits that stand for an id and its text."""
    return [F.xxhash64(doc_id, text).alias("k"), F.xxhash64(text, doc_id).alias("k2")]


def fingerprints(docs: DataFrame, width: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, k, k2, fp) of every document, with two digests of the row; a null text counts as empty."""
    def run(batches):
        for batch in batches:
            prints = [fingerprint(t.as_buffer().to_pybytes(), width, seed) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "k", "k2")),
                                              pa.array(prints, pa.int64())], ["doc_id", "k", "k2", "fp"])

    rows = texts(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return (rows.select("doc_id", *_keys(F.col("doc_id"), F.col("text")), F.col("text").cast("binary").alias("text"))
            .mapInArrow(run, f"doc_id {kind}, k long, k2 long, fp long"))


def block_masks(distance: int = 3, blocks: int = 6) -> list[int]:
    """Bit masks of which at least one is equal in any two fingerprints within ``distance``.

    The 64 bits are cut into ``blocks`` blocks; ``distance`` differing bits leave ``blocks - distance`` of them equal,
    and there is one mask for each choice of that many blocks.
    """
    cuts = [round(k * BITS / blocks) for k in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    masks = [sum(c) for c in combinations(parts, blocks - distance)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _flips(masks: list[int]) -> list[tuple[int, int, int]]:
    """(mask number, bits to flip, how many): up to two of the bits outside each mask."""
    signed = lambda x: x - (1 << BITS) if x >> (BITS - 1) else x
    out = []
    for k, mask in enumerate(masks):
        free = [1 << b for b in range(BITS) if not mask >> b & 1]
        out += [(k, 0, 0)] + [(k, signed(x), 1) for x in free]
        out += [(k, signed(x | y), 2) for x, y in combinations(free, 2)]
    return out


def links(prints: DataFrame, distance: int = 3, blocks: int = 6, pairs_to: int = PAIRS_TO) -> DataFrame:
    """Links (a, b) of distinct fingerprints ``fp`` within ``distance`` bits, enough of them to give every component.

    Fingerprints meet where they agree on all blocks of a mask. A meeting of up to ``pairs_to`` is joined with itself
    and every pair is verified. A larger one is not paired: x and y differ in at most 3 bits if and only if some z is at
    most 1 bit from x and 2 from y, so each member goes to every z within two flips of the free bits, and all
    that meet at a z that has a member within one flip are tied to that member. Each member goes to a fixed number of
    z, and at most as many meet at a z, so the work grows with the members and not with their pairs.
    """
    if distance != 3:
        raise ValueError("the links of crowded blocks are worked out for a distance of 3")
    masks = block_masks(distance, blocks)
    table = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(m)).alias("block"))
                                for k, m in enumerate(masks)]))
    keyed = prints.select("fp", table.alias("t")).select("fp", "t.k", "t.block")
    sizes = keyed.groupBy("k", "block").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    met = stage(keyed.join(sizes, ["k", "block"]), "meetings")
    few = met.filter(F.col("size") <= pairs_to).select("k", "block", "fp")
    pairs = (few.withColumnRenamed("fp", "a").join(few.withColumnRenamed("fp", "b"), ["k", "block"])
             .filter((F.col("a") > F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance))
             .select("a", "b"))
    crowd = met.filter(F.col("size") > pairs_to)
    if crowd.isEmpty():
        return pairs.distinct()
    flips = prints.sparkSession.createDataFrame(_flips(masks), "k int, flip long, n int")  # a fixed table
    at = (crowd.join(flips, "k").select("k", F.col("fp").bitwiseXOR(F.col("flip")).alias("z"), "fp", "n")
          .groupBy("k", "z").agg(F.min(F.when(F.col("n") < 2, F.col("fp"))).alias("hub"),
                                 F.collect_list("fp").alias("near")))
    stars = (at.filter("hub is not null").select(F.explode("near").alias("x"), "hub").filter("x != hub")
             .select(F.greatest("x", "hub").alias("a"), F.least("x", "hub").alias("b")))
    return pairs.union(stars).distinct()


def _members(docs: DataFrame, distance: int, width: int, seed: int, pairs_to: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, k, k2, fp) of every document, and (fp, component_id) of every fingerprint."""
    prints = stage(fingerprints(docs, width, seed), "fingerprints")
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    tied = stage(components(links(nodes.select("fp"), distance, pairs_to=pairs_to)), "components")
    ends = (nodes.join(tied.withColumnRenamed("node", "fp"), "fp", "left")
            .withColumn("component", F.coalesce("component", "fp")))
    ids = ends.groupBy("component").agg(F.min("first").alias("component_id"))
    return prints, stage(ends.join(ids, "component").select("fp", "component", "component_id"), "ends")


def near_duplicates(docs: DataFrame, distance: int = 3, width: int = 3, seed: int = 42,
                    pairs_to: int = PAIRS_TO) -> DataFrame:
    """doc_id, fingerprint and component_id of every document.

    Equal fingerprints are one node, so copies are never paired; components are built on distinct fingerprints and
    joined back. ``component_id`` is the smallest doc_id that can be reached by links of at most ``distance`` bits.
    Null and empty texts share fingerprint zero and are linked like any other. Repeated rows each give a row. A null
    doc_id keeps its row and is a component_id only where no other id is. An empty table gives an empty result.
    """
    prints, ends = _members(docs, distance, width, seed, pairs_to)
    return prints.join(ends, "fp").select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, distance: int = 3, width: int = 3, seed: int = 42,
               pairs_to: int = PAIRS_TO) -> DataFrame:
    """One document of each component of near-duplicates, with all its columns: the one with the smallest id.

    Of rows that repeat that id the one with the smaller digest stays; a null id stays only where no other is.
    """
    prints, ends = _members(docs, distance, width, seed, pairs_to)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k", "k2")).alias("best")
    # first within a fingerprint, so that the copies of a group are few when they meet
    of_print = prints.groupBy("fp").agg(best).join(ends, "fp").select("component", "best.*")
    first = stage(of_print.groupBy("component").agg(best).select("best.k", "best.k2"), "kept")
    rows = docs.select(*_keys(F.col("doc_id"), F.coalesce("text", F.lit(""))),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return (rows.join(first, ["k", "k2"], "left_semi").groupBy("k", "k2").agg(F.first("row").alias("row"))
            .select("row.*"))
