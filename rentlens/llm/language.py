"""Language identification by interpolated Kneser-Ney character models.

Every n-gram of the learning documents is counted, by Spark; discounts, continuation counts and the interpolated
probabilities are joins and aggregates over the table of n-grams. A language's model is a sorted array of n-gram hashes
for each order, with the logarithms of probability and back-off weight beside it. A text belongs to the language that
codes it with the least entropy per character; texts that the language codes much worse than its own are rejected.

The model's size is known before it is sent to the tasks. Where it is more than ``PART_BYTES`` it is sent in parts, by
the two characters before the one that is predicted: all n-grams that one place of a text may ask for lie in one part, so
the sums over the parts are the same as those of the whole model.
"""

from __future__ import annotations

import math
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.llm.common import by_value, stage, texts

by_value(sys.modules[__name__])

ORDER = 5  #: characters of the longest n-gram
PIECE = 1 << 20  #: characters that are looked at in one go
PART_BYTES = 96 << 20  #: the most a task gets of the model at a time
ENTRY = 16  #: bytes of an n-gram in the arrays
REJECT = 0.001  #: share of the documents of its own languages that the rejection gives up
UNKNOWN = "und"
MIX = np.uint64(0x9E3779B97F4A7C15)  # fixed value: odd multiplier of the hash
SHARP = [(b, g) for g in (0.0, 0.5, 1.0) for b in (0.05, 0.1, 0.2, 0.5, 1.0, 2.0, 4.0, 8.0, 16.0, 32.0)]


@lru_cache(maxsize=1)
def letter_table() -> tuple[bytes, bytes]:
    """Bits for all code points: is it a letter, and is it a letter or a mark (which belongs to the letter before)."""
    kinds = [unicodedata.category(chr(c))[0] for c in range(sys.maxunicode + 1)]
    return tuple(np.packbits([k in group for k in kinds]).tobytes() for group in ("L", "LM"))


class Reader:
    """Texts as runs of lower-case letters, with one space between, before and after them."""

    def __init__(self, table: tuple[bytes, bytes]):
        self.letter, self.inside = (np.unpackbits(np.frombuffer(t, np.uint8)).astype(bool) for t in table)

    def places(self, text: str) -> tuple[np.ndarray, int]:
        """Code points after ``ORDER`` - 1 spaces, and how many letters there are; nothing but the spaces without one."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        letters = int(self.letter[points].sum())
        if not letters:
            return np.zeros(0, np.uint32), 0
        inside = np.concatenate(([False], self.inside[points], [False]))
        points = np.where(inside, np.concatenate(([32], points, [32])), 32)
        keep = inside.copy()
        keep[1:] |= inside[:-1]  # a space is kept after a letter
        return np.concatenate((np.full(ORDER - 1, 32), points[keep])).astype(np.uint32), letters


def _at(points: np.ndarray, last: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` code points that end at each of the places ``last``."""
    h = points[last - size + 1].astype(np.uint64) + np.uint64(1)
    for k in range(size - 2, -1, -1):
        h = h * MIX + points[last - k] + np.uint64(1)
    h ^= h >> np.uint64(29)
    return h * MIX


def _pieces(rows: Iterable[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(code points, row of each) of rows one after the other, about ``PIECE`` characters at a time. A longer row comes
    in parts that share ``ORDER`` - 1 characters, so that each of its n-grams is seen once."""
    held, numbers, size = [], [], 0
    for row, points in enumerate(rows):
        for start in range(0, max(len(points) - ORDER + 1, 0), PIECE):
            part = points[start:start + PIECE + ORDER - 1]
            held.append(part)
            numbers.append(np.full(len(part), row))
            size += len(part)
            if size >= PIECE:  # two parts of a row are never in one piece
                yield np.concatenate(held), np.concatenate(numbers)
                held, numbers, size = [], [], 0
    if held:
        yield np.concatenate(held), np.concatenate(numbers)


def _distinct(points: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(last place of the first of each distinct n-gram, which of them each place holds, row of each place)."""
    inner = rows[ORDER - 1:] == rows[:len(rows) - ORDER + 1]
    last = np.flatnonzero(inner) + ORDER - 1
    _, first, which = np.unique(_at(points, last, ORDER), return_index=True, return_inverse=True)
    return last[first], which, rows[last]


def count_grams(docs: DataFrame, lang_col: str = "lang") -> DataFrame:
    """(lang, gram, n): how often each string of ``ORDER`` characters occurs in each language, over all documents."""
    table = letter_table()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(table)
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for lang in sorted(set(langs)):
                chosen = (reader.places(t.as_py())[0] for t, x in zip(batch.column("text"), langs) if x == lang)
                for points, rows in _pieces(chosen):
                    last, which, _ = _distinct(points, rows)
                    grams = np.stack([points[last - k] for k in range(ORDER - 1, -1, -1)], axis=1)
                    strings = np.ascontiguousarray(grams.astype("<u4")).view(f"<U{ORDER}").ravel().tolist()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(strings), pa.string()), pa.array(strings, pa.string()),
                         pa.array(np.bincount(which), pa.int64())], ["lang", "gram", "n"])

    rows = docs.select(F.col(lang_col).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return (rows.filter("lang is not null").mapInArrow(run, "lang string, gram string, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(lang, size, gram, logp, back) for the n-grams of all orders: interpolated probabilities and back-off weights.

    The longest n-grams go by their counts, shorter ones by the number of characters seen before them. Each order has an
    absolute discount per language, n1/(n1 + 2 n2), from its numbers of n-grams seen once and twice; what it takes off is
    given to the order below, and the lowest one shares it evenly among all characters seen and one that was not.
    ``back`` is the logarithm of the share given on by the n-gram as a context, null where it is none; ``logp`` is null for
    what is only a context.
    """
    none = F.lit(None).cast("double").alias("back")
    levels = {ORDER: stage(counts, "grams")}
    for k in range(ORDER - 1, 0, -1):
        shorter = levels[k + 1].select("lang", F.expr(f"substring(gram, 2, {k})").alias("gram"))
        levels[k] = stage(shorter.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("n")), "grams")
    letters = levels[1].groupBy("lang").agg(F.count(F.lit(1)).alias("letters"))
    even = letters.select("lang", F.lit("").alias("tail"), (1 / (F.col("letters") + 1)).alias("p"))
    lower, out = stage(even, "probabilities"), []
    for k in range(1, ORDER + 1):
        level = levels[k].withColumns({"context": F.expr(f"substring(gram, 1, {k - 1})"),
                                       "tail": F.expr(f"substring(gram, 2, {k - 1})")})
        contexts = level.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        contexts = stage(contexts.join(_discounts(levels[k]), "lang")
                         .withColumn("given", F.col("d") * F.col("kinds") / F.col("total")), "contexts")
        p = (F.col("n") - F.col("d")) / F.col("total") + F.col("given") * F.col("p")
        if k == 1:  # a character that was never seen, in no known context
            out.append(contexts.join(lower, "lang").select("lang", F.lit(0).alias("size"), F.lit("").alias("gram"),
                                                           F.log2(F.col("given") * F.col("p")).alias("logp"), none))
        else:
            backs = contexts.select("lang", F.col("context").alias("gram"), F.log2("given").alias("back"))
            # what stands before a text's first letters is a context, but no n-gram that was ever predicted
            out[-1] = out[-1].drop("back", "size").join(backs, ["lang", "gram"], "full").withColumn("size", F.lit(k - 1))
        here = stage(level.join(contexts, ["lang", "context"]).join(lower, ["lang", "tail"])
                     .select("lang", "gram", p.alias("p")), "probabilities")
        lower = here.withColumnRenamed("gram", "tail")
        out.append(here.select("lang", F.lit(k).alias("size"), "gram", F.log2("p").alias("logp"), none))
    return reduce(DataFrame.unionByName, out)


def _discounts(level: DataFrame) -> DataFrame:
    """(lang, d): the absolute discount of one order, within bounds that leave mass on both sides."""
    seen = level.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2"))
    d = F.coalesce(F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2")), F.lit(0.5))
    return seen.select("lang", F.least(F.greatest(d, F.lit(0.1)), F.lit(0.9)).alias("d"))


@dataclass(frozen=True)
class Arrays:
    """One language's part of a model: for each order from 1 on, sorted hashes, and logp and back beside them."""

    floor: float
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    def look_up(self, size: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(known, logp, back) of hashes among the n-grams of ``size`` characters; logp is nan for what is only a context."""
        hashed, logp, back = self.levels[size - 1]
        if not len(hashed):
            return np.zeros(len(keys), bool), np.zeros(len(keys)), np.zeros(len(keys))
        at = np.minimum(np.searchsorted(hashed, keys), len(hashed) - 1)
        known = hashed[at] == keys
        return known, logp[at], back[at]

    def bits(self, keys: list[np.ndarray], contexts: list[np.ndarray]) -> np.ndarray:
        """Minus log2 of the probability of each n-gram's last character, from its hashes at all orders."""
        out, left = np.zeros(len(keys[0])), np.arange(len(keys[0]))
        for size in range(ORDER, 0, -1):
            found, logp, _ = self.look_up(size, keys[size - 1][left])
            found = found & ~np.isnan(logp)
            out[left[found]] += logp[found]
            left = left[~found]
            if not len(left):
                return -out
            if size > 1:  # the context gives its share to the shorter n-gram; one never seen gives all
                known, _, back = self.look_up(size - 1, contexts[size - 2][left])
                out[left] += np.where(known, back, 0.0)
        out[left] += self.floor
        return -out


#: number of the part, how many there are, and floor and levels of each language: plain values, as workers unpickle them
Part = tuple[int, int, dict[str, tuple[float, list]]]


def _parts_of(points: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Where n-grams belong that are asked for after the two characters that end at ``last``; not negative."""
    return (_at(points, last, 2) >> np.uint64(1)).view(np.int64)


def _hashed(table: DataFrame) -> DataFrame:
    """(lang, size, hash, own, next, logp, back): own and next tell the part of an n-gram and that of it as a context."""
    def run(batches):
        for batch in batches:
            grams = batch.column("gram").to_pylist()
            size = batch.column("size").to_numpy()
            key, own, following = (np.zeros(len(grams), np.int64) for _ in range(3))
            for k in range(1, ORDER + 1):
                at = np.flatnonzero(size == k)
                points = np.array([ord(c) for i in at for c in grams[i]], np.uint32)
                last = np.arange(1, len(at) + 1) * k - 1
                if len(at):
                    key[at] = _at(points, last, k).view(np.int64)
                    if k > 1:
                        following[at] = _parts_of(points, last)
                    if k > 2:
                        own[at] = _parts_of(points, last - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("size"), pa.array(key), pa.array(own), pa.array(following),
                 batch.column("logp"), batch.column("back")], ["lang", "size", "hash", "own", "next", "logp", "back"])

    return table.select("lang", "size", "gram", "logp", "back").mapInArrow(
        run, "lang string, size int, hash long, own long, next long, logp double, back double")


class Model:
    """A Kneser-Ney model as a table in the shared folder, read part by part into sorted arrays."""

    def __init__(self, table: DataFrame, part_bytes: int = PART_BYTES):
        self.spark, self.table = table.sparkSession, stage(_hashed(table), "language-model")
        self._divide(part_bytes)

    def _divide(self, part_bytes: int) -> None:
        sizes = self.table.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per language
        self.langs = sorted(r["lang"] for r in sizes)
        total = sum(r["n"] for r in sizes) * ENTRY
        # an n-gram of a model in parts is in two of them: as itself and as a context
        self.parts = 1 if total <= part_bytes else math.ceil(2 * total / part_bytes)

    def part(self, number: int) -> Part:
        """The arrays of one part; n-grams of one or two characters are in all parts."""
        rows = self.table
        if self.parts > 1:
            rows = rows.filter((F.col("own") % self.parts == number) | (F.col("next") % self.parts == number)
                               | (F.col("size") <= 2))
        found = rows.select("lang", "size", "hash", "logp", "back").toArrow()
        size, key = (found.column(c).to_numpy() for c in ("size", "hash"))
        key, logp = key.view(np.uint64), found.column("logp").to_numpy().astype(np.float32)  # nan where null
        back = found.column("back").to_numpy().astype(np.float32)
        out = {}
        for lang in self.langs:
            mine = pc.equal(found.column("lang"), lang).to_numpy()
            levels = []
            for k in range(1, ORDER + 1):
                at = np.flatnonzero(mine & (size == k))
                at = at[np.argsort(key[at])]
                levels.append((key[at], logp[at], np.nan_to_num(back[at])))
            out[lang] = float(logp[mine & (size == 0)][0]), levels
        return number, self.parts, out


def _sums(rows: DataFrame, model: Model, number: int) -> DataFrame:
    """Every column of ``rows`` but the text, with n_letters, n_places and the bits of each language in one part."""
    table, shared = letter_table(), model.spark.sparkContext.broadcast(model.part(number))
    langs, others = model.langs, [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, (part, parts, values) = Reader(table), shared.value
        arrays = {lang: Arrays(*x) for lang, x in values.items()}
        for whole in batches:
            for k in range(0, whole.num_rows, 2048):
                batch = whole.slice(k, 2048)
                n = batch.num_rows
                bits, places, letters = np.zeros((len(langs), n)), np.zeros(n, np.int64), np.zeros(n, np.int64)

                def noted() -> Iterator[np.ndarray]:
                    for row, text in enumerate(batch.column("text")):
                        points, letters[row] = reader.places(text.as_py())
                        yield points

                for points, numbers in _pieces(noted()):
                    last, which, row = _distinct(points, numbers)
                    places += np.bincount(row, minlength=n)
                    mine = np.arange(len(last))
                    if parts > 1:
                        mine = np.flatnonzero(_parts_of(points, last - 1) % parts == part)
                    keys = [_at(points, last[mine], k) for k in range(1, ORDER + 1)]
                    contexts = [_at(points, last[mine] - 1, k) for k in range(1, ORDER)]
                    for i, lang in enumerate(langs):
                        value = np.zeros(len(last))
                        value[mine] = arrays[lang].bits(keys, contexts)
                        bits[i] += np.bincount(row, value[which], n)
                ends = pa.array(np.arange(n + 1) * len(langs), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in others], pa.array(letters), pa.array(places),
                     pa.ListArray.from_arrays(ends, pa.array(bits.T.ravel()))], [*others, "n_letters", "n_places", "bits"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")
    return rows.mapInArrow(run, f"{schema}, n_letters long, n_places long, bits array<double>")


def entropies(rows: DataFrame, model: Model) -> DataFrame:
    """Every column of ``rows`` (doc_id, text and others) but the text, with n_letters and ``entropy``: bits per character
    of the text in each language, in the order of ``model.langs``; null without a letter."""
    if model.parts == 1:
        sums = _sums(rows, model, 0)
    else:
        # equal rows have equal sums: they are added up once, and each row takes them from there
        keyed = rows.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
        single = stage(keyed.select("digest", "text").groupBy("digest").agg(F.first("text").alias("text")), "distinct-texts")
        parts = reduce(DataFrame.union, [_sums(single, model, k).withColumn("part", F.lit(k)) for k in range(model.parts)])
        total = F.array(*[F.sum(F.col("bits")[i]) for i in range(len(model.langs))])
        added = parts.groupBy("digest").agg(F.max("n_letters").alias("n_letters"), F.max("n_places").alias("n_places"),
                                            total.alias("bits"))
        sums = keyed.drop("text").join(added, "digest").drop("digest")
    per = F.when(F.col("n_letters") > 0, F.transform("bits", lambda b: b / F.col("n_places")))
    return sums.withColumn("entropy", per).drop("bits")


@dataclass(frozen=True)
class Calibration:
    """How sure a margin is, and how far above its own texts a language may code a text."""

    sharpness: tuple[float, float]
    mean: dict[str, float]
    spread: dict[str, tuple[float, float]]
    limit: float


def _best(langs: list[str]) -> Column:
    """(entropy, language) of the least entropy; ties go to the first name."""
    return F.array_min(F.transform("entropy", lambda e, i: F.struct(e.alias("entropy"), i.alias("at"))))


def _weights(n: Column, sharpness: tuple[float, float]) -> Column:
    b, g = sharpness
    return F.lit(b) * F.pow(n.cast("double"), F.lit(g))


def calibrate(scored: DataFrame, langs: list[str], reject: float = REJECT) -> Calibration:
    """From documents of known language that the counts have not seen (columns lang, n_places, entropy).

    The confidence is a softmax of the entropies, sharpened by a power of the length; its two parameters are those
    of ``SHARP`` with the least log loss. For the rejection, the entropy of a language's own texts has a mean and a
    variance a + b/length; the limit of the standardised entropy is exceeded by a share of ``reject``.
    """
    if not langs:
        return Calibration((1.0, 0.5), {}, {}, math.inf)
    names = F.array(*[F.lit(x) for x in langs])
    rows = stage(scored.filter("n_letters > 0").withColumn("at", F.array_position(names, F.col("lang")).cast("int") - 1)
                 .filter("at >= 0").withColumn("best", _best(langs)).drop("doc_id"), "calibration")
    own = F.get("entropy", F.col("at"))

    def loss(sharpness: tuple[float, float]) -> Column:
        w = _weights(F.col("n_places"), sharpness)
        total = F.aggregate("entropy", F.lit(0.0), lambda s, e: s + F.exp(-w * (e - F.col("best.entropy"))))
        return F.least(w * (own - F.col("best.entropy")) + F.log(total), F.lit(50.0))

    losses = rows.agg(*[F.avg(loss(s)) for s in SHARP]).first()
    known = [(x, s) for x, s in zip(losses, SHARP) if x is not None]
    sharpness = min(known)[1] if known else (1.0, 0.5)
    right = rows.filter("best.at = at").select("lang", (1 / F.col("n_places")).alias("v"), own.alias("e"))
    means = {r["lang"]: r["m"] for r in right.groupBy("lang").agg(F.avg("e").alias("m")).collect()}
    if not means:
        return Calibration(sharpness, {}, {}, math.inf)
    gap = F.col("e") - _by_lang(means)
    fits = right.withColumn("r", gap * gap).groupBy("lang").agg(
        F.avg("r").alias("r"), F.avg("v").alias("v"), F.covar_pop("r", "v").alias("c"), F.var_pop("v").alias("s")).collect()
    spread = {}
    for f in fits:
        slope = max(0.0, f["c"] / f["s"]) if f["s"] else 0.0
        base = f["r"] - slope * f["v"]
        if base <= 0:
            slope, base = (f["r"] / f["v"] if f["v"] else 0.0), 0.0
        spread[f["lang"]] = (max(base, 1e-6), slope)
    z = gap / F.sqrt(_by_lang({k: a for k, (a, _) in spread.items()}) + F.col("v") * _by_lang({k: b for k, (_, b) in spread.items()}))
    limit = right.agg(F.percentile_approx(z, 1.0 - reject, 10000)).first()[0]
    return Calibration(sharpness, means, spread, float(limit))


def _by_lang(values: dict[str, float], name: Column | None = None) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col("lang") if name is None else name]


def _fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def classify(docs: DataFrame, model: Model, calibration: Calibration) -> DataFrame:
    """Every column of ``docs`` but the text, with n_letters, lang (null where there is no letter or no model), entropy, score
    and rejected."""
    rows = entropies(docs, model).withColumn("best", _best(model.langs))
    names = F.array(*[F.lit(x) for x in model.langs]) if model.langs else F.array().cast("array<string>")
    rows = rows.withColumn("lang_best", F.get(names, F.col("best.at")))
    w = _weights(F.col("n_places"), calibration.sharpness)
    total = F.aggregate("entropy", F.lit(0.0), lambda s, e: s + F.exp(-w * (e - F.col("best.entropy"))))
    rejected = F.lit(False)
    if calibration.mean:
        mean, a, b = (_by_lang(v, F.col("lang_best")) for v in (
            calibration.mean, {k: x for k, (x, _) in calibration.spread.items()}, {k: x for k, (_, x) in calibration.spread.items()}))
        z = (F.col("best.entropy") - mean) / F.sqrt(a + b / F.col("n_places"))
        rejected = F.coalesce(z > calibration.limit, F.lit(False))
    return rows.select(*[c for c in rows.columns if c not in ("entropy", "best", "n_places", "lang_best")],
                       F.col("lang_best").alias("lang"), F.col("best.entropy").alias("entropy"),
                       F.coalesce(F.try_divide(F.lit(1.0), total), F.lit(0.0)).alias("score"),
                       (F.col("lang_best").isNull() | rejected).alias("rejected"))


def train(docs: DataFrame, lang_col: str = "lang", part_bytes: int = PART_BYTES) -> tuple[Model, Calibration]:
    """Model and calibration of labelled documents (doc_id, text and the language).

    One document in eight, by the CRC-32 of its id, calibrates; all others are counted. Documents without a language
    or an id take no part.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.filter("lang is not null and doc_id is not null")
    aside = F.floor(F.crc32(F.col("doc_id").cast("string").cast("binary")) / 4) % 8 == 0
    model = Model(kneser_ney(count_grams(rows.filter(~aside))), part_bytes)
    return model, calibrate(entropies(rows.filter(aside), model), model.langs)


def languages(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected, entropy and n_letters of every document.

    The model is learned from documents that have a language and whose id's CRC-32 leaves another remainder than 2 modulo 4;
    the others are ``held_out``. A text without a letter, a null or empty one among them, is ``und`` with score 0; so is
    every text where nothing could be learned. ``rejected`` says that the text is not like its language's own, as far as
    calibration can tell; ``lang_pred`` still names the closest. Repeated rows each give a row. A null doc_id stays null, is
    not held out and not learned from. Other columns are left out, and an empty table gives an empty result.
    """
    held = F.coalesce(_fold(F.col("doc_id"), 4) == 2, F.lit(False))
    model, calibration = train(docs.filter(~held), part_bytes=part_bytes)
    found = classify(texts(docs), model, calibration)
    return found.select("doc_id", held.alias("held_out"), F.coalesce("lang", F.lit(UNKNOWN)).alias("lang_pred"), "score",
                        "rejected", "entropy", "n_letters")
