"""Document fingerprints: invertible Bloom lookup tables of paragraph digests. DataFrame functions only.

A table has three parts of equal size; a digest has one cell in each. A cell holds the number of digests, their exclusive
or and that of their check values. The cells of one version are taken from those of another, digests in both cancel, and
peeling recovers the rest: a cell that holds one digest gives it away, it is taken out of its other cells, and so on.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentlens.llm.common import stage, texts
from rentlens.operators.control import numbered

#: A paragraph is a line, cut after every eighth word. Possessive, so that no text makes it go back.
PARAGRAPH = r"(?:[^\s]++[^\S\n]*+){1,8}+"
CHECK = 77        #: seed of the check value
CELLS = 4         #: cells of each part of a fingerprint, whose size is fixed
LEAST = 32        #: cells of each part of a table to be peeled, at least
ROUNDS = 4        #: passes over the three parts in an attempt
GROWTH = 4        #: an attempt that leaves cells is made anew with a table so much larger
BLOCK = 64        #: documents of neighbouring ids that are put in order together
BORDERS = 1 << 14  #: blocks at most, as the driver holds their borders; beyond, blocks take more documents
TASK = 8 << 20    #: bytes of text in a task; their cells take about twenty times as much

EDITED, NEXT, PRINT, EDITED_PRINT, COUNTS = range(5)  # tables of a document


def paragraphs(text: Column) -> Column:
    """Distinct digests of a text's paragraphs; white space at their ends does not count."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)),
                                        lambda p: F.xxhash64(F.rtrim(p))))


def _cell(digest: Column, part: Column, size: Column, attempt: int) -> Column:
    """Cell of a digest in a part of a table; another attempt spreads the digests anew."""
    return part * size + F.pmod(F.xxhash64(digest, part, F.lit(attempt)), size).cast("int")


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(CHECK))


def _size(many: Column, attempt: int) -> Column:
    """Cells of each part for so many digests: the next power of two."""
    power = F.ceil(F.log2(F.greatest(many, F.lit(1)).cast("double")))
    return F.greatest(F.lit(LEAST), F.pow(F.lit(2.0), power).cast("int")) * GROWTH ** attempt


def _summed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Cells with equal keys put together, without those in which everything cancels."""
    cells = rows.groupBy(*keys, "cell").agg(F.sum("n").alias("n"), F.bit_xor("digest").alias("digest"),
                                            F.bit_xor("check").alias("check"))
    return cells.filter("n != 0 or digest != 0 or check != 0")


def peel(cells: DataFrame, keys: list[str], attempt: int) -> DataFrame:
    """Peel all tables at once. ``cells`` has ``keys``, ``task``, ``size`` and cells of EDITED and NEXT tables; others pass.

    A pass takes one part after the other, in which a digest lies in one cell only, so none is taken out twice. What is
    recovered is counted in cell -1.
    """
    keys = [*keys, "task", "size"]
    for part in [0, 1, 2] * ROUNDS:
        alone = ((F.abs("n") == 1) & (F.col("check") == _check(F.col("digest"))) & (F.col("task") <= NEXT)
                 & (F.col("cell") >= 0) & (F.expr("cell div size") == part))
        others = [F.struct(_cell(F.col("digest"), F.lit(p), F.col("size"), attempt).alias("cell"), (-F.col("n")).alias("n"),
                           "digest", "check") for p in range(3) if p != part]
        zero = F.lit(0).cast("long")
        done = F.struct(F.lit(-1).alias("cell"), F.lit(1).cast("long").alias("n"), zero.alias("digest"), zero.alias("check"))
        same = F.struct("cell", "n", "digest", "check")
        cells = _summed(cells.select(*keys, F.explode(F.when(alone, F.array(*others, done)).otherwise(F.array(same)))
                                     .alias("c")).select(*keys, "c.*"), keys)
    return cells


def _spread(rows: DataFrame, keys: list[str], attempt: int, tables: dict[str, list[int]]) -> DataFrame:
    """Every digest once for each part of each of its tables, as a cell that holds one digest.

    ``rows`` has columns a, e and b of digests; ``tables`` says which tables a column's digests go to. Digests of e and b
    are taken from those of a. The numbers of digests go along, plus one so that every row has cells, as cells 0, 1
    and 2 of the table COUNTS.
    """
    rows = rows.withColumns({f"n_{c}": F.size(c) for c in "aeb"})
    rows = rows.withColumns({"size0": _size(F.col("n_a") + F.col("n_e"), attempt),
                             "size1": _size(F.col("n_a") + F.col("n_b"), attempt)})

    def of(column: str) -> Column:
        # a slot is table * 4 + part, and its sign that of the digest
        slots = [t * 4 + p for t in tables[column] for p in range(3)]
        return F.transform(column, lambda d: F.struct(d.alias("digest"), F.lit(-1 if column in "eb" else 1).alias("sign"),
                                                      F.array(*map(F.lit, slots)).alias("slots")))

    counts = F.array(*[F.struct((F.col(f"n_{c}") + 1).cast("long").alias("digest"), F.lit(0).alias("sign"),
                                F.array(F.lit(COUNTS * 4 + k)).alias("slots")) for k, c in enumerate("aeb")])
    carried = [*keys, "size0", "size1"]
    digests = rows.select(*carried, F.explode(F.concat(counts, *map(of, tables))).alias("d"))
    placed = digests.select(*carried, "d.digest", "d.sign", F.explode("d.slots").alias("slot"))
    placed = placed.withColumns({"task": F.shiftright("slot", 2), "part": F.col("slot").bitwiseAND(F.lit(3))})
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    is_count, is_print = F.col("task") == COUNTS, F.col("task").isin(PRINT, EDITED_PRINT)
    size = F.when(F.col("task") == EDITED, F.col("size0")).when(F.col("task") == NEXT, F.col("size1")).otherwise(CELLS)
    placed = placed.withColumn("size", size)
    # a text's print does not depend on the attempt, nor on what it is held against
    cell = F.when(is_print, _cell(F.col("digest"), F.col("part"), F.col("size"), 0)).otherwise(
        _cell(F.col("digest"), F.col("part"), F.col("size"), attempt))
    return placed.select(
        *keys, "task", "size", F.when(is_count, F.col("part")).otherwise(cell).alias("cell"),
        F.when(is_count, F.col("digest")).when(is_print, one).otherwise(F.col("sign").cast("long")).alias("n"),
        F.when(is_count, zero).otherwise(F.col("digest")).alias("digest"),
        F.when(is_count, zero).otherwise(_check(F.col("digest"))).alias("check"))


def _hex(value: Column, width: int) -> Column:
    return F.lower(F.lpad(F.hex(value), width, "0"))


def likeness(of: Column, other: Column, apart: Column) -> Column:
    """Shared paragraphs as a part of all, from the numbers of both and of those that only one has; 1 if both have none."""
    together = of + other
    return F.when(together == 0, F.lit(1.0)).otherwise((together - apart) / (together + apart))


def _compared(rows: DataFrame, keys: list[str], attempt: int, prints: bool) -> DataFrame:
    """Per row of digests: near_edited and near_next, null where peeling left cells, and with ``prints`` the fingerprints."""
    tables = {"a": [EDITED, NEXT], "e": [EDITED], "b": [NEXT]}
    if prints:
        tables = {"a": [EDITED, NEXT, PRINT], "e": [EDITED, EDITED_PRINT], "b": [NEXT]}
    cells = peel(_summed(_spread(rows, keys, attempt, tables), [*keys, "task", "size"]), keys, attempt)
    task, cell, n = F.col("task"), F.col("cell"), F.col("n")

    def total(when: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, n)), F.lit(0))

    text = F.concat(_hex(cell, 1), _hex(n, 8), _hex(F.col("digest"), 16), F.substring(_hex(F.col("check"), 16), 1, 8))
    of = {"print": PRINT, "edited_print": EDITED_PRINT} if prints else {}
    out = cells.groupBy(*keys).agg(
        *[total((task == t) & (cell == -1)).alias(f"apart{t}") for t in (EDITED, NEXT)],
        *[F.count(F.when((task == t) & (cell >= 0), 1)).alias(f"left{t}") for t in (EDITED, NEXT)],
        *[(total((task == COUNTS) & (cell == k)) - 1).alias(f"n_{c}") for k, c in enumerate("aeb")],
        *[F.array_join(F.array_sort(F.collect_list(F.when(task == t, text))), "").alias(c) for c, t in of.items()])
    near = [F.when(F.col(f"left{t}") == 0, likeness(F.col("n_a"), F.col(f"n_{c}"), F.col(f"apart{t}"))).alias(name)
            for t, c, name in ((EDITED, "e", "near_edited"), (NEXT, "b", "near_next"))]
    shown = [F.concat(_hex(F.col(f"n_{c}"), 8), F.lit(":"), F.col(p)).alias(p)
             for p, c in (("print", "a"), ("edited_print", "e")) if prints]
    return out.select(*keys, *near, *shown)


def edited(text: Column, following: Column) -> Column:
    """The text with its last floor(n / 2) code points replaced by the first as many (or all) of the following one."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(following, F.lit(1), half))


def _borders(rows: DataFrame, blocks: int) -> list[tuple[Decimal, int, float]]:
    """(key, k, salt) of the first row of each block but the first, where blocks take equal parts of the rows in order.

    Ids and hashes are sorted over all partitions and only the borders, at most ``BORDERS``, reach the driver.
    """
    n = rows.count()
    ids = rows.select((-F.col("key")).alias("down"), "k", "salt", F.lit(1).alias("one"))
    ranked = numbered(ids, ["one"], ["down", "k", "salt"], "rank")
    step = -(-n // blocks)
    found = ranked.filter((F.col("rank") - 1) % step == 0).orderBy("rank").select("down", "k", "salt").collect()
    return [(-r["down"], r["k"], r["salt"]) for r in found[1:]]


def _block(borders: list[tuple[Decimal, int, float]]) -> Column:
    """The number of borders that a row has reached, by bisection."""
    if not borders:
        return F.lit(0)
    keys, ks, salts = (F.split(F.lit(",".join(str(x[i]) for x in borders)), ",").cast(f"array<{kind}>")
                       for i, kind in enumerate(("decimal(20,0)", "long", "double")))
    steps = [1 << i for i in reversed(range(len(borders).bit_length()))]

    def reached(at: Column) -> Column:
        key, k, salt = (F.get(x, at - 1) for x in (keys, ks, salts))
        same = (key == F.col("key")) & ((k < F.col("k")) | ((k == F.col("k")) & (salt <= F.col("salt"))))
        return (at <= len(borders)) & ((key > F.col("key")) | same)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: at + F.when(
        reached(at + step), step).otherwise(F.lit(0)))


def _in_order(docs: DataFrame) -> DataFrame:
    """(block, place, doc_id, k, text, next_id, next_k, following): every document and the one before it by doc_id.

    Documents go to blocks of neighbouring ids, with equal numbers of rows whatever the ids are: rows of one id are
    divided by their text's hash, and equal rows by a random number, as their order does not matter. A block also gets
    the first row of the block that follows it, which comes from a table of one row per block, so the texts are shuffled
    once. The smallest id is followed by the largest. Beyond ``BORDERS`` blocks grow with the table.
    """
    # rows without an id come last, below all longs
    key = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit(Decimal(-10 ** 19)).cast("decimal(20,0)"))
    rows = texts(docs).withColumn("k", F.xxhash64("text")).withColumns({"key": key, "salt": F.rand(19)})
    span = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text").cast("long")).alias("bytes")).first()
    blocks = min(BORDERS, max(1, span["n"] // BLOCK))
    block = _block(_borders(rows, blocks)) if blocks > 1 else F.lit(0)
    rows = rows.select(block.alias("block"), "doc_id", "k", "text")
    top = F.struct(F.col("doc_id"), F.bitwise_not("k").alias("down"))
    heads = rows.groupBy("block").agg(F.max_by(F.struct("doc_id", "k", "text"), top).alias("head"))
    heads = stage(heads.select("block", "head.*"), "heads")
    # the block behind each block: within a run of blocks, else the first of the next run, else the first of all
    order = heads.select("block", F.floor(F.col("block") / 4096).alias("run"))
    runs = order.groupBy("run").agg(F.min("block").alias("low"))
    runs = runs.select("run", F.lead("low").over(Window.orderBy("run")).alias("over"), F.min("low").over(
        Window.partitionBy(F.lit(0))).alias("all"))
    within = Window.partitionBy("run").orderBy("block")
    behind = order.join(runs, "run").select("block", F.coalesce(F.lead("block").over(within), "over", "all").alias("behind"))
    borders = (behind.join(heads.withColumnRenamed("block", "behind"), "behind")
               .select("block", "doc_id", "k", "text", F.lit(1).alias("border")))
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), (span["bytes"] or 0) // TASK)
    every = rows.withColumn("border", F.lit(0)).unionByName(borders).repartition(tasks, "block")
    in_order = Window.partitionBy("block").orderBy("border", F.col("doc_id").desc_nulls_last(), "k")
    lead = {c: F.lead(x).over(in_order) for c, x in (("next_id", "doc_id"), ("next_k", "k"), ("following", "text"))}
    return every.withColumns({"place": F.row_number().over(in_order), **lead}).filter("border = 0").drop("border")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of every document.

    The fingerprint is a table of fixed size of the text's distinct paragraph digests: their number, and each cell that is
    not empty in hex. Equal texts have equal ones. Likeness is the shared part of both texts' paragraphs. It comes from
    the difference of two tables as large as their numbers of paragraphs ask for; where peeling fails, both are made
    anew, larger and with other cells, until it succeeds, so no document is left out.

    Cells of all documents are rows, summed where the texts lie; only texts are shuffled, once. Null and empty texts have no
    paragraph: their likeness is 1 to each other and 0 to others. Rows without an id come after all others, in the order
    of their text's hash; rows that repeat an id go by that hash too. A single document is followed by itself. An empty
    table gives an empty result.
    """
    rows = _in_order(docs)
    change = edited(F.col("text"), F.col("following"))
    keys = ["block", "place"]
    digests = rows.select(*keys, paragraphs(F.col("text")).alias("a"), paragraphs(change).alias("e"),
                          paragraphs(F.col("following")).alias("b"))
    first = _compared(digests, keys, 0, True)
    about = rows.select(*keys, "doc_id", "k", "next_id", "next_k", F.char_length("text").cast("long").alias("n_chars"),
                        F.sha2(change.cast("binary"), 256).alias("edited_sha256"))
    # both sides read one shuffle of the texts, as an inner join asks the same of them
    done = stage(about.join(first, keys), "fingerprints")
    failed = stage(done.filter("near_edited is null or near_next is null")
                   .select(*keys, "doc_id", "k", "next_id", "next_k"), "failed")
    out, attempt = None, 0
    while not failed.isEmpty():
        attempt += 1
        again = stage(_compared(_fetched(docs, failed), keys, attempt, False), "attempt")
        found = again.select(*keys, F.col("near_edited").alias("e"), F.col("near_next").alias("b"))
        out = found if out is None else out.unionByName(found)
        left = again.filter("near_edited is null or near_next is null").select(*keys)
        failed = stage(failed.join(left, keys, "left_semi"), "failed")
    if out is not None:
        out = out.groupBy(*keys).agg(F.max("e").alias("e"), F.max("b").alias("b"))
        done = done.join(out, keys, "left").withColumns({"near_edited": F.coalesce("near_edited", "e"),
                                                         "near_next": F.coalesce("near_next", "b")})
    return done.select("doc_id", "n_chars", "edited_sha256", F.col("print").alias("fingerprint"),
                       F.col("edited_print").alias("edited_fingerprint"), "near_edited", "near_next")


def _fetched(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Digests of the few documents whose tables did not peel, from their texts and those that follow them."""
    both = stage(wanted.select("doc_id", "k").union(wanted.select("next_id", "next_k")).distinct(), "wanted").alias("w")
    rows = texts(docs).withColumn("k", F.xxhash64("text")).alias("r")
    same = F.col("r.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("r.k") == F.col("w.k"))
    found = stage(rows.join(both, same, "left_semi").dropDuplicates(["doc_id", "k"]), "texts")
    a, b = found.alias("a"), found.select(F.col("doc_id").alias("b_id"), F.col("k").alias("b_k"),
                                          F.col("text").alias("following"))
    w = wanted.alias("w")
    pairs = w.join(a, F.col("w.doc_id").eqNullSafe(F.col("a.doc_id")) & (F.col("w.k") == F.col("a.k"))).join(
        b, F.col("w.next_id").eqNullSafe(F.col("b_id")) & (F.col("w.next_k") == F.col("b_k")))
    return pairs.select("w.block", "w.place", paragraphs(F.col("a.text")).alias("a"),
                        paragraphs(edited(F.col("a.text"), F.col("following"))).alias("e"),
                        paragraphs(F.col("following")).alias("b"))
