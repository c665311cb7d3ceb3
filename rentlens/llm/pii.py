"""Personal data: patterns, and terms that disclose the entities they occur with. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.llm.common import stage, texts

# The patterns, in the order in which kinds are listed. They match what the plain patterns match, leftmost and
# without overlap, but never scan a run of characters twice: a run is entered at its start or where the last match ended.
KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold for a kind to occur at all.
MARKS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
TERM = r"\p{L}{4,}"
TERM_KIND = "term"
SUPPORT = 2       #: documents in which a term and an entity must occur together
DISCLOSURE = 0.9  #: share of an entity's information that a term may not give away
PART = 64         #: matches whose places are counted together

SPAN = "struct<start:int,end:int,value:string>"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` and the lambdas in it name it."""
    return F.transform(F.array(value), use)[0]


def _parts(rows: Column, size: int = PART) -> Column:
    """An array cut into arrays of ``size`` elements, in order."""
    return _once(rows, lambda r: F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(r) - 1) / size).cast("int"))),
        lambda i: F.slice(r, i * size + 1, F.lit(size))))


def _placed(pieces: Column, kind: str, hit: Callable[[Column, Column, Column], Column],
            wanted: Callable[[Column], Column]) -> Column:
    """Spans of the wanted hits of a text, from ``pieces`` (gap, length, value) whose lengths add up to the places.

    An array that grows by one costs its length each time, so places are first counted inside parts of PART pieces, and
    the parts then get the places where they start.
    """
    empty = F.array().cast(f"array<{kind}>")

    def step(state: Column, piece: Column) -> Column:
        start = state["at"] + piece["gap"]
        end = start + F.coalesce(piece["length"], F.lit(0))
        return F.struct(end.alias("at"), F.when(piece["value"].isNotNull() & wanted(piece["value"]), F.concat(
            state["out"], F.array(hit(start, end, piece["value"])))).otherwise(state["out"]).alias("out"))

    inside = F.transform(_parts(pieces), lambda part: F.aggregate(
        part, F.struct(F.lit(0).alias("at"), empty.alias("out")), step))

    def follow(state: Column, part: Column) -> Column:
        more = F.struct(state["at"].alias("from"), part["out"].alias("out"))
        return F.struct((state["at"] + part["at"]).alias("at"), F.concat(state["out"], F.array(more)).alias("out"))

    parts = F.aggregate(inside, F.struct(F.lit(0).alias("at"), F.array().cast(
        f"array<struct<from:int,out:array<{kind}>>>").alias("out")), follow, lambda state: state["out"])
    return F.flatten(F.transform(parts, lambda part: F.transform(part["out"], lambda s: s.withField(
        "start", s["start"] + part["from"]).withField("end", s["end"] + part["from"]))))


def _pieces(text: Column, pattern: str) -> Column:
    """What lies between the matches of a pattern and the matches themselves, which alternate, with their lengths."""
    return F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                      lambda gap, hit: F.struct(F.char_length(gap).alias("gap"), F.char_length(hit).alias("length"),
                                                hit.alias("value")))


def matches(text: Column, pattern: str, wanted: Callable[[Column], Column] = lambda value: F.lit(True)) -> Column:
    """All wanted matches of a pattern as (start, end, value) in code points, end exclusive."""
    return _placed(_pieces(text, pattern), SPAN, lambda start, end, value: F.struct(
        start.alias("start"), end.alias("end"), value.alias("value")), wanted)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def add(state: Column, c: Column) -> Column:
        # digits come from the right, every second one doubled
        d = c.cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.struct((1 - state["odd"]).alias("odd"),
                        (state["sum"] + F.when(state["odd"] == 1, twice).otherwise(d)).alias("sum"))

    start = F.struct(F.lit(0).alias("odd"), F.lit(0).alias("sum"))
    return F.aggregate(F.split(F.reverse(digits), ""), start, add, lambda s: s["sum"] % 10 == 0)


def valid(kind: str, value: Column) -> Column:
    """Whether a match counts."""
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.forall(F.split(value, "\\."), lambda p: (F.length(part(p)) <= 3) & (part(p).cast("int") <= 255))
    if kind == "card":
        n = F.length(_digits(value))
        return (n >= 16) & (n <= 19) & luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """Valid matches of a kind, in order."""
    found = matches(text, PATTERNS[kind], lambda value: valid(kind, value))
    mark = F.contains(text, F.lit(MARKS[kind])) if MARKS[kind] else F.lit(True)
    if kind in ("ip", "card"):
        mark = mark & F.rlike(text, F.lit("[0-9]"))
    return F.when(mark, found).otherwise(F.array().cast(f"array<{SPAN}>"))


def _terms(text: Column) -> Column:
    """Distinct terms of a whole text, each in lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def _places(text: Column, terms: Column) -> Column:
    """Spans of all occurrences of the terms."""
    return _placed(_pieces(text, TERM), "struct<kind:string,start:int,end:int>", lambda start, end, value: F.struct(
        F.lit(TERM_KIND).alias("kind"), start.alias("start"), end.alias("end")),
        lambda value: F.array_contains(terms, F.lower(value)))


def _named(kind: str) -> Column:
    return F.transform(kind, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"),
                                                s["end"].alias("end"), s["value"].alias("value")))


def _text_of(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _digested(docs: DataFrame) -> DataFrame:
    return texts(docs).withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))


def _found(docs: DataFrame) -> DataFrame:
    """Per document: digest of the text, spans of each kind, the entities, and the terms of a text that has any."""
    rows = _digested(docs).withColumns({k: base_spans(F.col("text"), k) for k in KINDS})
    rows = rows.withColumn("base", F.concat(*[_named(k) for k in KINDS]))
    entities = F.array_distinct(F.transform("base", lambda s: F.concat_ws(":", s["kind"], F.lower(s["value"]))))
    return rows.select("doc_id", "digest", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
                       F.transform("base", lambda s: s.dropFields("value")).alias("base"), entities.alias("entities"),
                       F.when(F.size("base") > 0, _terms(F.col("text"))).alias("terms"))


def _word_counts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(term, n_term): in how many documents each wanted term occurs, over all documents and their whole texts.

    Words are counted where the texts lie before any of them moves, whether they are wanted or not.
    """
    counts = (texts(docs).select(F.explode(_terms(F.col("text"))).alias("term")).groupBy("term")
              .agg(F.count(F.lit(1)).alias("n_term")))
    # an inner join: Spark would move a semi-join below the counting
    return counts.join(wanted.select("term").distinct(), "term")


def _told(docs: DataFrame, found: DataFrame, support: int, disclosure: float) -> DataFrame:
    """Terms that give away an entity.

    Documents with the same text are counted together before they meet their terms. A term of n documents can only give
    away an entity of m documents, of N in all, if n <= m * (N / m) ** (1 - disclosure): P(entity | term) is m / n at
    most. So frequent terms are left out before pairs are made, and no pair that counts is.
    """
    total = float(max(found.count(), 1))
    held = stage(found.filter(F.size("entities") > 0).select("doc_id", "digest", "entities", "terms")
                 .dropDuplicates(["doc_id", "digest"]).groupBy("digest").agg(
                     F.count(F.lit(1)).alias("copies"), F.first("entities").alias("entities"),
                     F.first("terms").alias("terms")), "held")
    mentions = held.select("digest", "copies", F.explode("entities").alias("entity"))
    most = F.col("n_entity") * F.pow(total / F.col("n_entity"), F.lit(1 - disclosure)) * (1 + 1e-9)
    holders = stage(mentions.groupBy("entity").agg(F.sum("copies").alias("n_entity"))
                    .filter((F.col("n_entity") >= support) & (F.col("n_entity") < total))
                    .withColumn("most", most), "holders")
    mentions = stage(mentions.join(holders, "entity"), "mentions")
    texts_of = held.select("digest", "terms").join(mentions.groupBy("digest").agg(F.max("most").alias("top")), "digest")
    words = texts_of.select("digest", "top", F.explode("terms").alias("term"))
    rare = (words.join(stage(_word_counts(docs, words), "word-counts"), "term").filter(F.col("n_term") <= F.col("top"))
            .select("digest", "term", "n_term"))
    pairs = (rare.join(mentions, "digest").filter(F.col("n_term") <= F.col("most"))
             .groupBy("entity", "term", "n_entity", "n_term").agg(F.sum("copies").alias("n_pair"))
             .filter(F.col("n_pair") >= support))
    given = F.log2(F.col("n_pair") * total / (F.col("n_term") * F.col("n_entity")))
    return stage(pairs.filter(given >= disclosure * F.log2(total / F.col("n_entity"))).select("term").distinct(), "told")


def detect(docs: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """(doc_id, digest, n_email, n_ip, n_card, n_phone, base, extra): spans of personal data of every document.

    ``base`` are the spans of the patterns. Their values are the protected entities. Every term of a document with an
    entity is held against the corpus: it gives away log2(P(entity | term) / P(entity)) of the entity's
    log2(1 / P(entity)) bits, with probabilities over all documents and their whole texts. If that is a share of
    ``disclosure`` or more, and both are in ``support`` documents together at least, all occurrences of the term are in
    ``extra``, in whatever document, but for those inside a span of ``base``.

    The found terms are joined back to all documents. A null text counts as empty; a null doc_id is an id of its own;
    repeated rows each give a row; an empty table gives an empty result.
    """
    found = stage(_found(docs), "personal-data")
    told = _told(docs, found, support, disclosure)
    # words meet the found terms without the texts, and only documents that hold one are gone through for its places
    holding = stage(_digested(docs).select("doc_id", "digest", F.explode(_terms(F.col("text"))).alias("term"))
                    .join(told, "term").groupBy("doc_id", "digest").agg(F.collect_set("term").alias("terms")), "holding")
    same = F.col("f.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("f.digest") == F.col("h.digest"))
    hits = (_digested(docs).alias("f").join(holding.alias("h"), same)
            .select("f.doc_id", "f.digest", _places(F.col("f.text"), F.col("h.terms")).alias("extra")))
    hits = stage(hits.dropDuplicates(["doc_id", "digest"]), "terms")
    rows = found.drop("entities", "terms").alias("f")
    joined = rows.join(hits.alias("h"), same, "left").select("f.*", "h.extra")
    clear = F.filter("extra", lambda t: ~F.exists("base", lambda s: (t["start"] < s["end"]) & (s["start"] < t["end"])))
    return joined.withColumn("extra", F.when(F.col("extra").isNull(), F.array().cast(
        "array<struct<kind:string,start:int,end:int>>")).otherwise(clear))


def personal_data(docs: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of every document: all that ``detect`` finds."""
    return detect(docs, support, disclosure).select(
        "doc_id", *[F.col(f"n_{k}") for k in KINDS],
        F.sha2(_text_of(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _text_of(F.concat("base", "extra")).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """A text with every span replaced by its kind in brackets; overlapping spans are replaced together, once.

    A text is cut at the ends of parts of PART spans, and each part's spans are replaced in its own piece, so that
    a long text is not gone through for every span.
    """
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                                 s["kind"].alias("kind"))))

    def part(state: Column, some: Column) -> Column:
        first = state["at"]
        piece = F.substring(text, first + 1, F.greatest(F.array_max(F.transform(some, lambda s: s["end"])), first) - first)

        def step(inner: Column, s: Column) -> Column:
            fresh = s["start"] >= inner["at"]
            more = F.concat(inner["out"], F.substring(inner["piece"], inner["at"] - first + 1, s["start"] - inner["at"]),
                            F.lit("["), F.upper(s["kind"]), F.lit("]"))
            return F.struct(F.when(fresh, more).otherwise(inner["out"]).alias("out"),
                            F.greatest(inner["at"], s["end"]).alias("at"), inner["piece"].alias("piece"))

        start = F.struct(F.lit("").alias("out"), first.alias("at"), piece.alias("piece"))
        return F.aggregate(some, start, step, lambda inner: F.struct(
            F.concat(state["out"], inner["out"]).alias("out"), inner["at"].alias("at")))

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(_parts(ordered), start, part, lambda state: F.concat(
        state["out"], F.substring(text, state["at"] + 1, F.char_length(text)))))


def sanitise(docs: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """The documents with personal data removed from ``text``, and ``n_chars``, if there, made right.

    Terms that disclose an entity are generalised to [TERM] wherever they are, patterns to their kind. Rows without a span stay as they are;
    null texts stay null. All columns are kept, in their order.
    """
    spans = detect(docs, support, disclosure).select("doc_id", "digest", F.concat("base", "extra").alias("spans"))
    spans = stage(spans.filter(F.size("spans") > 0).dropDuplicates(["doc_id", "digest"]), "spans").alias("s")
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")).alias("d")
    digest = F.sha2(F.coalesce("d.row.text", F.lit("")).cast("binary"), 256)
    same = F.col("d.row.doc_id").eqNullSafe(F.col("s.doc_id")) & (digest == F.col("s.digest"))
    out = rows.join(spans, same, "left").select("d.row.*", F.col("s.spans").alias("__spans"))
    out = out.withColumn("text", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(
        redacted(F.col("text"), F.col("__spans"))))
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("__spans").isNull(), F.col("n_chars")).otherwise(
            F.char_length("text").cast(kind)))
    return out.select(*[F.col(f"`{c}`") for c in names])
