"""Periodic runs, alignment of two tokenizers and language models against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rentlens.llm import align, catalogue, language, runs

FOLDER = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, chunk string, bits int, words string, runs string"
LONG = " ".join(f"w{i * i % 997}" for i in range(20_000))
TEXTS = [None, "", " ", "\n\t", "a b c", "a b c", "x " * 300, "one two " * 40 + "end", LONG, "日本語 x́ 𐍈🙂 é", "a ▁ b", "a\x00b  c",
         "<|endoftext|> <s>", "x" * 3000, "12 34 !", "ein Haus und ein Hund " * 3]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 4 else None, t, "en" if i % 2 else "de", "x", 1, "y", "z") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[7]], SCHEMA)


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def bag(rows):
    return sorted(map(tuple, rows), key=repr)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_runs(words):
    found = set()
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            stretch = words[i:j + q]
            if len(stretch) >= max(6, 4 * q) and not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                found.add((i, len(stretch), q))
            i = max(j, i) + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_cover_holds_every_difference():
    assert {(a - b) % runs.V for a in runs.COVER for b in runs.COVER} == set(range(runs.V))
    assert all((runs.STEPS[d] + d) % runs.V in runs.COVER for d in range(runs.V) if d)


def test_extensions_are_the_longest():
    rng = random.Random(4)
    for _ in range(60):
        words = np.array([rng.randrange(2) for _ in range(rng.randint(40, 300))])
        words[len(words) // 2:] = words[:len(words) - len(words) // 2]
        i = np.array([rng.randrange(len(words) - 1) for _ in range(50)])
        j = np.array([rng.randrange(a + 1, len(words)) for a in i])
        want = [next((k for k in range(len(words) - b) if words[a + k] != words[b + k]), len(words) - b) for a, b in zip(i, j)]
        assert runs.Extensions(words).lce(i, j).tolist() == want


@pytest.mark.parametrize("grid", [runs.GRID, 8])
def test_runs_of_random_words(monkeypatch, grid):
    monkeypatch.setattr(runs, "GRID", grid)
    rng = random.Random(8)
    for _ in range(600):
        n, kinds = rng.randint(0, 150), rng.choice([1, 2, 3, 6, 60])
        words = [rng.randrange(kinds) for _ in range(n)]
        for _ in range(rng.randint(0, 3) if n else 0):
            a, p = rng.randrange(n), rng.randint(1, 1 + n // 4)
            for i in range(a, rng.randint(a, n)):
                words[i] = words[a + (i - a) % p]
        found = runs.find(np.array(words, np.int64))
        want = brute_runs(words)
        assert [tuple(r) for r in found.tolist()] == want
        gone = {i for s, n, q in want for i in range(s + q, s + n)}
        assert np.flatnonzero(runs.dropped(len(words), found)).tolist() == sorted(gone)


def test_long_sequences():
    assert runs.find(np.zeros(200_000, np.int64)).tolist() == [[0, 200_000, 1]]
    assert runs.find(np.arange(200_000) % 40_000).tolist() == [[0, 200_000, 40_000]]
    assert not len(runs.find(np.arange(200_000)))


@pytest.mark.parametrize("which", ["docs", "table"])
def test_runs_query(request, spark, which):
    df, want = request.getfixturevalue(which), []
    for r in df.select("doc_id", "text").collect():
        words = (r["text"] or "").encode().split()
        h, n = zlib.crc32(str(r["doc_id"]).encode()), len(words)
        if r["doc_id"] is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 5000:  # the brute force is slow: no run but planted ones is here
            found = [tuple(x) for x in runs.find(runs.numbers_of(words)).tolist()]
        else:
            found = brute_runs(words)
        gone = {i for s, k, q in found for i in range(s + q, s + k)}
        top = max(found, key=lambda x: (x[1], -x[0], -x[2]), default=(None, None, None))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        want.append((r["doc_id"], len(found), *top, top[1] * 1000 // top[2] if found else None,
                     sha("".join(f"{s},{k},{q}\n" for s, k, q in found)), sha(kept)))
    got = runs.digests(runs.detect(runs.with_planted(df)))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert bag(got.collect()) == bag(want)
    if which == "table":
        assert bag(catalogue.op11_runs(spark, FOLDER).collect()) == bag(want)


def test_runs_and_collapsed_text(docs):
    got = {r["doc_id"]: r for r in runs.detect(docs).collect()}
    assert got[7]["collapsed"] == "one two end" and tuple(got[7]["runs"][0]) == (0, 80, 2) and got[7]["n_words"] == 81
    assert got[6]["collapsed"] == "x" and got[0]["collapsed"] == got[2]["collapsed"] == "" and got[0]["runs"] == []


def brute_alignment(texts):
    """(tokens, groups, links) of each text by the libraries and the tokens' bytes over the whole text."""
    tok, model = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    letters = align._byte_letters()
    pieces = {k: t for t, k in tok.get_vocab().items()}
    out = []
    for text in texts:
        whole = f" {text}".encode()
        a, b = tok.encode(f" {text}", add_special_tokens=False).ids, model.encode(text or "")
        a_bytes = [bytes(letters[c] for c in pieces[k]) for k in a]
        b_bytes = [bytes([int(model.id_to_piece(k)[3:5], 16)]) if model.is_byte(k) else model.id_to_piece(k).replace("▁", " ").encode()
                   for k in b]
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            out.append(None)
            continue
        a_ends, b_ends = (np.cumsum([len(x) for x in side]).tolist() for side in (a_bytes, b_bytes))
        a_at, b_at = ({e: k for k, e in enumerate(ends)} for ends in (a_ends, b_ends))
        groups, links, i, j = [], [], 0, 0
        for end in a_ends:
            if end in b_at:
                x, y = a_at[end] + 1, b_at[end] + 1
                groups.append(f"{','.join(map(str, a[i:x]))}|{','.join(map(str, b[j:y]))}")
                links.append((a[x - 1], b[y - 1]))
                i, j = x, y
        out.append((len(a), len(b), groups, links))
    return out


def brute_rows(rows):
    found = brute_alignment([t for _, t in rows])
    counts = Counter(pair for x in found if x for pair in x[3])
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for (i, _), x in zip(rows, found):
        if x is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            a, b, groups, links = x
            out.append((i, a, b, len(groups), len(links), sum(counts[p] == best[p[1]] for p in links),
                        sum(counts[p] for p in links), sha(";".join(groups))))
    return out, counts


@pytest.mark.parametrize("which", ["docs", "table"])
def test_alignment(request, which):
    df = request.getfixturevalue(which)
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    want, counts = brute_rows(rows)
    got = align.align(df, A, B, chunk_bytes=1 << 14)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert bag(got.collect()) == bag(want)
    pairs = align.alignment_pairs(df, A, B, chunk_bytes=1 << 14).collect()
    assert {(r["a_id"], r["b_id"]): r["total"] for r in pairs} == counts


def test_alignment_of_awkward_texts(monkeypatch):
    monkeypatch.setattr(align, "SEEN", 50)  # room is made again and again
    rng, letters = random.Random(3), "abtheo  \n\t.,'s日本é́𐍈🙂▁\x00　\x1cßſ<|endoftext|><s>0123"
    texts = ["".join(rng.choice(letters[:rng.choice([12, len(letters)])]) for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    aligner = align.Aligner(*align.read_tokenizers(A, B))
    for text, want in zip(texts, brute_alignment(texts)):
        parts = aligner.split(text)
        known = dict(zip(new := list(dict.fromkeys(parts)), aligner.learn(new)))
        found = [known[s] for s in parts]
        if want is None:
            assert None in found
        else:
            assert (sum(x[0] for x in found), sum(x[1] for x in found)) == want[:2]
            assert ";".join(x[3] for x in found) == ";".join(want[2])
            assert [divmod(p, aligner.b_size) for x in found for p in x[4]] == want[3]


def test_words_are_one_text_to_tokenizer_a():
    class Counting:
        def __init__(self, inner):
            self.inner, self.asked = inner, 0

        def encode(self, *args, **options):
            self.asked += 1
            return self.inner.encode(*args, **options)

        def encode_batch(self, texts, **options):
            self.asked += len(texts)
            return self.inner.encode_batch(texts, **options)

    aligner = align.Aligner(*align.read_tokenizers(A, B))
    aligner.a = Counting(aligner.a)
    words = [f"wörd{k}" for k in range(500)]
    found = aligner.learn(words)
    assert aligner.a.asked == 1
    # a word that begins with white space goes in alone, and so do those with it
    assert aligner.learn(["a  ", "\tb", "c"]) == [aligner.align([s])[0] for s in ("a  ", "\tb", "c")]
    for word, got, want in zip(words, found, brute_alignment(words)):
        assert (None if got is None else (got[0], got[1], got[3])) == (want and (want[0], want[1], ";".join(want[2])))


def brute_model(texts, order=language.ORDER):
    """Probabilities of one language from the definition, as a function of (context, character)."""
    reader = language.Reader(language.letter_table())
    strings = ["".join(map(chr, reader.places(t)[0])) for t in texts]
    levels = {order: Counter(s[i:i + order] for s in strings for i in range(len(s) - order + 1))}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    letters = len(levels[1])

    def discount(level):
        once, twice = (sum(n == k for n in level.values()) for k in (1, 2))
        return min(max(once / (once + 2 * twice) if once + twice else 0.5, 0.1), 0.9)

    discounts = {k: discount(v) for k, v in levels.items()}

    def p(gram):
        if not gram:
            return 1 / (letters + 1)
        level, d = levels[len(gram)], discounts[len(gram)]
        after = [n for g, n in level.items() if g[:-1] == gram[:-1]]
        if not after:
            return p(gram[1:])
        return max(level.get(gram, 0) - d, 0) / sum(after) + d * len(after) / sum(after) * p(gram[1:])

    return p, strings


def test_kneser_ney_is_the_definition(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("aabcdeé") for _ in range(rng.randint(1, 5)))
    learned = {lang: [" ".join(word() for _ in range(12)) + "!" for _ in range(6)] for lang in ("aa", "bb")}
    rows = [(lang, t) for lang, found in learned.items() for t in found]
    model = language.Model(language.kneser_ney(language.count_grams(spark.createDataFrame(rows, "lang string, text string"))))
    asked = ["abc cab", "Éa, zz bb!", "q", learned["aa"][0]]
    df = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    got = {r["doc_id"]: r["entropy"] for r in language.entropies(df, model).collect()}
    for i, lang in enumerate(model.langs):
        p, _ = brute_model(learned[lang])
        for k, text in enumerate(asked):
            points = "".join(map(chr, language.Reader(language.letter_table()).places(text)[0]))
            bits = [-math.log2(p(points[j:j + language.ORDER])) for j in range(len(points) - language.ORDER + 1)]
            assert got[k][i] == pytest.approx(sum(bits) / len(bits), rel=1e-5)
        # what follows a context sums up to one, with one character that was not seen
        seen = {g[-1] for g in "".join(brute_model(learned[lang])[1])}
        assert sum(p("abca" + c) for c in seen | {"☃"}) == pytest.approx(1.0, abs=1e-9)


def test_language_held_out(spark, table):
    got = language.languages(table).join(table.select("doc_id", "lang", "text").dropDuplicates(["doc_id"]), "doc_id").collect()
    assert len(got) == table.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_of_awkward_rows(spark, table, docs):
    some = table.select("doc_id", "text", "lang").union(docs.select("doc_id", "text", "lang"))
    whole = {(r["doc_id"], r["entropy"], r["lang_pred"]) for r in language.languages(some).collect()}
    parts = language.languages(some, part_bytes=100_000).collect()  # the model in many parts gives the same sums
    near = lambda rows: sorted(((i, None if e is None else round(e, 9), x) for i, e, x in rows), key=repr)
    assert near({(r["doc_id"], r["entropy"], r["lang_pred"]) for r in parts}) == near(whole)
    model, calibration = language.train(table)
    got = language.classify(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), model, calibration).collect()
    assert len(got) == docs.count()
    without = {0, 1, 2, 3, 14}
    assert all((r["lang"] is None and r["score"] == 0 and r["rejected"]) == (r["doc_id"] in without) for r in got)
    # a text in no language of the model is named, but rejected
    odd = {r["doc_id"]: r for r in got}
    assert odd[9]["rejected"] and odd[13]["rejected"]


def test_rejection_is_calibrated(spark):
    """About the share asked for is rejected among texts like the learned ones, and nearly all of another kind."""
    rng = random.Random(6)
    text = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(rng.randint(5, 60)))
    rows = [(i, text("aabcd" if i % 2 else "efggh"), "x" if i % 2 else "y") for i in range(4000)]
    rows += [(i, text("acefpqrs"), None) for i in range(4000, 4400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model, calibration = language.train(df.filter("doc_id < 3000"))
    got = language.classify(df.filter("doc_id >= 3000").drop("lang"), model, calibration).collect()
    same, other = ([r["rejected"] for r in got if (r["doc_id"] < 4000) == k] for k in (True, False))
    assert sum(same) / len(same) < 0.02 and sum(other) / len(other) > 0.95
    assert all(r["lang"] == ("x" if r["doc_id"] % 2 else "y") for r in got if r["doc_id"] < 4000)


def test_empty_tables(docs, spark, tmp_path):
    none = docs.limit(0)
    assert runs.digests(runs.detect(runs.with_planted(none))).count() == 0
    assert align.align(none, A, B).count() == 0 and align.alignment_pairs(none, A, B).count() == 0
    assert language.languages(none).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {(r["lang_pred"], r["score"]) for r in language.languages(unlabelled).collect()} == {("und", 0.0)}
