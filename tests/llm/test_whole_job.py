"""Cases in which an operator once did less than its whole job."""

from __future__ import annotations

import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from rentlens.llm import main_text, mixing, pii


def sources(spark, sizes):
    """Documents of as many sources as there are sizes."""
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, n long")
    return rows.select(F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("doc_id"), "source")


def worst(read, weights):
    """The largest distance of a source from its share in blocks, over all slots; ``read`` is the source of each slot."""
    share = {s: Fraction(w) / sum(map(Fraction, weights.values())) for s, w in weights.items()}
    done, most = dict.fromkeys(weights, 0), 0
    for t, source in enumerate(read, 1):
        done[source] += 1
        most = max(most, *(abs(done[s] - t * share[s]) for s in weights))
    return most


def test_schedule_keeps_exact_weights(spark):
    # 1/3 is no whole number of slots of any cycle of 1000, and one document in 4000 is less than one slot of it
    equal, rare = dict.fromkeys("abc", 4000), {"a": 4000, "b": 1}
    for sizes in (equal, rare):
        weights = {s: n ** 0.9 for s, n in sizes.items()}
        got = mixing.schedule(sources(spark, sizes), block=1).collect()
        slots = sorted((r["mix_slot"], r["source"]) for r in got)
        assert [t for t, _ in slots] == list(range(len(slots)))
        assert worst([s for _, s in slots], weights) < 1
        assert {(r["doc_id"], r["source"]) for r in got} == {(i + 1, s) for s, n in sizes.items() for i in range(n)}
    # nothing is read again because of the one document
    assert len(got) <= 4002 and sum(r["source"] == "b" for r in got) <= 2


def test_schedule_of_many_sources(spark):
    sizes = {f"s{i}": 1 + i % 3 for i in range(1500)}
    got = mixing.schedule(sources(spark, sizes)).collect()
    assert {(r["doc_id"], r["source"]) for r in got} == {(i + 1, s) for s, n in sizes.items() for i in range(n)}
    assert worst([s for _, s in sorted({(r["mix_slot"], r["source"]) for r in got})],
                 {s: n ** 0.9 for s, n in sizes.items()}) < 1


def test_terms_far_from_their_entity(spark):
    far = "the common words go on and on " * 4
    rows = [(i, f"Zaphodine {far} zaphod@mail.example {far}") for i in range(3)]
    rows += [(3, f"{far} Zaphodine {far}"), (4, "zaphodine and ZAPHODINE")]
    rows += [(10 + i, f"{far} {i}") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["extra"]] for r in pii.detect(df).collect()}
    for i in range(5):
        assert got[i] == [m.span() for m in re.finditer("zaphodine", texts[i], re.I)]
    assert not any(got[10 + i] for i in range(2000))
    listed = {r["doc_id"]: r["spans"] for r in pii.personal_data(df).collect()}
    assert all("term:0:9" in listed[i] for i in range(3)) and not any(listed[i] for i in listed if i > 4)
    assert listed[3] == f"term:{texts[3].index('Zaph')}:{texts[3].index('Zaph') + 9}" and listed[4] == "term:0:9,term:14:23"
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(df).collect()}
    assert clean[4] == "[TERM] and [TERM]" and clean[3] == texts[3].replace("Zaphodine", "[TERM]")


@pytest.mark.parametrize("page, kept", [
    ('<div class="layout has-sidebar"><article>{}</article><div class="sidebar"><p>More of this</p></div></div>', True),
    ('<div class="sidebar-layout"><article>{}</article></div>', True),
    ('<form><main>{}</main></form>', True),
    ('<article class="post comments-open category-legal tag-menu">{}</article>', True),
    ('<div class="sidebar">{}</div>', False),
    ('<aside><article>{}</article></aside>', False),
    ('<div hidden><article>{}</article></div>', False)])
def test_main_text_in_marked_containers(page, kept):
    prose = "A long paragraph of plain prose follows here, as it should. " * 5
    page = "<html><body><nav><a href=x>Menu</a></nav>" + page.format(f"<p>{prose}</p><p>{prose}</p>") + "<footer>Legal</footer>"
    assert main_text.main_text(page) == ("\n".join([prose.strip()] * 2) if kept else "")
