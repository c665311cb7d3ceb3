"""Named steps across sessions, publications that are replaced as a whole, and proven order."""

from __future__ import annotations

import functools

import pytest
from pyspark.sql import functions as F

from rentlens.operators import design, mixed
from rentlens.plans.fixtures import Tables
from rentlens.plans.study import Study
from rentlens.sources import publication as published
from rentlens.sources.files import Files
from rentlens.sources.publication import Ordered, Publication
from rentlens.sources.steps import Steps, Table, code_digest, frame_digest

FOLDER = "/root/testdata/sf0.001"
FACTOR = 2


def doubled(df):
    return df.withColumn("twice", F.col("x") * FACTOR)


def total(df, extra=0):
    return df.agg((F.sum("twice") + extra).alias("total"))


@pytest.fixture
def source(spark, tmp_path):
    path = f"{tmp_path}/source"
    spark.range(5).select(F.col("id").alias("x")).write.parquet(path)
    return path


def rows(df):
    return sorted(map(tuple, df.collect()))


def run_both(steps, path, extra=0):
    first = steps.run("doubled", doubled, steps.source(steps.spark.read.parquet(path)), code=(doubled,))
    return steps.run("total", total, first, code=(total,), extra=extra)


def jobs_of(spark, make):
    spark.sparkContext.setJobGroup("counted", "")
    made = make()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return made, len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))


def test_a_second_session_reads_without_a_job(spark, source, tmp_path):
    first = Steps(spark, f"{tmp_path}/steps")
    assert run_both(first, source).frame.first()["total"] == 20
    assert first.made == ["doubled", "total"]
    other = Steps(spark.newSession(), f"{tmp_path}/steps")
    known = other.spark.read.schema("x long").parquet(source)
    assert run_both(other, source).frame.first()["total"] == 20 and other.made == []
    frame, jobs = jobs_of(spark, lambda: (frame_digest(known), other.load("total"))[1])
    assert jobs == 0 and frame.first()["total"] == 20
    assert other.names() == ["doubled", "total"]
    with pytest.raises(KeyError):
        other.load("missing")


def test_changes_make_only_later_steps_anew(spark, source, tmp_path):
    steps = Steps(spark, f"{tmp_path}/steps")
    run_both(steps, source)
    assert run_both(steps, source, extra=1).frame.first()["total"] == 21  # a parameter of the second step
    assert steps.made == ["doubled", "total", "total"]
    spark.createDataFrame([(10,)], "x long").write.mode("append").parquet(source)
    assert run_both(steps, source).frame.first()["total"] == 40
    assert steps.made[3:] == ["doubled", "total"]
    assert steps.load("total").first()["total"] == 40
    steps.prune()
    assert len(steps.files.names("total")) == 2 and steps.load("total").first()["total"] == 40  # the log and one key


def test_a_torn_write_is_no_step(spark, source, tmp_path):
    steps = Steps(spark, f"{tmp_path}/steps")
    made = run_both(steps, source)
    files, at = steps.files, f"total/{made.key}"
    folder = files.record(f"{at}/manifest.json")["folder"]
    data = files.read(f"{at}/manifest.json")
    for break_it in (lambda: files.delete(f"{at}/manifest.json"),  # the driver was lost before the manifest
                     lambda: (files.delete(f"{at}/manifest.json"), files.create(f"{at}/manifest.json", data[:40])),
                     lambda: [files.delete(f"{at}/{files.record(f'{at}/manifest.json')['folder']}/{n}")
                              for n in files.listing(f"{at}/{files.record(f'{at}/manifest.json')['folder']}")]):
        break_it()
        other = Steps(spark, f"{tmp_path}/steps")
        with pytest.raises(KeyError):
            other.load("total")
        assert run_both(other, source).frame.first()["total"] == 20 and other.made == ["total"]
    assert files.record(f"{at}/manifest.json")["folder"] != folder


def test_code_digest_sees_what_a_function_reaches(monkeypatch):
    package = __name__.split(".")[0]
    before = code_digest(doubled, package=package)
    assert before == code_digest(doubled, package=package) != code_digest(total, package=package)
    monkeypatch.setitem(globals(), "FACTOR", 3)
    assert code_digest(doubled, package=package) != before
    one, two = (functools.partial(total, extra=k) for k in (1, 2))
    assert code_digest(one, package=package) != code_digest(two, package=package)
    # an operator's digest follows its helpers in other modules
    before = code_digest(mixed.fit_nested)
    monkeypatch.setattr(design, "independent_columns", lambda a, tol=1e-9: list(range(len(a))))
    monkeypatch.setattr(mixed, "independent_columns", design.independent_columns)
    assert code_digest(mixed.fit_nested) != before


def test_sources_without_files_are_refused(spark, source):
    with pytest.raises(ValueError, match="files"):
        frame_digest(spark.range(3).toDF("x"))
    held = spark.read.parquet(source)
    with pytest.raises(ValueError, match="input"):
        code_digest(lambda: held.count())
    assert frame_digest(held) != frame_digest(held.filter("x > 1"))


def test_a_study_is_found_again(spark, tmp_path):
    t = Tables(spark, FOLDER)
    first = Study(t.listings, t.fee_census, t.cadastral, Steps(spark, f"{tmp_path}/steps"))
    want = rows(first.sector_rates)
    assert {"cleaned", "kept", "cohorts", "split", "pruned_P", "coefs_N", "rates_P"} <= set(first.steps.made)
    again = Study(t.listings, t.fee_census, t.cadastral, Steps(spark, f"{tmp_path}/steps"))
    assert rows(again.sector_rates) == want and again.steps.made == []
    assert rows(Steps(spark.newSession(), f"{tmp_path}/steps").load("rates_P")) == rows(first.classes["P"].rates)
    # another census changes what is cleaned and all that follows
    census = t.fee_census.withColumn("VALOR_ADMINISTRACION_MODA", F.col("VALOR_ADMINISTRACION_MODA") * 2)
    other = Study(t.listings, census, t.cadastral, Steps(spark, f"{tmp_path}/steps"))
    assert other.cleaned.count() == first.cleaned.count() and other.steps.made == ["cleaned"]


def test_a_failed_publication_leaves_the_one_before(spark, tmp_path):
    p = Publication(spark, f"{tmp_path}/rates")
    with pytest.raises(KeyError):
        p.read("a")
    old = {"a": spark.range(3), "b": spark.range(4)}
    assert p.write(old) == 1
    broken = spark.range(5).withColumn("id", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        p.write({"a": spark.range(30), "b": broken})  # the second of two tables fails
    other = Publication(spark.newSession(), f"{tmp_path}/rates")
    assert (other.read("a").count(), other.read("b").count(), other.versions()) == (3, 4, [1])
    assert p.write({"a": spark.range(30), "b": spark.range(40)}) == 2
    held = other.read("a", version=1)
    assert (other.read("a").count(), other.read("b").count(), held.count()) == (30, 40, 3)
    # a torn record is passed over, and the next one does not take its number
    p.files.create("_log/00000000000000000003.json", b'{"sha256": "x", "bo')
    assert other.read("a").count() == 30 and p.write(old) == 4 and other.read("b").count() == 4
    p.prune(keep=1)
    assert p.versions() == [4] and len(p.files.names("data")) == 1 and p.read("a").count() == 3


def test_order_is_proven_from_files(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 7919 % 13).alias("k"), F.when(F.col("id") % 5 > 0, F.col("id") % 3).alias("j"),
                                  F.lit("same").alias("text"))
    path = f"{tmp_path}/ordered"
    published.write_ordered(df, ["k", "j"], path, rows_per_file=64)
    found = spark.read.parquet(path)
    assert len(Files(spark, path).listing("")) == 16
    published.check_order(found, ["k", "j"])
    got = [(r["k"], r["j"]) for r in found.orderBy(published.RANK).collect()]
    assert got == sorted(got, key=lambda r: (r[0], r[1] is not None, r[1] or 0))
    assert [r[0] for r in found.select(published.RANK).orderBy(published.RANK).collect()] == list(range(1, 1001))
    with pytest.raises(ValueError, match="order of j"):
        published.check_order(found, ["j", "k"])
    gap = f"{tmp_path}/gap"
    found.filter(F.col(published.RANK) != 500).repartitionByRange(4, published.RANK).sortWithinPartitions(published.RANK).write.parquet(gap)
    with pytest.raises(ValueError, match="ranks"):
        published.check_order(spark.read.parquet(gap), ["k", "j"])
    mixed_up = f"{tmp_path}/mixed"
    found.repartitionByRange(4, published.RANK).sortWithinPartitions(F.desc(published.RANK)).write.parquet(mixed_up)
    with pytest.raises(ValueError, match="ranks"):
        published.check_order(spark.read.parquet(mixed_up), ["k", "j"])


def test_publications_check_their_files(spark, tmp_path):
    p = Publication(spark, f"{tmp_path}/tables")
    p.write({"a": Ordered(spark.range(50).toDF("x"), ("x",)), "none": Ordered(spark.range(0).toDF("x"), ("x",)), "b": spark.range(5)})
    p.check()
    entry = p.manifest()["a"]
    assert sorted(entry["ranges"].values())[0][0] == 1 and p.read("none").count() == 0
    p.files.delete(f"{entry['folder']}/{next(iter(entry['files']))}")
    with pytest.raises(ValueError, match="files of a"):
        p.check()


def test_table_is_plain(spark):
    assert Table(spark.range(1), "k").key == "k"
