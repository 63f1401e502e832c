"""Layouts for lookups: Z-order, Bloom filters, batches, counts of the writing job."""

import random

from pyspark.sql import functions as F

from reelframe import registry
from reelframe.operators import cleaning
from reelframe.sources import layout, sinks
from reelframe.sources.catalog import Catalog
from reelframe.sources.raw_views import RawCatalog
from tests.conftest import SF_SMALL


def scanned_rows(df) -> int:
    """Rows that the scan of a collected one-scan plan gave out."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().get("numOutputRows").get().value()


def test_keys_interleave_the_bits_of_the_ranks(spark):
    rnd = random.Random(1)
    rows = [(rnd.random(), rnd.randrange(1000), None if i % 50 == 0 else -rnd.random()) for i in range(640)]
    df = spark.createDataFrame(rows, "a double, b int, c double")
    cuts = {c: v for c, v in layout.quantile_cuts(df, ["a", "b", "c"], 3).first().asDict().items()}
    for r in layout.with_zkey(df, ["a", "b", "c"], 3).collect():
        want = 0
        for j, c in enumerate("abc"):
            rank = 0 if r[c] is None else sum(x <= r[c] for x in cuts[c])
            want |= sum(((rank >> i) & 1) << (3 * i + j) for i in range(3))
        assert r._z == want
    assert layout.with_zkey(df.limit(0), ["a"]).count() == 0
    assert layout.with_zkey(df.select(F.lit(None).cast("int").alias("a")), ["a"]).agg(F.max("_z")).first()[0] == 0


def test_zorder_skips_files_on_every_column(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(i, rnd.random(), rnd.random(), rnd.random()) for i in range(4000)],
                               "id long, a double, b double, c double").repartition(3)
    root = registry.scratch(spark, "z")
    layout.write_zorder(df, f"{root}/z", ["a", "b", "c"], 27)
    sinks.write_layout(df, f"{root}/s", sort_by=["a"], num_files=27)
    for c in "abc":
        bounds = {c: (0.0, 0.2)}
        read = {k: layout.files_to_read(layout.file_ranges(spark.read.parquet(f"{root}/{k}"), ["a", "b", "c"]), bounds).first()
                for k in "zs"}
        assert read["z"].files == 27 and read["z"].files_read <= 16
        if c != "a":
            assert read["s"].files_read == 27
        # the scan itself skips them: fewer rows leave it, and the answer is whole
        found = spark.read.parquet(f"{root}/z").where(F.col(c).between(0.0, 0.2))
        assert scanned_rows(found) < 4000 * 0.7
        assert found.count() == df.where(F.col(c).between(0.0, 0.2)).count()
    narrow = {c: (0.1, 0.2) for c in "abc"}
    ranges = layout.file_ranges(spark.read.parquet(f"{root}/z"), ["a", "b", "c"])
    assert layout.files_to_read(ranges, narrow).first().files_read <= 9


def test_bloom_filters_skip_row_groups(spark):
    films = registry._films(Catalog(spark, SF_SMALL)).repartition(8)
    root = registry.scratch(spark, "bloom")
    sinks.write_layout(films, f"{root}/with", bloom={"title": 5000, "movie_id": 5000})
    sinks.write_layout(films, f"{root}/without")
    total = films.count()
    for column, present, absent in (("title", "Order 7", "no such"), ("movie_id", 7, -7)):
        stored = spark.read.parquet(f"{root}/with")
        hit, miss = stored.where(F.col(column) == present), stored.where(F.col(column) == absent)
        assert scanned_rows(miss) == 0 and miss.count() == 0
        assert scanned_rows(hit) <= total / 4 and hit.count() == 1
    assert scanned_rows(spark.read.parquet(f"{root}/without").where("title = 'Order 70x'")) == total


def test_a_batch_written_twice_leaves_one_copy(spark):
    root = registry.scratch(spark, "batch")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    sinks.append_batch(df, root, "t", "one")
    sinks.append_batch(df.limit(1), root, "t", "two")
    sinks.append_batch(df, root, "t", "one")
    rows = spark.read.parquet(sinks.table_path(root, "t"))
    assert sorted((r.batch_id, r.id) for r in rows.collect()) == [("one", 1), ("one", 2), ("two", 1)]


def test_counts_of_the_writing_job_equal_the_report(spark):
    raw = RawCatalog(Catalog(spark, SF_SMALL))
    tables = {n: raw.table(n) for n in ("ratings", "characters", "persons")}
    seen = {}
    cleaning.load_tables(tables, registry.scratch(spark, "seen"), observed=seen)
    got = {(r.table_name, r.reason): r.rows for r in cleaning.observed_report(spark, seen).collect()}
    for r in cleaning.load_report(tables).collect():
        assert (got[r.table_name, "read"], got[r.table_name, "kept"]) == (r.rows_read, r.rows_kept)
    dropped = {(r.table_name, r.reject_reason): r["count"] for r in cleaning.quarantine(tables).groupBy(
        "table_name", "reject_reason").count().collect()}
    assert {k: v for k, v in got.items() if k[1] not in ("read", "kept")} == dropped


def test_valid_rows_are_the_tagged_ones(spark):
    raw = RawCatalog(Catalog(spark, SF_SMALL))
    for name in cleaning.PRIMARY_KEYS:
        df = raw.table(name)
        tagged = cleaning.tag_rows(name, df)
        key = lambda d: sorted(map(str, d.collect()))
        assert key(cleaning.valid_rows(name, df)) == key(tagged.where("reject_reason IS NULL").drop("reject_reason"))


def test_repeated_rows_in_steps(spark, monkeypatch):
    monkeypatch.setattr(cleaning, "REPEATED", 4)
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 4), ("d", 11)], "k string, n int")
    counts = {r.k: r["count"] for r in cleaning._repeat(df, F.col("n")).groupBy("k").count().collect()}
    assert counts == {"b": 1, "c": 4, "d": 11}
