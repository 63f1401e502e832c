"""Sinks, layout writer, CSV inventory and the catalog load order."""

import warnings

from pyspark.sql import functions as F

from reelframe import registry
from reelframe.operators import cleaning
from reelframe.schema import LOAD_ORDER, SCHEMAS
from reelframe.sources import csv_ingest, sinks
from reelframe.sources.catalog import Catalog
from tests.conftest import SF_SMALL


def test_create_append_and_empty_tables(spark):
    root = registry.scratch(spark, "sinks")
    sinks.create_tables(spark, root, ["persons", "genres"])
    persons = spark.read.parquet(sinks.table_path(root, "persons"))
    assert persons.count() == 0
    assert [f.name for f in persons.schema.fields] == SCHEMAS["persons"].fieldNames()

    batch = spark.createDataFrame([("p1", "A", 1900, None), ("p2", "B", None, None)], SCHEMAS["persons"])
    sinks.append_table(batch, root, "persons")
    sinks.append_table(batch, root, "persons")
    assert spark.read.parquet(sinks.table_path(root, "persons")).count() == 4

    sinks.empty_tables(spark, root, ["persons", "genres"])
    emptied = spark.read.parquet(sinks.table_path(root, "persons"))
    assert emptied.count() == 0 and emptied.schema.fieldNames() == SCHEMAS["persons"].fieldNames()


def test_layout_writer_sorts_and_partitions(spark):
    cat = Catalog(spark, SF_SMALL)
    path = registry.scratch(spark, "layout")
    sinks.write_layout(cat.movies.withColumn("decade", F.col("start_year") - F.col("start_year") % 10),
                       path, sort_by=["primary_title"], partition_by=["decade"], num_files=4)
    back = spark.read.parquet(path)
    assert back.count() == cat.movies.count()
    assert sorted(r.decade for r in back.select("decade").distinct().collect()) == [1990, 2000]
    # every file holds a contiguous title range: min/max statistics can skip files
    ranges = (back.groupBy(F.input_file_name().alias("f"))
              .agg(F.min("primary_title").alias("lo"), F.max("primary_title").alias("hi"))
              .orderBy("lo").collect())
    for a, b in zip(ranges, ranges[1:]):
        if a.f.split("decade=")[1].split("/")[0] == b.f.split("decade=")[1].split("/")[0]:
            assert a.hi <= b.lo


def test_bucketed_tables_join_without_exchange(spark):
    cat = Catalog(spark, SF_SMALL)
    root = registry.scratch(spark, "buckets")
    sinks.write_bucketed(cat.genres, "genres_bucketed", "movie_id", 8, f"{root}/genres")
    sinks.write_bucketed(cat.ratings, "ratings_bucketed", "movie_id", 8, f"{root}/ratings")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("genres_bucketed").join(spark.table("ratings_bucketed"), "movie_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == cat.genres.join(cat.ratings, "movie_id").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_catalog_csv_load_order_and_missing_file_warning(spark):
    root = registry.scratch(spark, "csvdir")
    cat = Catalog(spark, SF_SMALL)
    csv_ingest.export_csv(cat.persons, f"{root}/persons.csv")
    csv_ingest.export_csv(cat.genres, f"{root}/genres.csv")
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        loaded = csv_ingest.read_catalog_csv(spark, root)
    assert list(loaded) == [t for t in LOAD_ORDER if t in ("persons", "genres")]
    assert len([w for w in caught if "not found" in str(w.message)]) == len(LOAD_ORDER) - 2
    assert loaded["persons"].count() == cat.persons.count()
    inventory = csv_ingest.file_inventory(spark, root)
    assert {r.table_name for r in inventory.collect()} == {"persons", "genres"}


def test_load_tables_writes_valid_and_rejected(spark):
    root = registry.scratch(spark, "load")
    raw = spark.createDataFrame([("r1", 0.5, 1), ("r2", 5.0, 2)], "movie_id string, average_rating double, num_votes bigint")
    stored = cleaning.load_tables({"ratings": raw}, root)
    assert [r.movie_id for r in stored["ratings"].collect()] == ["r2"]
    rejected = cleaning.stored_rows(spark, root, "ratings", "rejected").collect()
    assert [(r.movie_id, r.reject_reason) for r in rejected] == [("r1", "rating_out_of_range")]
