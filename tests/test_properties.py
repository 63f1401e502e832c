"""Cross-formulation properties on the driver's smallest tables."""

import pytest
from pyspark.sql import functions as F

from reelframe import registry
from reelframe.operators import transfer
from reelframe.oracle import PARAMS as P
from reelframe.plans import collection_form as C
from reelframe.plans import film
from reelframe.plans import nested_form as N
from reelframe.plans import sql_form as S
from reelframe.sources.catalog import Catalog, StoredCatalog
from tests.conftest import SF_SMALL, rows


@pytest.fixture(scope="module")
def cat(spark):
    return Catalog(spark, SF_SMALL)


def test_q2_same_films_in_all_forms(cat):
    y0, y1 = P["q2_years"]
    sql = S.q2_top_films(cat.movies, cat.genres, cat.ratings, P["q2_genre"], y0, y1, 10)
    pipe = C.q2_top_films(cat.genres, cat.movies, cat.ratings, P["q2_genre"], y0, y1, 10)
    nest = N.q2_top_films(cat.docs, P["q2_genre"], y0, y1, 10)
    expected = [r.titre for r in sql.collect()]
    assert expected
    assert [r.titre for r in pipe.collect()] == expected
    assert [r.title for r in nest.collect()] == expected


def test_q3_relational_top_equals_collection_form(cat):
    # characters are distinct per (film, person, name), so row counts equal distinct names
    sql = S.q3_multi_role(cat.characters, cat.persons, cat.movies).limit(100)
    pipe = C.q3_multi_role(cat.characters, cat.persons, cat.movies)
    assert rows(sql) == rows(pipe)


def test_full_film_flat_equals_nested(cat):
    flat = film.film_full_flat(cat.movies, cat.ratings, cat.genres, cat.persons, cat.directors,
                               cat.principals, cat.characters, cat.writers, P["film_title"])
    nested = film.film_full_nested(cat.docs, P["film_title"])
    cmp = film.compare_documents(flat, nested).first()
    assert (cmp.flat_only, cmp.nested_only, cmp.same) == (0, 0, True)
    assert flat.count() == 1


def test_nested_genres_round_trip(cat):
    exploded = cat.docs.select("movie_id", F.explode("genres").alias("genre"))
    known = cat.genres.join(cat.movies.select("movie_id"), "movie_id", "left_semi")
    assert exploded.exceptAll(known).count() == 0
    assert known.exceptAll(exploded).count() == 0


def test_cast_sizes_equal_distinct_credits(cat):
    cast_total = cat.docs.agg(F.sum(F.size("cast"))).first()[0]
    credits = (cat.principals.join(cat.movies.select("movie_id"), "movie_id", "left_semi")
               .select("movie_id", "person_id").distinct().count())
    assert cast_total == credits


def test_every_movie_has_one_document(cat):
    assert cat.docs.count() == cat.movies.count()
    assert cat.docs.select("movie_id").distinct().count() == cat.movies.count()


def test_stored_catalog_gives_the_same_answers(spark, cat):
    stored = StoredCatalog.materialize(cat, registry.scratch(spark, "stored-test"))
    for key in ["q1_sql", "q4_pipe", "q9_nest", "q7_sql"]:
        fn = registry.questions()[key]
        assert rows(fn(stored)) == rows(fn(cat)), key


def test_copy_verify_detects_a_short_copy(spark, cat):
    source = {"genres": cat.genres, "ratings": cat.ratings}
    target = {"genres": cat.genres.limit(10), "ratings": cat.ratings}
    got = {r.table_name: (r.match, r.all_match) for r in transfer.copy_verify(source, target).collect()}
    assert got == {"genres": (False, False), "ratings": (True, False)}


def test_gain_ratio(spark):
    m = spark.createDataFrame([("q1", "flat", 100.0), ("q1", "nested", 25.0), ("q2", "flat", 0.0),
                               ("q2", "nested", 5.0)], "item string, variant string, value double")
    got = {r.item: (r.ratio, r.gain_pct) for r in transfer.gain(m, "flat", "nested").collect()}
    assert got == {"q1": (4.0, 75.0), "q2": (0.0, None)}


def test_answers_do_not_change_when_aqe_splits_skewed_partitions(spark, cat):
    """Force AQE's skew-join splitting and partition coalescing to kick in on tiny
    data (every partition counts as skewed); answers must not change."""
    keys = ["q1_sql", "q4_pipe", "q8_sql", "q9_sql", "q7_sql", "q3_nest", "q8_nest"]
    expected = {k: rows(registry.questions()[k](cat)) for k in keys}
    forced = {
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "17",
    }
    saved = {k: spark.conf.get(k, None) for k in forced}
    try:
        for k, v in forced.items():
            spark.conf.set(k, v)
        fresh = Catalog(spark, SF_SMALL)
        for k in keys:
            assert rows(registry.questions()[k](fresh)) == expected[k], k
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
