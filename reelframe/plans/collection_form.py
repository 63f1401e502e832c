"""The nine catalog questions over flat document collections (one collection per
table, joined by lookups).

A lookup followed by an unwind is an inner join with multiplicity, so these
forms count *rows* where the relational form counts distinct films: double
credits and several matching people inflate counts (Q4, Q6, Q8, Q9), genre
lists stay arrays (Q1, Q9).  Where the source had no sort before a slice
(Q7), a fixed order by id is imposed so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelframe.functions import decade_floor, decade_label, name_matches


def _matching_credits(persons: DataFrame, principals: DataFrame, actor_name: str) -> DataFrame:
    people = persons.filter(name_matches("name", actor_name)).select("person_id")
    return principals.join(people, "person_id", "left_semi")


def q1_filmography(persons: DataFrame, principals: DataFrame, movies: DataFrame,
                   genres: DataFrame, ratings: DataFrame, actor_name: str,
                   limit: int = 100) -> DataFrame:
    """``genres`` is an array of arrays: the film's genre list once per matching
    credit row; ``note`` is null when unrated."""
    per_film = (_matching_credits(persons, principals, actor_name)
                .groupBy("movie_id").agg(F.count(F.lit(1)).alias("k")))
    lists = (genres.join(per_film.select("movie_id"), "movie_id", "left_semi")
             .groupBy("movie_id").agg(F.sort_array(F.collect_list("genre")).alias("genre_list")))
    return (per_film
            .join(movies.select("movie_id", "primary_title", "start_year"), "movie_id")
            .join(lists, "movie_id", "left")
            .join(ratings.select("movie_id", "average_rating"), "movie_id", "left")
            .select("movie_id", F.col("primary_title").alias("titre"), F.col("start_year").alias("annee"),
                    F.array_repeat(F.coalesce("genre_list", F.array().cast("array<string>")),
                                   F.col("k").cast("int")).alias("genres"),
                    F.col("average_rating").alias("note"))
            .orderBy(F.desc("annee"), "movie_id")
            .limit(limit))


def q2_top_films(genres: DataFrame, movies: DataFrame, ratings: DataFrame, genre: str,
                 year_start: int, year_end: int, n: int = 10) -> DataFrame:
    return (genres.filter(F.col("genre") == genre).select("movie_id")
            .join(movies.filter(F.col("start_year").between(year_start, year_end))
                  .select("movie_id", "primary_title", "start_year"), "movie_id")
            .join(ratings.filter(F.col("num_votes") > 0)
                  .select("movie_id", "average_rating", "num_votes"), "movie_id")
            .orderBy(F.desc("average_rating"), F.desc("num_votes"), "movie_id")
            .limit(n)
            .select(F.col("primary_title").alias("titre"), F.col("start_year").alias("annee"),
                    F.col("average_rating").alias("note"), F.col("num_votes").alias("votes")))


def q3_multi_role(characters: DataFrame, persons: DataFrame, movies: DataFrame,
                  limit: int = 100) -> DataFrame:
    """Character *rows* per (person, film) > 1."""
    return (characters.groupBy("person_id", "movie_id").agg(F.count(F.lit(1)).alias("nombre_roles"))
            .filter(F.col("nombre_roles") > 1)
            .join(persons.select("person_id", F.col("name").alias("acteur")), "person_id")
            .join(movies.select("movie_id", F.col("primary_title").alias("film")), "movie_id")
            .orderBy(F.desc("nombre_roles"), "person_id", "movie_id")
            .limit(limit)
            .select("acteur", "film", "nombre_roles"))


def q4_collaborations(persons: DataFrame, principals: DataFrame, directors: DataFrame,
                      actor_name: str, limit: int = 50) -> DataFrame:
    """Rows of (matching credit x director of that film), counted per director.

    Computed as ``sum(k)`` with k = matching credit rows per film, which equals
    the row count of the unwound lookups without materialising them."""
    per_film = (_matching_credits(persons, principals, actor_name)
                .groupBy("movie_id").agg(F.count(F.lit(1)).alias("k")))
    return (directors.join(per_film, "movie_id")
            .groupBy("person_id").agg(F.sum("k").alias("nombre_films"))
            .join(persons.select("person_id", F.col("name").alias("realisateur")), "person_id")
            .orderBy(F.desc("nombre_films"), "person_id")
            .limit(limit)
            .select("realisateur", "nombre_films"))


def q5_popular_genres(genres: DataFrame, ratings: DataFrame, min_rating: float = 7.0,
                      min_count: int = 50) -> DataFrame:
    return (genres.join(ratings.select("movie_id", "average_rating"), "movie_id")
            .groupBy("genre")
            .agg(F.avg("average_rating").alias("note_moyenne"), F.count(F.lit(1)).alias("nombre_films"))
            .filter((F.col("note_moyenne") > min_rating) & (F.col("nombre_films") > min_count))
            .orderBy(F.desc("note_moyenne"), "genre")
            .select("genre", "note_moyenne", "nombre_films"))


def q6_career(persons: DataFrame, principals: DataFrame, movies: DataFrame, ratings: DataFrame,
              actor_name: str) -> DataFrame:
    """Credit rows and their mean rating per floor decade (> 0)."""
    return (_matching_credits(persons, principals, actor_name).select("movie_id")
            .join(movies.select("movie_id", "start_year"), "movie_id")
            .join(ratings.select("movie_id", "average_rating"), "movie_id", "left")
            .withColumn("decade", decade_floor("start_year"))
            .filter(F.col("decade") > 0)
            .groupBy("decade")
            .agg(F.count(F.lit(1)).alias("nombre_films"), F.avg("average_rating").alias("note_moyenne"))
            .orderBy("decade")
            .select(decade_label("decade").alias("decennie"), "nombre_films", "note_moyenne"))


def q7_top_per_genre(genres: DataFrame, movies: DataFrame, ratings: DataFrame, top_n: int = 3,
                     max_genres: int = 50) -> DataFrame:
    """First ``n`` rated films per genre in id order (the source slices an
    unsorted push), for the first ``max_genres`` genres by name."""
    rows = (genres.join(movies.select("movie_id", "primary_title", "start_year"), "movie_id")
            .join(ratings.select("movie_id", "average_rating"), "movie_id"))
    w = Window.partitionBy("genre").orderBy("movie_id")
    # cut each genre to n films before the shuffle (partial window limit), then keep
    # the first genres of that small result
    best = rows.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= top_n)
    films = F.sort_array(F.collect_list(F.struct("position", "primary_title", "start_year", "average_rating")))
    return (best.groupBy("genre").agg(films.alias("films"))
            .orderBy("genre").limit(max_genres)
            .select("genre", F.inline("films"))
            .orderBy("genre", "position")
            .select("genre", "position", F.col("primary_title").alias("titre"),
                    F.col("start_year").alias("annee"), F.col("average_rating").alias("note")))


def q8_breakthrough(persons: DataFrame, principals: DataFrame, ratings: DataFrame,
                    threshold_votes: int = 200000, limit: int = 50) -> DataFrame:
    t = threshold_votes
    votes = F.col("num_votes")
    rows = (principals.select("person_id", "movie_id")
            .join(ratings.select("movie_id", "num_votes", "average_rating"), "movie_id"))
    per_person = (rows.groupBy("person_id")
                  .agg(F.count_if(votes <= t).alias("films_avant"),
                       F.count_if(votes > t).alias("films_apres"),
                       F.max(votes).alias("max_votes"),
                       F.max(F.when(votes > t, F.col("average_rating")).otherwise(F.lit(0.0)))
                       .alias("max_note")))
    return (per_person.filter((F.col("films_avant") > 0) & (F.col("films_apres") > 0)
                              & (F.col("max_votes") > t))
            .join(persons.select("person_id", F.col("name").alias("acteur")), "person_id")
            .orderBy(F.desc("max_votes"), "person_id")
            .limit(limit)
            .select("person_id", "acteur", "films_avant", "films_apres", "max_votes", "max_note"))


def q9_prolific_directors(directors: DataFrame, movies: DataFrame, persons: DataFrame,
                          ratings: DataFrame, genres: DataFrame, min_films: int = 10,
                          limit: int = 30) -> DataFrame:
    """Director rows with their film's rating; ``genres_explores`` sums the sizes
    of the films' genre arrays (not distinct genres)."""
    genre_counts = genres.groupBy("movie_id").agg(F.count(F.lit(1)).alias("n_genres"))
    rows = (directors.select("movie_id", "person_id")
            .join(movies.select("movie_id"), "movie_id", "left_semi")
            .join(ratings.select("movie_id", "average_rating"), "movie_id")
            .join(genre_counts, "movie_id", "left"))
    return (rows.groupBy("person_id")
            .agg(F.count(F.lit(1)).alias("nombre_films"),
                 F.avg("average_rating").alias("note_moyenne"),
                 F.min("average_rating").alias("note_min"),
                 F.max("average_rating").alias("note_max"),
                 F.coalesce(F.sum("n_genres"), F.lit(0)).cast("bigint").alias("genres_explores"))
            .filter(F.col("nombre_films") >= min_films)
            .join(persons.select("person_id", F.col("name").alias("realisateur")), "person_id")
            .orderBy(F.desc("nombre_films"), "person_id")
            .limit(limit)
            .select("realisateur", "nombre_films", "note_moyenne", "note_min", "note_max",
                    "genres_explores"))
