"""The nine catalog questions over the nested documents (``movies_complete``).

Differences from the relational form are kept on purpose: people are matched by
regular expression on any cast entry and grouped by *name* (homonyms merge,
unknown people merge as ``'Unknown'``); each film counts once per matching
document; Q5 filters good films before grouping; unrated films count with
``votes = 0`` and a null average.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelframe.functions import decade_floor, decade_label, name_matches


def _cast_matches(pattern: str):
    return F.exists("cast", lambda c: name_matches(c["name"], pattern))


def q1_filmography(docs: DataFrame, actor_name: str, limit: int = 100) -> DataFrame:
    return (docs.filter(_cast_matches(actor_name))
            .select("movie_id", "title", "year", "genres", "rating")
            .orderBy(F.desc("year"), "movie_id")
            .limit(limit))


def q2_top_films(docs: DataFrame, genre: str, year_start: int, year_end: int, n: int = 10) -> DataFrame:
    return (docs.filter(F.array_contains("genres", genre)
                        & F.col("year").between(year_start, year_end)
                        & (F.col("rating.votes") > 0))
            .orderBy(F.desc("rating.average"), F.desc("rating.votes"), "movie_id")
            .limit(n)
            .select("title", "year", "rating"))


def q3_multi_role(docs: DataFrame, limit: int = 100) -> DataFrame:
    roles = (docs.filter(F.size("cast") > 0)
             .select("title", F.explode("cast").alias("c"))
             .groupBy(F.col("c.name").alias("acteur"), F.col("title").alias("film"))
             .agg(F.sum(F.size("c.characters")).cast("bigint").alias("nombre_roles"))
             .filter(F.col("nombre_roles") > 1))
    return roles.orderBy(F.desc("nombre_roles"), "acteur", "film").limit(limit)


def q4_collaborations(docs: DataFrame, actor_name: str, limit: int = 50) -> DataFrame:
    return (docs.filter(_cast_matches(actor_name))
            .select(F.explode("directors").alias("d"))
            .groupBy(F.col("d.name").alias("realisateur"))
            .agg(F.count(F.lit(1)).alias("nombre_films"))
            .orderBy(F.desc("nombre_films"), "realisateur")
            .limit(limit))


def q5_popular_genres(docs: DataFrame, min_rating: float = 7.0, min_count: int = 50) -> DataFrame:
    return (docs.filter(F.col("rating.average") > min_rating)
            .select(F.explode("genres").alias("genre"), F.col("rating.average").alias("r"))
            .groupBy("genre")
            .agg(F.count(F.lit(1)).alias("nombre_films"), F.avg("r").alias("note_moyenne"))
            .filter(F.col("nombre_films") > min_count)
            .orderBy(F.desc("note_moyenne"), "genre")
            .select("genre", "note_moyenne", "nombre_films"))


def q6_career(docs: DataFrame, actor_name: str) -> DataFrame:
    return (docs.filter(_cast_matches(actor_name))
            .withColumn("decade", decade_floor("year"))
            .filter(F.col("decade") > 0)
            .groupBy("decade")
            .agg(F.count(F.lit(1)).alias("nombre_films"), F.avg("rating.average").alias("note_moyenne"))
            .orderBy("decade")
            .select(decade_label("decade").alias("decennie"), "nombre_films", "note_moyenne"))


def q7_top_per_genre(docs: DataFrame, top_n: int = 3, max_genres: int = 50) -> DataFrame:
    """Top ``n`` films per genre by rating (unrated last, ties by id), for the
    first ``max_genres`` genres by name; one row per (genre, position)."""
    rows = docs.select(F.explode("genres").alias("genre"), "movie_id", "title", "year",
                       F.col("rating.average").alias("rating"))
    # row_number <= n is cut before the shuffle (partial window limit) ...
    w = Window.partitionBy("genre").orderBy(F.desc_nulls_last("rating"), "movie_id")
    best = rows.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= top_n)
    # ... so a genre is a list of at most n films, of which the first genres are kept
    films = F.sort_array(F.collect_list(F.struct("position", "title", "year", "rating")))
    return (best.groupBy("genre").agg(films.alias("films"))
            .orderBy("genre").limit(max_genres)
            .select("genre", F.inline("films"))
            .orderBy("genre", "position")
            .select("genre", "position", "title", "year", "rating"))


def q8_breakthrough(docs: DataFrame, threshold_votes: int = 200000, min_films: int = 5,
                    limit: int = 50) -> DataFrame:
    t = threshold_votes
    per_name = (docs.filter(F.size("cast") > 0)
                .select(F.explode("cast.name").alias("acteur"), F.col("rating.votes").alias("votes"))
                .groupBy("acteur")
                .agg(F.count(F.lit(1)).alias("films_total"),
                     F.count_if(F.col("votes") > t).alias("blockbuster_films"),
                     F.max("votes").alias("max_votes")))
    return (per_name.filter((F.col("films_total") > min_films) & (F.col("blockbuster_films") > 0)
                            & (F.col("max_votes") > t))
            .orderBy(F.desc("max_votes"), "acteur")
            .limit(limit)
            .select("acteur", "films_total", "blockbuster_films", "max_votes"))


def q9_prolific_directors(docs: DataFrame, min_films: int = 10, limit: int = 30) -> DataFrame:
    return (docs.select(F.explode("directors.name").alias("realisateur"),
                        F.col("rating.average").alias("r"))
            .groupBy("realisateur")
            .agg(F.count(F.lit(1)).alias("nombre_films"), F.avg("r").alias("note_moyenne"),
                 F.min("r").alias("note_min"), F.max("r").alias("note_max"))
            .filter(F.col("nombre_films") >= min_films)
            .orderBy(F.desc("nombre_films"), "realisateur")
            .limit(limit))


def film_by_title(docs: DataFrame, title: str) -> DataFrame:
    """Point lookup of one whole document by title (first one by id)."""
    return docs.filter(F.col("title") == title).orderBy("movie_id").limit(1)
