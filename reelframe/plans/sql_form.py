"""The nine catalog questions over the normalised tables (relational form).

Semantics follow the relational formulation as written, including its
multiplicities: a person credited k times in a film repeats that film's genres
k times (Q1), the average of Q6 is over credit rows, Q7 re-joins qualifying
films to *all* their genres, Q8 duplicates a row per double credit, Q9 weighs
a film's rating by its number of genres.  Those multiplicities are produced from
pre-aggregated counts, never by materialising a fan-out join.

Ties at a LIMIT are broken by ids so that results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelframe.functions import dealt, decade_intdiv, decade_label, name_contains, repeat_each


def _matching_people(persons: DataFrame, actor_name: str) -> DataFrame:
    return persons.filter(name_contains("name", actor_name)).select("person_id")


def q1_filmography(movies: DataFrame, principals: DataFrame, persons: DataFrame,
                   genres: DataFrame, ratings: DataFrame, actor_name: str) -> DataFrame:
    """Films of every person whose name contains ``actor_name``.

    Output ``titre, annee, genres, note``; genres is the sorted ``', '`` list,
    each genre repeated once per matching credit row of the film; note is the
    rating as text or ``'N/A'``.  Rows equal on all four columns collapse.
    """
    credits = principals.join(_matching_people(persons, actor_name), "person_id", "left_semi")
    per_film = credits.groupBy("movie_id").agg(F.count(F.lit(1)).alias("k"))
    film_genres = (genres.join(per_film.select("movie_id"), "movie_id", "left_semi")
                   .groupBy("movie_id")
                   .agg(F.sort_array(F.collect_list("genre")).alias("genre_list")))
    rows = (per_film
            .join(movies.select("movie_id", "primary_title", "start_year"), "movie_id")
            .join(film_genres, "movie_id", "left")
            .join(ratings.select("movie_id", "average_rating"), "movie_id", "left"))
    return (rows.select(
                F.col("primary_title").alias("titre"),
                F.col("start_year").alias("annee"),
                F.array_join(repeat_each("genre_list", "k"), ", ").alias("genres"),
                F.coalesce(F.col("average_rating").cast("string"), F.lit("N/A")).alias("note"))
            .distinct()
            .orderBy(F.desc("annee"), "titre"))


def q2_top_films(movies: DataFrame, genres: DataFrame, ratings: DataFrame, genre: str,
                 year_start: int, year_end: int, n: int = 10) -> DataFrame:
    """Best-rated ``n`` films of a genre in a closed year range, with a row number."""
    order = [F.desc("average_rating"), F.desc("num_votes"), F.asc("movie_id")]
    candidates = (genres.filter(F.col("genre") == genre).select("movie_id")
                  .join(movies.filter(F.col("start_year").between(year_start, year_end))
                        .select("movie_id", "primary_title", "start_year"), "movie_id")
                  .join(ratings.filter(F.col("num_votes") > 0)
                        .select("movie_id", "average_rating", "num_votes"), "movie_id"))
    # top-k first (TakeOrderedAndProject), then number the n survivors
    top = candidates.orderBy(*order).limit(n)
    return (top.withColumn("rang", F.row_number().over(Window.orderBy(*order)))
            .select("rang", F.col("primary_title").alias("titre"), F.col("start_year").alias("annee"),
                    F.col("average_rating").alias("note"), F.col("num_votes").alias("votes"))
            .orderBy("rang"))


def q3_multi_role(characters: DataFrame, persons: DataFrame, movies: DataFrame) -> DataFrame:
    """People who played more than one distinct character in the same film."""
    # one shuffle by film serves the distinct count and the join to movies
    per_pair = (dealt(characters.select("movie_id", "person_id", "name"), "movie_id")
                .groupBy("movie_id", "person_id")
                .agg(F.count_distinct("name").alias("nombre_roles"))
                .filter(F.col("nombre_roles") > 1))
    return (per_pair
            .join(movies.select("movie_id", F.col("primary_title").alias("film")), "movie_id")
            .join(persons.select("person_id", F.col("name").alias("acteur")), "person_id")
            .orderBy(F.desc("nombre_roles"), "person_id", "movie_id")
            .select("acteur", "film", "nombre_roles"))


def q4_collaborations(directors: DataFrame, principals: DataFrame, persons: DataFrame,
                      actor_name: str) -> DataFrame:
    """Directors of the films of matching people, with their distinct film count."""
    films = principals.join(_matching_people(persons, actor_name), "person_id", "left_semi")
    per_director = (directors.join(films.select("movie_id"), "movie_id", "left_semi")
                    .groupBy("person_id")
                    .agg(F.count_distinct("movie_id").alias("nombre_films")))
    return (per_director
            .join(persons.select("person_id", F.col("name").alias("realisateur")), "person_id")
            .orderBy(F.desc("nombre_films"), "person_id")
            .select("realisateur", "nombre_films"))


def q5_popular_genres(genres: DataFrame, ratings: DataFrame, min_rating: float = 7.0,
                      min_count: int = 50) -> DataFrame:
    """Genres whose mean rating (unrounded) exceeds ``min_rating`` over more than
    ``min_count`` rated films; the mean is shown rounded to 2 places."""
    per_genre = (genres.join(ratings.select("movie_id", "average_rating"), "movie_id")
                 .groupBy("genre")
                 .agg(F.avg("average_rating").alias("mean_rating"),
                      F.count_distinct("movie_id").alias("nombre_films")))
    return (per_genre
            .filter((F.col("mean_rating") > min_rating) & (F.col("nombre_films") > min_count))
            .select("genre", F.round("mean_rating", 2).alias("note_moyenne"), "nombre_films")
            .orderBy(F.desc("note_moyenne"), "genre"))


def q6_career(movies: DataFrame, principals: DataFrame, persons: DataFrame, ratings: DataFrame,
              actor_name: str) -> DataFrame:
    """Distinct films and mean rating per decade (integer-division decade > 0).

    The mean is over credit rows, so a double credit weighs double."""
    credits = (principals.join(_matching_people(persons, actor_name), "person_id", "left_semi")
               .select("movie_id"))
    rows = (credits
            .join(movies.select("movie_id", "start_year"), "movie_id")
            .join(ratings.select("movie_id", "average_rating"), "movie_id", "left")
            .withColumn("decade", decade_intdiv("start_year"))
            .filter(F.col("decade") > 0))
    return (rows.groupBy("decade")
            .agg(F.count_distinct("movie_id").alias("nombre_films"),
                 F.round(F.avg("average_rating"), 2).alias("note_moyenne"))
            .select(decade_label("decade").alias("decennie"), "nombre_films", "note_moyenne")
            .orderBy("decennie"))


def _ranks(rows: DataFrame, weight) -> DataFrame:
    """(genre, average_rating, rk): RANK by descending rating within a genre.

    Rows are counted per (genre, rating); a rating's rank is one more than the rows
    with higher ratings.  The window runs over distinct ratings, not over films, so
    neither a genre with most of the films nor a tie of most of them meets in one task."""
    counts = rows.groupBy("genre", "average_rating").agg(F.sum(weight).alias("n"))
    higher = (Window.partitionBy("genre").orderBy(F.desc("average_rating"))
              .rowsBetween(Window.unboundedPreceding, -1))
    return counts.select("genre", "average_rating",
                         (F.coalesce(F.sum("n").over(higher), F.lit(0)) + 1).cast("int").alias("rk"))


def _with_rank(rows: DataFrame, ranks: DataFrame) -> DataFrame:
    r = ranks.withColumnRenamed("genre", "_g").withColumnRenamed("average_rating", "_r")
    return rows.join(r, rows.genre.eqNullSafe(r._g) & rows.average_rating.eqNullSafe(r._r)).drop("_g", "_r")


def _ranked_in_genre(genres: DataFrame, ratings: DataFrame, top_n: int) -> DataFrame:
    rows = genres.join(ratings.select("movie_id", "average_rating"), "movie_id")
    return _with_rank(rows, _ranks(rows, F.lit(1)).filter(F.col("rk") <= top_n))


def q7_top_per_genre(genres: DataFrame, ratings: DataFrame, movies: DataFrame,
                     top_n: int = 3) -> DataFrame:
    """As written: films ranked <= n in some genre are re-joined to all of their
    genres (one copy per genre they qualified in) and ranked again."""
    qualified = (_ranked_in_genre(genres, ratings, top_n)
                 .groupBy("movie_id").agg(F.count(F.lit(1)).alias("copies"),
                                          F.first("average_rating").alias("average_rating")))
    rows = genres.join(qualified, "movie_id")
    ranked = (_with_rank(rows, _ranks(rows, F.col("copies")))
              .join(movies.select("movie_id", "primary_title", "start_year"), "movie_id")
              .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))))
    return (ranked.orderBy("genre", "rk", "movie_id")
            .select("genre", F.col("rk").alias("rang"), F.col("primary_title").alias("titre"),
                    F.col("start_year").alias("annee"), F.col("average_rating").alias("note")))


def q7_top_per_genre_clean(genres: DataFrame, ratings: DataFrame, movies: DataFrame,
                           top_n: int = 3) -> DataFrame:
    """Rank <= n within each genre, ties kept, no re-join."""
    return (_ranked_in_genre(genres, ratings, top_n)
            .join(movies.select("movie_id", "primary_title", "start_year"), "movie_id")
            .orderBy("genre", "rk", "movie_id")
            .select("genre", F.col("rk").alias("rang"), F.col("primary_title").alias("titre"),
                    F.col("start_year").alias("annee"), F.col("average_rating").alias("note")))


def q8_breakthrough(principals: DataFrame, persons: DataFrame, ratings: DataFrame,
                    movies: DataFrame, threshold_votes: int = 200000, limit: int = 50) -> DataFrame:
    """People with films on both sides of a vote threshold, shown with the film(s)
    carrying their highest vote count above it (one row per credit), first ``limit`` rows.

    A person with such a film in ``movies`` gives at least one row, so the rows shown
    belong to the first ``limit`` of these people by that vote count: they are chosen
    first, and only their credits are looked up again."""
    t = threshold_votes
    votes = ratings.select("movie_id", "num_votes", "average_rating")
    # person-film pairs by film: the join, the pairs and the votes share one shuffle
    pairs = (dealt(principals.select("movie_id", "person_id"), "movie_id").join(votes.select("movie_id", "num_votes"), "movie_id")
             .groupBy("movie_id", "person_id").agg(F.first("num_votes").alias("num_votes")))
    career = (pairs.groupBy("person_id")
              .agg(F.count_if(F.col("num_votes") <= t).alias("films_avant"),
                   F.count_if(F.col("num_votes") > t).alias("films_apres"),
                   F.max(F.when(F.col("num_votes") > t, F.col("num_votes"))).alias("best"))
              .filter((F.col("films_avant") > 0) & (F.col("films_apres") > 0))
              .join(persons.select("person_id", F.col("name").alias("acteur")), "person_id"))
    # a rating may lack its film; only a best film that has one gives a row
    titled = (pairs.where(F.col("num_votes") > t).join(movies.select("movie_id"), "movie_id", "left_semi")
              .select("person_id", F.col("num_votes").alias("best")))
    top = career.join(titled, ["person_id", "best"], "left_semi").orderBy(F.desc("best"), "person_id").limit(limit)
    # at most ``limit`` people: broadcast
    credits = principals.select("movie_id", "person_id").join(F.broadcast(top), "person_id")
    # joined by film alone, so that the look-ups of votes and title share one shuffle
    hits = (credits.join(votes, "movie_id").filter(F.col("best") - F.col("num_votes") == 0)
            .join(movies.select("movie_id", F.col("primary_title").alias("film_percee")), "movie_id"))
    return (hits.orderBy(F.desc("num_votes"), "person_id", "movie_id")
            .limit(limit)
            .select("acteur", "films_avant", "films_apres", "film_percee",
                    F.col("num_votes").alias("votes_film"), F.col("average_rating").alias("note_film")))


def q9_prolific_directors(directors: DataFrame, persons: DataFrame, movies: DataFrame,
                          ratings: DataFrame, genres: DataFrame, min_films: int = 10,
                          limit: int = 30) -> DataFrame:
    """Directors with at least ``min_films`` rated films, first ``limit`` by film count.

    The mean rating is over the genre fan-out of the relational form (a film weighs by
    its number of genres, at least 1), computed as a weighted mean.  One pass over the
    films: every director-film pair gives a row without a genre, which carries the
    figures, and a row per genre; a director's distinct genres are then the groups
    of the rows that have one."""
    shelves = genres.groupBy("movie_id").agg(F.count(F.lit(1)).alias("n"), F.collect_list("genre").alias("g"))
    # one shuffle by film serves the pairs and the joins
    pairs = (directors.select("movie_id", "person_id").repartition("movie_id")
             .groupBy("movie_id", "person_id").agg(F.count(F.lit(1)).alias("k"))
             .join(movies.select("movie_id"), "movie_id", "left_semi")
             .join(ratings.select("movie_id", F.col("average_rating").alias("r")), "movie_id")
             .join(shelves, "movie_id", "left"))
    weight = F.greatest(F.coalesce(F.col("n"), F.lit(0)), F.lit(1)) * F.col("k")
    no_genre = F.array(F.lit(None).cast("string"))
    rows = pairs.select("person_id", "r", weight.alias("w"),
                        F.explode(F.concat(no_genre, F.coalesce("g", F.array().cast("array<string>")))).alias("genre"))
    groups = rows.groupBy("person_id", "genre").agg(
        F.count(F.lit(1)).alias("films"), F.sum(F.col("r") * F.col("w")).alias("total"), F.sum("w").alias("w"),
        F.min("r").alias("low"), F.max("r").alias("high"))
    figures = F.col("genre").isNull()
    per = groups.groupBy("person_id").agg(
        *[F.max(F.when(figures, F.col(c))).alias(c) for c in ("films", "total", "w", "low", "high")],
        F.count_if(~figures).alias("genres_explores"))
    return (per.filter(F.col("films") >= min_films)
            .join(persons.select("person_id", F.col("name").alias("realisateur")), "person_id")
            .orderBy(F.desc("films"), "person_id").limit(limit)
            .select("realisateur", F.col("films").alias("nombre_films"),
                    F.round(F.col("total") / F.col("w"), 2).alias("note_moyenne"),
                    F.round("low", 2).alias("note_min"),
                    F.round("high", 2).alias("note_max"), "genres_explores"))
