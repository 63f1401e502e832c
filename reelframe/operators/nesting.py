"""Nested documents per title (``movies_complete``) and document rendering.

Document schema::

    movie_id, title, year, runtime,
    rating struct<average, votes>                       -- {null, 0} when unrated
    genres array<string>                                -- sorted, [] when none
    directors array<struct<person_id, name>>            -- sorted by person_id
    cast array<struct<person_id, name, characters array<string>>>
                                                        -- one entry per (title, person),
                                                        -- billing order, characters sorted
    writers array<struct<person_id, name>>              -- sorted by person_id

Unknown people are named ``'Unknown'``; a character is attached only when its
(title, person) pair is credited.

Plan shape: credits and characters are dealt by ``movie_id`` and grouped by (title,
person); with directors and writers they are joined to ``persons`` once; then title
rows, rating rows, genre rows and people rows, all dealt by ``movie_id``, are unioned
and grouped by it.  There is one document per title, whatever the data; a document is
one value, so its credits bound a row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelframe.functions import dealt

UNKNOWN = "Unknown"


def _cast(principals: DataFrame, characters: DataFrame) -> DataFrame:
    """One row per credited (title, person): first billing and sorted characters."""
    no_name = F.lit(None).cast("string")
    no_order = F.lit(None).cast(principals.schema["ordering"].dataType)
    credits = (principals.select("movie_id", "person_id", F.lit(1).alias("credit"), "ordering", no_name.alias("name"))
               .unionByName(characters.where("movie_id IS NOT NULL AND person_id IS NOT NULL").select(
                   "movie_id", "person_id", F.lit(0).alias("credit"), no_order.alias("ordering"), "name")))
    return (dealt(credits, "movie_id").groupBy("movie_id", "person_id")
            .agg(F.max("credit").alias("credit"), F.min("ordering").alias("ordering"),
                 F.sort_array(F.collect_list("name")).alias("characters"))
            .where("credit = 1").drop("credit"))


def _people(persons: DataFrame, directors: DataFrame, principals: DataFrame,
            characters: DataFrame, writers: DataFrame) -> DataFrame:
    """One row per people entry: (movie_id, role, ordering, person_id, name, characters)."""
    roles = _cast(principals, characters).withColumn("role", F.lit("c"))
    for role, df in (("d", directors), ("w", writers)):
        roles = roles.unionByName(dealt(df.select("movie_id", "person_id"), "movie_id").select(
            "movie_id", "person_id", F.lit(None).cast(principals.schema["ordering"].dataType).alias("ordering"),
            F.lit(None).cast("array<string>").alias("characters"), F.lit(role).alias("role")))
    return (roles.join(persons.select("person_id", "name"), "person_id", "left")
            .withColumn("name", F.coalesce(F.col("name"), F.lit(UNKNOWN))))


def build_documents(movies: DataFrame, ratings: DataFrame, genres: DataFrame,
                    persons: DataFrame, directors: DataFrame, principals: DataFrame,
                    characters: DataFrame, writers: DataFrame) -> DataFrame:
    id_type = movies.schema["movie_id"].dataType
    votes_type = ratings.schema["num_votes"].dataType
    runtime = (F.col("runtime_minutes").cast("int") if "runtime_minutes" in movies.columns
               else F.lit(None).cast("int"))
    people = _people(persons, directors, principals, characters, writers)

    # every list of a document is a part of one list of (role, ordering, person_id, name, characters)
    parts = ["role", "ordering", "person_id", "name", "characters"]
    people = people.select("movie_id", F.struct(*parts).alias("entry"))
    entry_type = people.schema["entry"].dataType
    shelf = F.struct(*[c.cast(entry_type[n].dataType).alias(n) for n, c in zip(
        parts, [F.lit("g"), F.lit(None), F.lit(None), F.col("genre"), F.lit(None)])])
    empty = {
        "title": F.lit(None).cast("string"), "year": F.lit(None).cast(movies.schema["start_year"].dataType),
        "runtime": F.lit(None).cast("int"), "average": F.lit(None).cast("double"),
        "votes": F.lit(None).cast(votes_type), "entry": F.lit(None).cast(entry_type),
    }

    def tagged(df: DataFrame, is_title: int = 0, **cols: Column) -> DataFrame:
        fields = {**empty, **cols}
        return df.select(F.col("movie_id"), F.lit(is_title).alias("is_title"),
                         *[c.alias(n) for n, c in fields.items()])

    long = (tagged(dealt(movies.select("movie_id", F.col("primary_title").alias("t"),
                                       F.col("start_year").alias("y"), runtime.alias("rt")), "movie_id"),
                   1, title=F.col("t"), year=F.col("y"), runtime=F.col("rt"))
            .unionByName(tagged(dealt(ratings.select("movie_id", "average_rating", "num_votes"), "movie_id"),
                                average=F.col("average_rating").cast("double"), votes=F.col("num_votes")))
            .unionByName(tagged(dealt(genres.where(F.col("genre").isNotNull()).select("movie_id", "genre"), "movie_id"),
                                entry=shelf))
            .unionByName(tagged(people, entry=F.col("entry"))))

    docs = (long.groupBy("movie_id").agg(
        F.max("is_title").alias("_titles"),
        F.max("title").alias("title"), F.max("year").alias("year"), F.max("runtime").alias("runtime"),
        F.max("average").alias("average"), F.max("votes").alias("votes"),
        F.sort_array(F.collect_list("entry")).alias("entries"))
        .filter(F.col("_titles") > 0))  # documents exist for titles only

    def listed(role: str, shape: Callable[[Column], Column]) -> Column:
        return F.transform(F.filter("entries", lambda e: e["role"] == role), shape)

    def person(e: Column) -> Column:
        return F.struct(e["person_id"].alias("person_id"), e["name"].alias("name"))

    return docs.select(
        F.col("movie_id").cast(id_type).alias("movie_id"),
        "title", "year", "runtime",
        F.struct(F.col("average"), F.coalesce(F.col("votes"), F.lit(0).cast(votes_type)).alias("votes"))
        .alias("rating"),
        listed("g", lambda e: e["name"]).alias("genres"), listed("d", person).alias("directors"),
        listed("c", lambda e: F.struct(
            e["person_id"].alias("person_id"), e["name"].alias("name"),
            e["characters"].alias("characters"))).alias("cast"),
        listed("w", person).alias("writers"),
    )


def build_from_catalog(cat) -> DataFrame:
    return build_documents(cat.movies, cat.ratings, cat.genres, cat.persons, cat.directors,
                           cat.principals, cat.characters, cat.writers)


def render_people(col: str) -> Column:
    """``[{1, A}, {2, B}]`` -> ``'1:A; 2:B'``."""
    return F.array_join(F.transform(col, lambda p: F.concat(
        p["person_id"].cast("string"), F.lit(":"), p["name"])), "; ")


def render_cast(col: str = "cast") -> Column:
    """``[{1, A, [x, y]}]`` -> ``'1:A[x|y]'``."""
    return F.array_join(F.transform(col, lambda p: F.concat(
        p["person_id"].cast("string"), F.lit(":"), p["name"], F.lit("["),
        F.array_join(p["characters"], "|"), F.lit("]"))), "; ")


def render_documents(docs: DataFrame) -> DataFrame:
    """Flatten documents to text columns with a fixed order (for comparison/export)."""
    return docs.select(
        "movie_id", "title", "year", "runtime",
        F.col("rating.average").alias("rating_average"),
        F.col("rating.votes").alias("rating_votes"),
        F.array_join("genres", ", ").alias("genres"),
        render_people("directors").alias("directors"),
        render_cast("cast").alias("cast"),
        render_people("writers").alias("writers"),
    )


def sample_document(docs: DataFrame, min_votes: int = 1_000_000) -> DataFrame:
    """The first title (by id) with more than ``min_votes`` votes, with its first
    three genres and the number of directors, cast and writers."""
    return (docs.filter(F.col("rating.votes") > min_votes)
            .select("movie_id", "title", "year",
                    F.col("rating.average").alias("rating_average"),
                    F.col("rating.votes").alias("rating_votes"),
                    F.array_join(F.slice("genres", 1, 3), ", ").alias("genres_first3"),
                    F.size("directors").alias("directors_count"), F.size("cast").alias("cast_count"),
                    F.size("writers").alias("writers_count"))
            .orderBy("movie_id").limit(1))
