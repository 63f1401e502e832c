"""Logical schema of the 12 catalog tables: types, keys, foreign keys, checks.

Ids are strings in the raw CSV catalog; the driver's derived views use bigint
ids.  Nothing in the library depends on the id type.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

S, I, D = T.StringType(), T.IntegerType(), T.DoubleType()


def _struct(*cols: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in cols])


# Table and column names, types and nullability (name, type, nullable).
SCHEMAS: dict[str, T.StructType] = {
    "persons": _struct(("person_id", S, False), ("name", S, False),
                       ("birth_year", I, True), ("death_year", I, True)),
    "movies": _struct(("movie_id", S, False), ("title_type", S, False),
                      ("primary_title", S, False), ("original_title", S, True),
                      ("is_adult", I, True), ("start_year", I, False),
                      ("end_year", I, True), ("runtime_minutes", I, True)),
    "ratings": _struct(("movie_id", S, False), ("average_rating", D, False),
                       ("num_votes", I, False)),
    "genres": _struct(("movie_id", S, False), ("genre", S, False)),
    "titles": _struct(("movie_id", S, False), ("ordering", I, False), ("title", S, False),
                      ("region", S, True), ("language", S, True), ("types", S, True),
                      ("attributes", S, True), ("is_original_title", I, True)),
    "professions": _struct(("person_id", S, False), ("job_name", S, False)),
    "principals": _struct(("movie_id", S, False), ("ordering", I, False),
                          ("person_id", S, False), ("category", S, False), ("job", S, True)),
    "directors": _struct(("movie_id", S, False), ("person_id", S, False)),
    "writers": _struct(("movie_id", S, False), ("person_id", S, False)),
    "characters": _struct(("movie_id", S, False), ("person_id", S, False), ("name", S, False)),
    "knownformovies": _struct(("person_id", S, False), ("movie_id", S, False)),
    "episodes": _struct(("movie_id", S, False), ("parent_movie_id", S, False),
                        ("season_number", I, False), ("episode_number", I, False)),
}

# Parent-first load order (children after the tables they reference).
LOAD_ORDER = [
    "persons", "movies", "ratings", "titles", "episodes", "genres",
    "professions", "principals", "directors", "writers", "characters", "knownformovies",
]

# Declared primary keys.
PRIMARY_KEYS: dict[str, list[str]] = {
    "persons": ["person_id"],
    "movies": ["movie_id"],
    "ratings": ["movie_id"],
    "genres": ["movie_id", "genre"],
    "titles": ["movie_id", "ordering"],
    "professions": ["person_id", "job_name"],
    "principals": ["movie_id", "ordering", "person_id"],
    "directors": ["movie_id", "person_id"],
    "writers": ["movie_id", "person_id"],
    "characters": ["movie_id", "person_id", "name"],
    "knownformovies": ["person_id", "movie_id"],
    "episodes": ["movie_id"],
}


@dataclass(frozen=True)
class ForeignKey:
    child: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...] = field(default=())

    @property
    def name(self) -> str:
        """``genres_movie_id_to_movies``, ``episodes_parent_movie_id_to_movies``."""
        return f"{self.child}_{'_'.join(self.columns)}_to_{self.parent}"

    def parent_key(self) -> tuple[str, ...]:
        return self.parent_columns or self.columns


# Declared foreign keys of the schema.
FOREIGN_KEYS: list[ForeignKey] = [
    ForeignKey("ratings", ("movie_id",), "movies"),
    ForeignKey("genres", ("movie_id",), "movies"),
    ForeignKey("titles", ("movie_id",), "movies"),
    ForeignKey("professions", ("person_id",), "persons"),
    ForeignKey("principals", ("movie_id",), "movies"),
    ForeignKey("principals", ("person_id",), "persons"),
    ForeignKey("directors", ("movie_id",), "movies"),
    ForeignKey("directors", ("person_id",), "persons"),
    ForeignKey("writers", ("movie_id",), "movies"),
    ForeignKey("writers", ("person_id",), "persons"),
    ForeignKey("characters", ("movie_id",), "movies"),
    ForeignKey("characters", ("person_id",), "persons"),
    ForeignKey("knownformovies", ("person_id",), "persons"),
    ForeignKey("knownformovies", ("movie_id",), "movies"),
    ForeignKey("episodes", ("movie_id",), "movies"),
    ForeignKey("episodes", ("parent_movie_id",), "movies", ("movie_id",)),
]

# The audit of the exploration step covers these children (movie side, person side).
AUDITED_MOVIE_CHILDREN = ["principals", "genres", "ratings", "directors", "writers", "characters"]
AUDITED_PERSON_CHILDREN = ["principals", "directors", "writers", "characters"]

# Raw CSV header (tuple-style after export) -> column name.  Fixed values.
COLUMN_MAP = {
    "pid": "person_id",
    "primaryName": "name",
    "birthYear": "birth_year",
    "deathYear": "death_year",
    "mid": "movie_id",
    "titleType": "title_type",
    "primaryTitle": "primary_title",
    "originalTitle": "original_title",
    "isAdult": "is_adult",
    "startYear": "start_year",
    "endYear": "end_year",
    "runtimeMinutes": "runtime_minutes",
    "averageRating": "average_rating",
    "numVotes": "num_votes",
    "ordering": "ordering",
    "title": "title",
    "region": "region",
    "language": "language",
    "types": "types",
    "attributes": "attributes",
    "isOriginalTitle": "is_original_title",
    "genre": "genre",
    "jobName": "job_name",
    "category": "category",
    "job": "job",
    "name": "name",
    "parentMid": "parent_movie_id",
    "seasonNumber": "season_number",
    "episodeNumber": "episode_number",
}
