"""Raw (uncleaned) inputs for the cleaning operators, derived from the driver's tables.

The driver's tables are clean, so each raw view injects rule violations with a
fixed, data-derived rule (nulls, out-of-range values, duplicate keys), the way
dirty CSV exports would carry them.  Same definitions as SQL for the oracle.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.sources.catalog import Catalog


class RawCatalog:
    def __init__(self, catalog: Catalog):
        self.cat = catalog

    def table(self, name: str) -> DataFrame:
        return getattr(self, name) if name in RAW_TABLES else self.cat.table(name)

    @cached_property
    def persons(self) -> DataFrame:
        s = self.cat.source("supplier")
        return s.select(
            F.col("s_suppkey").alias("person_id"), F.col("s_name").alias("name"),
            (F.lit(1900) + F.col("s_suppkey") % 90).cast("int").alias("birth_year"),
            F.when(F.col("s_nationkey") % 3 != 0, F.lit(1900) + F.col("s_nationkey") * 4)
            .cast("int").alias("death_year"))

    @cached_property
    def movies(self) -> DataFrame:
        o = self.cat.source("orders")
        year = F.year("o_orderdate")
        return o.select(
            F.col("o_orderkey").alias("movie_id"),
            F.col("o_orderstatus").alias("title_type"),
            F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("primary_title"),
            F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).alias("is_adult"),
            year.alias("start_year"),
            F.when(F.col("o_orderstatus") == "F", year + F.col("o_custkey") % 3 - 1)
            .cast("int").alias("end_year"),
            F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey") % 200 - 10)
            .cast("int").alias("runtime_minutes"))

    @cached_property
    def ratings(self) -> DataFrame:
        return self.cat.ratings.select(
            "movie_id", (F.col("average_rating") * 2).alias("average_rating"), "num_votes")

    @cached_property
    def episodes(self) -> DataFrame:
        return self.cat.episodes

    @cached_property
    def professions(self) -> DataFrame:
        return (self.cat.source("lineitem")
                .select(F.col("l_suppkey").alias("person_id"),
                        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("job_name"))
                .distinct())

    @cached_property
    def characters(self) -> DataFrame:
        part = self.cat.source("part").select("p_partkey", "p_name")
        return (self.cat.source("lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
                .select(F.col("l_orderkey").alias("movie_id"), F.col("l_suppkey").alias("person_id"),
                        F.when(F.col("l_returnflag") != "N", F.col("p_name")).alias("name")))

    @cached_property
    def principals(self) -> DataFrame:
        return self.cat.source("lineitem").select(
            F.col("l_orderkey").alias("movie_id"), F.col("l_linenumber").alias("ordering"),
            F.col("l_suppkey").alias("person_id"), F.col("l_returnflag").alias("category"),
            F.when(F.col("l_returnflag") == "N", F.lit("")).otherwise(F.col("l_linestatus")).alias("job"))

    @cached_property
    def movie_years(self) -> DataFrame:
        """Start years as raw text, some unparsable (tolerant conversion input)."""
        return self.cat.source("orders").select(
            F.col("o_orderkey").alias("movie_id"),
            F.when(F.col("o_orderstatus") == "P", F.lit("x"))
            .otherwise(F.year("o_orderdate").cast("string")).alias("start_year"))


    # -- the text of dirty CSV exports: whole numbers with a fraction part, texts that
    # mean missing, and texts that are no numbers
    @cached_property
    def text_movies(self) -> DataFrame:
        o = self.cat.source("orders")
        key, year = F.col("o_orderkey"), F.year("o_orderdate").cast("string")
        return o.select(
            key.cast("string").alias("movie_id"), F.col("o_orderstatus").alias("title_type"),
            F.when(key % 11 == 0, "NULL").otherwise("T").alias("primary_title"),
            F.when(key % 5 == 0, F.concat(year, F.lit(".0"))).when(key % 5 == 1, "NA")
            .when(key % 5 == 2, F.concat(year, F.lit(".5"))).otherwise(year).alias("start_year"),
            F.when(key % 7 == 0, "").when(key % 7 == 1, "N/A").when(key % 7 == 2, "90.0")
            .when(key % 7 == 3, "x").when(key % 7 == 4, "nan").otherwise((key % 200).cast("string"))
            .alias("runtime_minutes"))

    @cached_property
    def text_ratings(self) -> DataFrame:
        key = F.col("movie_id")
        return self.cat.ratings.select(
            key.cast("string").alias("movie_id"),
            F.when(key % 6 == 0, "NaN").when(key % 6 == 1, "n/a").when(key % 6 == 2, "bad")
            .when(key % 6 == 3, "7").otherwise("8.25").alias("average_rating"),
            F.when(key % 4 == 0, F.concat(F.col("num_votes").cast("string"), F.lit(".0")))
            .when(key % 4 == 1, "null").otherwise(F.col("num_votes").cast("string")).alias("num_votes"))


RAW_TABLES = ["persons", "movies", "ratings", "episodes", "professions", "characters", "principals"]

RAW_VIEW_SQL = {
    "raw_persons": ("SELECT s_suppkey AS person_id, s_name AS name, "
                    "CAST(1900 + s_suppkey % 90 AS INTEGER) AS birth_year, "
                    "CAST(CASE WHEN s_nationkey % 3 <> 0 THEN 1900 + s_nationkey * 4 END AS INTEGER) "
                    "AS death_year FROM supplier"),
    "raw_movies": ("SELECT o_orderkey AS movie_id, o_orderstatus AS title_type, "
                   "'Order ' || CAST(o_orderkey AS VARCHAR) AS primary_title, "
                   "CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS is_adult, "
                   "CAST(year(o_orderdate) AS INTEGER) AS start_year, "
                   "CAST(CASE WHEN o_orderstatus = 'F' THEN year(o_orderdate) + o_custkey % 3 - 1 END "
                   "AS INTEGER) AS end_year, "
                   "CAST(CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey % 200 - 10 END AS INTEGER) "
                   "AS runtime_minutes FROM orders"),
    "raw_ratings": "SELECT movie_id, average_rating * 2 AS average_rating, num_votes FROM ratings",
    "raw_episodes": "SELECT * FROM episodes",
    "raw_professions": ("SELECT DISTINCT l_suppkey AS person_id, "
                        "CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS job_name FROM lineitem"),
    "raw_characters": ("SELECT l_orderkey AS movie_id, l_suppkey AS person_id, "
                       "CASE WHEN l_returnflag <> 'N' THEN p_name END AS name "
                       "FROM lineitem JOIN part ON l_partkey = p_partkey"),
    "raw_principals": ("SELECT l_orderkey AS movie_id, l_linenumber AS ordering, l_suppkey AS person_id, "
                       "l_returnflag AS category, "
                       "CASE WHEN l_returnflag = 'N' THEN '' ELSE l_linestatus END AS job FROM lineitem"),
    **{f"raw_{t}": f"SELECT * FROM {t}" for t in ("genres", "titles", "directors", "writers", "knownformovies")},
    "raw_movie_years": ("SELECT o_orderkey AS movie_id, CASE WHEN o_orderstatus = 'P' THEN 'x' "
                        "ELSE CAST(year(o_orderdate) AS VARCHAR) END AS start_year FROM orders"),
}
