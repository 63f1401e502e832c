"""The 12 catalog tables as views over the driver's TPC-H-shaped parquet tables.

Every view is a lazy DataFrame that Spark derives from the given tables, so the
work of every question grows with the input.  Column pruning and predicate
pushdown reach the parquet scans through these projections.

The same definitions exist as SQL text (``VIEW_SQL``) for the DuckDB oracle.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.functions import dealt

SOURCE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

CATALOG_TABLES = [
    "persons", "movies", "ratings", "genres", "titles", "professions",
    "principals", "directors", "writers", "characters", "knownformovies", "episodes",
]


def read_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Catalog:
    """Lazily-built catalog views for one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def source(self, name: str) -> DataFrame:
        return read_source(self.spark, self.sf_dir, name)

    def table(self, name: str) -> DataFrame:
        if name not in CATALOG_TABLES:
            raise KeyError(name)
        return getattr(self, name)

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in CATALOG_TABLES}

    @cached_property
    def docs(self) -> DataFrame:
        """The nested documents, built from the views."""
        from reelframe.operators.nesting import build_from_catalog

        return build_from_catalog(self)

    # -- views ------------------------------------------------------------
    @cached_property
    def persons(self) -> DataFrame:
        return self.source("supplier").select(
            F.col("s_suppkey").alias("person_id"), F.col("s_name").alias("name"))

    @cached_property
    def movies(self) -> DataFrame:
        return self.source("orders").select(
            F.col("o_orderkey").alias("movie_id"),
            F.col("o_orderstatus").alias("title_type"),
            F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("primary_title"),
            F.year("o_orderdate").alias("start_year"),
            F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey") % 180 + 1)
            .cast("int").alias("runtime_minutes"),
        )

    @cached_property
    def ratings(self) -> DataFrame:
        return (self.source("lineitem")
                .filter(F.col("l_returnflag") != "N")
                .groupBy(F.col("l_orderkey").alias("movie_id"))
                .agg((F.lit(1) + F.max("l_quantity") / 8).alias("average_rating"),
                     F.sum("l_quantity").cast("bigint").alias("num_votes")))

    def _line_parts(self) -> DataFrame:
        part = self.source("part").select("p_partkey", "p_brand", "p_type", "p_name")
        return self.source("lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))

    @cached_property
    def genres(self) -> DataFrame:
        rows = (self._line_parts()
                .filter(F.col("p_type") != "PROMO")
                .select(F.col("l_orderkey").alias("movie_id"), F.col("p_brand").alias("genre")))
        return dealt(rows, *rows.columns).distinct()

    @cached_property
    def principals(self) -> DataFrame:
        return self.source("lineitem").select(
            F.col("l_orderkey").alias("movie_id"),
            F.col("l_linenumber").alias("ordering"),
            F.col("l_suppkey").alias("person_id"),
            F.col("l_returnflag").alias("category"),
        )

    def _credit_pairs(self, linenumber: int) -> DataFrame:
        rows = (self.source("lineitem")
                .filter(F.col("l_linenumber") == linenumber)
                .select(F.col("l_orderkey").alias("movie_id"), F.col("l_suppkey").alias("person_id")))
        return dealt(rows, *rows.columns).distinct()

    @cached_property
    def directors(self) -> DataFrame:
        return self._credit_pairs(1)

    @cached_property
    def writers(self) -> DataFrame:
        return self._credit_pairs(2)

    @cached_property
    def characters(self) -> DataFrame:
        rows = self._line_parts().select(
            F.col("l_orderkey").alias("movie_id"), F.col("l_suppkey").alias("person_id"),
            F.col("p_name").alias("name"))
        return dealt(rows, *rows.columns).distinct()

    @cached_property
    def professions(self) -> DataFrame:
        return (self.source("lineitem")
                .select(F.col("l_suppkey").alias("person_id"), F.col("l_returnflag").alias("job_name"))
                .distinct())

    @cached_property
    def knownformovies(self) -> DataFrame:
        return (self.source("lineitem")
                .filter(F.col("l_quantity") == 50)
                .select(F.col("l_suppkey").alias("person_id"), F.col("l_orderkey").alias("movie_id"))
                .distinct())

    @cached_property
    def titles(self) -> DataFrame:
        return self.source("documents").select(
            F.col("doc_id").alias("movie_id"), F.lit(1).alias("ordering"),
            F.col("source").alias("title"), F.col("lang").alias("language"))

    @cached_property
    def episodes(self) -> DataFrame:
        return (self.source("conversations")
                .select((F.col("conv_id") * 100 + F.col("turn")).alias("movie_id"),
                        F.col("conv_id").alias("parent_movie_id"),
                        F.lit(1).alias("season_number"),
                        F.col("turn").alias("episode_number"))
                .distinct())


class StoredCatalog:
    """The catalog tables (and optionally the documents) as written Parquet tables.

    ``materialize`` writes every view once (the load step); later questions read
    the stored tables, which also cuts the lineage back to the source tables.
    Exposes the same attributes as ``Catalog``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in CATALOG_TABLES}

    @property
    def docs(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/movies_complete")

    @staticmethod
    def materialize(catalog: Catalog, root: str, with_docs: bool = True) -> "StoredCatalog":
        stored = StoredCatalog(catalog.spark, root)
        for name in CATALOG_TABLES:
            catalog.table(name).write.mode("overwrite").parquet(f"{stored.root}/{name}")
        if with_docs:
            from reelframe.operators.nesting import build_from_catalog

            build_from_catalog(stored).write.mode("overwrite").parquet(f"{stored.root}/movies_complete")
        return stored


for _name in CATALOG_TABLES:
    setattr(StoredCatalog, _name, property(lambda self, n=_name: self.table(n)))


# The same views as SQL text, for the DuckDB oracle (fixed definitions).
VIEW_SQL: dict[str, str] = {
    "persons": "SELECT s_suppkey AS person_id, s_name AS name FROM supplier",
    "movies": ("SELECT o_orderkey AS movie_id, o_orderstatus AS title_type, "
               "'Order ' || CAST(o_orderkey AS VARCHAR) AS primary_title, "
               "CAST(year(o_orderdate) AS INTEGER) AS start_year, "
               "CAST(CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey % 180 + 1 END AS INTEGER) "
               "AS runtime_minutes FROM orders"),
    "ratings": ("SELECT l_orderkey AS movie_id, 1 + max(l_quantity) / 8 AS average_rating, "
                "CAST(sum(l_quantity) AS BIGINT) AS num_votes "
                "FROM lineitem WHERE l_returnflag <> 'N' GROUP BY l_orderkey"),
    "genres": ("SELECT DISTINCT l_orderkey AS movie_id, p_brand AS genre "
               "FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type <> 'PROMO'"),
    "principals": ("SELECT l_orderkey AS movie_id, l_linenumber AS ordering, "
                   "l_suppkey AS person_id, l_returnflag AS category FROM lineitem"),
    "directors": ("SELECT DISTINCT l_orderkey AS movie_id, l_suppkey AS person_id "
                  "FROM lineitem WHERE l_linenumber = 1"),
    "writers": ("SELECT DISTINCT l_orderkey AS movie_id, l_suppkey AS person_id "
                "FROM lineitem WHERE l_linenumber = 2"),
    "characters": ("SELECT DISTINCT l_orderkey AS movie_id, l_suppkey AS person_id, p_name AS name "
                   "FROM lineitem JOIN part ON l_partkey = p_partkey"),
    "professions": "SELECT DISTINCT l_suppkey AS person_id, l_returnflag AS job_name FROM lineitem",
    "knownformovies": ("SELECT DISTINCT l_suppkey AS person_id, l_orderkey AS movie_id "
                       "FROM lineitem WHERE l_quantity = 50"),
    "titles": ("SELECT doc_id AS movie_id, 1 AS ordering, source AS title, lang AS language "
               "FROM documents"),
    "episodes": ("SELECT DISTINCT conv_id * 100 + turn AS movie_id, conv_id AS parent_movie_id, "
                 "1 AS season_number, turn AS episode_number FROM conversations"),
}


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the CTEs of every catalog view (and ``extra``) it names."""
    import re

    defs = dict(VIEW_SQL)
    defs.update(extra or {})
    used: list[str] = []

    def visit(text: str) -> None:
        for name, body in defs.items():
            if name not in used and re.search(rf"\b{name}\b", text):
                visit(body)
                if name not in used:
                    used.append(name)

    visit(sql)
    if not used:
        return sql
    ctes = ",\n".join(f"{name} AS ({defs[name]})" for name in used)
    body = sql.lstrip()
    if re.match(r"(?i)with\s", body):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
