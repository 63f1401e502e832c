"""One complete film, from the flat tables and from the nested documents (QF, X1).

The flat path restricts every child table to the looked-up film with a
semi-join (the lookup is a single row, so its size is bounded) and assembles the
same document the nested build produces; the nested path is a filtered scan of
the documents.  Both must be equal, which ``compare_documents`` checks without
collecting anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.operators.nesting import build_documents, render_documents
from reelframe.plans.nested_form import film_by_title


def film_full_flat(movies: DataFrame, ratings: DataFrame, genres: DataFrame, persons: DataFrame,
                   directors: DataFrame, principals: DataFrame, characters: DataFrame,
                   writers: DataFrame, title: str) -> DataFrame:
    chosen = movies.filter(F.col("primary_title") == title).orderBy("movie_id").limit(1)
    ids = F.broadcast(chosen.select("movie_id"))  # one row by construction

    def only(df: DataFrame) -> DataFrame:
        return df.join(ids, "movie_id", "left_semi")

    return build_documents(chosen, only(ratings), only(genres), persons, only(directors),
                           only(principals), only(characters), only(writers))


def film_full_nested(docs: DataFrame, title: str) -> DataFrame:
    return film_by_title(docs, title)


def compare_documents(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows only in ``left``, only in ``right`` (multiset difference) and equality."""
    sides = [render_documents(docs) for docs in (left, right)]
    columns = sides[0].columns
    # each side is derived once: how often an equal row is more on the one than on the other
    rows = sides[0].withColumn("_more", F.lit(1)).unionByName(sides[1].withColumn("_more", F.lit(-1)))
    surplus = rows.groupBy(*columns).agg(F.sum("_more").alias("_more"))
    return (surplus.agg(F.coalesce(F.sum(F.greatest("_more", F.lit(0))), F.lit(0)).cast("bigint").alias("flat_only"),
                        F.coalesce(F.sum(F.greatest(-F.col("_more"), F.lit(0))), F.lit(0)).cast("bigint").alias("nested_only"))
            .withColumn("same", (F.col("flat_only") == 0) & (F.col("nested_only") == 0)))
