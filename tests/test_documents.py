"""Documents from rows with repeated and missing keys, and their comparison."""

import re

from reelframe.operators.nesting import build_documents, render_documents
from reelframe.plans.film import compare_documents


def tables(spark):
    pairs = "movie_id long, person_id long"
    make = spark.createDataFrame
    return {
        "movies": make([(1, "A", 1990, 90), (1, "B", 1980, None), (2, "C", None, None), (None, "N", 2000, 5)],
                       "movie_id long, primary_title string, start_year int, runtime_minutes int"),
        "ratings": make([(1, 7.0, 10), (None, 3.0, 2), (9, 1.0, 1)], "movie_id long, average_rating double, num_votes long"),
        "genres": make([(1, "y"), (1, "x"), (1, None), (1, "x"), (None, "z"), (9, "w")], "movie_id long, genre string"),
        "persons": make([(5, "Eve"), (6, "Ann"), (6, "Bob"), (None, "Nil")], "person_id long, name string"),
        "directors": make([(1, 6), (1, 6), (1, 7), (2, None), (9, 5)], pairs),
        "principals": make([(1, 3, 5), (1, 2, 6), (1, 4, 5), (1, None, 7), (None, 1, 5), (2, 1, None)],
                           "movie_id long, ordering int, person_id long"),
        "characters": make([(1, 5, "q"), (1, 5, "p"), (1, 5, "p"), (1, 5, None), (1, 8, "r"), (None, 5, "s"), (2, None, "t")],
                           "movie_id long, person_id long, name string"),
        "writers": make([(1, 5)], pairs),
    }


def test_documents_of_repeated_and_missing_keys(spark):
    rows = {r["movie_id"]: tuple(r)[1:] for r in render_documents(build_documents(**tables(spark))).collect()}
    assert rows == {
        1: ("B", 1990, 90, 7.0, 10, "x, x, y", "6:Ann; 6:Ann; 6:Bob; 6:Bob; 7:Unknown",
            "7:Unknown[]; 6:Ann[]; 6:Bob[]; 5:Eve[p|p|q]", "5:Eve"),
        2: ("C", None, None, None, 0, "", "", "", ""),
        None: ("N", 2000, 5, 3.0, 2, "z", "", "5:Eve[]", ""),
    }


def test_comparison_counts_surplus_rows_and_derives_each_side_once(spark):
    docs = build_documents(**tables(spark))
    one = docs.where("movie_id = 1")
    assert tuple(compare_documents(docs.union(one).union(one), docs.where("movie_id = 2")).first()) == (4, 0, False)
    assert tuple(compare_documents(one, docs.union(one)).first()) == (0, 3, False)
    assert tuple(compare_documents(docs, docs).first()) == (0, 0, True)
    assert tuple(compare_documents(docs.limit(0), docs.limit(0)).first()) == (0, 0, True)
    marked = docs.withColumn("year", docs.year + 1)
    plan = compare_documents(marked, docs.limit(0))._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"year#\d+ \+ 1\)", plan)) == 1
