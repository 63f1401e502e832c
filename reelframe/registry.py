"""Registered operators: key -> callable(spark, sf_dir) -> DataFrame.

Every callable reads the driver's tables through the catalog views (work grows
with the input) and returns flat columns only (arrays/structs are rendered to
text with a fixed order) so results can be compared with the SQL oracle.

The questions are defined over a catalog object (``Catalog`` over the source
tables or ``StoredCatalog`` over materialised tables), so the benchmark runs
the very same plans on stored tables.
"""

from __future__ import annotations

from collections.abc import Callable
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.operators import (cleaning, distributions, integrity, name_index, profiling, sketches,
                                 transfer)
from reelframe.operators.nesting import build_from_catalog, render_documents, sample_document
from reelframe.oracle import PARAMS as P
from reelframe.plans import collection_form as C
from reelframe.plans import film
from reelframe.plans import nested_form as N
from reelframe.plans import sql_form as S
from reelframe.schema import AUDITED_MOVIE_CHILDREN, AUDITED_PERSON_CHILDREN, LOAD_ORDER
from reelframe.session import scratch_folder
from reelframe.sources import csv_ingest, csv_records, inference, layout, sinks
from reelframe.sources.catalog import CATALOG_TABLES, Catalog
from reelframe.sources.raw_views import RawCatalog
from reelframe.streaming import clean_stream

Query = Callable[[SparkSession, str], DataFrame]
CatalogQuery = Callable[[object], DataFrame]

Y0, Y1 = P["q2_years"]


def _nested_lists(col: str):
    """``[[a, b], [a, b]]`` -> ``'[a, b], [a, b]'``."""
    return F.array_join(F.transform(col, lambda g: F.concat(F.lit("["), F.array_join(g, ", "), F.lit("]"))),
                        ", ")


def _rating_cols():
    return [F.col("rating.average").alias("rating_average"), F.col("rating.votes").alias("rating_votes")]


def questions() -> dict[str, CatalogQuery]:
    """The nine questions x three formulations (+ q7_clean), over a catalog ``c``."""
    return {
        # relational form
        "q1_sql": lambda c: S.q1_filmography(c.movies, c.principals, c.persons, c.genres, c.ratings,
                                             P["q1_name"]),
        "q2_sql": lambda c: S.q2_top_films(c.movies, c.genres, c.ratings, P["q2_genre"], Y0, Y1, P["q2_n"]),
        "q3_sql": lambda c: S.q3_multi_role(c.characters, c.persons, c.movies),
        "q4_sql": lambda c: S.q4_collaborations(c.directors, c.principals, c.persons, P["q4_name"]),
        "q5_sql": lambda c: S.q5_popular_genres(c.genres, c.ratings, P["q5_min_rating"], P["q5_min_count"]),
        "q6_sql": lambda c: S.q6_career(c.movies, c.principals, c.persons, c.ratings, P["q6_name"]),
        "q7_sql": lambda c: S.q7_top_per_genre(c.genres, c.ratings, c.movies, P["q7_n"]),
        "q7_clean": lambda c: S.q7_top_per_genre_clean(c.genres, c.ratings, c.movies, P["q7_n"]),
        "q8_sql": lambda c: S.q8_breakthrough(c.principals, c.persons, c.ratings, c.movies, P["q8_threshold"]),
        "q9_sql": lambda c: S.q9_prolific_directors(c.directors, c.persons, c.movies, c.ratings, c.genres,
                                                    P["q9_min_films"]),
        # flat document collections
        "q1_pipe": lambda c: C.q1_filmography(c.persons, c.principals, c.movies, c.genres, c.ratings,
                                              P["q1_name"]).select(
            "movie_id", "titre", "annee", _nested_lists("genres").alias("genres"), "note"),
        "q2_pipe": lambda c: C.q2_top_films(c.genres, c.movies, c.ratings, P["q2_genre"], Y0, Y1, P["q2_n"]),
        "q3_pipe": lambda c: C.q3_multi_role(c.characters, c.persons, c.movies),
        "q4_pipe": lambda c: C.q4_collaborations(c.persons, c.principals, c.directors, P["q4_name"]),
        "q5_pipe": lambda c: C.q5_popular_genres(c.genres, c.ratings, P["q5_min_rating"], P["q5_min_count"]),
        "q6_pipe": lambda c: C.q6_career(c.persons, c.principals, c.movies, c.ratings, P["q6_name"]),
        "q7_pipe": lambda c: C.q7_top_per_genre(c.genres, c.movies, c.ratings, P["q7_n"]),
        "q8_pipe": lambda c: C.q8_breakthrough(c.persons, c.principals, c.ratings, P["q8_threshold"]),
        "q9_pipe": lambda c: C.q9_prolific_directors(c.directors, c.movies, c.persons, c.ratings, c.genres,
                                                     P["q9_min_films"]),
        # nested documents
        "q1_nest": lambda c: N.q1_filmography(c.docs, P["q1_name"]).select(
            "movie_id", "title", "year", F.array_join("genres", ", ").alias("genres"), *_rating_cols()),
        "q2_nest": lambda c: N.q2_top_films(c.docs, P["q2_genre"], Y0, Y1, P["q2_n"]).select(
            "title", "year", *_rating_cols()),
        "q3_nest": lambda c: N.q3_multi_role(c.docs),
        "q4_nest": lambda c: N.q4_collaborations(c.docs, P["q4_name"]),
        "q5_nest": lambda c: N.q5_popular_genres(c.docs, P["q5_min_rating"], P["q5_min_count"]),
        "q6_nest": lambda c: N.q6_career(c.docs, P["q6_name"]),
        "q7_nest": lambda c: N.q7_top_per_genre(c.docs, P["q7_n"]),
        "q8_nest": lambda c: N.q8_breakthrough(c.docs, P["q8_threshold"]),
        "q9_nest": lambda c: N.q9_prolific_directors(c.docs, P["q9_min_films"]),
    }


def _film_flat(c) -> DataFrame:
    return film.film_full_flat(c.movies, c.ratings, c.genres, c.persons, c.directors,
                               c.principals, c.characters, c.writers, P["film_title"])


def documents() -> dict[str, CatalogQuery]:
    return {
        "movies_complete": lambda c: render_documents(c.docs),
        "sample_document": lambda c: sample_document(c.docs, P["sample_min_votes"]),
        "film_full_flat": lambda c: render_documents(_film_flat(c)),
        "film_full_nested": lambda c: render_documents(film.film_full_nested(c.docs, P["film_title"])),
        "film_compare": lambda c: film.compare_documents(_film_flat(c),
                                                         film.film_full_nested(c.docs, P["film_title"])),
    }


# -- data-quality operators over raw / cleaned inputs -----------------------------

CLEANED = LOAD_ORDER  # all twelve tables, parents first


def _raw_tables(raw: RawCatalog) -> dict[str, DataFrame]:
    return {t: raw.table(t) for t in CLEANED}


def _audited_tables(raw: RawCatalog) -> dict[str, DataFrame]:
    """The valid rows of every table (rejected parents leave orphaned children
    behind), as plans: an audit reads only the tables and columns it checks."""
    return {name: cleaning.clean_table(name, raw.table(name))[0] for name in CLEANED}


def _kept(raw: RawCatalog) -> DataFrame:
    """(item, variant, value): rows read and kept per table."""
    return cleaning.load_report(_raw_tables(raw)).select(
        F.col("table_name").alias("item"), F.inline(F.array(*[
            F.struct(F.lit(v).alias("variant"), F.col(f"rows_{v}").cast("double").alias("value"))
            for v in ("read", "kept")])))


def data_quality() -> dict[str, Callable[[RawCatalog], DataFrame]]:
    MC, PC = AUDITED_MOVIE_CHILDREN, AUDITED_PERSON_CHILDREN
    D = distributions

    def valid(table):
        return lambda raw: cleaning.clean_table(table, raw.table(table))[0]

    def audited(fn):
        return lambda raw: fn(_audited_tables(raw))

    out: dict[str, Callable[[RawCatalog], DataFrame]] = {f"clean_{t}": valid(t) for t in CLEANED}
    out.update({
        "quarantine": lambda raw: cleaning.quarantine(_raw_tables(raw)),
        "load_gain": lambda raw: transfer.gain(_kept(raw), "read", "kept"),
        "load_report": lambda raw: cleaning.load_report(_raw_tables(raw)),
        "pk_duplicates": lambda raw: integrity.pk_duplicates({n: raw.table(n) for n in CATALOG_TABLES}),
        "orphan_movies": audited(lambda t: integrity.orphan_movies(t["movies"], {c: t[c] for c in MC})),
        "orphan_persons": audited(lambda t: integrity.orphan_persons(t["persons"], {c: t[c] for c in PC})),
        "films_without_data": audited(lambda t: integrity.films_without_data(t["movies"],
                                                                              {c: t[c] for c in MC})),
        "films_without_data_examples": audited(lambda t: integrity.films_without_data_examples(
            t["movies"], {c: t[c] for c in MC})),
        "coverage": audited(lambda t: integrity.coverage({c: t[c] for c in MC})),
        "orphan_characters": audited(lambda t: integrity.orphan_pairs(t["characters"], t["principals"])),
        "integrity_summary": audited(integrity.integrity_summary),
        "fk_audit": audited(integrity.fk_audit),
        "table_counts": lambda raw: profiling.table_counts(raw.cat.tables()),
        "dataset_summary": lambda raw: profiling.dataset_summary({n: raw.table(n) for n in CATALOG_TABLES}),
        "profile_columns": lambda raw: profiling.profile_tables({n: raw.table(n) for n in CATALOG_TABLES}),
        "profile_numeric": lambda raw: profiling.describe_tables({n: raw.table(n) for n in CATALOG_TABLES}),
        "year_stats": lambda raw: D.year_stats(raw.movie_years),
        "films_per_decade": lambda raw: D.films_per_decade(raw.movie_years),
        "top_genres": lambda raw: D.top_genres(raw.cat.genres),
        "rating_stats": lambda raw: D.rating_stats(raw.ratings),
        "rating_histogram": lambda raw: D.rating_histogram(raw.ratings),
        "credits_stats": lambda raw: D.credits_stats(raw.cat.principals),
        "credits_histogram": lambda raw: D.credits_histogram(raw.cat.principals),
    })
    return out


# -- storage: copies, CSV round trip, layout (these write into the shared folder) --

scratch = scratch_folder


def storage() -> dict[str, Query]:
    copies: dict[tuple[str, str], dict[str, str]] = {}  # of this process, by session and source

    def copied(spark, d):
        cat, key = Catalog(spark, d), (spark.sparkContext.applicationId, d)
        if key not in copies:
            copies[key] = transfer.copy_tables(cat.tables(), scratch(spark, "copy"))
        return cat, transfer.read_tables(spark, copies[key]), copies[key]

    def verify(spark, d):
        cat, target, _ = copied(spark, d)
        return transfer.copy_verify(cat.tables(), target)

    def stats(spark, d):
        cat, target, _ = copied(spark, d)
        return transfer.copy_stats(transfer.copy_verify(cat.tables(), target))

    def stored_docs(spark, tables) -> str:
        """The nested documents of copied tables, written."""
        root = scratch(spark, "nested")
        sinks.overwrite_table(build_from_catalog(SimpleNamespace(**tables)), root, "movies_complete")
        return sinks.table_path(root, "movies_complete")

    def stored(spark, d):
        cat, target, paths = copied(spark, d)
        return cat, paths, {"movies_complete": stored_docs(spark, target)}

    # sizes differ between runs of any writer: the queries compare what the operators
    # report with the file system's own listing
    def listed(spark, path) -> tuple[int, int]:
        """Bytes and number of the Parquet files of a folder, from the file system."""
        top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        files = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(top)
        sizes = [f.getLen() for f in files if f.getPath().getName().endswith(".parquet")]
        return sum(sizes), len(sizes)

    def by_table(values: dict, name="table_name"):
        return F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), F.col(name))

    def storage_stats(spark, d):
        _, flat, nested = stored(spark, d)
        found = {t: listed(spark, p) for t, p in {**flat, **nested}.items()}
        s = transfer.storage_stats(spark, {**flat, **nested})
        size = by_table({t: v[0] for t, v in found.items()})
        return s.select("table_name", "rows", (F.col("files") == by_table({t: v[1] for t, v in found.items()})).alias("files_as_listed"),
                        (F.col("bytes") == size).alias("bytes_as_listed"),
                        (F.abs(F.col("avg_row_bytes") - size / F.col("rows")) < 1e-6).alias("average_fits"))

    def storage_compare(spark, d):
        _, flat, nested = stored(spark, d)
        f, n = (sum(listed(spark, p)[0] for p in paths.values()) for paths in (flat, nested))
        c = transfer.storage_compare(transfer.storage_stats(spark, flat), transfer.storage_stats(spark, nested))
        return c.select((F.col("flat_bytes") == f).alias("flat_as_listed"), (F.col("nested_bytes") == n).alias("nested_as_listed"),
                        (F.abs(F.col("variation_pct") - (n - f) * 100.0 / f) < 1e-6).alias("variation_fits"))

    def largest(spark, d):
        """Rank of every stored table, against its rank in the listing."""
        _, flat, _ = stored(spark, d)
        sizes = {t: listed(spark, p)[0] for t, p in flat.items()}
        order = sorted(sizes, key=lambda t: (-sizes[t], t))
        top = transfer.largest_tables(transfer.storage_stats(spark, flat), 5)
        share = by_table({t: n * 100.0 / sum(sizes.values()) for t, n in sizes.items()})
        return top.agg(F.count(F.lit(1)).alias("tables"),
                       (F.sort_array(F.collect_set("table_name")) == F.lit(sorted(order[:5]))).alias("largest_as_listed"),
                       F.bool_and(F.abs(F.col("share_pct") - share) < 1e-6).alias("shares_as_listed"),
                       F.bool_and(F.abs(F.col("size_mb") * 1048576 - by_table(sizes)) < 1).alias("sizes_as_listed"))

    def sizes(spark, d):
        cat, _, paths = copied(spark, d)
        found = {t: listed(spark, p)[0] for t, p in paths.items()}
        found["TOTAL"] = sum(found.values())
        s = profiling.dataset_summary(cat.tables(), transfer.storage_stats(spark, paths))
        return s.select("table_name", "rows", "columns",
                        (F.abs(F.col("size_mb") * 1048576 - by_table(found)) < 1).alias("size_as_listed"))

    def csv_report(spark, d):
        root = scratch(spark, "csv")
        for name, df in _raw_tables(RawCatalog(Catalog(spark, d))).items():
            csv_ingest.export_csv(df, f"{root}/{name}.csv")
        return cleaning.load_report(csv_ingest.read_catalog_csv(spark, root, CLEANED))

    def csv_typed(table):
        def run(spark, d):
            root = scratch(spark, "csv-typed")
            csv_ingest.export_csv(getattr(RawCatalog(Catalog(spark, d)), f"text_{table}"), f"{root}/{table}.csv")
            return csv_ingest.read_table_csv(spark, f"{root}/{table}.csv", table)
        return run

    def inventory(spark, d):
        root = scratch(spark, "csv")
        for name, df in _raw_tables(RawCatalog(Catalog(spark, d))).items():
            csv_ingest.export_csv(df, f"{root}/{name}.csv")
        found = {}
        fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(
            spark.sparkContext._jsc.hadoopConfiguration())
        for name, paths in csv_records.find_csv(spark, root).items():
            status = fs.listStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(paths[0]))
            found[name] = [f.getLen() for f in status if f.getPath().getName().endswith(".csv")]
        files = csv_ingest.file_inventory(spark, root).groupBy("table_name").agg(
            F.count(F.lit(1)).alias("files"), F.sum("size_kb").alias("kb"))
        return files.select("table_name", (F.col("files") == by_table({t: len(v) for t, v in found.items()})).alias("files_as_listed"),
                            (F.abs(F.col("kb") * 1024 - by_table({t: float(sum(v)) for t, v in found.items()})) < 1e-3)
                            .alias("bytes_as_listed"))

    def lifecycle(spark, d):
        """Rows of each table when created, after an append, after a second append, and emptied."""
        cat, names, counts = Catalog(spark, d), ["genres", "ratings", "directors"], []
        schemas = {n: cat.table(n).schema for n in names}
        for label, appends, emptied in (("created", 0, False), ("appended", 1, False), ("twice", 2, False),
                                        ("emptied", 1, True)):
            root = scratch(spark, f"sink-{label}")
            sinks.create_tables(spark, root, names, schemas)
            for _ in range(appends):
                for n in names:
                    sinks.append_table(cat.table(n), root, n)
            if emptied:
                sinks.empty_tables(spark, root, names)
            counts.append(transfer.row_counts({n: spark.read.parquet(sinks.table_path(root, n)) for n in names},
                                              label))
        out = counts[0]
        for c in counts[1:]:
            out = out.join(c, "table_name")
        return out

    def layout(spark, d):
        path = scratch(spark, "layout")
        sinks.write_layout(Catalog(spark, d).docs, path, sort_by=["title"])
        return render_documents(film.film_full_nested(spark.read.parquet(path), P["film_title"]))

    def streamed(table):
        def run(spark, d):
            raw = RawCatalog(Catalog(spark, d)).table(table)
            root = scratch(spark, f"stream-{table}")
            csv_ingest.export_csv(raw, f"{root}/in")
            query = clean_stream.start(spark, f"{root}/in", raw.columns, table, f"{root}/out", f"{root}/ckpt")
            query.awaitTermination()
            return clean_stream.valid_rows(spark, f"{root}/out")
        return run

    return {"stream_clean_movies": streamed("movies"), "stream_clean_characters": streamed("characters"),
            "csv_typed_movies": csv_typed("movies"), "csv_typed_ratings": csv_typed("ratings"),
            "sink_lifecycle": lifecycle, "dataset_sizes": sizes, "copy_verify": verify, "copy_stats": stats, "storage_stats": storage_stats,
            "storage_compare": storage_compare, "storage_largest": largest, "csv_load_report": csv_report,
            "file_inventory": inventory, "film_full_layout": layout}


# -- sketches that merge, and the substring index ----------------------------------

PROFILED = ["movies", "ratings", "persons", "principals"]


def _halves(df: DataFrame) -> list[DataFrame]:
    """Two load batches of a table."""
    odd = F.xxhash64(*df.columns) % 2 != 0
    return [df.where(odd), df.where(~odd)]


def indexes() -> dict[str, Query]:
    def profiled(spark, d):
        """The merged sketches of two batches per table, written and read as they would
        be from load to load, beside the exact profile: counts, and whether the
        estimates lie within their bounds."""
        raw, root = RawCatalog(Catalog(spark, d)), scratch(spark, "sketches")
        for name in PROFILED:
            for i, part in enumerate(_halves(raw.table(name))):
                sketches.column_sketches(name, part, f"batch {i}").write.mode("append").parquet(root)
        found = sketches.estimates(sketches.merge_sketches(spark.read.parquet(root)))
        exact = profiling.profile_tables({n: raw.table(n) for n in PROFILED})
        both = found.join(exact.select("table_name", "column_name", F.col("unique_values").alias("exact")),
                          ["table_name", "column_name"])
        bound = F.greatest(F.lit(1.0), F.col("exact") * sketches.HLL_ERROR)
        return both.select("table_name", "column_name", "total_rows", "missing",
                           (F.abs(F.col("unique_values") - F.col("exact")) <= bound).alias("distinct_in_bound"))

    def ranked(spark, d):
        """Ranks that the merged sketches' quartiles really have: (column, share, whether
        the values at most and below it bracket the share, within the bound)."""
        raw, root = RawCatalog(Catalog(spark, d)), scratch(spark, "quantiles")
        numbers = raw.table("ratings").select("average_rating", "num_votes")
        for i, part in enumerate(_halves(numbers)):
            sketches.column_sketches("ratings", part, f"batch {i}").write.mode("append").parquet(root)
        probs = [0.1, 0.25, 0.5, 0.75, 0.9]
        found = sketches.estimates(sketches.merge_sketches(spark.read.parquet(root)), probs)
        found = found.select("column_name", F.posexplode("q").alias("i", "v")).withColumn(
            "share", F.get(F.array(*[F.lit(p) for p in probs]), F.col("i")))
        cells = numbers.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x"))
                                                  for c in numbers.columns]))).where("x IS NOT NULL")
        # five rows per column
        held = cells.join(F.broadcast(found), "column_name").groupBy("column_name", "share").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("x") <= F.col("v")).alias("upto"),
            F.count_if(F.col("x") < F.col("v")).alias("below"))
        e = sketches.RANK_ERROR
        inside = (F.col("below") / F.col("n") <= F.col("share") + e) & (F.col("upto") / F.col("n") >= F.col("share") - e)
        return held.select("column_name", "share", F.col("n").alias("values"), inside.alias("in_bound"))

    def bitmap_coverage(spark, d):
        """Distinct films per child table from the bitmaps of two batches."""
        tables = _audited_tables(RawCatalog(Catalog(spark, d)))
        batches = [sketches.bitmap_counts({n: _halves(tables[n])[i] for n in AUDITED_MOVIE_CHILDREN}, "movie_id")
                   for i in range(2)]
        merged = sketches.merge_bitmaps(batches[0].union(batches[1]))
        return sketches.distinct_ids(merged).select(F.col("name").alias("table_name"), F.col("ids").alias("films"))

    def by_index(spark, d, needle):
        c, root = Catalog(spark, d), scratch(spark, "names")
        name_index.write_postings(c.persons, "person_id", "name", root)
        return c, name_index.find_names(c.persons, spark.read.parquet(root), "person_id", "name", needle)

    def q1_indexed(spark, d):
        c, people = by_index(spark, d, P["q1_name"])
        return S.q1_filmography(c.movies, c.principals, people, c.genres, c.ratings, P["q1_name"])

    def q6_indexed(spark, d):
        c, people = by_index(spark, d, P["q6_name"])
        return S.q6_career(c.movies, c.principals, people, c.ratings, P["q6_name"])

    def search(spark, d):
        """Part names by needles of one, two, three and more characters."""
        part, root, found = Catalog(spark, d).source("part").select("p_partkey", "p_name"), scratch(spark, "grams"), []
        name_index.write_postings(part, "p_partkey", "p_name", root)
        for needle in P["needles"]:
            hits = name_index.find_names(part, spark.read.parquet(root), "p_partkey", "p_name", needle)
            found.append(hits.select(F.lit(needle).alias("needle"), "p_partkey", "p_name"))
        out = found[0]
        for f in found[1:]:
            out = out.union(f)
        return out

    def bucketed(spark, d):
        """Films and votes per genre from two tables bucketed by film: no shuffle for the join."""
        cat, root = Catalog(spark, d), scratch(spark, "bucketed")
        names = {t: f"reelframe_{t}_{root.rsplit('-', 1)[1]}" for t in ("genres", "ratings")}
        for t, name in names.items():
            sinks.write_bucketed(cat.table(t), name, "movie_id", 8, f"{root}/{t}")
        joined = spark.table(names["genres"]).join(spark.table(names["ratings"]).hint("merge"), "movie_id")
        return joined.groupBy("genre").agg(F.count(F.lit(1)).alias("films"), F.sum("num_votes").alias("votes"))

    return {"sketch_profile": profiled, "sketch_quantiles": ranked, "bitmap_coverage": bitmap_coverage,
            "q1_indexed": q1_indexed, "q6_indexed": q6_indexed, "name_search": search, "bucketed_join": bucketed}


# -- files without a declared schema, batches, layouts for lookups ----------------

ZORDER = ["start_year", "average_rating", "num_votes"]
ZFILES = 16


def _films(cat) -> DataFrame:
    """Flat films: the columns that lookups filter on."""
    return cat.movies.join(cat.ratings, "movie_id").select(
        "movie_id", F.col("primary_title").alias("title"), "start_year", "average_rating", "num_votes")


def ingest() -> dict[str, Query]:
    def exported(spark, d, names):
        root, raw = scratch(spark, "csv-text"), RawCatalog(Catalog(spark, d))
        for name in names:
            csv_ingest.export_csv(getattr(raw, f"text_{name}"), f"{root}/{name}.csv")
        return root

    def inferred_types(spark, d):
        """Types of the dirty exports, each from the merged states of two halves."""
        root, parts = exported(spark, d, ["movies", "ratings"]), []
        for name in ("movies", "ratings"):
            text = csv_ingest.normalise_headers(csv_records.read_quoted_csv(spark, f"{root}/{name}.csv"))
            odd = F.xxhash64("movie_id") % 2 != 0
            state = inference.merge_states([inference.type_state(text.where(odd)), inference.type_state(text.where(~odd))])
            parts.append(inference.column_types(state).select(F.lit(name).alias("table_name"), "*"))
        return parts[0].union(parts[1])

    def inferred_rows(spark, d):
        return inference.read_inferred_csv(spark, f"{exported(spark, d, ['movies'])}/movies.csv")

    def multiline(spark, d):
        """Whole documents, line feeds and quotes included, through a CSV file."""
        root = scratch(spark, "csv-lines")
        docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang", "source", "text")
        csv_ingest.export_csv(docs, f"{root}/documents.csv")
        back = csv_ingest.normalise_headers(csv_records.read_quoted_csv(spark, f"{root}/documents.csv"))
        return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "source",
                           F.length("text").cast("bigint").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("text_md5"))

    def discovered(spark, d):
        """Tables found in a folder, known and unknown ones, with rows and types."""
        root, cat = scratch(spark, "csv-found"), Catalog(spark, d)
        for name, df in {"Genres": cat.genres, "persons": cat.persons, "Parts_List": cat.source("part").select(
                "p_partkey", "p_name", "p_size")}.items():
            csv_ingest.export_csv(df, f"{root}/{name}.csv")
        parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(", ".join(
                f"{c} {t}" for c, t in df.drop(cleaning.UNPARSABLE).dtypes)).alias("types"))
            for name, df in inference.read_directory(spark, root).items()]
        return parts[0].union(parts[1]).union(parts[2])

    def batches(spark, d):
        """Rows per batch after one was appended twice and another was replaced."""
        root, movies = scratch(spark, "batches"), Catalog(spark, d).movies
        first, second = movies.where("start_year < 1998"), movies.where("start_year >= 1998")
        for df, batch in ((first, "early"), (second.limit(3), "late"), (first, "early"), (second, "late")):
            sinks.append_batch(df, root, "movies", batch)
        return spark.read.parquet(sinks.table_path(root, "movies")).groupBy(sinks.BATCH).agg(
            F.count(F.lit(1)).alias("rows"), F.countDistinct("movie_id").alias("films"))

    def observed_load(spark, d):
        raw, seen = RawCatalog(Catalog(spark, d)), {}
        cleaning.load_tables(_raw_tables(raw), scratch(spark, "observed"), observed=seen)
        return cleaning.observed_report(spark, seen)

    def zorder(spark, d):
        path = scratch(spark, "zorder")
        layout.write_zorder(_films(Catalog(spark, d)), path, ZORDER, ZFILES)
        films = spark.read.parquet(path)
        y, r, v = P["zorder_bounds"]
        return films.where(F.col("start_year").between(*y) & (F.col("average_rating") >= r) & (F.col("num_votes") >= v))

    def zorder_files(spark, d):
        """How many files the filter leaves to be read in Z-order and sorted by title."""
        films, found = _films(Catalog(spark, d)), []
        y, r, v = P["zorder_bounds"]
        bounds = {"start_year": y, "average_rating": (r, None), "num_votes": (v, None)}
        for label in ("zorder", "title"):
            path = scratch(spark, label)
            if label == "zorder":
                layout.write_zorder(films, path, ZORDER, ZFILES)
            else:
                sinks.write_layout(films, path, sort_by=["title"], num_files=ZFILES)
            read = layout.files_to_read(layout.file_ranges(spark.read.parquet(path), ZORDER), bounds)
            found.append(read.select(F.lit(label).alias("layout"), "files", "files_read"))
        both = found[0].union(found[1]).groupBy().pivot("layout", ["zorder", "title"]).agg(
            F.first("files").alias("files"), F.first("files_read").alias("read"))
        return both.select("zorder_files", "title_files", (F.col("zorder_read") < F.col("title_read")).alias("fewer_files"))

    def bloom(spark, d):
        """Equality lookups, present and absent, on unsorted columns with Bloom filters."""
        root, cat = scratch(spark, "bloom"), Catalog(spark, d)
        sinks.write_layout(_films(cat), f"{root}/films", bloom={"title": 1 << 20, "movie_id": 1 << 20})
        sinks.write_layout(cat.principals, f"{root}/principals", bloom={"person_id": 1 << 16})
        films, cast = (spark.read.parquet(f"{root}/{t}") for t in ("films", "principals"))
        wanted = [(films, "title", P["film_title"]), (films, "title", "no such title"), (films, "movie_id", 7),
                  (films, "movie_id", -7), (cast, "person_id", 3), (cast, "person_id", -3)]
        parts = [df.where(F.col(c) == v).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(c).alias("column_name"), F.lit(str(v)).alias("value"), "rows") for df, c, v in wanted]
        out = parts[0]
        for p in parts[1:]:
            out = out.union(p)
        return out

    return {"csv_inferred_types": inferred_types, "csv_inferred_movies": inferred_rows, "csv_multiline": multiline,
            "csv_discovered": discovered, "append_batches": batches, "load_observed": observed_load,
            "layout_zorder": zorder, "layout_zorder_files": zorder_files, "layout_bloom": bloom}


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for key, fn in {**questions(), **documents()}.items():
        out[key] = (lambda f: lambda spark, d: f(Catalog(spark, d)))(fn)
    for key, fn in data_quality().items():
        out[key] = (lambda f: lambda spark, d: f(RawCatalog(Catalog(spark, d))))(fn)
    out.update(storage())
    out.update(ingest())
    out.update(indexes())
    return out
