"""Referential-integrity audit driven by foreign-key specs.

The checks on references are conditional sums over one census of all keys: one scan
per table and one aggregate, with partial sums before the shuffle, so hot keys stay
cheap.  No key set is ever collected, and nothing is joined to its parent.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from reelframe.functions import dealt
from reelframe.schema import (AUDITED_MOVIE_CHILDREN, AUDITED_PERSON_CHILDREN, FOREIGN_KEYS, PRIMARY_KEYS,
                              ForeignKey)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _status(col: str) -> F.Column:
    return F.when(F.col(col) == 0, F.lit("OK")).otherwise(F.lit("PROBLEM"))


def pk_duplicates(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, distinct keys and ``rows - distinct keys`` per table."""
    parts = []
    for name, df in tables.items():
        pk = [k for k in PRIMARY_KEYS.get(name, []) if k in df.columns] or df.columns
        per_key = dealt(df, *pk).groupBy(*pk).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(per_key.agg(F.sum("_n").cast("bigint").alias("total_rows"),
                                 F.count(F.lit(1)).alias("distinct_keys"))
                     .select(F.lit(name).alias("table_name"), "total_rows", "distinct_keys"))
    return (_union(parts)
            .withColumn("total_rows", F.coalesce("total_rows", F.lit(0).cast("bigint")))
            .withColumn("duplicates", F.col("total_rows") - F.col("distinct_keys")))


EXAMPLES = 3


# -- one census of all keys ---------------------------------------------------------

@dataclass(frozen=True)
class Reference:
    """Columns of a table that name rows of a parent (or, as the first of its kind,
    the parent's own key)."""
    table: str
    columns: tuple[str, ...]


def census(tables: dict[str, DataFrame], kinds: list[list[Reference]]) -> DataFrame:
    """(kind, key, n0, n1, ...): for every key of every kind, how many rows of each of
    its references carry it (n0: of the parent).

    A table gives the keys of all its references in one scan, and keys are counted
    in one aggregate (map-side first, so a hot key travels once per task).  Shorter
    keys are padded with nulls; keys whose types differ are compared as text."""
    width = max(len(r.columns) for refs in kinds for r in refs)
    types: list[set[str]] = [set() for _ in range(width)]
    for refs in kinds:
        for r in refs:
            for i, c in enumerate(r.columns):
                types[i].add(tables[r.table].schema[c].dataType.simpleString())
    kept = [t.pop() if len(t) == 1 else "string" for t in types]
    cells: dict[str, list] = {}
    for kind, refs in enumerate(kinds):
        for role, r in enumerate(refs):
            key = [(F.col(r.columns[i]) if i < len(r.columns) else F.lit(None)).cast(kept[i]).alias(f"k{i}")
                   for i in range(width)]
            cells.setdefault(r.table, []).append(F.struct(F.lit(kind).alias("kind"), F.lit(role).alias("role"),
                                                          F.struct(*key).alias("key")))
    rows = _union([tables[t].select(F.inline(F.array(*c))) for t, c in cells.items()])
    roles = max(len(refs) for refs in kinds)
    return rows.groupBy("kind", "key").agg(*[F.count_if(F.col("role") == i).alias(f"n{i}") for i in range(roles)])


def _null_key(width: int) -> F.Column:
    """Whether a key of ``width`` columns has a null in it."""
    out = F.col("key.k0").isNull()
    for i in range(1, width):
        out = out | F.col(f"key.k{i}").isNull()
    return out


def _reference_checks(tables: dict[str, DataFrame], kinds: list[list[Reference]], nulls: bool,
                      examples: bool = True) -> DataFrame:
    """(kind, role, referenced_ids, orphaned_count, orphaned_rows, examples) of every
    reference: its keys, those that the parent lacks, the rows that carry them, the
    first such keys.  With ``nulls`` a key with a null is one that every parent lacks,
    else it is no reference."""
    counted = census(tables, kinds)
    specs, found = [], []
    for kind, refs in enumerate(kinds):
        null = _null_key(len(refs[0].columns))
        known = (F.col("n0") > 0) & ~null
        for role in range(1, len(refs)):
            mine = (F.col("kind") == kind) & (F.col(f"n{role}") > 0)
            if not nulls:
                mine = mine & ~null
            specs.append((kind, role, mine, mine & ~known))
    for i, (_, role, mine, lost) in enumerate(specs):
        found += [F.count_if(mine).alias(f"a{i}"), F.count_if(lost).alias(f"b{i}"),
                  F.coalesce(F.sum(F.when(lost, F.col(f"n{role}"))), F.lit(0)).cast("bigint").alias(f"c{i}")]
    out = counted.agg(*found).select(F.inline(F.array(*[F.struct(
        F.lit(i).alias("spec"), F.lit(kind).alias("kind"), F.lit(role).alias("role"), F.col(f"a{i}").alias("referenced_ids"),
        F.col(f"b{i}").alias("orphaned_count"), F.col(f"c{i}").alias("orphaned_rows"))
        for i, (kind, role, _, _) in enumerate(specs)])))
    if not examples:
        return out.drop("spec")
    lost = F.filter(F.array(*[F.when(x, F.lit(i)) for i, (_, _, _, x) in enumerate(specs)]), lambda i: i.isNotNull())
    shown = counted.where(F.col("key.k0").isNotNull()).select("key", F.explode(lost).alias("spec"))
    first = W.partitionBy("spec").orderBy("key")  # cut to the first ones before the shuffle
    shown = shown.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= EXAMPLES)
    text = F.concat_ws("|", *[F.col(f"key.{f.name}").cast("string") for f in counted.schema["key"].dataType])
    listed = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("nth", text.alias("k")))), lambda x: x.k), ", ")
    shown = shown.groupBy("spec").agg(listed.alias("examples"))
    return out.join(shown, "spec", "left").withColumn("examples", F.coalesce("examples", F.lit(""))).drop("spec")


def orphan_check(parent: DataFrame, parent_key: str, children: dict[str, DataFrame],
                 child_key: str, suffix: str, examples: bool = True) -> DataFrame:
    """Per child table — referenced ids, ids missing from the parent,
    child rows carrying those ids, example ids (optional), status."""
    refs = [Reference("", (parent_key,)), *[Reference(name, (child_key,)) for name in children]]
    found = _reference_checks({"": parent, **children}, [refs], nulls=True, examples=examples)
    name = F.element_at(F.array(*[F.lit(c) for c in children]), F.col("role"))
    return (found.select(F.concat(name, F.lit(f"_orphaned_{suffix}")).alias("check_name"), name.alias("table_name"),
                         *[c for c in found.columns if c not in ("kind", "role")])
            .withColumn("status", _status("orphaned_count")))


def fk_audit(tables: dict[str, DataFrame], specs: list[ForeignKey] | None = None) -> DataFrame:
    """Every declared foreign key, over all its columns (SQL semantics: a null in the
    child key is not a violation): referenced keys, keys missing from the parent,
    child rows carrying them, example keys, status.  One row per key spec; specs whose
    tables are absent are skipped."""
    specs = [fk for fk in specs or FOREIGN_KEYS if fk.child in tables and fk.parent in tables]
    by_parent: dict[tuple, list[ForeignKey]] = {}
    for fk in specs:
        by_parent.setdefault((fk.parent, fk.parent_key()), []).append(fk)
    kinds = [[Reference(*parent), *[Reference(fk.child, fk.columns) for fk in fks]] for parent, fks in by_parent.items()]
    found = _reference_checks(tables, kinds, nulls=False)
    labels = F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(role).alias("role"), F.lit(fk.name).alias("check_name"),
                                F.lit(fk.child).alias("table_name"), F.lit(", ".join(fk.columns)).alias("column_name"),
                                F.lit(fk.parent).alias("parent_table"))
                       for kind, fks in enumerate(by_parent.values()) for role, fk in enumerate(fks, 1)])
    mine = F.get(F.filter(labels, lambda x: (x.kind == F.col("kind")) & (x.role == F.col("role"))), F.lit(0))
    return (found.withColumn("l", mine)
            .select("l.check_name", "l.table_name", "l.column_name", "l.parent_table",
                    "referenced_ids", "orphaned_count", "orphaned_rows", "examples")
            .withColumn("status", _status("orphaned_count")))


def orphan_movies(movies: DataFrame, children: dict[str, DataFrame], examples: bool = True) -> DataFrame:
    return orphan_check(movies, "movie_id", children, "movie_id", "movies", examples)


def orphan_persons(persons: DataFrame, children: dict[str, DataFrame], examples: bool = True) -> DataFrame:
    return orphan_check(persons, "person_id", children, "person_id", "persons", examples)


def films_without_data(movies: DataFrame, children: dict[str, DataFrame]) -> DataFrame:
    """Films with no row in any child table (ordered by id)."""
    referenced = _union([c.select("movie_id").distinct() for c in children.values()])
    return (movies.join(referenced, "movie_id", "left_anti")
            .select("movie_id", "primary_title", "start_year")
            .orderBy("movie_id"))


def films_without_data_examples(movies: DataFrame, children: dict[str, DataFrame], k: int = 5) -> DataFrame:
    """The first ``k`` films without data (by id), as shown next to their count."""
    return films_without_data(movies, children).limit(k)


def coverage(children: dict[str, DataFrame]) -> DataFrame:
    """I4: distinct films per child table."""
    counted = census(children, [[Reference(name, ("movie_id",)) for name in children]])
    found = counted.agg(*[F.count_if(F.col(f"n{i}") > 0).alias(f"n{i}") for i in range(len(children))])
    return found.select(F.inline(F.array(*[F.struct(F.lit(name).alias("table_name"), F.col(f"n{i}").alias("films"))
                                           for i, name in enumerate(children)])))


def orphan_pairs(characters: DataFrame, principals: DataFrame) -> DataFrame:
    """(movie, person) pairs present in characters but absent from principals."""
    return (characters.select("movie_id", "person_id").distinct()
            .join(principals.select("movie_id", "person_id"), ["movie_id", "person_id"], "left_anti"))


def integrity_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per check (orphaned count, status) sorted by name, plus a total.

    ``films_without_data`` reports its true count.  All checks come from one census:
    films, persons, and the (film, person) pairs of characters and principals."""
    films, people = AUDITED_MOVIE_CHILDREN, AUDITED_PERSON_CHILDREN
    pair = ("movie_id", "person_id")
    counted = census(tables, [
        [Reference("movies", ("movie_id",)), *[Reference(c, ("movie_id",)) for c in films]],
        [Reference("persons", ("person_id",)), *[Reference(c, ("person_id",)) for c in people]],
        [Reference("principals", pair), Reference("characters", pair)]])

    def lost(kind: int, role: int, width: int = 1) -> F.Column:
        known = (F.col("n0") > 0) & ~_null_key(width)
        return F.count_if((F.col("kind") == kind) & (F.col(f"n{role}") > 0) & ~known)

    checks = {f"{c}_orphaned_movies": lost(0, i) for i, c in enumerate(films, 1)}
    checks |= {f"{c}_orphaned_persons": lost(1, i) for i, c in enumerate(people, 1)}
    unused = F.lit(True)
    for i in range(1, len(films) + 1):
        unused = unused & (F.col(f"n{i}") == 0)
    bare = (F.col("kind") == 0) & (unused | _null_key(1))
    checks["films_without_data"] = F.coalesce(F.sum(F.when(bare, F.col("n0"))), F.lit(0)).cast("bigint")
    checks["characters_orphaned"] = lost(2, 1, 2)
    row = counted.agg(*[c.alias(name) for name, c in checks.items()])
    total = sum((F.col(c) for c in list(checks)[1:]), F.col(list(checks)[0]))
    out = row.select(F.inline(F.array(*[F.struct(F.lit(name).alias("check_name"), value.alias("orphaned_count"))
                                        for name, value in [*[(c, F.col(c)) for c in checks], ("total", total)]])))
    return (out.withColumn("status", _status("orphaned_count"))
            .orderBy(F.col("check_name") == "total", "check_name"))
