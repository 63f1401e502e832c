"""Row-level cleaning with quarantine (never lose a table, never lose a row).

Each table has ordered rules; a row's ``reject_reason`` is its first failed
rule.  Rules C1-C6 are the loader's cleaning rules; the remaining declared
constraints (NOT NULL, CHECK, primary key) are enforced the same way instead of
failing the whole table append.

Primary-key conflicts are found with an aggregate on the key that is joined back once
and gives every row its status; every row of a conflicting key is quarantined.  Both
sides are dealt by the key.  Exact duplicate characters are
collapsed to one row and the surplus copies are quarantined.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from reelframe.functions import dealt
from reelframe.schema import PRIMARY_KEYS, SCHEMAS

UNPARSABLE = "unparsable"  # set by the CSV typing: the first column whose text is no value of its type

REASON = "reject_reason"

Rule = tuple[str, Callable[[], Column]]


def _not_null(*cols: str) -> list[Rule]:
    return [(f"{c}_missing", (lambda c=c: F.col(c).isNotNull())) for c in cols]


def _rules(table: str, columns: list[str]) -> list[Rule]:
    c = F.col
    has = set(columns)
    required = [f.name for f in SCHEMAS[table].fields if not f.nullable and f.name in has]
    rules: list[Rule] = []
    if table == "persons" and {"birth_year", "death_year"} <= has:          # C1
        rules.append(("death_before_birth", lambda: c("birth_year").isNull() | c("death_year").isNull()
                      | (c("birth_year") <= c("death_year"))))
    if table == "movies":
        if "runtime_minutes" in has:                                         # C2
            rules.append(("runtime_not_positive",
                          lambda: c("runtime_minutes").isNull() | (c("runtime_minutes") > 0)))
        if {"start_year", "end_year"} <= has:
            rules.append(("end_before_start",
                          lambda: c("end_year").isNull() | (c("start_year") <= c("end_year"))))
    if table == "episodes":                                                  # C3
        for col in ("season_number", "episode_number"):
            if col in has:
                rules.append((f"{col}_not_positive",
                              lambda col=col: c(col).isNotNull() & (c(col) > 0)))
    if table == "professions" and "job_name" in has:                        # C4
        rules.append(("job_name_missing", lambda: c("job_name").isNotNull()))
    if table == "ratings":
        if "average_rating" in has:                                          # C5
            rules.append(("rating_out_of_range",
                          lambda: (c("average_rating") >= 1.0) & (c("average_rating") <= 10.0)))
        if "num_votes" in has:
            rules.append(("negative_votes", lambda: c("num_votes").isNull() | (c("num_votes") >= 0)))
    if table == "characters" and "name" in has:                             # C6
        rules.append(("name_missing", lambda: c("name").isNotNull()))
    seen = {r[0] for r in rules}
    rules += [r for r in _not_null(*required) if r[0] not in seen]          # C8
    return rules


def reject_reason(table: str, columns: list[str]) -> Column:
    """First failed rule of a row (null when the row passes every rule).  A text that
    could not be parsed (``unparsable``, from the CSV typing) fails before the others."""
    checks = [F.when(F.col(UNPARSABLE).isNotNull(), F.concat(F.col(UNPARSABLE), F.lit("_unparsable")))
              ] if UNPARSABLE in columns else []
    checks += [F.when(~F.coalesce(pred(), F.lit(False)), F.lit(name)) for name, pred in _rules(table, columns)]
    return F.coalesce(*checks) if checks else F.lit(None).cast("string")


def tag_rows(table: str, df: DataFrame) -> DataFrame:
    """Every row with its ``reject_reason`` (null: valid)."""
    cols = [c for c in df.columns if c != UNPARSABLE]
    tagged = df.withColumn(REASON, reject_reason(table, df.columns)).select(*cols, REASON)
    if table == "characters":
        counted = dealt(tagged, *cols).groupBy(*cols, REASON).agg(F.count(F.lit(1)).alias("_n"))
        copy = F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))
        again = F.when(F.col(REASON).isNull() & (F.col("_copy") > 1), F.lit("duplicate_row"))
        return counted.withColumn("_copy", copy).select(*cols, F.coalesce(REASON, again).alias(REASON))
    pk = [k for k in PRIMARY_KEYS.get(table, []) if k in cols]
    if not pk:
        return tagged
    conflicts = (dealt(tagged.filter(F.col(REASON).isNull()), *pk).groupBy(*pk)
                 .agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1))
    again = F.when(F.col("_n").isNotNull(), F.lit("duplicate_key"))
    return dealt(tagged, *pk).join(conflicts, pk, "left").select(*cols, F.coalesce(REASON, again).alias(REASON))


def clean_table(table: str, df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into (valid rows, rejected rows with ``reject_reason``)."""
    return valid_rows(table, df), tag_rows(table, df).filter(F.col(REASON).isNotNull())


def valid_rows(table: str, df: DataFrame) -> DataFrame:
    """The rows that ``tag_rows`` gives no reason, by one scan and one aggregate: of the
    rows that pass the rules, those whose key occurs once (for characters: one of each
    set of equal rows)."""
    cols = [c for c in df.columns if c != UNPARSABLE]
    passed = df.filter(reject_reason(table, df.columns).isNull()).select(*cols)
    if table == "characters":
        return dealt(passed, *cols).distinct()
    pk = [k for k in PRIMARY_KEYS.get(table, []) if k in cols]
    if not pk:
        return passed
    keys = dealt(passed, *pk).groupBy(*pk).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in cols if c not in pk])
    return keys.filter(F.col("_n") == 1).select(*cols)


REPEATED = 10_000


def _repeat(df: DataFrame, times: Column) -> DataFrame:
    """Every row ``times`` over, in steps that bound the arrays."""
    steps = F.explode(F.sequence(F.lit(0), F.floor((times - 1) / REPEATED)))
    d = df.withColumn("_times", times).where("_times > 0").withColumn("_step", steps)
    left = F.least(F.lit(REPEATED), F.col("_times") - F.col("_step") * REPEATED).cast("int")
    return d.withColumn("_copy", F.explode(F.sequence(F.lit(1), left))).drop("_times", "_step", "_copy")


def record_key(table: str, df: DataFrame) -> Column:
    """Printable primary key: key columns as text joined by ``'|'``."""
    pk = [k for k in PRIMARY_KEYS.get(table, []) if k in df.columns] or df.columns
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in pk])


def quarantine(tables: dict[str, DataFrame]) -> DataFrame:
    """All rejected rows of several tables: ``table_name, record_key, reject_reason``.

    One scan and one aggregate per table: rows are counted by key and reason, and a key
    that passed the rules more than once is a conflict (for characters, whose key is
    the whole row, all but one are surplus).  Then every count becomes that many rows."""
    parts = []
    for name, df in tables.items():
        pk = [k for k in PRIMARY_KEYS.get(name, []) if k in df.columns]
        # without a key no row conflicts
        keys = pk or [c for c in df.columns if c != UNPARSABLE]
        counted = (dealt(df.withColumn(REASON, reject_reason(name, df.columns)), *keys).groupBy(*keys, REASON)
                   .agg(F.count(F.lit(1)).alias("_n")))
        if name == "characters":
            surplus, conflict = F.col("_n") - 1, "duplicate_row"
        else:
            surplus, conflict = F.when(F.col("_n") > 1, F.col("_n")).otherwise(0) if pk else F.lit(0), "duplicate_key"
        times = F.when(F.col(REASON).isNotNull(), F.col("_n")).otherwise(surplus).cast("bigint")
        rows = counted.select(F.lit(name).alias("table_name"), record_key(name, df).alias("record_key"),
                              F.coalesce(REASON, F.lit(conflict)).alias(REASON), times.alias("_rows"))
        parts.append(_repeat(rows.where("_rows > 0"), F.col("_rows")).drop("_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def load_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows read, kept and dropped per table.  One scan and one aggregate on the key
    per table: a key is kept when one row (for characters: any row) passes the rules."""
    parts = []
    for name, df in tables.items():
        pk = [k for k in PRIMARY_KEYS.get(name, []) if k in df.columns] or df.columns
        passed = F.col(REASON).isNull()
        keys = (dealt(df.withColumn(REASON, reject_reason(name, df.columns)), *pk).groupBy(*pk)
                .agg(F.count(F.lit(1)).alias("n"), F.count_if(passed).alias("k")))
        kept = (F.col("k") > 0) if name == "characters" else (F.col("k") == 1)
        parts.append(keys.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows_read"),
                              F.count_if(kept).alias("rows_kept"))
                     .select(F.lit(name).alias("table_name"), "rows_read", "rows_kept"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("rows_dropped", F.col("rows_read") - F.col("rows_kept"))


def load_tables(tables: dict[str, DataFrame], root: str, clean: bool = True,
                observed: dict[str, Observation] | None = None) -> dict[str, DataFrame]:
    """S7 + S8 + C1-C8: clean every table (parent-first order of ``tables``) and write
    valid and rejected rows in one job to ``root/<table>``, partitioned by
    ``status`` (``valid`` / ``rejected``, with ``reject_reason``); return the stored
    valid rows (a partition-pruned read).  ``observed`` is filled with each table's
    counts as the writing job sees them (see ``observed_report``).

    Reading the written tables back cuts the lineage: later audits and
    questions scan Parquet instead of re-deriving the cleaning.  Overwrite per
    directory keeps a re-run after a failure idempotent."""
    root = root.rstrip("/")
    out: dict[str, DataFrame] = {}
    for name, df in tables.items():
        both = tag_rows(name, df) if clean else df.withColumn(REASON, F.lit(None).cast("string"))
        both = both.withColumn("status", F.when(F.col(REASON).isNull(), "valid").otherwise("rejected"))
        written = both
        if observed is not None:
            observed[name] = Observation(f"load {name}")
            reasons = {r: F.count_if(F.col(REASON) == r) for r in possible_reasons(name, df.columns)}
            written = both.observe(observed[name], F.count(F.lit(1)).alias("rows_read"),
                                   F.count_if(F.col(REASON).isNull()).alias("rows_kept"),
                                   *[n.alias(f"dropped {r}") for r, n in reasons.items()])
        written.write.mode("overwrite").partitionBy("status").parquet(f"{root}/{name}")
        out[name] = stored_rows(df.sparkSession, root, name, schema=both.schema)
    return out


def possible_reasons(table: str, columns: list[str]) -> list[str]:
    """Every ``reject_reason`` that a row of the table can get."""
    reasons = [r for r, _ in _rules(table, columns)]
    if UNPARSABLE in columns:
        reasons += [f"{f.name}_unparsable" for f in SCHEMAS[table].fields if f.name in columns]
    return reasons + ["duplicate_row" if table == "characters" else "duplicate_key"]


def observed_report(spark, observed: dict[str, Observation]) -> DataFrame:
    """S9 without another job: (table_name, reason, rows) from the counts that the
    writing jobs made; reasons are ``read``, ``kept`` and those of dropped rows, if any."""
    rows = []
    for name, seen in observed.items():
        counts = seen.get
        rows += [(name, "read", counts["rows_read"]), (name, "kept", counts["rows_kept"])]
        rows += [(name, k.removeprefix("dropped "), n) for k, n in counts.items() if k.startswith("dropped ") and n]
    return spark.createDataFrame(rows, "table_name string, reason string, rows long")


def stored_rows(spark, root: str, table: str, status: str = "valid", schema=None) -> DataFrame:
    """Valid (or rejected) rows of a table written by ``load_tables``; with its
    ``schema`` a table that was written without rows reads as empty."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    rows = reader.parquet(f"{root.rstrip('/')}/{table}").filter(F.col("status") == status).drop("status")
    return rows.drop(REASON) if status == "valid" else rows
