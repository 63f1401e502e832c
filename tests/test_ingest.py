"""Files without a declared schema: records over splits, type inference, discovery."""

import io
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from reelframe import registry
from reelframe.sources import csv_ingest, csv_records, inference

COLUMNS = {
    "whole": ["1", "-2", " 30 "], "gappy": ["1", "", "3"], "fixed": ["1", "2.50", "-.5"], "exponent": ["1", "2e3", "0.5"],
    "infinite": ["inf", "1", "-Infinity"], "flag": ["True", "false", "TRUE"], "gappy_flag": ["True", "NA", "False"],
    "mixed": ["True", "1", "2"], "text": ["a", "1", "2.0"], "empty": ["", "NULL", "nan"], "padded": ["007", "1", "12"],
    "big": ["123456789012345678901234567890", "1", "2"], "long": ["9223372036854775807", "1", "2"],
    "far": ["1" * 40 + ".5", "1", "2"], "trailing": ["5.", "1", "2"],
}
SPARK = {"whole": "bigint", "gappy": "bigint", "fixed": "decimal(3,2)", "exponent": "double", "infinite": "double",
         "flag": "boolean", "gappy_flag": "boolean", "mixed": "string", "text": "string", "empty": "double",
         "padded": "bigint", "big": "decimal(30,0)", "long": "bigint", "far": "double", "trailing": "decimal(1,0)"}


def frame(spark, rows=slice(None)):
    return spark.createDataFrame([tuple(v) for v in list(zip(*COLUMNS.values()))[rows]],
                                 ", ".join(f"{c} string" for c in COLUMNS))


def test_types_are_those_of_pandas_and_hold_every_value(spark):
    found = {r.column_name: r for r in inference.column_types(inference.type_state(frame(spark))).collect()}
    text = pd.DataFrame(COLUMNS).to_csv(index=False)
    for c, kind in pd.read_csv(io.StringIO(text)).dtypes.items():
        assert found[c].pandas_type == ("object" if str(kind) == "str" else str(kind)), c
    assert {c: r.spark_type for c, r in found.items()} == SPARK
    typed = inference.infer_schema(frame(spark))
    assert dict(typed.dtypes) == {c: t for c, t in SPARK.items()}
    missing = {c: sum(v in csv_ingest.DEFAULT_NA_VALUES for v in vs) for c, vs in COLUMNS.items()}
    nulls = typed.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in COLUMNS]).first().asDict()
    assert nulls == missing
    assert {c: r.n_missing for c, r in found.items()} == missing
    assert (found["text"].witness, found["fixed"].witness, found["mixed"].witness) == ("a", "-.5", "True")


def test_states_of_batches_merge_into_the_state_of_the_whole(spark):
    whole = inference.type_state(frame(spark))
    parts = [inference.type_state(frame(spark, slice(i, i + 1))) for i in range(3)]
    key = lambda df: sorted(tuple(r) for r in df.collect())
    merged = inference.merge_states([inference.merge_states(parts[:2]), parts[2]])
    assert key(merged.select(*whole.columns)) == key(whole)
    # widening only: a batch of text makes the column text, whatever came before
    types = inference.column_types(inference.merge_states([parts[0], inference.type_state(frame(spark).limit(0))]))
    assert types.count() == len(COLUMNS)


def test_frames_without_rows_or_columns(spark):
    assert inference.infer_types(frame(spark).limit(0)) == dict.fromkeys(COLUMNS, "string")
    assert inference.infer_schema(frame(spark).limit(0)).count() == 0


def nasty(n, seed=2):
    rnd = random.Random(seed)
    pieces = ["plain", 'quo"ted', "two\nlines", "\n\n", ",", "end ", "ü", "\r\nback", '""', "x" * 40]
    return [(str(i), "".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 6))), rnd.choice([None, "b", "c,d"]))
            for i in range(n)]


@pytest.mark.parametrize("split", [64, 500, 1 << 27])
def test_records_with_line_feeds_over_splits(spark, tmp_path, split):
    import csv

    rows = nasty(200)
    for part in range(2):
        with open(tmp_path / f"part-{part}.csv", "w", newline="") as f:
            out = csv.writer(f, lineterminator="\n" if part else "\r\n")
            out.writerow(["('mid',)", "some\ntext", "last"])
            out.writerows([[c if c is not None else "" for c in r] for r in rows[part::2]])
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        df = csv_records.read_quoted_csv(spark, str(tmp_path))
        assert df.columns == ["('mid',)", "some\ntext", "last"]
        assert sorted(map(tuple, df.collect()), key=lambda r: int(r[0])) == rows
        if split == 64:
            assert csv_records._lines(spark, str(tmp_path)).select("file", "block").distinct().count() > 50
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_one_record_over_many_blocks(spark, tmp_path):
    long = "\n".join(f"line {i}" for i in range(100))
    (tmp_path / "a.csv").write_text(f'id,text\n1,"{long}"\n2,short\n')
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "50")
        assert sorted(map(tuple, csv_records.read_quoted_csv(spark, str(tmp_path / "a.csv")).collect())) == [
            ("1", long), ("2", "short")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_spark_written_files_and_empty_ones(spark, tmp_path):
    df = spark.createDataFrame(nasty(50, 5), "movie_id string, title string, region string")
    csv_ingest.export_csv(df, str(tmp_path / "out.csv"))
    back = csv_ingest.normalise_headers(csv_records.read_quoted_csv(spark, str(tmp_path / "out.csv")))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    (tmp_path / "head.csv").write_text("a,b\n")
    assert csv_records.read_quoted_csv(spark, str(tmp_path / "head.csv")).collect() == []


def test_directory_discovery(spark, tmp_path):
    (tmp_path / "Unknown_Table.csv").write_text("a,b,c\n1,x,\n2,,2.5\n")
    (tmp_path / "ratings.csv").write_text('"(\'mid\',)","(\'averageRating\',)"\nr1,7.5\nr2,bad\n')
    (tmp_path / "notes.txt").write_text("no table")
    found = csv_records.find_csv(spark, str(tmp_path))
    assert list(found) == ["ratings", "unknown_table"]
    tables = inference.read_directory(spark, str(tmp_path))
    assert tables["unknown_table"].dtypes == [("a", "bigint"), ("b", "string"), ("c", "decimal(2,1)")]
    assert [tuple(r) for r in tables["ratings"].orderBy("movie_id").collect()] == [
        ("r1", 7.5, None), ("r2", None, "average_rating")]
    assert csv_records.find_csv(spark, registry.scratch(spark, "none")) == {}
