"""Plan-level guards for the properties that matter at scale."""

import contextlib
import io
import re

import pytest

from reelframe import registry
from reelframe.operators import cleaning
from reelframe.operators.nesting import build_from_catalog
from reelframe.sources.catalog import Catalog
from reelframe.sources.raw_views import RawCatalog
from tests.conftest import SF_SMALL

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"]


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.fixture(scope="module")
def cat(spark):
    return Catalog(spark, SF_SMALL)


@pytest.mark.parametrize("key", sorted({**registry.questions(), **registry.documents()}))
def test_questions_have_no_cross_join_or_python(cat, key):
    text = plan({**registry.questions(), **registry.documents()}[key](cat))
    assert not [f for f in FORBIDDEN if f in text]


@pytest.mark.parametrize("key", sorted(registry.data_quality()))
def test_data_quality_has_no_cross_join_or_python(cat, key):
    text = plan(registry.data_quality()[key](RawCatalog(cat)))
    assert not [f for f in FORBIDDEN if f in text]


def test_top_n_per_genre_limits_before_the_shuffle(cat):
    for key in ["q7_nest", "q7_pipe"]:
        text = plan(registry.questions()[key](cat))
        assert "WindowGroupLimit" in text and "Partial" in text, key


def test_top_k_is_take_ordered(cat):
    text = plan(registry.questions()["q2_sql"](cat))
    assert "TakeOrderedAndProject" in text


def test_scans_read_only_needed_columns(cat):
    text = plan(registry.questions()["q8_sql"](cat))
    schemas = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    lineitem = [s for s in schemas if "l_orderkey" in s]
    assert lineitem and all(s.count(":") <= 4 for s in lineitem)
    assert not any("l_comment" in s or "l_extendedprice" in s for s in schemas)


def test_name_filter_reaches_the_scan(cat):
    text = plan(registry.questions()["q4_sql"](cat))
    assert "s_name" in text and "Contains" in text


def test_ranks_have_no_window_over_films(cat):
    for key in ["q7_clean", "q7_sql"]:
        df = registry.questions()[key](cat)
        tree = df._jdf.queryExecution().optimizedPlan().toString()
        windows = [line for line in tree.splitlines() if "Window [" in line]
        assert windows and all("movie_id" not in w and "sum(n" in w for w in windows), key


def test_nested_build_groups_once_by_title(cat):
    text = plan(build_from_catalog(cat))
    assert text.count("hashpartitioning(movie_id") >= 1
    finals = [line for line in text.splitlines() if "Keys [1]: [movie_id" in line]
    assert finals, "documents are not grouped by movie_id"


def test_lookups_and_cast_questions_read_the_documents_once(spark, cat):
    from types import SimpleNamespace

    path = registry.scratch(spark, "docs")
    cat.docs.write.parquet(path)
    stored = SimpleNamespace(docs=spark.read.parquet(path))
    for key in ["q1_nest", "q4_nest", "q6_nest", "q7_nest"]:
        text = plan(registry.questions()[key](stored))
        assert text.count("Scan parquet") == text.count("(1) Scan parquet") + text.count("- Scan parquet") == 2, key
        assert "Join" not in text, key
    lookup = plan(registry.documents()["film_full_nested"](stored))
    scans = [line for line in lookup.splitlines() if line.startswith("PushedFilters")]
    assert scans and all("EqualTo(title," in line for line in scans)


@pytest.mark.parametrize("key", ["coverage", "orphan_persons"])
def test_wide_keys_are_dealt_over_all_partitions(cat, key):
    """The aggregates on whole keys of credits read partitions that adaptive execution
    does not merge: their rows compress too well for its measure of bytes."""
    text = registry.data_quality()[key](RawCatalog(cat))._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in text.splitlines() if "Exchange hashpartitioning(" in line and "person_id#" in line]
    assert dealt and all("REPARTITION_BY_NUM" in line for line in dealt if "job_name#" not in line)


def exchanges(df) -> list[str]:
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.splitlines() if "Exchange hashpartitioning(" in line]


def test_status_of_rows_is_found_over_all_partitions(cat):
    """Neither the rows nor the conflicts of a load read merged partitions."""
    raw = RawCatalog(cat)
    for name in ["principals", "characters", "movies"]:
        found = exchanges(cleaning.tag_rows(name, raw.table(name)))
        assert found and all("REPARTITION_BY_NUM" in line for line in found if "p_partkey" not in line), name


def test_counts_of_values_are_spread_by_a_hash(cat):
    """The bytes of a partition of counted values bound their number."""
    text = exchanges(registry.data_quality()["profile_numeric"](RawCatalog(cat)))
    counted = [line for line in text if re.search(r"hashpartitioning\(_column#\d+, value#", line)]
    assert counted and all(re.search(r"\(_column#\d+, value#\d+, \w+#\d+L, ", line) for line in counted)


def test_breakthrough_pairs_are_dealt_by_film(cat):
    """Pairs of people and films are grouped on partitions that are not merged."""
    found = exchanges(registry.questions()["q8_sql"](cat))
    assert any("REPARTITION_BY_NUM" in line and "movie_id#" in line for line in found)


def test_credits_are_dealt_by_film_only(cat):
    """The documents need no join of credits with characters, and no second shuffle of
    what is dealt by film."""
    found = exchanges(build_from_catalog(cat))
    by_film = [line for line in found if re.search(r"hashpartitioning\(movie_id#\d+L?, \d+\)", line)]
    assert by_film and all("REPARTITION_BY_NUM" in line for line in by_film if "l_orderkey" not in line)
    assert not [line for line in found if "ENSURE_REQUIREMENTS" in line and "person_id#" in line and "movie_id#" in line]
