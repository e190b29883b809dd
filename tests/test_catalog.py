"""Every query with SQL gives the rows that DuckDB gives, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from genoweave.plans import catalog

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.is_dir(), reason="no tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_same_rows(spark, duck, name):
    df = catalog.QUERIES[name](spark, str(SF))
    found = duck.execute(catalog.ORACLE[name])
    columns = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert plain(df.collect(), df.columns) == plain(found.fetchall(), columns)


def test_queries_without_sql_have_tests_of_their_own():
    """They are compared row by row with plain walks in test_multi_queries.py and test_folds.py."""
    assert set(catalog.QUERIES) - set(catalog.ORACLE) == {
        "annotate", "covered_blocks", "evidence", "fused_blocks", "genotype_insertions", "global_align", "merge_insertions", "merged_blocks", "nested_blocks", "region_rows", "single_coverage",
    }


def test_merges_match_plain_walks(spark):
    """Members of all clusters are all rows, and clusters are those of a walk over sorted rows."""
    from genoweave.operators import folds
    from genoweave.plans.views import register

    iv = register(spark, str(SF), "v_iv")["v_iv"]
    rows = [r.asDict() for r in iv.selectExpr("id", "contig", "st AS beg", "en AS end", "en - st AS len", "sample").collect()]
    want, last = {}, {}
    for r in sorted(rows, key=lambda r: (r["contig"], r["beg"], r["end"], r["len"], r["id"])):
        rep = last.get(r["contig"])
        share = folds._share(r["beg"], r["end"], rep["beg"], rep["end"]) if rep else None
        if not (share is not None and share > 0.9 and 0.95 < r["len"] / rep["len"] < 1.05):
            rep = last[r["contig"]] = r
        want[rep["id"]] = want.get(rep["id"], 0) + 1
    got = {r["id"]: r["n"] for r in catalog.QUERIES["merge_deletions"](spark, str(SF)).collect()}
    assert got == want
