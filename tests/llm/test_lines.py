from __future__ import annotations

import hashlib
import string
from collections import Counter, defaultdict

import duckdb
import pytest

from hanji.llm import lines

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
BANNER = "This very line stands in a great many documents."
EXACT = "exactly forty code points, é and ß too.."


def brute(rows, min_chars=40, min_documents=5):
    holders = defaultdict(set)
    cut = [(d, (t or "").split("\n")) for d, t in rows]
    key = lambda line: line.strip(lines.WHITE).translate(LOWER)
    for d, ls in cut:
        for line in ls:
            if len(key(line)) >= min_chars:
                holders[key(line)].add(d)
    keeper = {k: max((d for d in ds if d is not None), default=-1) for k, ds in holders.items() if len(ds) >= min_documents}
    out = []
    for d, ls in cut:
        kept = [line for line in ls if key(line) not in keeper or d == keeper[key(line)]]
        out.append((d, len(ls), len(ls) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


@pytest.fixture(scope="module")
def rows(corpus_rows):
    out = [(d, t) for d, t, *_ in corpus_rows]
    out += [(1000 + k, f"start {k}\n  {BANNER.upper() if k % 2 else BANNER}\t\r\nend\n{BANNER}") for k in range(30)]
    out += [(2000 + k, EXACT) for k in range(5)] + [(2100 + k, EXACT[:-1]) for k in range(5)] + [(2200 + k, EXACT + " four only") for k in range(4)]
    out += [(2200, EXACT + " four only"), (2300, f"{BANNER}\n\n\n"), (None, BANNER), (None, "\n" + BANNER), (3000, "É" + BANNER), (3001, "é" + BANNER)]
    out += [(1005, "start 5\n  " + BANNER), (4000, "\n".join([BANNER] * 20_000 + ["x"] * 20_000)), (4001, "\n" * 100_000), (10, " " + BANNER)]
    assert len(EXACT) == 40
    return out


@pytest.fixture(scope="module")
def table(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lines") / "documents.parquet")
    from pyspark.sql import functions as F

    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).select("*", *[F.lit(1).alias(c) for c in ("line", "key", "position", "gone", "rows", "h1", "d1", "parts")]).write.parquet(path)
    return spark.read.parquet(path)


def test_against_brute_force_and_sql(spark, rows, table):
    got = Counter(map(tuple, lines.digests(lines.dedup_lines(table)).collect()))
    assert got == brute(rows)
    documents = table.select("doc_id", "text").toArrow()  # noqa: F841
    con = duckdb.connect()
    con.register("documents", documents)
    assert Counter(con.sql(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({lines.oracle()})").fetchall()) == got


def test_other_bounds(rows, table):
    got = Counter(map(tuple, lines.digests(lines.dedup_lines(table, 10, 2)).collect()))
    assert got == brute(rows, 10, 2)


def test_texts_come_back(table):
    kept = {r.doc_id: r for r in lines.dedup_lines(table).filter("doc_id between 1000 and 2004").collect()}
    assert kept[1001].text == "start 1\nend" and (kept[1001].n_lines, kept[1001].n_dropped) == (4, 2)
    assert kept[2000].text == "" and kept[2004].text == EXACT


def test_no_rows(table):
    assert lines.dedup_lines(table.limit(0)).count() == 0


def test_no_python_and_one_shuffle_of_texts(table):
    plan = lines.dedup_lines(table)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
