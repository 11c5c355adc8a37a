"""Office files made of rows, read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from hanji.plans import files
from hanji.sources import odt

SCHEMA = "path string, text string, tables array<array<array<string>>>, spans array<string>"


def test_odd_texts_come_back(spark):
    texts = [None, "", "a  b\tc <&> ]]> \"'", "one\n\n  \ntwo", "bell\x07 and \r return", "x" * 1_000_000, " a" * 50_000]
    rows = [(f"/d/{k}.odt", t, [[["h", None], ["a|b", "  c  "]]], []) for k, t in enumerate(texts)]
    read = odt.parse_documents(files.documents(spark.createDataFrame(rows, SCHEMA)).withColumn("file_hash", F.lit("")))
    got = {int(r["doc_id"]): r for r in read.collect()}
    assert [got[k]["error"] for k in range(len(texts))] == [None] * len(texts)
    first = lambda k: got[k]["sections"][0]
    assert [(first(k)["section_type"], len(got[k]["sections"])) for k in (0, 1)] == [("table", 1)] * 2
    assert first(0)["content"] == "| h |  |\n| --- | --- |\n| a\\|b | c |"
    assert [first(k)["content"] for k in (2, 3, 4)] == ["a  b\tc <&> ]]> \"'", "one\ntwo", "bell  and \r return"]
    assert first(5)["content"] == texts[5] and first(6)["content"] == texts[6].strip()


def test_no_rows(spark):
    assert files.documents(spark.createDataFrame([], SCHEMA)).collect() == []


def test_files_are_written_and_found(spark, tmp_path):
    """Blanks in names, the same file twice, a scheme before the folder."""
    made = files.documents(spark.createDataFrame([(f"file:{tmp_path}/deep er/{k % 3}.odt", f"text {k % 3}", [], []) for k in range(6)], SCHEMA))
    assert files.write(made) == 6
    assert {r["doc_id"]: r["sections"][0]["content"] for r in odt.read_documents(spark, str(tmp_path)).collect()} == {f"{k}": f"text {k}" for k in range(3)}
