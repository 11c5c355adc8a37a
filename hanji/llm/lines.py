"""Lines that many documents share, dropped everywhere but in one document."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import HOT_KEYS, staged

#: White space that a line's key goes without at both ends: space, tab to carriage return.
WHITE = " \t\n\x0b\x0c\r"
#: Code points that a key needs to count as boilerplate, and documents that must hold it.
MIN_CHARS, MIN_DOCUMENTS = 40, 5


def lower_ascii(x: Column) -> Column:
    """Only A-Z become small; strings of ASCII alone take the quick way."""
    return F.when(F.octet_length(x) == F.length(x), F.lower(x)).otherwise(F.translate(x, ascii_uppercase, ascii_lowercase))


def hashes(*xs: Column) -> list[Column]:
    """128 bits: two hashes of different seeds."""
    return [F.xxhash64(F.lit(seed), *xs) for seed in (1, 2)]


def rows_of(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty) and d1, d2, by which a row is known; equal rows lose equal lines."""
    text = F.coalesce("text", F.lit(""))
    d1, d2 = hashes(F.col("doc_id"), text)
    return docs.select("doc_id", text.alias("text"), d1.alias("d1"), d2.alias("d2"))


def long_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """Every line whose key has min_chars code points: d1, d2, doc_id, position from 0, and the key as h1, h2."""
    lines = rows_of(docs).select("d1", "d2", "doc_id", F.posexplode(F.split("text", "\n")).alias("position", "line"))
    lines = lines.withColumn("bare", F.btrim("line", F.lit(WHITE))).filter(F.length("bare") >= min_chars)
    h1, h2 = hashes(F.col("key"))
    return lines.withColumn("key", lower_ascii(F.col("bare"))).select("d1", "d2", "doc_id", "position", h1.alias("h1"), h2.alias("h2"))


def repeated_keys(lines: DataFrame, min_documents: int) -> DataFrame:
    """h1, h2, keeper (the largest doc_id that holds the key) and rows, for keys of min_documents documents or more.

    A document's repeats fall together before the first shuffle, and the counts of documents before the second, so a
    line that stands in every document is nobody's large group.
    """
    nameless = F.max(F.col("doc_id").isNull().cast("int"))
    keys = lines.groupBy("h1", "h2").agg((F.count_distinct("doc_id") + nameless).alias("documents"), F.max("doc_id").alias("keeper"), F.count("*").alias("rows"))
    return keys.filter(F.col("documents") >= min_documents).select("h1", "h2", "keeper", "rows")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Documents (doc_id, text, ...) -> doc_id, text (what is left), n_lines (before), n_dropped.

    Lines end at \\n. A line's key is the line without white space at both ends, A-Z small. A key of min_chars code points
    or more that min_documents documents or more hold loses all its lines but those in the largest doc_id that holds it;
    shorter keys lose nothing. Rows of one doc_id are one document, and all rows without doc_id together are one, which
    never is the largest. Null and empty texts are one empty line; where every line goes, the text left is empty. Repeated
    rows give repeated rows, no rows give none, and other columns are ignored.

    Only hashes and positions are shuffled for the counts. The repeated keys with most lines, HOT_KEYS of them at most, are
    broadcast; any other key has fewer than a HOT_KEYS-th of all lines, and is joined by a shuffle. Then each text is
    shuffled once to meet the positions it loses.
    """
    lines, keys = long_lines(docs, min_chars), ["h1", "h2"]
    repeated = staged(repeated_keys(lines, min_documents), "repeated")
    hot = repeated.orderBy(F.desc("rows"), *keys).limit(HOT_KEYS)
    cold = repeated.join(F.broadcast(hot.select(keys)), keys, "left_anti")
    near = lines.join(F.broadcast(hot.drop("rows")), keys)
    found = near.unionByName(lines.join(cold.drop("rows"), keys)).filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    gone = found.groupBy("d1", "d2").agg(F.collect_set("position").alias("gone"))
    whole = rows_of(docs).join(gone, ["d1", "d2"], "left")
    parts = F.split("text", "\n")
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    left = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get("parts", i)), "\n"))
    whole = whole.withColumn("parts", F.when(F.col("gone").isNotNull(), parts))
    return whole.select("doc_id", kept.alias("text"), n_lines.cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"))


def digests(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def oracle(min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> str:
    white = " || ".join(f"chr({ord(c)})" for c in WHITE)
    return f"""
WITH rows_ AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT r, doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS position FROM rows_),
keyed AS (SELECT *, translate(trim(line, {white}), '{ascii_uppercase}', '{ascii_lowercase}') AS key FROM lines),
repeated AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= {min_chars}
  GROUP BY key HAVING count(DISTINCT doc_id) + max((doc_id IS NULL)::int) >= {min_documents}),
judged AS (SELECT r, doc_id, line, position, repeated.key IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS gone
  FROM keyed LEFT JOIN repeated USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r"""
