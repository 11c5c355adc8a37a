"""Column functions that find dates in texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

# The ways in which the documents write dates, and the labels before dates in their heads.
NUMERIC = r"(\d{4})[.\-/]\s*(\d{1,2})[.\-/]\s*(\d{1,2})"
KOREAN = r"(\d{4})(?U:\s)*년(?U:\s)*(\d{1,2})(?U:\s)*월(?U:\s)*(\d{1,2})(?U:\s)*일"
HEADER_LABELS = ("결재일자", "등록일자", "전결", "대결", "결재")
PREFERRED_LABELS = ("결재일자", "전결", "대결", "결재", "등록일자")
APPROVAL_LINE = "결재|전결|대결|확인|기안"


def make_date(year: Column, month: Column, day: Column) -> Column:
    """Null unless the three strings are a date."""
    return F.try_to_date(F.concat_ws("-", year, month, day), "yyyy-M-d")


def first_match(text: Column, pattern: str) -> Column:
    """The date of a pattern's first match, null if that isn't one. The text is searched once; the match's numbers are the
    date's parts."""
    numbers = lambda m: F.regexp_extract_all(m, F.lit(r"\d+"), F.lit(0))
    date = lambda xs: make_date(F.get(xs, F.lit(0)), F.get(xs, F.lit(1)), F.get(xs, F.lit(2)))
    return let(F.regexp_extract(text, pattern, 0), lambda m: F.when(m != "", let(numbers(m), date)))


def parse_date(text: Column) -> Column:
    return F.coalesce(first_match(text, NUMERIC), first_match(text, KOREAN))


def all_dates(text: Column) -> Column:
    """All valid dates: those of the numeric pattern in order, then those of the Korean one."""
    of = lambda pattern: F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: first_match(m, pattern))
    return F.filter(F.concat(of(NUMERIC), of(KOREAN)), lambda d: d.isNotNull())


def guess_report_date(text: Column) -> Column:
    """The last date on any line that speaks of approval, else the last of the text."""
    lines = F.split(text, r"\r\n|[\n\r]")
    dates = lambda xs: F.flatten(F.transform(xs, all_dates))
    last = lambda xs: F.try_element_at(xs, F.lit(-1))
    approving = F.filter(lines, lambda line: line.rlike(APPROVAL_LINE))
    return F.coalesce(last(dates(approving)), last(dates(lines)))


def resolve_report_date(content: Column, raw: Column, *fallbacks: Column) -> Column:
    return F.coalesce(parse_date(content), guess_report_date(raw), *[parse_date(x) for x in fallbacks])


def header_candidates(text: Column) -> Column:
    """array<struct<label,date>> of the labelled dates, in order of labels, then of place."""

    def labelled(label: str) -> Column:
        pattern = label + r"\D{0,20}(\d{4}[.\-/]\s*\d{1,2}[.\-/]\s*\d{1,2})"
        dated = lambda m: F.struct(F.lit(label).alias("label"), parse_date(m).alias("date"))
        return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), dated)

    return F.filter(F.concat(*[labelled(label) for label in HEADER_LABELS]), lambda c: c["date"].isNotNull())


def choose_report_date(doc_year: Column, current: Column, text: Column) -> Column:
    """struct<current_report_date, proposed_report_date, auto_fixable, confidence, reason, matched_label, candidates>:
    the first labelled date of the document's year, by the labels' preference."""
    none = F.array().cast("array<struct<label:string,date:date>>")
    seen = F.struct(parse_date(current).alias("now"), F.coalesce(header_candidates(text), none).alias("candidates"))

    def choose(v: Column) -> Column:
        fitting = F.filter(v["candidates"], lambda c: F.year(c["date"]) == doc_year)
        of_label = lambda label: F.get(F.filter(fitting, lambda c: c["label"] == label), F.lit(0))
        return let(F.coalesce(*[of_label(label) for label in PREFERRED_LABELS]), lambda chosen: decide(v, chosen))

    def decide(v: Column, chosen: Column) -> Column:
        now, found = v["now"], chosen.isNotNull() & doc_year.isNotNull()
        matches = found & F.coalesce(now == chosen["date"], F.lit(False))
        return F.struct(
            now.alias("current_report_date"),
            F.when(found, chosen["date"]).alias("proposed_report_date"),
            (found & ~matches).alias("auto_fixable"),
            F.when(doc_year.isNull(), "none").when(~found, "low").when(~matches & (chosen["label"] == "등록일자"), "medium").otherwise("high").alias("confidence"),
            F.when(doc_year.isNull(), "doc_year_missing").when(~found, "no_doc_year_matched_header_date").when(matches, "already_matches_preferred_candidate").otherwise("doc_year_matched_header_date").alias("reason"),
            F.when(found, chosen["label"]).alias("matched_label"),
            F.transform(v["candidates"], lambda c: F.concat_ws(":", c["label"], F.date_format(c["date"], "yyyy-MM-dd"))).alias("candidates"),
        )

    return let(seen, choose)
