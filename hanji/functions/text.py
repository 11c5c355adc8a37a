"""Column functions on texts, titles, paths and ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode has it (Java's \s knows ASCII only).
SPACE = r"(?U)\s"
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x) with x written once, so that expressions that need a value several times don't grow with each use."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def strip(x: Column) -> Column:
    return F.btrim(x, F.lit(WHITE))


def collapse(x: Column) -> Column:
    """Stripped, with each run of white space as one space."""
    return strip(F.regexp_replace(x, r"(?U)\s+", " "))


def clean_optional(x: Column) -> Column:
    """Stripped; null if nothing is left."""
    return F.nullif(strip(x), F.lit(""))


def first_filled(*xs: Column) -> Column:
    """The first value with anything but white space, stripped; null if there is none."""
    return F.coalesce(*[clean_optional(x) for x in xs])


def unescape(x: Column) -> Column:
    """The five named entities of XML, the no-break space and the apostrophe's number."""
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", "\u00a0"), ("&amp;", "&")):
        x = F.replace(x, F.lit(entity), F.lit(char))
    return x


def normalize_title(x: Column) -> Column:
    """Without a leading number and underscore, entities resolved, middle dots unified, white space collapsed; null if
    only punctuation is left."""
    t = F.regexp_replace(strip(x), r"^\d+_", "")
    t = collapse(F.translate(unescape(t), "・∙⋅", "···"))
    return F.when((t != "") & ~t.rlike(r"^[_\-.()\[\]\s]+$"), t)


def resolve_title(*titles: Column) -> Column:
    return F.coalesce(*[normalize_title(t) for t in titles], F.lit(""))


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)[/\\]*$", 1)


def safe_basename(path: Column) -> Column:
    """The last part of a path; <invalid-path> for null, <unnamed> where there is none."""
    name = basename(path)
    return F.when(path.isNull(), F.lit("<invalid-path>")).when(name == "", F.lit("<unnamed>")).otherwise(name)


def stem(path: Column) -> Column:
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*$", "")


def suffix(path: Column) -> Column:
    """Lower-case suffix with its dot, empty without one."""
    return F.lower(F.regexp_extract(basename(path), r"[^.](\.[^.]+)$", 1))


def parent(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)[/\\][^/\\]*$", 1)


def document_id(path: Column) -> Column:
    """The first part of a path that begins with DCT or ENF, else the file's stem."""
    parts = F.filter(F.split(path, "[/\\\\]"), lambda p: p.startswith("DCT") | p.startswith("ENF"))
    return F.coalesce(F.get(parts, F.lit(0)), stem(path))


def file_order(stem_: Column) -> Column:
    """The number before a leading underscore, null without one."""
    return F.nullif(F.regexp_extract(stem_, r"^(\d+)_", 1), F.lit("")).try_cast("int")


def title_from_path(path: Column) -> Column:
    t = F.regexp_replace(stem(path), r"^\d+_", "")
    return collapse(F.translate(unescape(t), "・∙⋅", "···"))


def sanitize_paths(x: Column) -> Column:
    """Absolute paths in a text become their last part."""
    x = F.regexp_replace(x, r"[A-Za-z]:\\(?:[^\s:]*\\)?([^\s:\\]+)", "$1")
    return F.regexp_replace(x, r"(?<!/)/(?:[^\s:]*/)?([^\s:/]+)", "$1")


def mask_url(url: Column) -> Column:
    """A URL's password as three stars."""
    return F.regexp_replace(url, r"(://[^:/@]+:)[^@]+@", "$1***@")


def chunk_id(doc_id: Column, number: Column) -> Column:
    return F.format_string("CH-%s-%03d", F.substring(doc_id, 1, 16), number)


def estimate_of(length: Column, hangul: Column) -> Column:
    """1.5 for each Hangul syllable and 0.25 for each other character, truncated."""
    return F.floor(hangul * 1.5 + (length - hangul) * 0.25).cast("int")


def hangul_count(text: Column) -> Column:
    """Number of Hangul syllables; texts of ASCII alone aren't searched."""
    found = F.length(text) - F.length(F.regexp_replace(text, "[가-힣]+", ""))
    return F.when(F.octet_length(text) == F.length(text), F.lit(0)).otherwise(found)


def token_estimate(text: Column) -> Column:
    return estimate_of(F.length(text), hangul_count(text))


def contains_ignoring_case(text: Column, keyword: str) -> Column:
    """LIKE without regard to case, with the keyword's own % and _ as plain characters."""
    return F.contains(F.lower(text), F.lit(keyword.lower()))


def is_boilerplate_table(text: Column) -> Column:
    """The head of a letter as a table: receiver, via and title rows, twelve table lines at most."""
    plain = F.regexp_replace(text, r"(?U)[^\S\n]+", " ")
    rows = F.filter(F.split(plain, "\n"), lambda line: F.ltrim(line).startswith("|"))
    return F.contains(plain, F.lit("| 수신 |")) & F.contains(plain, F.lit("| (경유) |")) & F.contains(plain, F.lit("| 제목 |")) & (F.size(rows) <= 12)


def markdown_row(cells: Column) -> Column:
    escaped = F.transform(cells, lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("|"), F.lit("\\|")))
    return F.concat(F.lit("| "), F.array_join(escaped, " | "), F.lit(" |"))


def markdown_table(rows: Column) -> Column:
    """array<array<string>> -> a Markdown table; rows are cut or filled up to the first row's width."""
    width = F.size(F.get(rows, F.lit(0)))
    even = F.transform(rows, lambda r: F.slice(F.concat(r, F.array_repeat(F.lit(""), width)), F.lit(1), width))
    lines = F.transform(even, markdown_row)
    rule = markdown_row(F.array_repeat(F.lit("---"), width))
    return F.when(F.size(rows) > 0, F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), F.slice(lines, F.lit(2), F.greatest(F.size(lines), F.lit(1)))), "\n")).otherwise("")


def raw_text(sections: Column) -> Column:
    """array<struct<section_type,content,order>> -> contents in order, with a blank line between."""
    ordered = F.array_sort(F.transform(sections, lambda s: F.struct(s["order"].alias("order"), s["content"].alias("content"))))
    return F.array_join(ordered["content"], "\n\n")


def marked_text(sections: Column) -> Column:
    """As raw_text, with tables between marks."""
    mark = lambda s: F.when(s["section_type"] == "table", F.concat(F.lit("[TABLE_START]\n"), s["content"], F.lit("\n[TABLE_END]"))).otherwise(s["content"])
    ordered = F.array_sort(F.transform(sections, lambda s: F.struct(s["order"].alias("order"), mark(s).alias("content"))))
    return F.array_join(ordered["content"], "\n\n")


def looks_like_image(name: Column, data: Column) -> Column:
    """Whether a payload begins as its name's suffix says."""
    head = F.hex(F.substring(data, 1, 48))
    starts = lambda *codes: F.coalesce(F.greatest(*[head.startswith(c) for c in codes], F.lit(False)), F.lit(False))
    kind = suffix(name)
    return (
        F.when(kind == ".bmp", starts("424D"))
        .when(kind.isin(".jpg", ".jpeg"), starts("FFD8FF"))
        .when(kind == ".png", starts("89504E470D0A1A0A"))
        .when(kind == ".gif", starts("474946383761", "474946383961"))
        .when(kind.isin(".tif", ".tiff"), starts("49492A00", "4D4D002A"))
        .when(kind == ".emf", (F.octet_length(data) >= 44) & (F.substring(head, 81, 8) == "20454D46"))
        .when(kind == ".wmf", starts("D7CDC69A", "01000900", "02000900"))
        .otherwise(False)
    )
