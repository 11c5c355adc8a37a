"""Permit fields in tables that were flattened to run-on text, in tables of changes, and in sentences.

A flattened table begins with its columns' names one after another. Which columns there are comes from those names; the
values behind them are told apart by what they are: quantities by their unit, periods by their dates, and what stands
before the first quantity is an applicant, a place and a purpose, which the names and endings of places divide.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import applicants
from .permits import clean, dates, found, has_any, quantity
from .text import let, strip

FIELDS = ("permittee_name", "location", "purpose", "area", "collection_volume", "amount", "period")
# The names of columns; white space and middle dots may stand between any two of a name's letters.
COLUMNS = {
    "who": ("신청인", "신청자", "피승인자", "성명"),
    "where": ("점용사용장소", "점용사용위치", "점용장소", "위치"),
    "purpose": ("점용사용목적", "사용목적", "점용목적", "점용유형", "공사내용", "목적"),
    "area": ("점용면적", "면적"),
    "volume": ("채취량", "준설량"),
    "amount": ("점사용료", "점용료"),
    "period": ("점용사용기간", "점사용기간", "허가기간", "공사기간", "기간"),
    "other": ("허가번호", "비고", "주소", "직접", "간접계"),
}
# How places begin, and the words that end a place, in order of preference.
PLACES = (
    "서울특별시", "부산광역시", "인천광역시", "대구광역시", "광주광역시", "대전광역시", "울산광역시", "세종특별자치시", "경기도",
    "강원도", "충청북도", "충청남도", "전라북도", "전라남도", "경상북도", "경상남도", "제주특별자치도", "창원시", "포항시", "신안군",
    "무안군", "여수시", "목포시", "통영시", "군산시", "울진군", "울주군", "서울", "부산", "인천", "대구", "광주", "대전", "울산",
    "세종", "경기", "강원", "충북", "충남", "전북", "전남", "경북", "경남", "제주",
)
PLACE_ENDS = ("공유수면", "번지 지선", "번지선", "지선", "번지)", "번지", "일원", "해역")
# Provinces that stand before a town, titles of officers and kinds of bodies that end an applicant, and the
# words with which a period without a first date begins.
PROVINCES = ("경남", "경북", "전남", "전북", "충남", "충북", "강원", "경기", "제주")
OFFICERS = ("시장", "군수", "구청장", "지사", "청장", "장관", "공사", "공단")
PERIOD_STARTS = ("허가일", "착공일", "협의일", "승인일")
COMPANY_MARKS = ("주식회사", "㈜", "(주)", "(유)")

GAP = r"[\s·․･ㆍ‧.]*"
#: A number; the bounds keep a run of digits from being tried in all ways.
NUMBER = r"\d[\d,]{0,24}(?:\.\d{1,12})?"
SQUARE, CUBIC = rf"{NUMBER}\s*(?:㎡|m2|m²)", rf"{NUMBER}\s*(?:㎥|m3|m³)"
NAME = r"[가-힣A-Za-z㈜()·]"


def any_of(words: tuple[str, ...] | list[str]) -> str:
    """A pattern for any of the words, longer ones first."""
    escaped = [w.replace("(", r"\(").replace(")", r"\)") for w in sorted(words, key=len, reverse=True)]
    return f"(?:{'|'.join(escaped)})"


def spaced(words: tuple[str, ...]) -> str:
    return any_of([GAP.join(w) for w in words])


ANY_COLUMN = rf"{spaced(tuple(w for words in COLUMNS.values() for w in words))}(?:\((?!유\)|주\))[^)]*\))?[\s/]*"
#: Columns of a flattened header; one with fewer or more is no header.
LEAST_COLUMNS, MOST_COLUMNS = 4, 40
#: Characters of GAP, and the names of columns that hold no other: each column's name holds one of them.
GAPS = " \t\n\x0b\x0c\r·․･ㆍ‧."
CORES = tuple(w for words in COLUMNS.values() for w in words if not any(o != w and o in w for others in COLUMNS.values() for o in others))
KNOWN = rf"(?<!{any_of(PROVINCES)}\s{{0,3}}){any_of(PLACES)}"
#: How a place may begin, in order of trust: a known name, a town or county, a township or quarter.
BEGINNINGS = (KNOWN, r"[가-힣]{2}(?:시|군|구)\s", r"[가-힣]{2}(?:읍|면|동)")
LATE = rf"(?:{any_of(PERIOD_STARTS)}|[`'‘’]?(?:\d{{4}}|\d{{2}})\s*[.\-/]\s*\d{{1,2}}\s*[.\-/])"


def fields(**values: Column) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(*[values.get(f, none).alias(f) for f in FIELDS])


def groups(x: Column, pattern: str, *names: str) -> Column:
    """struct of a pattern's groups, null if it doesn't occur."""
    return F.when(x.rlike(pattern), F.struct(*[F.regexp_extract(x, pattern, k).alias(n) for k, n in enumerate(names, 1)]))


def first_group(x: Column, patterns: list[str], *names: str) -> Column:
    return F.coalesce(*[groups(x, p, *names) for p in patterns])


def who_and_where(text: Column, address_first: Column) -> Column:
    """struct<who, where>: where begins at the first place behind a body or officer, else at the first place; if an
    address stands before the applicant's name, at the last place."""
    ending = rf"(?:{any_of(OFFICERS)}|대표\s*[가-힣]{{2,4}}|외\s*\d+\s*명)"
    first = [rf"(?s)^(.+?{end})\s*(?={begin})(.+)$" for begin in BEGINNINGS for end in (ending, "")]
    last = [rf"(?s)^(.+)(?={begin})(.+)$" for begin in BEGINNINGS]
    split = lambda patterns: first_group(text, patterns, "who", "where")
    return F.when(address_first, let(split(last), lambda s: F.struct(name_after_address(s["who"]).alias("who"), s["where"].alias("where")))).otherwise(split(first))


def name_after_address(x: Column) -> Column:
    """The name at the end of a text that begins with an address."""
    name = found(strip(x), rf"((?:{any_of(COMPANY_MARKS)}\s*)?{NAME}+(?:\s*외\s*\d+\s*명)?)$")
    return clean(F.regexp_replace(name, "^(?:번지|번길|호|층|길)", ""))


def where_and_purpose(text: Column) -> Column:
    """struct<location, purpose>: the place ends with the first of PLACE_ENDS that occurs in the text."""
    end = F.get(F.filter(F.array(*[F.lit(e) for e in PLACE_ENDS]), lambda e: F.contains(text, e)), F.lit(0))
    upto = lambda e: F.coalesce(F.position(e, text) + F.length(e) - 1, F.length(text))
    cut = lambda n: F.struct(clean(F.substring(text, F.lit(1), n)).alias("location"), clean(F.regexp_replace(F.substring(text, n + 1, F.length(text)), r"^[(/ ]+", "")).alias("purpose"))
    return let(end, lambda e: let(upto(e), cut))


def may_have_header(x: Column) -> Column:
    """Whether enough names of columns occur at all, wherever they stand: without gaps each holds one of CORES."""
    times = lambda v, w: F.length(v) - F.length(F.replace(v, F.lit(w), F.lit(w[1:])))
    return let(F.translate(x, GAPS, ""), lambda v: reduce(lambda a, b: a + b, [times(v, w) for w in CORES]) >= LEAST_COLUMNS)


def flattened(x: Column) -> Column:
    """The first row of a run-on table: a header of four columns or more, and values with a quantity among them. Values in
    which another header stands are no row."""
    head = F.when(may_have_header(x), F.regexp_extract(x, f"(?:{ANY_COLUMN}){{{LEAST_COLUMNS},{MOST_COLUMNS}}}", 0))
    parts = F.when(head != "", F.struct(head.alias("head"), strip(F.substring(x, F.instr(x, head) + F.length(head), F.length(x))).alias("body")))
    return let(parts, lambda p: let(measured(p["head"], p["body"]), lambda m: let(row_of(p["head"], m), lambda r: F.when(r["permittee_name"].isNotNull() & r["location"].isNotNull(), r))))


def measured(head: Column, body: Column) -> Column:
    """struct<text, area, unit, amount, rest>: what stands before the area, the area, and what follows. The area is the
    first number with a unit; where the unit stands in the header only, the number before the amount or the period."""
    has = lambda column: head.rlike(spaced(COLUMNS[column]))
    unit = F.when(head.rlike(r"m2|m²"), F.regexp_extract(head, r"m2|m²", 0)).otherwise(F.lit("㎡"))
    charged = groups(body, rf"(?s)^(.+?)(\d[\d,]{{0,12}}(?:\.\d{{1,2}})?)(\d{{1,3}}(?:,\d{{3}}){{1,6}})(?=\d{{4}}\.)(.*)$", "text", "area", "amount", "rest")
    plain = groups(body, rf"(?is)^(.+?)({NUMBER})\s*(㎡|m2|m²)(.*)$", "text", "area", "unit", "rest")
    bare = groups(body, rf"(?s)^(.+?)({NUMBER})\s*(?={LATE})(.*)$", "text", "area", "rest")
    shaped = lambda m, u, amount: F.when(m.isNotNull(), F.struct(m["text"].alias("text"), m["area"].alias("area"), u.alias("unit"), amount.alias("amount"), m["rest"].alias("rest")))
    none = F.lit(None).cast("string")
    with_amount = let(charged, lambda m: shaped(m, unit, F.concat(m["amount"], F.lit("원"))))
    found_ = F.coalesce(F.when(has("amount"), with_amount), let(plain, lambda m: shaped(m, m["unit"], none)), let(bare, lambda m: shaped(m, unit, none)))
    return F.when(has("area") | has("amount"), let(found_, lambda m: F.when(~m["text"].rlike(f"(?:{ANY_COLUMN}){{3}}"), m)))


def row_of(head: Column, m: Column) -> Column:
    has = lambda column: head.rlike(spaced(COLUMNS[column]))
    numbered = r"^\s*\d{4}-\d+\s*"  # a permit's number, behind which an address stands
    text = strip(F.regexp_replace(m["text"], numbered, ""))
    late = clean(F.regexp_replace(found(m["rest"], rf"(?s)^(.*?)(?:{LATE}|$)"), "(?:끝|붙임).*$", ""))
    volume = F.when(has("volume"), quantity(found(m["rest"], rf"(?i)({CUBIC})")))
    period = F.when(F.size(dates(m["rest"])) >= 2, m["rest"])

    def build(s: Column) -> Column:
        return let(
            where_and_purpose(s["where"]),
            lambda p: fields(
                permittee_name=clean(s["who"]), location=p["location"], purpose=F.coalesce(p["purpose"], F.when(~has("volume"), late)),
                area=F.concat(m["area"], m["unit"]), collection_volume=volume, amount=m["amount"], period=period,
            ),
        )

    return F.when(m.isNotNull(), let(who_and_where(text, m["text"].rlike(numbered)), lambda s: F.when(s.isNotNull(), build(s))))


# The rows of a table of changes.
CHANGED = {"location": "장소", "area": "면적", "purpose": "목적", "period": "기간"}


def changes(x: Column) -> Column:
    """A table of values before and after: what each label says up to the next, and the last period of several."""
    stop = f"(?={spaced(tuple(CHANGED.values()))}|$)"
    said = {f: clean(F.regexp_replace(found(x, rf"(?s){GAP.join(label)}(.+?){stop}"), r"변경\s*없음.*$", "")) for f, label in CHANGED.items()}
    iso = lambda ds, k: F.date_format(F.try_element_at(ds, F.lit(k)), "yyyy-MM-dd")
    last = let(dates(said["period"]), lambda ds: F.when(F.size(ds) >= 2, F.concat_ws(" ", iso(ds, -2), iso(ds, -1))))
    return F.when(F.contains(x, F.lit("변경")) & x.rlike(r"변경\s*전") & x.rlike(r"변경\s*후"), fields(**(said | {"period": last})))


# What follows the sender of an application, and how a sentence names ground, quotes a purpose and goes on.
SENDER = r"(?:에서|으로부터|로부터)\s*(?:신청한|제출한|제출된|다음과\s*같이)?\s*"
GROUND = any_of(("번지선", "번지", "지선", "공유수면", "해역", "일원"))
QUOTED = r"[“\"『]([^”\"』]{1,400})[”\"』]"


BEGIN = "|".join(BEGINNINGS)


def sender(x: Column) -> Column:
    """Who sent an application, from what the first sentence of that kind says before its verb; a person's name will do."""
    after = rf"(?=[“\"『]|공유수면|{BEGIN})"
    from_body = F.when(has_any(x, ("에서", "로부터")), found(x, rf"(?:^|\n)([^\n]+?){SENDER}{after}(?=[\s\S]{{0,200}}(?:신청|목적|위한))"))
    of_body = F.when(F.contains(x, F.lit("신청에")), found(x, r"(?:^|\n)([^\n]{2,40}?)의\s+공유수면[^\n]*신청에"))
    sent = F.coalesce(from_body, of_body)
    name = let(sent, lambda v: F.when(v.isNotNull(), clean(applicants.entity(applicants.cleared(v)))))
    return let(name, lambda v: F.when(F.coalesce(applicants.refusal(v), F.lit("")).isin("", applicants.NO_BODY), v))


#: The ways in which a sentence tells the ground and the purpose of an application, which of the two it tells first, and a
#: word without which it doesn't.
PLACE = rf"(?m)^([^\n]*?{GROUND}[^\n“\"『]{{0,12}}?)에\s*"
TOLD = (
    (rf"{QUOTED}\s*\(([^()]{{0,200}}{GROUND}[^()]{{0,200}})\)\s*목적", ("purpose", "where"), "목적"),
    (rf"{PLACE}{QUOTED}(?:를|을)\s*위한", ("where", "purpose"), "위한"),
    (rf"{PLACE}([^“\"『]{{2,120}}?)\s*목적의\s*공유수면", ("where", "purpose"), "목적의"),
)


def ground(x: Column) -> Column:
    """The place itself, without the sender before it."""
    bare = F.regexp_replace(clean(x), rf"^.*(?:께서|에서|로부터)\s+(?={BEGIN})", "")
    return let(bare, lambda v: F.coalesce(found(v, rf"((?:{KNOWN}).*)$"), v))


def sentences(x: Column) -> Column:
    """What the first of the ways that is used says: ground and purpose, and with them who sent the application."""
    told = lambda g: F.when(g.isNotNull(), F.struct(g["where"].alias("where"), g["purpose"].alias("purpose")))
    named = [F.when(F.contains(x, F.lit(word)), let(groups(x, pattern, *order), told)) for pattern, order, word in TOLD]
    return let(F.coalesce(*named), lambda t: F.when(t.isNotNull(), fields(permittee_name=sender(x), location=ground(t["where"]), purpose=clean(t["purpose"]))))


def quantities(x: Column) -> Column:
    """Areas and volumes that stand in brackets or in sentences."""
    dredged, dumped = (F.contains(x, F.lit(word)) for word in ("준설량", "투기면적"))
    area = F.coalesce(F.when(dredged, found(x, rf"(?i)면\s*적\s*\(\s*준설량\s*\)\s*[:：]?\s*({SQUARE})")), F.when(dumped, found(x, rf"(?i)투기면적\s*[:：]\s*({SQUARE})")))
    volume = F.when(dredged, found(x, rf"(?i)준설량\s*\)?\s*[:：]?\s*(?:{SQUARE}\s*\(\s*)?({CUBIC})"))
    return fields(area=quantity(area), collection_volume=quantity(volume))


def shapes(x: Column, tables: Column) -> Column:
    """array<struct> of what each shape found, in order of preference; `tables` are the Markdown tables' fields."""
    return F.filter(F.array(flattened(x), tables, changes(x), quantities(x), sentences(x)), lambda s: s.isNotNull())


def first(shapes_: Column, field: str) -> Column:
    return F.get(F.filter(F.transform(shapes_, lambda s: s[field]), lambda v: v.isNotNull()), F.lit(0))
