"""Who applied, as sentences say it: every sentence about an application offers names, and the first that can be an
applicant's counts. The others keep the reason for which they were refused."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .permits import clean, found, squeezed
from .text import let, strip

# Marks and endings of bodies, officers who apply for their town, and an applicant who isn't named.
FRONT_MARKS = ("(주)", "㈜", "(유)")
BODIES = ("주식회사", "유한회사", "(주)", "㈜", "(유)", "공사", "공단", "조합", "어촌계", "재단", "법인")
OFFICERS = ("시장", "군수", "구청장", "군", "시", "구청", "어촌계장")
UNNAMED = "민원인"
# Words that make a name a body's, and names that are none: addressees, and marks without a name.
BODY_WORDS = (
    "주식회사", "(주)", "㈜", "유한회사", "(유)", "재단법인", "사단법인", "공사", "공단", "조합", "어촌계", "회사", "법인", "재단", "발전",
    "건설", "산업", "개발", "해운", "수산", "에너지", "대표", "민원인",
)
ADDRESSEES = ("귀하", "귀기관", "귀시", "귀군", "귀청", "희망", "국민", "공유수면", "사용", "변경", "허가", "승인", "우리청", "주식회사")
ADDRESSEE_BEGINS, ADDRESSEE_HOLDS = ("귀", "우리청"), ("새시대", "지방해양")
BARE_MARKS = ("주식회사", "(주)", "㈜", "유한회사", "(유)", "어촌계", "조합", "공사", "공단")
# What stands between an applicant and the application, and the words that make it one about sea or shore.
FROM, BY, OF = ("으로부터", "로부터"), ("에서",), ("의", "에서", "가", "이")
ABOUT, ACT, ASKED = ("공유수면", "점용", "사용", "매립"), ("허가", "승인"), "신청"
NAME_LENGTH, REACH, SHORT_REACH = 80, 80, 40

LETTER = r"[가-힣A-Za-z0-9·\-]"


def any_of(words: tuple[str, ...]) -> str:
    escape = lambda w: w.replace("(", r"\(").replace(")", r"\)")
    return f"(?:{'|'.join(map(escape, sorted(words, key=len, reverse=True)))})"


#: A representative behind a body's name, and what can be an applicant inside a longer text.
PERSON = r"(?:\s*대표(?:이사)?\s*[가-힣]{2,5})?"
ENTITY = "|".join((
    rf"{any_of(FRONT_MARKS)}\s*{LETTER}{{2,30}}{PERSON}", rf"(?:주식회사|유한회사)\s+{LETTER}{{2,30}}{PERSON}(?=\s*$)", rf"{LETTER}{{2,30}}\s?{any_of(BODIES)}{PERSON}",
    rf"[가-힣]{{2,12}}{any_of(OFFICERS)}(?![가-힣])", rf"{UNNAMED}\s*\([^)]+\)",
))
NAME = rf"([가-힣A-Za-z0-9㈜()·ㆍ\s\-]{{2,{NAME_LENGTH}}}?)"
REPRESENTED = r"(?:\([^()]*\))?"
#: Behind the particle: an application about sea or shore in the same sentence.
MATTER = rf"(?=[^.]{{0,{REACH}}}?{any_of(ABOUT)}[^.]{{0,{REACH}}}?{any_of(ACT)}[^.]{{0,{SHORT_REACH}}}?{ASKED})"
#: The ways in which a sentence says who applied, the surest first.
WAYS = (
    rf"{NAME}{REPRESENTED}\s*{any_of(FROM)}(?=.{{0,{REACH}}}?허가\s*{ASKED})",
    rf"([^.]{{2,{NAME_LENGTH}}}?(?:주식회사|유한회사))\([^()]*대표[^()]*\)\s*{any_of(FROM)}",
    rf"([^.]{{2,{NAME_LENGTH}}}?{any_of(FRONT_MARKS)})\s*{any_of(BY)}(?=[^.]{{0,120}}?{ASKED})",
    rf"{NAME}{any_of(OF)}\s*{MATTER}",
    rf"{NAME}{REPRESENTED}\s*{any_of(FROM)}\s*{MATTER}",
)


def cleared(x: Column) -> Column:
    """What a sentence says of its applicant, without item numbers, references to other letters and representatives in
    brackets; behind an address, the name alone."""
    cuts = (r"^.*(?:^|\s)1?\d\.\s*", r"^.*관련입니다\.?\s*", r"\([^()]*대표[^()]*\)", r"^공유수면.*(?:고시|알림|공고|의뢰|통보)\s+")
    bare = reduce(lambda v, p: F.regexp_replace(v, p, ""), cuts, clean(x))
    behind = r"^\S+(?:도|시|군|구)\s.*\d[\d\-]*(?:번지)?\s+([가-힣A-Za-z㈜()·\s\-]{2,50})$"
    return let(strip(bare), lambda v: F.coalesce(found(v, behind), v))


def entity(x: Column) -> Column:
    """The last body or officer that a text names, if it has three letters or more; else the text."""
    last = F.try_element_at(F.regexp_extract_all(x, F.lit(ENTITY), F.lit(0)), F.lit(-1))
    letters = lambda v: F.length(F.regexp_replace(v, "[^가-힣A-Za-z0-9]", ""))
    return let(last, lambda v: F.when(letters(v) >= 3, strip(v)).otherwise(x))


#: Why a person's name, or any other text, is refused.
NO_BODY = "no body or officer"


def refusal(name: Column) -> Column:
    """Why a name can't be an applicant's; null if it can."""
    def of(v: Column) -> Column:
        addressee = v.isin(*ADDRESSEES) | v.rlike(f"^{any_of(ADDRESSEE_BEGINS)}|{any_of(ADDRESSEE_HOLDS)}")
        bare = v.isin(*BARE_MARKS) | v.rlike(rf"^{any_of(FRONT_MARKS)}[^가-힣A-Za-z0-9]*[가-힣A-Za-z0-9]?[^가-힣A-Za-z0-9]*$")
        body = v.rlike(any_of(BODY_WORDS)) | v.rlike(rf"^[가-힣]{{2,12}}{any_of(OFFICERS)}$")
        return (
            F.when(v.isNull() | (v == ""), "empty").when(addressee, "addressee").when(bare, "mark without a name")
            .when(v.endswith("도시"), "a plan").when(~body, NO_BODY)
        )

    return let(squeezed(name), of)


def candidates(x: Column) -> Column:
    """array<struct<way,name,refused>> of a normalised text: what each way finds, line by line, the surest way first."""
    lines = F.filter(F.split(x, "\n"), lambda line: F.contains(line, F.lit(ASKED)) & line.rlike(any_of((*FROM, *OF))))

    def of(ways_lines: Column, way: int, pattern: str) -> Column:
        names = F.flatten(F.transform(ways_lines, lambda line: F.regexp_extract_all(line, F.lit(pattern), F.lit(1))))
        read = F.transform(names, lambda n: clean(entity(cleared(n))))
        return F.transform(read, lambda n: F.struct(F.lit(way).alias("way"), n.alias("name"), refusal(n).alias("refused")))

    return let(lines, lambda ls: F.concat(*[of(ls, way, pattern) for way, pattern in enumerate(WAYS, 1)]))


def applicant(x: Column) -> Column:
    """The first candidate that isn't refused."""
    return F.get(F.filter(candidates(x), lambda c: c["refused"].isNull()), F.lit(0))["name"]
