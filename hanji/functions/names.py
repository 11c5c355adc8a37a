"""Authors' names in approval blocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Titles that stand at either end of a name.
TITLES = (
    "주무관", "사무관", "행정사무관", "행정주무관", "서기관", "과장", "국장", "부장", "청장", "본부장", "담당", "팀장", "실장",
    "결재", "전결", "검토", "기안", "협조",
)
# Marks of an approval row, of a receiver row, and of roles.
STRONG = ("주무관", "사무관", "행정사무관", "행정주무관", "서기관", "전결", "대결", "결재", "협조자", "기안", "검토")
RECEIVER = ("수신자", "수신", "받는분", "참조", "경유")
ROLES = ("과장", "국장", "부장", "실장", "팀장", "청장", "본부장")
# Words of two to four syllables that are no names.
NO_NAMES = (
    "담당", "과장", "부장", "국장", "차관", "장관", "실장", "팀장", "주무관", "사무관", "서기관", "정책관", "전문위", "조정관", "행정사무관",
    "행정주무관", "행정사무", "행정주무", "본부장", "청장", "대장", "중장", "소장", "준장", "대령", "중령", "소령", "대위", "중위", "소위", "원사",
    "상사", "중사", "하사", "병장", "상병", "일병", "이병", "검토", "협조", "결재", "기안", "승인", "대결", "전결", "내부결재", "내부", "협조자",
    "수신", "수신자", "제목", "참조", "기안자", "검토자", "등록번호", "등록일자", "문서번호", "시행일자", "접수일자", "결재일자", "공개구분",
    "보존기간", "분류기호", "비공개", "공개여부", "시행", "접수", "붙임", "전화", "팩스", "전화번호", "팩스번호", "향후", "가결", "대한", "수면",
    "매립", "계획", "알림", "반영", "요청", "심의", "결과", "통보", "회신", "행정사항", "행정", "시간", "검토를", "관련", "사항", "해양산업",
    "해양수산", "해양", "산업", "어업", "항만", "공유수면", "공유", "면허", "취득", "휴가", "병가", "연가", "출장", "교육", "관계", "보통", "낮음",
    "높음", "신청한", "허가", "전송", "제대상", "하여", "기존", "부분", "결정", "추가허가", "검토사항", "매립면허", "채취허가", "검토배경",
    "매립공사", "구분", "장소", "면적", "목적", "기간", "변경전", "변경후", "변경", "간접점용", "조선소", "선박접안", "부선거와", "의장안벽",
    "면제대상", "시설", "관로의", "군산", "신청인", "다음", "호의", "모든", "기준이", "고시일자", "변경고시", "귀하", "회장", "운영지원", "문화재",
    "어촌어항", "의견", "내용", "주요", "직인", "승인의", "점용사용", "변경허가", "법률", "설치", "없음", "계류시설", "배경", "변경승인", "부식시험",
    "사하구청", "운영", "점사용", "준설", "타당성", "보고", "부산조선", "성창기업", "실시간", "언로딩선", "허가취소", "동해전력", "토건", "연장에",
    "대해", "내용을", "합니다", "평택대표", "김청수에", "대하여", "드립니다",
)
TITLE_ENDINGS = ("시장", "군수", "구청장", "도지사", "회장")
OFFICE_WORDS = (
    "지방", "항만", "해양", "해사", "선원", "물류", "건설", "표지", "환경", "계획", "조사", "개발", "정비", "안전", "행정",
    "외교", "국제", "법규", "통상", "산업", "자원", "안보", "공사", "사장", "사무소", "센터", "본부",
)


def _any(x: Column, marks: tuple[str, ...]) -> Column:
    return F.exists(F.array(*[F.lit(m) for m in marks]), lambda m: F.contains(x, m))


def is_approval_context(x: Column) -> Column:
    """Whether a row or paragraph speaks of an approval: by a strong mark, or, unless it names a receiver, by two roles."""
    roles = F.size(F.filter(F.array(*[F.lit(m) for m in ROLES]), lambda m: F.contains(x, m)))
    return F.when(_any(x, STRONG), True).when(_any(x, RECEIVER), False).otherwise(roles >= 2)


def bare_name(token: Column) -> Column:
    """Hangul only, without bracketed parts, and without titles at either end as long as something is left."""
    name = F.regexp_replace(F.regexp_replace(token, r"[(\[{].*?[)\]}]", " "), "[^가-힣]", "")
    titles = "|".join(sorted(TITLES, key=len, reverse=True))
    for _ in range(4):
        name = F.regexp_replace(F.regexp_replace(name, f"(?<=.)(?:{titles})$", ""), f"^(?:{titles})(?=.)", "")
    return name


def is_plausible_name(name: Column) -> Column:
    return name.rlike("^[가-힣]{2,4}$") & ~name.isin(*NO_NAMES) & ~name.rlike(f"(?:{'|'.join(TITLE_ENDINGS)})$") & ~_any(name, OFFICE_WORDS)


def names_in(x: Column) -> Column:
    """The first five different names in a text."""
    tokens = F.transform(F.split(x, r"(?U)[\s,|/;:]+"), bare_name)
    return F.slice(F.array_distinct(F.filter(tokens, is_plausible_name)), 1, 5)


def _from_rows(rows: Column, ahead: int) -> Column:
    """Names after the first approval row that leads to any: of the next rows, else of the row itself."""
    blank = lambda n: F.coalesce(F.get(rows, n), F.lit(""))

    def own(row: Column, k: Column) -> Column:
        following = names_in(F.concat_ws(" | ", *[blank(k + n) for n in range(1, ahead + 1)]))
        found = F.when(F.size(following) > 0, following).otherwise(names_in(row))
        return F.when(is_approval_context(row) & (F.size(found) > 0), F.array_join(found, ", "))

    return F.get(F.filter(F.transform(rows, own), lambda names: names.isNotNull()), F.lit(0))


def from_tables(tables: Column) -> Column:
    """tables: array of tables, each an array of row texts. The last table that has names decides."""
    return F.get(F.filter(F.transform(F.reverse(tables), lambda rows: _from_rows(rows, 2)), lambda names: names.isNotNull()), F.lit(0))


def from_paragraphs(paragraphs: Column) -> Column:
    return _from_rows(F.filter(paragraphs, lambda p: p != ""), 1)
