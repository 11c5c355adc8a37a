"""The proper noun (company, agency) that a search query names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Endings of company and agency names.
NAME_ENDINGS = (
    "산업", "건설", "중공업", "해운", "조선", "기업", "공사", "에너지", "화학", "전력", "항만", "물산", "엔지니어링",
    "개발", "솔루션", "철강", "시멘트", "정유", "석유", "가스", "통신", "전자", "시청", "구청", "군청", "도청", "공단",
    "협회", "재단", "조합",
)
# Particles that follow a noun, in the order in which they are tried.
PARTICLES = (
    "에서", "에게", "께서", "로부터", "으로부터", "이랑", "랑", "부터", "까지", "한테", "으로", "로서", "으로서", "에는",
    "에도", "에만", "이", "가", "을", "를", "은", "는", "의", "에", "로", "와", "과", "도", "만", "서",
)
COMPANY_MARK = r"[㈜㈔](?U:\s)*|[(（](?:[Jj]주|주)[)）](?U:\s)*"


def keyword(query: Column) -> Column:
    """The first word of the query that, without punctuation and up to three particles at its end, ends as names do and
    is longer than that ending; null if there is none."""
    words = F.split(F.regexp_replace(query, COMPANY_MARK, ""), r"(?U)\s+")
    particle = f"(?:{'|'.join(PARTICLES)})$"

    def bare(word: Column) -> Column:
        word = F.regexp_replace(word, r"(?U)[^\w]", "")
        for _ in range(3):
            word = F.regexp_replace(word, particle, "")
        return word

    named = F.filter(F.transform(words, bare), lambda w: w.rlike(f".(?:{'|'.join(NAME_ENDINGS)})$"))
    return F.get(named, F.lit(0))
