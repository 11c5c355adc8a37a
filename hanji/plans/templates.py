"""Notices in many shapes for the catalogue: texts and expected values with a number in every field, written once and given
to Spark and to DuckDB alike."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where a row's own number goes.
MARK = "{n}"

#: Flattened tables, a table of changes, quantities in brackets and sentences: text, then the fields that it gives.
RUN_ON = (
    (
        "점용허가 허가번호 점용장소 점사용료 성 명 2019-12 부산 중구 중앙로 12번길 한빛해운 여수시 돌산읍 우두리 {n}번지 지선 공유수면 부잔교 설치 1,250.55123,4502019.1.1.~2021.12.31.",
        {"ask_org_nm": "한빛해운", "addr": "여수시 돌산읍 우두리 {n}번지 지선 공유수면", "xtn": "1,250.55㎡", "purps_cn": "부잔교 설치", "permit_start_date": "2019-01-01", "permit_end_date": "2021-12-31", "amount": "123,450원"},
    ),
    (
        "신 청 자 위 치 사 용 목 적 면적 준설량 기간 전라남도지사 여수시 웅천동 {n}번지 지선 공유수면 항로 준설 1{n}㎡2{n}㎥ 협의서 접수 2020.1.1",
        {"ask_org_nm": "전라남도지사", "addr": "여수시 웅천동 {n}번지 지선 공유수면", "xtn": "1{n}㎡", "purps_cn": "항로 준설", "collection_volume": "2{n}㎥"},
    ),
    (
        "신청인점용·사용 장소점용·사용 목적면적(㎡) /채취량(㎥)점용·사용 기간서해골재군산시 옥도면 {n}번지 해역골재 채취9{n}㎡회당 약 1{n}㎥",
        {"ask_org_nm": "서해골재", "addr": "군산시 옥도면 {n}번지", "xtn": "9{n}㎡", "purps_cn": "해역골재 채취", "collection_volume": "1{n}㎥"},
    ),
    (
        "신청인위 치목 적면 적허가 기간푸른수산울산광역시 북구 당사동 {n}번지 지선 해수 인입관 설치3{n}㎡2018.3.1.~2020.2.28.",
        {"ask_org_nm": "푸른수산", "addr": "울산광역시 북구 당사동 {n}번지 지선", "xtn": "3{n}㎡", "purps_cn": "해수 인입관 설치", "permit_start_date": "2018-03-01", "permit_end_date": "2020-02-28"},
    ),
    (
        "구 분 변경 전 변경 후 장 소 군산시 옥도면 {n}번지 지선 공유수면 면 적 5{n}㎡ 목 적 부두 축조 공사 기 간 2018.1.1 ~ 2018.12.31 2019.1.1 ~ 2020.12.31",
        {"addr": "군산시 옥도면 {n}번지 지선 공유수면", "xtn": "5{n}㎡", "purps_cn": "부두 축조 공사", "permit_start_date": "2019-01-01", "permit_end_date": "2020-12-31"},
    ),
    (
        "신청인 위치 면적(㎡) 목적 기간 동해수산 울진군 후포면 {n}번지 지선 2{n}㎡ 어구 보관장 설치 2021.5.1 ~ 2022.4.30",
        {"ask_org_nm": "동해수산", "addr": "울진군 후포면 {n}번지 지선", "xtn": "2{n}㎡", "purps_cn": "어구 보관장 설치", "permit_start_date": "2021-05-01", "permit_end_date": "2022-04-30"},
    ),
    ("면적(준설량) : 1{n}㎡(2{n}㎥)", {"xtn": "1{n}㎡", "collection_volume": "2{n}㎥"}),
    (
        "(주)새빛{n}에서 포항시 남구 동해면 {n}번지 지선 공유수면에 “선박 수리시설 {n}동 설치”를 위한 점용",
        {"ask_org_nm": "(주)새빛{n}", "addr": "포항시 남구 동해면 {n}번지 지선 공유수면", "purps_cn": "선박 수리시설 {n}동 설치"},
    ),
    (
        "1. 관련입니다.\n주식회사 바다건설{n}에서 신청한 “해상 낚시공원 {n}호 조성”(통영시 산양읍 {n}번지 지선) 목적",
        {"ask_org_nm": "주식회사 바다건설{n}", "addr": "통영시 산양읍 {n}번지 지선", "purps_cn": "해상 낚시공원 {n}호 조성"},
    ),
)

#: Sentences about applications, and who applied; null where those named can't be applicants.
SENTENCES = (
    ("새바다{n}항만공사의 공유수면 점ㆍ사용 변경허가 신청에 대해 허가합니다.", "새바다{n}항만공사"),
    ("한빛시장으로부터 제출된 공유수면 점용·사용 변경승인 신청에 대하여 {n}차 검토한 바", "한빛시장"),
    ("한빛{n}발전(주)에서 제출한 공유수면 점용 사용 변경허가 신청에 대하여 변경 허가하고", "한빛{n}발전(주)"),
    ("㈜섬바다{n} 대표이사 홍길동으로부터 공유수면 점용 사용 변경허가 신청이 있어 검토합니다.", "㈜섬바다{n} 대표이사 홍길동"),
    ("푸른건설{n} 주식회사(대표 홍길동)로부터 공유수면 점용 사용 허가 신청에 따른 협의를 요청합니다.", "푸른건설{n} 주식회사"),
    ("수신한빛{n}어촌계장 귀하 (경유)제목공유수면 점용 사용 변경 허가", "한빛{n}어촌계장"),
    ("{n}. 귀기관의 공유수면 점용 사용 협의 허가 신청과 관련입니다.\n우리청의 매립 승인 신청에 대하여\n바다{n}수산업협동조합으로부터 공유수면 사용허가 신청이 있어", "바다{n}수산업협동조합"),
    ("국민의 공유수면 사용 허가 신청 {n}건에 대하여", None),
    ("주식회사의 공유수면 점용 허가 신청 {n}건", None),
)

#: Values by field, and what is left of them.
VALUES = {
    "location": (
        ("군산시 옥도면 {n}번지 지선 / 군산시 옥도면 9{n}번지 지선", "군산시 옥도면 9{n}번지 지선"),
        ("경남 통영시 산양읍 {n}번지 지선 / 비고란", "경남 통영시 산양읍 {n}번지 지선 / 비고란"),
        ("통영시 산양읍 {n}번지 지선 공유수면을 '부잔교 설치' 목적", "통영시 산양읍 {n}번지 지선 공유수면"),
        ("ⓐ 부산 남구 {n}번지선 ⓑ 부산 남구 7번지선 ⓐ 부산 남구  {n}번지선", "ⓐ 부산 남구 {n}번지선 ⓑ 부산 남구 7번지선"),
        ("신청 위치 / 면적 기간 {n}", None),
        ("울산 남구 {n}번지 실태조사 결과", None),
    ),
    "area": (
        ("{n}㎡ / 2{n}㎡", "2{n}㎡"),
        ("(직접) {n}㎡ / (간접) 2{n}㎡", "(직접) {n}㎡ / (간접) 2{n}㎡"),
        ("5{n}㎡ (직접 3{n} / 간접 (가 1 / 나 1)) / 4{n}㎡ [직접 3 / 간접 1]", "4{n}㎡ [직접 3 / 간접 1]"),
        ("검토 {n}㎡", None),
        ("없음", None),
        ("옥도면 {n}번지 2020. 1. 2.", None),
    ),
    "purpose": (
        ("부두 축조 및 사용목적면적 {n}㎡ 확대 공사", "부두 축조 및 사용목적면적 {n}㎡ 확대 공사"),
        ("부두 축조 (사용 [기존 / 신설]) 공사 / 안벽 보강 [{n}공구 / (2공구 / 3공구)] 공사", "안벽 보강 [{n}공구 / (2공구 / 3공구)] 공사"),
        ("선박 접안시설 보강 및 운영, 선박 접안시설 및 부잔교({n}기) 신설과 그 배후부지의 정비 및 운영", "선박 접안시설 및 부잔교({n}기) 신설과 그 배후부지의 정비 및 운영"),
        ("다목적 인양기(5톤급) 3기 / 다목적 인양기({n}톤급) 2기 - 물양장 다목적 인양기(9톤급) 1기", "다목적 인양기({n}톤급) 2기, 다목적 인양기(9톤급) 1기"),
        ("사용목적 면적 {n}", None),
        ("승인 신청 {n}건", None),
    ),
    "permittee_name": (
        ("한빛해운 {n} 귀하", "한빛해운 {n}"),
        ("새바다 검역소 {n}", "새바다 검역소 {n}"),
        ("검토 의뢰 {n}", None),
        ("이 {n}번 사업자", None),
        ("한빛 {n}㎡", None),
        ("면 적 {n}", None),
    ),
}


#: Notices of labelled lines: text, then the fields that it gives.
LABELLED = (
    (
        "부산지방해양수산청\n수신 귀하\n제목 점용 허가\n1. 신청인 : 한빛{n}해운\n가. 위치 : 부산광역시 영도구 {n}번지 지선 공유수면\n나. 면적 : 1{n}㎡\n다. 목적 : 선박 계류 시설\n라. 허가기간 : 2020. 1. 2. ~ 2021. 3. 4.\n마. 점용료 : 1{n}원",
        {"org_nm": "부산지방해양수산청", "addr": "부산광역시 영도구 {n}번지 지선 공유수면", "xtn": "1{n}㎡", "purps_cn": "선박 계류 시설", "permit_start_date": "2020-01-02", "permit_end_date": "2021-03-04", "amount": "1{n}원"},
    ),
    (
        "기관명 : 여수지방해양수산청\n피허가자 : 새바다{n}건설\n○ 허가장소 : 여수시 돌산읍 {n}번지 지선\n○ 면적 및 목적 : 2{n}㎡ (부잔교 설치)\n○ 허가시작일 : 2022-05-06\n○ 허가종료일 : 2023년 7월 8일",
        {"org_nm": "여수지방해양수산청", "ask_org_nm": "새바다{n}건설", "addr": "여수시 돌산읍 {n}번지 지선", "xtn": "2{n}㎡", "purps_cn": "부잔교 설치", "permit_start_date": "2022-05-06", "permit_end_date": "2023-07-08"},
    ),
    (
        "담당 http://www.gunsan.mof.go.kr\n피허가자명 : 푸른{n}수산\n□ 소재지 : 군산시 옥도면 {n}번지 지선\n□ 면적(준설량) : 3{n}㎡\n□ 준설량 : 4{n}㎥\n□ 용도 : 항로 준설\n□ 점용기간 : 19.2.3 ~ 20/4/5\n□ 사용료 : 금 5{n}원정",
        {"org_nm": "군산지방해양수산청", "ask_org_nm": "푸른{n}수산", "addr": "군산시 옥도면 {n}번지 지선", "xtn": "3{n}㎡", "purps_cn": "항로 준설", "collection_volume": "4{n}㎥", "permit_start_date": "2019-02-03", "permit_end_date": "2020-04-05", "amount": "5{n}원"},
    ),
    (
        "해양수산부\n수신 대한{n}건설 귀하\n제목 허가 알림\n- 장소 : 울산광역시 북구 당사동 {n}번지 지선\n- 면적 및 용도 : 6{n}㎡ / 해수 인입관 설치\n- 허가 기간 : 2018년 2월 30일 ~ 2018년 12월 31일",
        {"org_nm": "해양수산부", "ask_org_nm": "대한{n}건설", "addr": "울산광역시 북구 당사동 {n}번지 지선", "xtn": "6{n}㎡", "purps_cn": "해수 인입관 설치", "permit_start_date": "2018-12-31"},
    ),
    ("", {}),
)


def pick(key: str, choices: tuple[str | None, ...]) -> Column:
    """The choice that a row's key falls on, with the key in place of the mark."""
    number = F.col(key).cast("string")
    found = F.lit(None).cast("string")
    for k, choice in enumerate(choices):
        if choice is not None:
            found = F.when(F.col(key) % len(choices) == k, F.replace(F.lit(choice), F.lit(MARK), number)).otherwise(found)
    return found


def pick_sql(key: str, choices: tuple[str | None, ...]) -> str:
    quoted = lambda x: "'" + x.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
    cases = [f"WHEN {k} THEN replace({quoted(choice)}, '{MARK}', {key}::VARCHAR)" for k, choice in enumerate(choices) if choice is not None]
    return f"CASE {key} % {len(choices)} {' '.join(cases)} END" if cases else "NULL::VARCHAR"
