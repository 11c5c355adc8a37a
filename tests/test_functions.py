from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from hanji.functions import dates, keywords, metadata, names, permits, text, vectors


def evaluate(spark, values, f, kind="string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"x {kind}").select(f(F.col("x"))).collect()]


def test_titles(spark):
    values = ["012_  부산∙항 &lt;허가&gt;　 건", " [-_.] ", None, "", "3_"]
    assert evaluate(spark, values, text.normalize_title) == ["부산·항 <허가> 건", None, None, None, None]
    assert evaluate(spark, values[:2], lambda x: text.resolve_title(x, F.lit("둘째"))) == ["부산·항 <허가> 건", "둘째"]


def test_paths(spark):
    paths = ["/d/2024/DCT01/attachments/000_제목.odt", "/d/x/ENF9/a.b.odt", "/plain/name.tar.gz", "x"]
    assert evaluate(spark, paths, text.document_id) == ["DCT01", "ENF9", "name.tar", "x"]
    assert evaluate(spark, ["012_a", "a", "_1"], text.file_order) == [12, None, None]
    assert evaluate(spark, [None, "/", "/a/b.c"], text.safe_basename) == ["<invalid-path>", "<unnamed>", "b.c"]
    assert evaluate(spark, [r"failed at /usr/lib/a.so and C:\x\y.txt!"], text.sanitize_paths) == ["failed at a.so and y.txt!"]
    assert evaluate(spark, ["postgresql://me:secret@h/db", "sqlite:///x"], text.mask_url) == ["postgresql://me:***@h/db", "sqlite:///x"]


def test_chunk_ids_keep_long_numbers(spark):
    got = spark.sql("SELECT 'DCT00000000000000001' AS d, n FROM VALUES (7), (1234) AS t(n)").select(text.chunk_id(F.col("d"), F.col("n")))
    assert [r[0] for r in got.collect()] == ["CH-DCT0000000000000-007", "CH-DCT0000000000000-1234"]


def test_token_estimate_truncates(spark):
    assert evaluate(spark, ["", "abc", "abcd", "한국", "한a"], text.token_estimate) == [0, 0, 1, 3, 1]


def test_boilerplate(spark):
    head = "| 수신 | 갑 |\n| (경유) | |\n| 제목 | 을 |"
    assert evaluate(spark, [head, head + "\n| x |" * 10, head.replace("제목", "제")], text.is_boilerplate_table) == [True, False, False]


def test_markdown_table_pads_cuts_and_escapes(spark):
    got = evaluate(spark, [[["a", "b"], ["1"], ["x|y", "2", "3"]], []], text.markdown_table, "array<array<string>>")
    assert got == ["| a | b |\n| --- | --- |\n| 1 |  |\n| x\\|y | 2 |", ""]


def test_magic_bytes(spark):
    df = spark.createDataFrame([("a.png", bytes.fromhex("89504E470D0A1A0A00")), ("a.png", b"GIF89a"), ("a.gif", b"GIF89a"), ("a.emf", b"\0" * 40 + b" EMF"), ("a.txt", b"x")], "n string, d binary")
    assert [r[0] for r in df.select(text.looks_like_image(F.col("n"), F.col("d"))).collect()] == [True, False, True, True, False]


def test_dates(spark):
    values = ["2014-02-30 2014년 3월 1일", "2014. 9. 8", "none", None]
    assert evaluate(spark, values, dates.parse_date) == [datetime.date(2014, 3, 1), datetime.date(2014, 9, 8), None, None]
    lines = "기안 2020.1.1\n결재 2020.1.2\n시행 2021.1.1"
    assert evaluate(spark, [lines, "2020.1.1\n2021-2-2", ""], dates.guess_report_date) == [datetime.date(2020, 1, 2), datetime.date(2021, 2, 2), None]


@pytest.mark.parametrize(
    ("year", "current", "want"),
    [
        (2024, "2024-05-06", (False, "high", "already_matches_preferred_candidate", "전결")),
        (2024, None, (True, "high", "doc_year_matched_header_date", "전결")),
        (2023, "2024-01-01", (True, "medium", "doc_year_matched_header_date", "등록일자")),
        (1999, None, (False, "low", "no_doc_year_matched_header_date", None)),
        (None, None, (False, "none", "doc_year_missing", None)),
    ],
)
def test_report_date_choice(spark, year, current, want):
    df = spark.createDataFrame([(year, current, "등록일자 2023-1-2 전결 2024/5/6")], "y int, c string, t string")
    d = df.select(dates.choose_report_date(F.col("y"), F.col("c"), F.col("t")).alias("d")).first()["d"]
    assert (d["auto_fixable"], d["confidence"], d["reason"], d["matched_label"]) == want
    assert d["candidates"] == ["등록일자:2023-01-02", "전결:2024-05-06"]


def test_keyword(spark):
    assert evaluate(spark, ["㈜한빛건설에서는 어디", "(주)동해 산업의 허가", "부산시청에서의", "없다"], keywords.keyword) == ["한빛건설", None, "부산시청", None]


def test_names(spark):
    rows = ["수신자 김수신", "", "주무관 과장 전결 2024. 1. 2.", "홍길동 | 김철수과장"]
    assert evaluate(spark, [[rows]], names.from_tables, "array<array<string>>") == ["홍길동, 김철수"]
    assert evaluate(spark, [["본문", "기안 박영희"], ["해양수산부 장관"]], names.from_paragraphs, "array<string>") == ["박영희", None]


def test_metadata(spark):
    assert evaluate(spark, ["xDPBT2", "DPBT3", " raw ", None], lambda x: F.concat_ws("/", metadata.open_code(x), metadata.open_name(x))) == ["DPBT2/비공개", "DPBT3/부분공개", "raw/", "/"]
    assert evaluate(spark, ["P2026", "R20x", "P", None], metadata.doc_year) == [2026, None, None, None]
    assert evaluate(spark, [" A ", ""], lambda x: metadata.full_path(x, F.lit(None), F.lit("C"))) == ["A > C", "C"]


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    got = df.select(vectors.cosine(F.col("a"), F.col("b")), vectors.l2_norm(F.col("a")), vectors.normalized(F.col("a"))).collect()
    assert got[0][0] == pytest.approx(0.96)
    assert got[0][1] == 5.0
    assert got[1][0] is None
    assert got[1][2] == [0.0, 0.0]


def test_hash_embedding_is_the_same_in_every_partition(spark):
    df = spark.createDataFrame([("가",), ("나",), ("가",)], "x string").repartition(3)
    rows = df.select("x", vectors.hash_embedding(16)("x").alias("v")).collect()
    same = [r["v"] for r in rows if r["x"] == "가"]
    assert same[0] == same[1]
    assert sum(v * v for v in same[0]) == pytest.approx(1, abs=1e-5)


def test_model_embedding_loads_once_for_a_worker(spark):
    import numpy as np

    def load():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    df = spark.createDataFrame([("abc",), (None,)], "x string").coalesce(1)
    got = [r[0] for r in df.select(vectors.model_embedding(load, 1)("x")).collect()]
    assert got[0] == pytest.approx([3 / 10**0.5, 1 / 10**0.5])
    assert got[1] == [0.0, 1.0]


NOTICE = """부산지방해양수산청
수신 주식회사 한빛건설 귀하
제목 공유수면 점용 사용 허가
가. 위치 : 부산광역시 영도구 동삼동 1번지 지선 공유수면
나. 면적 및 목적 : 1,234.5㎡ (선박 계류)
다. 허가기간 : 2024. 1. 5. ~ '26.12.31.
라. 채취량 : 3,000 ㎥
마. 점용료 : 금1,005,680원"""
TABLE = """[TABLE_START]
| 신청인 | 위치 | 면적(㎡) | 목적 | 허가기간 |
| --- | --- | --- | --- | --- |
| 한빛해운 | 군산시 옥도면 12번지 지선 | 500 | 부두 축조 공사 | 2020.3.1 ~ 2021-2-28 |
[TABLE_END]
http://gunsan.mof.go.kr"""
SPOILT = """신청인: |
위치: 및
면적: ㎡
목적: 사용 목적 면적 부과액
허가시작일: 2020-02-30"""


def test_permits(spark):
    df = spark.createDataFrame([(1, NOTICE), (2, TABLE), (3, SPOILT), (4, None)], "k int, text string")
    got = {r["k"]: r["permit"] for r in permits.extract(df).collect()}
    d = datetime.date
    assert tuple(got[1])[:10] == ("부산지방해양수산청", "주식회사 한빛건설", "부산광역시 영도구 동삼동 1번지 지선 공유수면", "1,234.5㎡", "선박 계류", "3,000㎥", d(2024, 1, 5), d(2026, 12, 31), "1,005,680원", 1.0)
    assert tuple(got[2])[:10] == ("군산지방해양수산청", "한빛해운", "군산시 옥도면 12번지 지선", "500㎡", "부두 축조 공사", None, d(2020, 3, 1), d(2021, 2, 28), None, 0.778)
    assert tuple(got[3])[:10] == (None,) * 9 + (0.0,)
    assert got[4]["source_text"] is None


def test_changed_values_follow_a_slash(spark):
    values = ["군산시 옥도면 1번지 지선 / 군산시 옥도면 2번지 지선", "1번지 지선 공유수면"]
    assert evaluate(spark, values, permits.sanitize_location) == ["군산시 옥도면 2번지 지선", "1번지 지선 공유수면"]
    assert evaluate(spark, ["100㎡ / 200㎡", "(직접) 10㎡ / (간접) 20㎡", "검토 100㎡"], permits.sanitize_area) == ["200㎡", "(직접) 10㎡ / (간접) 20㎡", None]


RUN_ON = {
    "점용허가 허가번호 점용장소 점사용료 성 명 2019-12 부산 중구 중앙로 12번길 한빛해운 여수시 돌산읍 우두리 1번지 지선 공유수면 부잔교 설치 1,250.55123,4502019.1.1.~2021.12.31.": ("한빛해운", "여수시 돌산읍 우두리 1번지 지선 공유수면", "1,250.55㎡", "부잔교 설치", None, "2019-01-01", "2021-12-31", "123,450원"),
    "신 청 자 위 치 사 용 목 적 면적 준설량 기간 전라남도지사 여수시 웅천동 3번지 지선 공유수면 항로 준설 12,000㎡35,000㎥ 협의서 접수 2020.1.1": ("전라남도지사", "여수시 웅천동 3번지 지선 공유수면", "12,000㎡", "항로 준설", "35,000㎥", None, None, None),
    "신청인점용·사용 장소점용·사용 목적면적(㎡) /채취량(㎥)점용·사용 기간서해골재군산시 옥도면 11번지 해역골재 채취900㎡회당 약 1,500㎥": ("서해골재", "군산시 옥도면 11번지", "900㎡", "해역골재 채취", "1,500㎥", None, None, None),
    "신청인위 치목 적면 적허가 기간푸른수산울산광역시 북구 당사동 5번지 지선 해수 인입관 설치300㎡2018.3.1.~2020.2.28.": ("푸른수산", "울산광역시 북구 당사동 5번지 지선", "300㎡", "해수 인입관 설치", None, "2018-03-01", "2020-02-28", None),
    "구 분 변경 전 변경 후 장 소 군산시 옥도면 7번지 지선 공유수면 면 적 500㎡ 목 적 부두 축조 공사 기 간 2018.1.1 ~ 2018.12.31 2019.1.1 ~ 2020.12.31": (None, "군산시 옥도면 7번지 지선 공유수면", "500㎡", "부두 축조 공사", None, "2019-01-01", "2020-12-31", None),
    "신청인 위치 면적(㎡) 목적 기간 동해수산 울진군 후포면 8번지 지선 250㎡ 어구 보관장 설치 2021.5.1 ~ 2022.4.30": ("동해수산", "울진군 후포면 8번지 지선", "250㎡", "어구 보관장 설치", None, "2021-05-01", "2022-04-30", None),
    "1. 관련입니다.\n주식회사 바다건설에서 신청한 “해상 낚시공원 조성”(통영시 산양읍 9번지 지선) 목적": ("주식회사 바다건설", "통영시 산양읍 9번지 지선", None, "해상 낚시공원 조성", None, None, None, None),
    "(주)새빛에서 포항시 남구 동해면 2번지 지선 공유수면에 “선박 수리시설 설치”를 위한 점용": ("(주)새빛", "포항시 남구 동해면 2번지 지선 공유수면", None, "선박 수리시설 설치", None, None, None, None),
    "면적(준설량) : 1,000㎡(2,000㎥)": (None, None, "1,000㎡", None, "2,000㎥", None, None, None),
}


def test_run_on_tables_and_sentences(spark):
    df = spark.createDataFrame([(x,) for x in RUN_ON], "text string")
    for r in permits.extract(df).collect():
        p = r["permit"]
        iso = lambda d: d.isoformat() if d else None
        got = (p["permittee_name"], p["location"], p["area"], p["purpose"], p["collection_volume"], iso(p["permit_start_date"]), iso(p["permit_end_date"]), p["amount"])
        assert got == RUN_ON[r["text"]], r["text"]


PERMIT_TAIL = {
    "위치 : ⓐ 부산 남구 1번지선 공유수면 ⓑ 부산 남구 2번지선 공유수면 ⓐ 부산 남구  1번지선 공유수면": ("location", "ⓐ 부산 남구 1번지선 공유수면 ⓑ 부산 남구 2번지선 공유수면"),
    "목적 : 선박 접안시설 보강 및 운영, 선박 접안시설 및 부잔교(2기) 신설과 그 배후부지의 정비 및 운영": ("purpose", "선박 접안시설 및 부잔교(2기) 신설과 그 배후부지의 정비 및 운영"),
    "목적 : 접안 부두 축조 공사 및 접안 부두 축조 보강을 위한 부대시설 설치와 그 운영 일체": ("purpose", "접안 부두 축조 공사 및 접안 부두 축조 보강을 위한 부대시설 설치와 그 운영 일체"),
    "목적 : ㅇ 다목적 인양기(5톤급) 3기 - 다대동 물양장 / ㅇ 다목적 인양기(5톤급) 2기 - 다대동 물양장 ㅇ 다목적 인양기(9톤급) 1기 - 감천동 물양장": ("purpose", "다목적 인양기(5톤급) 2기, 다목적 인양기(9톤급) 1기"),
    "목적 : 부두 축조 및 사용목적면적 확대 공사": ("purpose", "부두 축조 및 사용목적면적 확대 공사"),
    "목적 : 부두 축조 (사용 [기존 / 신설]) 공사 / 안벽 보강 [1공구 / (2공구 / 3공구)] 공사": ("purpose", "안벽 보강 [1공구 / (2공구 / 3공구)] 공사"),
    "위치 : 경남 통영시 산양읍 100번지 지선 / 비고란": ("location", "경남 통영시 산양읍 100번지 지선 / 비고란"),
    "위치 : 통영시 산양읍 7번지 지선 공유수면을 '부잔교 설치' 목적": ("location", "통영시 산양읍 7번지 지선 공유수면"),
    "위치 : 신청 위치 / 면적 기간": ("location", None),
    "면적 : 500㎡ (직접 300 / 간접 (가 100 / 나 100)) / 400㎡ (직접 300 / 간접 100)": ("area", "400㎡ (직접 300 / 간접 100)"),
    "면적 : 400㎡(직접 400㎡) / 300㎡(직접 300㎡) / 2021.10.1.부터 변경": ("area", "300㎡(직접 300㎡)"),
    "신청인 : 한빛면 3번지선 방파제 공사120㎡허가일로부터 5년": ("permittee_name", None),
    "1. 동해공사-12(2020.1.2.)호 관련입니다.\n2. 공유수면 점용 사용 변경 고시 주식회사 새바다에서 공유수면 점용 사용 변경허가 신청서를 제출하였습니다.": ("permittee_name", "주식회사 새바다"),
    "울산광역시 남구 장생포로 12-3 김바다로부터 울산광역시 남구 장생포동 9번지선 공유수면 일원에\n해수 취수 목적의 공유수면 점용 신청": ("permittee_name", "김바다"),
    "동해개발(주)(대표이사 홍길순)로부터 다음과 같이 공유수면 점용 신청이 있어": ("permittee_name", "동해개발(주)"),
    "[TABLE_START] | 신청인 | 위치 | 면적(㎡) | --- | --- | --- | 한빛해운 | 군산시 옥도면 1번지 지선 | 70 | [TABLE_END]": ("area", "70㎡"),
    "성 명위 치사용 목적면적(㎡)기간바다공사목 적면 적(㎡)기 간울산 남구 매암동 앞 보존 23㎡2018.02.01.~2018.5.1.": ("location", None),
}


def test_permit_values_that_need_more_than_a_label(spark):
    df = spark.createDataFrame([(x,) for x in PERMIT_TAIL], "text string")
    got = {r["text"]: r["permit"] for r in permits.extract(df).collect()}
    assert {x: got[x][field] for x, (field, _) in PERMIT_TAIL.items()} == {x: want for x, (_, want) in PERMIT_TAIL.items()}


APPLICANTS = {
    "새바다항만공사의 공유수면 점ㆍ사용 변경허가 신청에 대해 허가합니다.": "새바다항만공사",
    "한빛시장으로부터 제출된 공유수면 점용·사용 변경승인 신청에 대하여 검토한 바": "한빛시장",
    "한빛발전(주)에서 제출한 공유수면 점용 사용 변경허가 신청에 대하여 변경 허가하고": "한빛발전(주)",
    "㈜섬바다랜드 대표이사 홍길동으로부터 공유수면 점용 사용 변경허가 신청이 있어 검토합니다.": "㈜섬바다랜드 대표이사 홍길동",
    "수신한빛어촌계장 귀하 (경유)제목공유수면 점용 사용 변경 허가": "한빛어촌계장",
    "푸른건설 주식회사(대표 홍길동)로부터 공유수면 점용 사용 허가 신청에 따른 협의를 요청합니다.": "푸른건설 주식회사",
    "1. 귀기관의 공유수면 점용 사용 협의 허가 신청과 관련입니다.\n2. 우리청의 매립 승인 신청에 대하여\n3. 바다수산업협동조합으로부터 공유수면 사용허가 신청이 있어": "바다수산업협동조합",
    "국민의 공유수면 사용 허가 신청에 대하여": None,
    "김바다의 공유수면 점용 허가 신청에 대하여": "김바다",
    "부산지방해양항만청장수신자해양수산부장관(연안계획과장), 부산광역시장주무관 2013. 5. 27.": None,
}


def test_applicants_in_sentences(spark):
    df = spark.createDataFrame([(x,) for x in APPLICANTS], "text string")
    got = {r["text"]: r["permit"]["permittee_name"] for r in permits.extract(df).collect()}
    assert got == APPLICANTS


def test_refused_applicants_keep_their_reason(spark):
    from hanji.functions import applicants

    text = "귀기관의 공유수면 점용 허가 신청에 대하여\n주식회사에서 공유수면 점용 허가를 신청\n한빛신도시가 공유수면 매립 승인 신청\n아무개가 점용 허가 신청\n한빛해운(주)에서 점용 허가 신청"
    found = evaluate(spark, [text], applicants.candidates)[0]
    assert {c["refused"] for c in found} >= {None, "addressee", "a plan", "no body or officer"}
    assert evaluate(spark, [text], applicants.applicant) == ["한빛해운(주)"]


def test_long_texts_take_time_in_proportion(spark):
    """Labelled values, brackets, paths and run-on text of great length: no pattern may nest or go over the rest of the text from
    every place."""
    import time

    deep = "/a" * 100_000
    assert evaluate(spark, [f"at {deep}b: x", "/" * 100_000 + " y", "C:" + "\\d" * 50_000], text.sanitize_paths) == ["at ab: x", "/" * 100_000 + " y", "d"]
    value = "가나다 (라 " * 15_000
    assert evaluate(spark, [value, "부두 축조 / 안벽 보강 " * 8000], permits.sanitize_purpose)[0] == value.strip()
    run_on = "신청인 위치 면적(㎡) 목적 기간 " + "동해수산 울진군 후포면 여덟번지 어구 보관장에 “설치 (신청 " * 12_000
    texts = ["위치 : " + "부산 남구 1번지 " * 12_000, "목적 : " + "(" * 100_000, "면적 : " + "1" * 100_000, run_on, "공유수면 점용 사용 허가 신청 가 이 에서 의 " * 40_000, "신청인 위치 " * 100_000, "12-34 " * 20_000 + "번지 / 지선 / 12번지 지선 바다"]
    for x in texts:
        start = time.perf_counter()
        permits.extract(spark.createDataFrame([(x,)], "text string")).select("permit").collect()
        assert time.perf_counter() - start < 60, (x[:30], len(x))


def test_permits_do_little_for_what_a_text_lacks(spark):
    """Patterns that need a word are asked only where it occurs; texts are cut into lines once for all labels."""
    from hanji.functions import run_on

    columns = list(permits.steps(spark.sparkContext.applicationId))
    assert "__lines" in [name for name, _ in columns]
    text = "제목 허가\n나. 점용료 : 금 100원\n다. 채취량 : 3 ㎥ 이하\n라. 신청인 : 갑 ."
    rows = [(text,), ("신 청 자 위 치 사 용 목 적 면적 기간 갑",), ("신청인 갑 위치 을\n목\t적 병 면·적",), ("위치 위치 위치 위치",), ("위 치(구역) / 목적(㎡)/면적",)]
    plan = spark.createDataFrame(rows, "x string")
    head = F.regexp_extract("x", f"(?:{run_on.ANY_COLUMN}){{4,{run_on.MOST_COLUMNS}}}", 0) != ""
    found = [tuple(r) for r in plan.select(run_on.may_have_header(F.col("x")), head).collect()]
    assert found == [(False, False), (True, True), (True, False), (True, True), (False, False)]
    assert all(any(core in name for core in run_on.CORES) for names_ in run_on.COLUMNS.values() for name in names_)
    assert all(domain.endswith(permits.DOMAIN_END) for domain in permits.DOMAINS)
    done = permits.extract(plan.select(F.col("x").alias("text"))).first()
    assert done.permit.permittee_name == "갑" and done.permit.amount == "100원" and done.permit.collection_volume == "3㎥" and "__lines" not in done.asDict()
