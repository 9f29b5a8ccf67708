import json
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from meterglass import domain
from meterglass.operators import normalize
from meterglass.sources import documents

BASE = {
    "_id": {"$oid": "0123456789abcdef01234567"}, "eventTimeStamp": {"$date": "2025-03-09T21:15:42Z"},
    "userId": "ada", "eventType": "Token Used", "subscriptionId": "s-77", "packageId": "3",
    "eggToken": -4096, "chatToken": -2048, "websearchToken": 12,
    "totalCostUsd": {"$numberDecimal": "1.234567"}, "chatCostUsd": {"$numberDecimal": "1.000001"},
    "websearchCostUsd": {"$numberDecimal": "0.2"}, "externalToken": -9,
    "externalCostUsd": {"$numberDecimal": "0.034566"}, "externalCostName": "lookup", "deductType": "TEAM_TOKEN",
    "agentId": None, "deductionBreakdown": None,
}


def docs_of(spark, tmp_path, fields, *docs):
    path = tmp_path / "docs.json"
    path.write_text("\n".join(json.dumps(d, ensure_ascii=False) for d in docs), encoding="utf-8")
    return documents.read_json(spark, str(path), fields)


@pytest.fixture
def event(spark, tmp_path):
    def make(**changes):
        doc = {**BASE, **changes}
        doc = {k: v for k, v in doc.items() if v is not ...}
        return normalize.normalize_events(docs_of(spark, tmp_path, domain.EVENT_FIELDS, doc)).first()
    return make


def test_columns_follow_the_schema(spark, tmp_path):
    frame = normalize.normalize_events(docs_of(spark, tmp_path, domain.EVENT_FIELDS, BASE))
    assert frame.columns == domain.EVENT_SCHEMA.names
    assert [f.dataType for f in frame.schema] == [f.dataType for f in domain.EVENT_SCHEMA]


def test_id_forms(event):
    assert event().event_id == "0123456789abcdef01234567"
    assert event(_id="plain-7").event_id == "plain-7"


@pytest.mark.parametrize("change", [{"_id": ...}, {"eventTimeStamp": ...}, {"eventTimeStamp": "soon"},
                                    {"eggToken": "2.5x"}, {"eggToken": "2.5"}])
def test_bad_documents_fail(event, change):
    with pytest.raises(PySparkException):
        event(**change)


@pytest.mark.parametrize("text, day", [
    ("2024-02-28T17:00:00Z", date(2024, 2, 29)), ("2024-02-28T16:59:59Z", date(2024, 2, 28)),
    ("2024-12-31T16:59:59.999999+00:00", date(2024, 12, 31)), ("2025-01-01T03:00:00+09:00", date(2025, 1, 1)),
    ("2024-12-31 20:00:00", date(2025, 1, 1)), ("2024-02-29", date(2024, 2, 29)),
])
def test_local_day(event, text, day):
    assert event(eventTimeStamp=text).date_id == day
    assert event(eventTimeStamp={"$date": text}).date_id == day


def test_money_is_exact(event):
    row = event()
    assert row.totalCostUsd == Decimal("1.234567")
    assert row.totalCostThb == Decimal("40.333304")
    assert event(totalCostUsd={"$numberDecimal": "0.0000005"}).totalCostUsd == Decimal("0.000001")
    assert event(totalCostUsd=0.25).totalCostUsd == Decimal("0.250000")


def test_missing_cost(event):
    row = event(totalCostUsd=None)
    assert row.totalCostUsd is None
    assert row.totalCostThb == Decimal("0.000000")


def test_tokens_keep_their_sign(event):
    row = event()
    assert (row.eggToken, row.externalToken, row.websearchToken) == (-4096, -9, 12)
    assert event(eggToken=None).eggToken is None


def test_breakdown_text(event):
    assert event(deductionBreakdown={"a": 1, "b": [1, 2]}).deductionBreakdown == '{"a": 1, "b": [1, 2]}'
    odd = {"ก,ข": 'x: "y", z', "n": None}
    assert event(deductionBreakdown=odd).deductionBreakdown == json.dumps(odd, ensure_ascii=False)
    assert event(deductionBreakdown="plain").deductionBreakdown == '"plain"'
    assert event().deductionBreakdown is None


def test_rejects(spark, tmp_path):
    docs = docs_of(spark, tmp_path, domain.EVENT_FIELDS, BASE, {**BASE, "_id": None})
    good, bad = normalize.split_rejects(docs)
    assert (good.count(), bad.count()) == (1, 1)


PACKAGE = {"packageId": 41, "packageName": "Orchard", "packageType": "Trial run", "tierName": "north",
           "priceThb": {"$numberDecimal": "1999.123456789"}, "eggToken": 880, "durationDay": 14, "durationMonth": 0,
           "createdAt": "2024-05-06T07:08:09Z", "updatedAt": {"$date": "2024-06-07T08:09:10.5Z"}}


def test_packages(spark, tmp_path):
    docs = docs_of(spark, tmp_path, domain.PACKAGE_FIELDS, PACKAGE,
                   {**PACKAGE, "packageId": "42", "priceThb": None, "updatedAt": None})
    frame = normalize.normalize_packages(docs)
    assert frame.columns == domain.PACKAGE_SCHEMA.names
    first, second = sorted(frame.collect(), key=lambda r: r.packageId)
    assert first[:8] == (41, "Orchard", "Trial run", "north", Decimal("1999.123456789"), 880, 14, 0)
    assert first.updatedAt == datetime(2024, 6, 7, 8, 9, 10, 500000)
    assert (second.packageId, second.priceThb, second.updatedAt) == (42, None, None)


@pytest.mark.parametrize("value, whole", [(5.0, 5), (2.7, 2), (-2.7, -2), (7, 7), ("8", 8), (None, None)])
def test_whole_numbers(event, value, whole):
    assert event(eggToken=value).eggToken == whole


def test_texts_that_look_like_json(event):
    for text in ("[note] hi", "{not an object", "5", "true"):
        assert event(deductionBreakdown=text).deductionBreakdown == json.dumps(text)
    assert event(deductionBreakdown=[]).deductionBreakdown == "[]"


def test_malformed_lines_fail_unless_set_aside(spark, tmp_path):
    path = tmp_path / "docs.json"
    path.write_text('{"userId": "a", "isBanned": true}\n{"userId": "b", "isBan\n\n[1]\n', encoding="utf-8")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        normalize.normalize_users(documents.read_json(spark, str(path), domain.USERS_FIELDS)).collect()
    good, bad = documents.split_lines(spark.read.text(str(path)))
    rows = normalize.normalize_users(documents.parse_lines(good, domain.USERS_FIELDS)).collect()
    assert [(r.userId, r.isBanned) for r in rows] == [("a", True)]
    assert sorted(r.value for r in bad.collect()) == ["[1]", '{"userId": "b", "isBan']


def test_user_flags(spark, tmp_path):
    docs = docs_of(spark, tmp_path, domain.USERS_FIELDS, *[
        {"userId": f"u-{n}", **({} if flag is ... else {"isBanned": flag})}
        for n, flag in enumerate([True, False, "TRUE", "false", " t ", "y", 1, 0, None, ..., 7])])
    flags = [r.isBanned for r in sorted(normalize.normalize_users(docs).collect(), key=lambda r: int(r.userId[2:]))]
    assert flags == [True, False, True, False, True, False, True, False, None, None, True]


def test_number_flags(spark):
    docs = spark.createDataFrame([("a", 0), ("b", 7), ("c", None)], "userId string, isBanned int")
    assert [r.isBanned for r in normalize.normalize_users(docs).orderBy("userId").collect()] == [False, True, None]


def test_text_masters(spark):
    team = spark.createDataFrame([("t-1", 5)], "teamId string, companyId int")
    assert normalize.normalize_b2b_team(team).first()[:2] == ("t-1", "5")
    users = spark.createDataFrame([("u-1",)], "userId string")
    assert normalize.normalize_b2b_users(users).first()[:3] == ("u-1", None, None)
    company = spark.createDataFrame([("c-1", "ACME")], "companyId string, companyName string")
    assert normalize.normalize_b2b_company(company).columns == domain.COMPANY_SCHEMA.names


@pytest.mark.parametrize("rule, schema", [
    (normalize.normalize_events, domain.EVENT_SCHEMA), (normalize.normalize_packages, domain.PACKAGE_SCHEMA),
    (normalize.normalize_users, domain.USERS_SCHEMA), (normalize.normalize_b2b_users, domain.B2B_USERS_SCHEMA),
    (normalize.normalize_b2b_company, domain.COMPANY_SCHEMA), (normalize.normalize_b2b_team, domain.TEAM_SCHEMA)])
def test_empty_input(spark, rule, schema):
    docs = spark.createDataFrame([], documents.text_schema(("_id", "userId", "eventTimeStamp")))
    frame = rule(docs)
    assert frame.columns == schema.names and frame.count() == 0


def test_ingest_time_is_the_runs(spark):
    at = datetime(2026, 1, 2, 3, tzinfo=timezone.utc)
    docs = spark.createDataFrame([("u",)], "userId string")
    assert normalize.normalize_users(docs, ingested_at=at).first()._ingested_at == at.replace(tzinfo=None)
