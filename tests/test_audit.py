"""Audit-log JSON extraction edge cases."""

from __future__ import annotations

import datetime as dt

from tijara.plans import audit_log

MSG = "SKU updated successfully"


def _logs(spark, docs):
    return spark.createDataFrame([(i, MSG, d) for i, d in enumerate(docs)], "event_id bigint, payload string, changes string")


def test_typed_casts_and_bad_values(spark):
    docs = [
        '{"current":{"id":"n/a","price":12.5,"is_hot":true,"updated_at":"2023-06-10T19:12:41.593000Z",'
        '"delivery_date":"2023-06-01"},"sku":{"id":3,"approved":false,"seller_change_requests":{"expiry_date":"2024-01-02"}}}',
        '{"current":{"id":"5.","is_hot":"maybe","updated_at":"2023-06-11T00:00:00.000000Z"}}',
        '{"current":{"id":"1e5","updated_at":"2023-07-11T00:00:00.000000Z"}}',
        'not json at all',
    ]
    out = {r.id: r for r in audit_log.audit_log_typed(_logs(spark, docs), month=6).collect()}
    assert set(out) == {None, 5.0}           # July row and unparsable document drop out (no updated_at in June)
    first = out[None]
    assert first.price == 12.5 and first.is_hot is True and first.sku_id == 3.0 and first.sku_approved is False
    assert first.updated_at == dt.datetime(2023, 6, 10, 19, 12, 41, 593000)   # zone suffix dropped, wall clock kept
    assert first.delivery_date == dt.date(2023, 6, 1) and first.sku_expiry_date == dt.date(2024, 1, 2)
    assert out[5.0].is_hot is None           # non-boolean text -> NULL, not an error


def test_text_extract_keeps_json_text(spark):
    docs = ['{"current":{"id":"7","price":8,"is_hot":false,"deleted_at":null},"sku":{"sku_id":"S1"}}']
    r = audit_log.audit_log_text(_logs(spark, docs)).first()
    assert (r.id, r.price, r.is_hot, r.deleted_at, r.sku_sku_id) == ("7", "8", "false", None, "S1")
    assert len(audit_log.audit_log_text(_logs(spark, docs)).columns) == 45


def test_since_cut_is_midnight(spark):
    docs = ['{"current":{"updated_at":"2023-06-21T00:00:00.000000Z"}}',
            '{"current":{"updated_at":"2023-06-21T00:00:00.000001Z"}}',
            '{"current":{"updated_at":"2023-06-20T23:59:59.999999Z"}}',
            '{"current":{"updated_at":"garbage"}}']
    got = [r.updated_at for r in audit_log.audit_log_since(_logs(spark, docs), dt.date(2023, 6, 21)).collect()]
    assert got == ["2023-06-21T00:00:00.000001Z"]


def test_since_cut_with_any_fraction(spark):
    """No fraction, and one to six digits, on both sides of the cut."""
    docs = [f'{{"current":{{"updated_at":"2023-06-{d}T{t}Z"}}}}' for d, t in (
        ("25", "10:00:00"), ("20", "10:00:00"), ("21", "00:00:00"), ("21", "00:00:01"), ("25", "10:00:00.5"),
        ("21", "00:00:00.001"), ("20", "23:59:59.999"), ("21", "00:00:00.000"))]
    got = sorted(r.updated_at for r in audit_log.audit_log_since(_logs(spark, docs), dt.date(2023, 6, 21)).collect())
    assert got == ["2023-06-21T00:00:00.001Z", "2023-06-21T00:00:01Z", "2023-06-25T10:00:00.5Z", "2023-06-25T10:00:00Z"]


def test_text_extract_keeps_all_digits(spark):
    docs = ['{"current":{"mrp":12345678901234567890.12,"price":12.50,"weight":1e3,"id":0.1,"rank":-7}}',
            '{"current":{"mrp":true,"code":"12.50","price":null}}', '{"current":{"mrp":1},"current":{"mrp":2, "mrp": 3.0}}',
            "[]", "{}", None, "[1, 2", '{"current":{"mrp":01}}', '{"current":{"code":"a\\" : 5, 6 ,", "mrp": 30.00 , "rank" :-0.0}}',
            '{"current":{"mrp":%s}}' % ("9" * 30 + ".50")]
    got = [(r.mrp, r.price, r.weight, r.id, r.rank, r.code) for r in audit_log.audit_log_text(_logs(spark, docs)).collect()]
    assert got[0] == ("12345678901234567890.12", "12.50", "1e3", "0.1", "-7", None)    # as the document spells them
    assert got[1] == ("true", None, None, None, None, "12.50")
    assert got[2] == ("3.0", None, None, None, None, None)                      # of a key named twice the last one
    assert got[3:8] == [(None,) * 6] * 5                                        # no object, nothing, no JSON
    assert got[8] == ("30.00", None, None, None, "-0.0", 'a" : 5, 6 ,')         # numbers within strings stay
    assert got[9][0] == "9" * 30 + ".50"


def test_numeric_ids_regex(spark):
    docs = ['{"current":{"id":"-.5"}}', '{"current":{"id":"5."}}', '{"current":{"id":"1e5"}}',
            '{"current":{"id":"+12"}}', '{"current":{}}']
    got = sorted((r.id_text, r.id_a) for r in audit_log.audit_numeric_ids(_logs(spark, docs)).collect())
    assert got == [("+12", 12.0), ("-.5", -0.5)]


def test_numeric_ids_judge_the_documents_own_text(spark):
    """Numbers without quotes: an exponent is no plain number, digits and trailing zeros stay."""
    digits = "123456789012345678901234567890.125"
    docs = ['{"current":{"id":1e5}}', '{"current":{"id":12.50}}', '{"current":{"id":%s}}' % digits, '{"current":{"id":1,"id":-7}}']
    got = sorted((r.id_text, r.id_a) for r in audit_log.audit_numeric_ids(_logs(spark, docs)).collect())
    assert got == [("-7", -7.0), ("12.50", 12.5), (digits, float(digits))]
    text = sorted(r.id for r in audit_log.audit_log_text(_logs(spark, docs)).collect())
    assert text == ["-7", "12.50", digits, "1e5"]                               # both extracts agree


def test_message_filter_is_pushed_to_scan(spark, small_tables, tmp_path):
    path = str(tmp_path / "logs")
    small_tables["activity_logs"].write.parquet(path)
    plan = audit_log.message_filter(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(payload" in plan or "PushedFilters: [IsNotNull(payload), In(payload" in plan
