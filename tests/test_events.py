from __future__ import annotations

import pytest
from stockflow.functions import contract
from stockflow.functions import events as E
from stockflow.functions import vocabulary as V
from tests.conftest import EVENT, event


def derived(topic, *values):
    rows = E.events_from_messages(topic.rows(values)).orderBy("kafka_offset")
    return rows.collect()


def test_output_has_the_29_contract_columns(topic):
    assert E.events_from_messages(topic.rows([EVENT])).columns == E.EVENT_OUTPUT
    assert len(E.EVENT_OUTPUT) == 29


@pytest.mark.parametrize(
    "text", ["not json", "[]", "null", "", '{"event_id": "x", ', "7", None]
)
def test_malformed_json_is_an_empty_event_and_never_fails(topic, text):
    (row,) = derived(topic, text)
    assert row.json_value == text
    assert row.invalid_reason in ("missing_event_id", "missing_campaign_id")
    assert not row.is_valid_event


@pytest.mark.parametrize("quantity", ['"x"', "2.5", "3000000000"])
def test_a_bad_field_nulls_only_itself(topic, quantity):
    text = (
        '{"event_id": 7, "campaign_id": "C", "event_time": "2024-01-15T10:00:00Z",'
        ' "event_type": "RETURN_RECEIVED", "sku_id": "S", "warehouse_id": "W",'
        f' "quantity": {quantity}, "unit_price": "1.5"}}'
    )
    (row,) = derived(topic, text)
    assert (row.event_id, row.quantity, row.unit_price) == ("7", None, None)
    assert row.invalid_reason == "missing_quantity"


@pytest.mark.parametrize(
    "changes, reason",
    [
        ({"event_id": None}, "missing_event_id"),
        ({"campaign_id": None}, "missing_campaign_id"),
        ({"event_time": "soon"}, "invalid_event_time"),
        ({"event_time": None}, "invalid_event_time"),
        ({"event_type": None}, "missing_event_type"),
        ({"sku_id": None}, "missing_sku_id"),
        ({"warehouse_id": None}, "missing_warehouse_id"),
        ({"quantity": None}, "missing_quantity"),
        ({"quantity": 0}, "invalid_quantity"),
        ({"quantity": -2147483648}, "invalid_quantity"),
        ({"event_type": "BOGUS"}, "invalid_event_type"),
        ({"payment_method": "E_WALLET"}, "invalid_cod_confirmed_logic"),
        ({"event_id": None, "quantity": 0}, "missing_event_id"),
        ({}, None),
    ],
)
def test_first_broken_rule_wins(topic, changes, reason):
    (row,) = derived(topic, event(**changes))
    assert row.invalid_reason == reason
    assert row.is_valid_event == (reason is None)


@pytest.mark.parametrize("kind, methods, status, reason", V.PAYMENT_RULES)
def test_payment_rules_keep_three_valued_logic(topic, kind, methods, status, reason):
    grid = [
        (method, state)
        for method in (methods[0], "OTHER", None)
        for state in (status, "OTHER", None)
    ]
    rows = derived(
        topic,
        *[
            event(event_type=kind, payment_method=method, payment_status=state)
            for method, state in grid
        ],
    )
    fires = [row.invalid_reason for row in rows]
    expected = [
        reason if "OTHER" in (method, state) else None for method, state in grid
    ]
    assert fires == expected


def test_movement_sign_by_type(topic):
    kinds = V.EVENT_TYPES + ["BOGUS"]
    rows = derived(topic, *[event(event_type=kind, quantity=3) for kind in kinds])
    signs = {row.event_type: row.movement_qty for row in rows}
    assert signs == {
        "STOCK_RESERVED": -3,
        "COD_CONFIRMED": -3,
        "PAYMENT_CONFIRMED": 0,
        "RESERVATION_EXPIRED": 3,
        "ORDER_CANCELLED": 3,
        "RETURN_RECEIVED": 3,
        "STOCK_REPLENISHED": 3,
        "BOGUS": None,
    }


def test_business_day_starts_at_local_midnight(topic):
    before, after = derived(
        topic,
        event(event_time="2024-01-15T16:59:59Z"),
        event(event_time="2024-01-15T17:00:00Z"),
    )
    assert str(before.business_date) == "2024-01-15" and before.business_hour == 23
    assert str(after.business_date) == "2024-01-16" and after.business_hour == 0
    assert str(after.event_date) == "2024-01-15" and after.event_hour == 17


def test_time_zone_comes_from_the_environment(monkeypatch):
    monkeypatch.setenv("TIMEZONE", "Asia/Tokyo")
    assert E.business_timezone() == "Asia/Tokyo"
    monkeypatch.setenv("BUSINESS_TIMEZONE", "UTC")
    assert E.business_timezone() == "UTC"


def test_json_is_parsed_once_under_a_validity_filter(topic):
    rows = E.events_from_messages(topic.rows([EVENT])).filter("is_valid_event")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
    assert plan.count("missing_sku_id") == 1
    assert "size(" not in plan


def test_contract_audit_counts_each_rule(topic):
    audit = contract.contract_audit(
        E.events_from_messages(
            topic.rows(
                [
                    EVENT,
                    event(event_type="STOCK_REPLENISHED"),
                    event(order_id=None),
                    event(quantity=0),
                    event(event_type=None),
                    event(
                        event_type="STOCK_RESERVED",
                        payment_method="E_WALLET",
                        payment_status="PENDING",
                        reservation_expires_at="2024-01-16T10:00:00Z",
                    ),
                    event(reservation_expires_at="2024-01-16T10:00:00Z"),
                ]
            )
        )
    )
    assert {row.rule: row.violations for row in audit.collect()} == {
        "unknown_event_type": 1,
        "order_id_required": 1,
        "order_id_forbidden": 1,
        "payment_mismatch": 1,
        "quantity_not_positive": 1,
        "reservation_expiry": 1,
    }


def test_payment_rule_violations_treat_null_as_a_violation(topic):
    rows = contract.payment_rule_violations(
        E.events_from_messages(
            topic.rows(
                [
                    EVENT,
                    event(event_id="null", payment_method=None),
                    event(event_id="type", event_type="BOGUS"),
                    event(
                        event_id="ok",
                        event_type="RETURN_RECEIVED",
                        payment_method="NOT_APPLICABLE",
                        payment_status="NOT_APPLICABLE",
                    ),
                ]
            )
        )
    )
    assert {row.event_id: row.violation for row in rows.collect()} == {
        "null": "payment_mismatch",
        "type": "unknown_event_type",
    }


def test_is_promotional_needs_flag_and_id(spark):
    rows = spark.createDataFrame(
        [(True, "P"), (True, ""), (True, None), (False, "P"), (None, "P")],
        "promotion_applied BOOLEAN, promotion_id STRING",
    )
    flags = [row[0] for row in rows.select(E.is_promotional()).collect()]
    assert flags == [True, False, False, False, False]
