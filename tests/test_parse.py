import json

from tellerscore.operators import parse
from tests.records import account_a, account_b, record, records, transaction_a, transaction_b


def reasons(bad):
    return {r.offset: r.reason for r in bad.collect()}


def test_record_cases(spark):
    insert = transaction_a(1, 10, 5_000_000, 1_700_000_000_000)
    update = json.loads(insert)
    update["payload"]["before"] = {"id": 1}
    empty_before = json.loads(insert)
    empty_before["payload"]["before"] = {}
    delete = {"payload": {"before": {"id": 1}, "after": None}}
    nothing = {"payload": {"before": None, "after": None}}
    df = records(
        spark,
        [
            insert,
            json.dumps(update),
            json.dumps(empty_before),
            json.dumps(delete),
            None,
            insert[:-4],
            "not json",
            "{}",
            json.dumps(nothing),
        ],
    )
    good, bad = parse.transactions(df, parse.TENANT_A)
    assert [(r.id, r.account_id, r.amount, r.offset) for r in good.collect()] == [(1, 10, 5.0, 0)]
    assert reasons(bad) == {4: "tombstone", 5: "malformed", 6: "malformed", 7: "malformed", 8: "empty"}
    parsed = parse.parse_envelope(df, parse.TENANT_A.transaction_after)
    assert [r.status for r in parsed.orderBy("offset").collect()][:4] == ["insert", "update", "update", "delete"]
    assert parse.filter_insert(parsed).count() == 1


def test_unusable_fields_are_set_aside(spark):
    def changed(**values):
        message = json.loads(transaction_a(1, 10, 5_000_000, 1_700_000_000_000))
        message["payload"]["after"].update(values)
        return json.dumps(message)

    df = records(
        spark,
        [
            changed(id=None),
            changed(savings_account_id=None),
            changed(created_date=None),
            changed(amount="%%%"),
            changed(amount=None),
            changed(transaction_type_enum=None),
            changed(id="seven"),
        ],
    )
    good, bad = parse.transactions(df, parse.TENANT_A)
    assert [r.op_type for r in good.collect()] == ["CREDIT"]
    assert set(reasons(bad)) == {0, 1, 2, 3, 4, 6}
    assert bad.where("value IS NULL").count() == 0


def test_tenant_b(spark):
    df = records(spark, [transaction_b(5, "U7", 20.25, 1_700_003_600_000_000, "OUT", "rent")])
    row = parse.transactions(df, parse.TENANT_B)[0].first()
    assert (row.id, row.account_id, row.amount, row.op_type, row.description) == (5, "U7", 20.25, "OUT", "rent")
    assert str(row.ts) == "2023-11-14 22:13:20"
    huge = records(spark, [transaction_b(5, "U7", 1e20, 1_700_003_600_000_000, "OUT", "rent")])
    assert parse.transactions(huge, parse.TENANT_B)[1].first().reason == "unusable field"


def test_accounts_keep_updates(spark):
    a = records(spark, [account_a(1, 100), account_a(1, 101, before={"id": 1})])
    assert sorted(r.customer_id for r in parse.accounts(a, parse.TENANT_A)[0].collect()) == [100, 101]
    b = records(spark, [account_b("U1", 100, "SA"), account_b("U2", 100, "XX")])
    assert [r.account_type for r in parse.accounts(b, parse.TENANT_B)[0].orderBy("account_id").collect()] == [
        "Saving Account",
        "Current Account",
    ]


def test_bytes_and_text_are_the_same_record(spark):
    from tellerscore.functions.text import decode_value

    df = records(spark, [record({"a": 1})]).selectExpr("CAST(value AS BINARY) AS value")
    assert decode_value(df).first().value == record({"a": 1})


def test_json_is_parsed_once(spark):
    good, _ = parse.transactions(records(spark, [transaction_a(1, 10, 5, 1)]), parse.TENANT_A)
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
