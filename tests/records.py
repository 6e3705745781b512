"""Small change-event builders."""

import base64
import json

from tellerscore.schemas import CDC_RECORD


def record(after, before=None):
    return json.dumps({"payload": {"before": before, "after": after}})


def transaction_a(id, account, millionths, epoch_ms, kind=1):
    raw = millionths.to_bytes(8, "big")
    return record(
        {
            "id": id,
            "savings_account_id": account,
            "created_date": epoch_ms,
            "transaction_type_enum": kind,
            "amount": base64.b64encode(raw).decode(),
        }
    )


def transaction_b(id, account, amount, epoch_us, kind, description):
    return record(
        {
            "id": id,
            "bank_account_id": account,
            "operation_date": epoch_us,
            "type": kind,
            "amount": amount,
            "description": description,
        }
    )


def account_a(id, customer, before=None):
    return record({"id": id, "client_id": customer}, before)


def account_b(id, customer, kind, before=None):
    return record({"id": id, "client_id": customer, "type": kind}, before)


def records(spark, values, start=0):
    return spark.createDataFrame([(v, 0, start + i) for i, v in enumerate(values)], CDC_RECORD)
