"""Texts and JSON bodies of fraud alerts and notifications."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The wording and look of the alerts.
SUBJECT = "Urgent: Potential Fraud Transaction Detected - Action Required"
BODY = (
    "We have detected a suspicious transaction on a user's account on {datetime}.\n"
    "Your immediate attention to this matter is required.\n"
    "Please review the details provided below:\n\n"
    "Transaction ID: {id}\n"
    "Customer ID: {customer_id}\n"
    "Account ID: {account_id}\n"
    "Amount: ${amount}\n"
    "Date: {datetime}.\n\n"
    "We kindly request that you take immediate action to thoroughly investigate and address "
    "this issue to prevent any further fraudulent activity.\n"
    "Your prompt response is greatly appreciated."
)
SALUTATION = "Dear Admin,\n\n"
CLOSING = "\n\nBest regards,\n"
ICON = ":exclamation:"
SENDER = "AI Assistant Alert"
COLOR = "danger"


def fill(template: str, values: dict[str, Column]) -> Column:
    """Replace each ``{name}`` of a template by a column's text."""
    pieces, rest = [], template
    while "{" in rest:
        text, rest = rest.split("{", 1)
        name, rest = rest.split("}", 1)
        pieces += [F.lit(text), values[name].cast("string")]
    return F.concat(*pieces, F.lit(rest))


def alert_text(moment: Column, id: Column, customer_id: Column, account_id: Column, amount: Column) -> Column:
    return fill(
        BODY,
        {
            "datetime": moment,
            "id": id,
            "customer_id": customer_id,
            "account_id": account_id,
            "amount": amount,
        },
    )


def mail_text(body: Column, signature: str) -> Column:
    return F.concat(F.lit(SALUTATION), body, F.lit(CLOSING + signature))


def alert_payload(title: Column, body: Column) -> Column:
    """Chat message as JSON, one attachment."""
    attachment = F.struct(title.alias("title"), body.alias("text"), F.lit(COLOR).alias("color"))
    return F.to_json(
        F.struct(
            F.lit(ICON).alias("icon_emoji"),
            F.lit(SENDER).alias("username"),
            F.array(attachment).alias("attachments"),
        )
    )


def notification(message: Column) -> Column:
    return F.to_json(F.struct(message.alias("message")))
