"""Alert rows for transactions labelled fraudulent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerscore.functions import alerts as texts
from tellerscore.functions.fields import number_text, time_text


def alert_rows(scored: DataFrame, recipient: str, signature: str, channel: str = "fraud") -> DataFrame:
    """One row per fraudulent transaction with everything a sender needs.

    ``scored`` is the canonical scored frame, before its columns get a tenant's names.
    """
    body = texts.alert_text(
        time_text(F.col("ts")),
        F.col("id"),
        F.col("customer_id"),
        F.col("account_id"),
        number_text(F.col("amount")),
    )
    return (
        scored.where("is_fraud = 'fraudulent'")
        .withColumn("body", body)
        .select(
            "id",
            F.lit(channel).alias("channel"),
            F.lit(recipient).alias("recipient"),
            F.lit(texts.SUBJECT).alias("subject"),
            texts.alert_payload(F.lit(texts.SUBJECT), F.col("body")).alias("chat"),
            texts.mail_text(F.col("body"), signature).alias("mail"),
        )
    )
