"""Schemas of the input and output tables. Readers always take one; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def struct(text: str) -> T.StructType:
    """Schema from ``name type, …`` of plain types, every field nullable; needs no session."""
    result = T.StructType()
    for part in text.split(","):
        name, kind = part.split()
        result = result.add(name, {"int": "integer"}.get(kind, kind))
    return result


USER_EVENT = struct("username string, action string, timestamp double, event_date string")
TOUCH_RAW = struct("timestamp string, uid string, campaign string, conversion string, conversion_timestamp string, conversion_id string")
TELCO_CUSTOMER = struct(
    "gender string, SeniorCitizen long, Partner string, Dependents string, tenure long, PhoneService string, MultipleLines string, "
    "InternetService string, OnlineSecurity string, OnlineBackup string, DeviceProtection string, TechSupport string, StreamingTV string, "
    "StreamingMovies string, Contract string, PaperlessBilling string, PaymentMethod string, MonthlyCharges double, TotalCharges double"
)
SCORED_LOG = T.StructType(
    [*TELCO_CUSTOMER.fields, *struct("timestamp_utc string, prediction_label string, churn_probability double").fields]
)
