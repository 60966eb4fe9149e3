"""The 13 silver cleaning jobs: ``clean_<entity>(df) -> df``.

Each is a pure projection + filter over the raw bronze frame, so it runs
unchanged on a batch frame or on a streaming frame (the stateful part --
latest row per key and the upsert -- happens in the micro-batch sink).
Every job ends the same way: ``createdAt``/``updatedAt`` parsed, rows
without key or ``updatedAt`` dropped, the rescue and bronze load-date
columns removed, and (for
fixed-schema entities) the contract projection.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.clock import SYSTEM_CLOCK, Clock, add_audit_columns
from lakepipe.sinks.writers import INGEST_DATE_COL
from lakepipe.functions import (
    blank_to_null,
    bmi,
    clean_email,
    clean_phone,
    clean_pincode,
    code_norm,
    csv_to_array,
    day_of,
    default_if_null,
    digits_only,
    duration_minutes,
    full_name,
    pg_array_to_array,
    positive_or_null,
    std_cast,
    strip_quotes,
    title_case,
)

PK = "id"
UPDATED = "updatedAt"
RESCUE_COL = "_rescued_data"
# Bronze bookkeeping columns that never reach silver (the load-date
# partition column is a property of the bronze layout, not of the entity).
BRONZE_ONLY_COLS = (RESCUE_COL, INGEST_DATE_COL)
# User columns that silver leaves out.
SENSITIVE_USER_COLS = ("password", "refreshToken", "loginAttempts", "lastLoginAt")

# Contracts (column order of the silver tables).  Columns in
# OPTIONAL are filled with a typed NULL when the source does not have them.
CONTRACTS = {
    "fitness_center": ["id", "name", "category", "officalemail", "phone", "isVerified", "description",
                       "addressId", "createdAt", "updatedAt", "isBlocked", "lastLoginAt"],
    "address": ["id", "street", "city", "state", "pincode", "country", "landmark", "createdAt", "updatedAt"],
    "staff": ["id", "firstName", "lastName", "fullName", "age", "role", "experience", "bio", "addressId",
              "userId", "fitnessCenterId", "createdAt", "updatedAt"],
    "session": ["id", "name", "sessionType", "startTime", "endTime", "durationMinutes", "maxCapacity",
                "trainerId", "fitnessCenterId", "createdAt", "updatedAt", "availableSlots"],
    "workout_details": ["id", "title", "mode", "startTime", "endTime", "durationMinutes", "availableSlots",
                        "fitnessCenterId", "createdAt", "updatedAt", "goal", "exercises", "equipment"],
    "booking": ["id", "userId", "sessionId", "fitnessCenterId", "bookingDate", "status", "createdAt",
                "updatedAt"],
    "membership_plan": ["id", "fitnessCenterId", "name", "description", "price", "durationDays", "features",
                        "status", "createdAt", "updatedAt"],
    "user_membership": ["id", "userId", "membershipPlanId", "fitnessCenterId", "startDate", "endDate",
                        "price", "status", "createdAt", "updatedAt"],
    "payment": ["id", "userId", "membershipPlanId", "amount", "currency", "status", "provider", "paymentId",
                "createdAt", "updatedAt", "fitnessCenterId"],
    "fitnesscentersubscription": ["id", "fitnessCenterId", "membershipPlanId", "startDate", "endDate",
                                  "price", "status", "createdAt", "updatedAt"],
    "fitnesscentermembershipplan": ["id", "name", "description", "price", "durationDays", "features",
                                    "status", "createdAt", "updatedAt"],
}
OPTIONAL = {
    "session": {"availableSlots": "int"},
    "workout_details": {"goal": "string", "exercises": "array<string>", "equipment": "array<string>"},
    "payment": {"fitnessCenterId": "bigint"},
}


def to_ts(df: DataFrame, *cols: str) -> DataFrame:
    """Parse the named columns to ``timestamp`` by their actual type; text
    that does not parse becomes NULL (never an error)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    for c in cols:
        if c not in types:
            continue
        dt = types[c]
        if isinstance(dt, T.TimestampType):
            continue
        if isinstance(dt, (T.TimestampNTZType, T.DateType)):
            out[c] = F.col(c).cast("timestamp")
        elif isinstance(dt, T.NumericType):
            out[c] = F.timestamp_seconds(F.col(c))
        else:
            out[c] = F.try_to_timestamp(F.col(c).cast("string"))
    return df.withColumns(out) if out else df


def finish(df: DataFrame, entity: str | None = None, extra_not_null: tuple[str, ...] = ()) -> DataFrame:
    """Common tail: timestamps, not-null gates, bronze-only columns, contract."""
    df = to_ts(df, "createdAt", UPDATED)
    for c in (*extra_not_null, UPDATED, PK):
        df = df.filter(F.col(c).isNotNull())
    df = df.drop(*[c for c in BRONZE_ONLY_COLS if c in df.columns])
    if entity is None:
        return df
    return conform(df, entity)


def conform(df: DataFrame, entity: str) -> DataFrame:
    have = set(df.columns)
    optional = OPTIONAL.get(entity, {})
    cols = []
    for c in CONTRACTS[entity]:
        if c in have:
            cols.append(F.col(c))
        elif c in optional:
            cols.append(F.lit(None).cast(optional[c]).alias(c))
        else:
            raise ValueError(f"{entity}: source lacks required column {c!r}")
    return df.select(*cols)


def _bool_or_false(c: str):
    return F.coalesce(std_cast(c, "boolean"), F.lit(False))


def clean_user(df: DataFrame) -> DataFrame:
    df = to_ts(df, "createdAt", UPDATED, "lastLoginAt").withColumns(
        {
            "isVerified": _bool_or_false("isVerified"),
            "isBlocked": _bool_or_false("isBlocked"),
            "phone": digits_only("phone"),
            "email": default_if_null(F.lower("email"), "unknown"),
            "role": default_if_null(F.upper("role"), "USER"),
            "fitnessCenterId": std_cast("fitnessCenterId", "int"),
        }
    )
    df = df.withColumns({"createdDate": day_of("createdAt"), "updatedDate": day_of(UPDATED)})
    return finish(df).drop(*SENSITIVE_USER_COLS)


def clean_user_info(df: DataFrame, clock: Clock = SYSTEM_CLOCK) -> DataFrame:
    df = df.withColumns(
        {
            "firstName": title_case("firstName"),
            "lastName": title_case("lastName"),
            "height": positive_or_null("height"),
            "weight": positive_or_null("weight"),
        }
    )
    df = df.withColumns({"fullName": full_name("firstName", "lastName"), "BMI": bmi("height", "weight")})
    return finish(add_audit_columns(df, "postgres_bronze", clock))


def clean_fitness_center(df: DataFrame) -> DataFrame:
    df = to_ts(df, "lastLoginAt").withColumns(
        {
            "name": title_case("name"),
            "category": code_norm("category"),
            "description": blank_to_null("description", "keep"),
            "officalemail": clean_email("officalemail"),
            "phone": clean_phone("phone"),
            "isVerified": std_cast("isVerified", "boolean"),
            "isBlocked": std_cast("isBlocked", "boolean"),
        }
    )
    return finish(df, "fitness_center")


def clean_address(df: DataFrame) -> DataFrame:
    df = df.withColumns(
        {
            "street": title_case("street"),
            "city": title_case("city"),
            "state": title_case("state"),
            "country": title_case("country"),
            "landmark": blank_to_null("landmark", "title"),
            "pincode": clean_pincode("pincode"),
        }
    )
    return finish(df, "address")


def clean_staff(df: DataFrame) -> DataFrame:
    df = df.withColumns({"firstName": title_case("firstName"), "lastName": title_case("lastName")})
    df = df.withColumns(
        {
            "fullName": full_name("firstName", "lastName"),
            "role": code_norm("role"),
            "bio": blank_to_null("bio", "keep"),
            "age": std_cast("age", "int"),
            "experience": std_cast("experience", "int"),
        }
    )
    return finish(df, "staff")


def clean_session(df: DataFrame) -> DataFrame:
    df = to_ts(df, "startTime", "endTime").withColumns(
        {"name": title_case("name"), "sessionType": code_norm("sessionType")}
    )
    df = df.withColumn("durationMinutes", duration_minutes("startTime", "endTime"))
    return finish(df, "session")


def clean_workout_details(df: DataFrame) -> DataFrame:
    df = to_ts(df, "startTime", "endTime").withColumns(
        {
            "goal": code_norm("goal"),
            "exercises": csv_to_array("exercises"),
            "equipment": csv_to_array("equipment"),
        }
    )
    return finish(df, "workout_details")


def clean_booking(df: DataFrame) -> DataFrame:
    df = to_ts(df, "bookingDate").withColumn("status", code_norm("status"))
    return finish(df, "booking", extra_not_null=("userId", "sessionId", "fitnessCenterId"))


def _plan_columns(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "name": title_case("name"),
            "description": blank_to_null("description", "trim"),
            "features": pg_array_to_array("features"),
            "status": code_norm("status"),
            "price": std_cast("price", "double"),
            "durationDays": std_cast("durationDays", "int"),
        }
    )


def clean_membership_plan(df: DataFrame) -> DataFrame:
    return finish(_plan_columns(df), "membership_plan")


def clean_center_plan(df: DataFrame) -> DataFrame:
    return finish(_plan_columns(df), "fitnesscentermembershipplan")


def _priced_period(df: DataFrame) -> DataFrame:
    return to_ts(df, "startDate", "endDate").withColumns(
        {"status": code_norm("status"), "price": std_cast("price", "double")}
    )


def clean_user_membership(df: DataFrame) -> DataFrame:
    return finish(_priced_period(df), "user_membership")


def clean_center_subscription(df: DataFrame) -> DataFrame:
    return finish(_priced_period(df), "fitnesscentersubscription")


def clean_payment(df: DataFrame) -> DataFrame:
    df = df.withColumns(
        {
            "currency": code_norm("currency"),
            "status": code_norm("status"),
            "provider": code_norm("provider"),
            "amount": std_cast("amount", "double"),
            "paymentId": strip_quotes("paymentId"),
        }
    )
    return finish(df, "payment")


@dataclass(frozen=True)
class SilverSpec:
    entity: str  # silver table name
    bronze: str  # bronze (source) table name
    clean: Callable[[DataFrame], DataFrame]
    pk: str = PK
    updated_col: str = UPDATED


# Source table -> silver entity pairs of the pipeline.
SILVER_SPECS = {
    s.entity: s
    for s in [
        SilverSpec("user", "User", clean_user),
        SilverSpec("user_info", "UserInfo", clean_user_info),
        SilverSpec("fitness_center", "FitnessCenter", clean_fitness_center),
        SilverSpec("address", "Address", clean_address),
        SilverSpec("staff", "Staff", clean_staff),
        SilverSpec("session", "Session", clean_session),
        SilverSpec("workout_details", "WorkOutDetails", clean_workout_details),
        SilverSpec("booking", "Booking", clean_booking),
        SilverSpec("membership_plan", "MembershipPlan", clean_membership_plan),
        SilverSpec("user_membership", "UserMembership", clean_user_membership),
        SilverSpec("payment", "Payment", clean_payment),
        SilverSpec("fitnesscentersubscription", "FitnessCenterSubscription", clean_center_subscription),
        SilverSpec("fitnesscentermembershipplan", "FitnessCenterMembershipPlan", clean_center_plan),
    ]
}
