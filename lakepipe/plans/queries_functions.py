"""One query per column function: ``id, input(s), result`` over a raw table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakepipe import functions as lf
from lakepipe.plans.catalog import CLOCK, initcap_sql, register, sround
from lakepipe.plans.queries_silver import arr, blank, digits, pg_arr, title, to_dbl, to_int, ts
from lakepipe.plans.raw_sources import raw_frame, raw_sql

EMAIL_RE = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"

# name: (raw table, input columns, Spark result, DuckDB result, covers)
FUNCTION_PROBES = {
    "text_norm": ("Address", ["street"], lambda: lf.text_norm("street"), "trim(street)", "ST-1"),
    "title_case": ("Staff", ["firstName", "lastName"], lambda: lf.title_case("lastName"), title("lastName"),
                   "ST-2"),
    "code_norm": ("Payment", ["currency"], lambda: lf.code_norm("currency"), "upper(trim(currency))", "ST-3"),
    "email_norm": ("User", ["email"], lambda: lf.email_norm("email", trim=False), "lower(email)", "ST-4"),
    "blank_to_null": ("FitnessCenter", ["description"], lambda: lf.blank_to_null("description", "keep"),
                      blank("description", "description"), "ST-5 ST-6"),
    "blank_to_null_title": ("Address", ["landmark"], lambda: lf.blank_to_null("landmark", "title"),
                            blank("landmark", initcap_sql("trim(landmark)")), "ST-6"),
    "digits_only": ("User", ["phone"], lambda: lf.digits_only("phone"), digits("phone"), "ST-7"),
    "strip_quotes": ("Payment", ["paymentId"], lambda: lf.strip_quotes("paymentId"),
                     "regexp_replace(paymentId, '^\"+|\"+$', '', 'g')", "ST-8"),
    "clean_email": ("FitnessCenter", ["officalemail"], lambda: lf.clean_email("officalemail"),
                    f"case when regexp_matches(lower(trim(officalemail)), '{EMAIL_RE}') "
                    "then lower(trim(officalemail)) end", "ST-9 FLT-8"),
    "clean_phone": ("FitnessCenter", ["phone"], lambda: lf.clean_phone("phone"),
                    f"case when length({digits('trim(phone)')}) between 9 and 11 then {digits('trim(phone)')} end",
                    "ST-7 FLT-6"),
    "clean_pincode": ("Address", ["pincode"], lambda: lf.clean_pincode("pincode"),
                      f"case when length({digits('pincode')}) > 0 then {digits('pincode')} end", "ST-7"),
    "full_name": ("Staff", ["firstName", "lastName"], lambda: lf.full_name("firstName", "lastName"),
                  "concat_ws(' ', firstName, lastName)", "ST-10"),
    "default_if_null": ("User", ["role"], lambda: lf.default_if_null(F.upper("role"), "USER"),
                        "coalesce(upper(role), 'USER')", "CD-3 CD-4"),
    "pg_array_to_array": ("MembershipPlan", ["features"], lambda: F.array_join(lf.pg_array_to_array("features"), "|"),
                          pg_arr("features"), "AR-1"),
    "csv_to_array": ("WorkOutDetails", ["exercises"], lambda: F.array_join(lf.csv_to_array("exercises"), "|"),
                     arr("trim(exercises)"), "AR-2"),
    "std_ts": ("Booking", ["updatedAt"], lambda: lf.std_ts("updatedAt"), ts("updatedAt"), "DT-1"),
    "day_of": ("UserMembership", ["startDate"], lambda: lf.day_of(lf.std_ts("startDate")),
               f"cast({ts('startDate')} as date)", "DT-2"),
    "days_since": ("FitnessCenter", ["lastLoginAt"], lambda: lf.days_since(lf.std_ts("lastLoginAt"), CLOCK.date()),
                   f"case when {ts('lastLoginAt')} is null then 999 "
                   f"else date_diff('day', cast({ts('lastLoginAt')} as date), date '2001-10-01') end", "DT-3 DT-4"),
    "duration_minutes": ("Session", ["startTime", "endTime"],
                         lambda: lf.duration_minutes(lf.std_ts("startTime"), lf.std_ts("endTime")),
                         "cast(" + sround(f"(epoch({ts('endTime')}) - epoch({ts('startTime')})) / 60", 0)
                         + " as double)", "DT-5 MA-1"),
    "bmi": ("UserInfo", ["height", "weight"], lambda: lf.bmi("height", "weight"),
            "case when height <= 0 or weight <= 0 or height is null or weight is null then null else "
            + sround("weight / ((height / 100) ^ 2)", 2) + " end", "MA-2 MA-4 FLT-7"),
    "std_cast_int": ("Staff", ["age"], lambda: lf.std_cast("age", "int"), to_int("age"), "CA-1"),
    "std_cast_double": ("Payment", ["amount"], lambda: lf.std_cast("amount", "double"), to_dbl("amount"), "CA-1"),
    "std_cast_boolean": ("FitnessCenter", ["isVerified"], lambda: lf.std_cast("isVerified", "boolean"),
                         "try_cast(isVerified as boolean)", "CA-1"),
}


def _make(raw: str, inputs: list[str], spark_expr):
    def build(spark, sf_dir):
        return raw_frame(spark, sf_dir, raw).select("id", *inputs, spark_expr().alias("result"))

    return build


for _name, (_raw, _inputs, _spark, _duck, _covers) in FUNCTION_PROBES.items():
    _sql = f"with raw as ({raw_sql(_raw)})\nselect id, {', '.join(_inputs)}, {_duck} as result from raw"
    register(f"fn_{_name}", _sql, _covers)(_make(_raw, _inputs, _spark))
