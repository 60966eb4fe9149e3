"""Silver cleaning queries: raw table -> ``clean_<entity>`` (one per entity).

Array columns are reported as their ``'|'``-joined text so the oracle
comparison does not depend on how either engine renders lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.plans import silver
from lakepipe.plans.catalog import AS_OF, CLOCK, initcap_sql, register, sround
from lakepipe.plans.raw_sources import raw_frame, raw_sql


def flatten_arrays(df: DataFrame) -> DataFrame:
    arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    return df.withColumns({a: F.array_join(a, "|") for a in arrays}) if arrays else df


# DuckDB spellings of the column functions.
def ts(x):
    return f"try_cast({x} as timestamp)"


def title(x):
    return initcap_sql(f"trim({x})")


def blank(x, kept):
    return f"case when length(trim({x})) = 0 then null else {kept} end"


def digits(x):
    return f"regexp_replace(cast({x} as varchar), '[^0-9]', '', 'g')"


def to_int(x):
    return f"cast(trunc(try_cast({x} as double)) as integer)"


def to_dbl(x):
    return f"try_cast({x} as double)"


def arr(x):
    return f"array_to_string(string_split(regexp_replace({x}, '\\s*,\\s*', ',', 'g'), ','), '|')"


def pg_arr(x):
    return arr(f"regexp_replace({x}, '[{{}}]', '', 'g')")


def up(x):
    return f"upper(trim({x}))"


EMAIL_RE = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


def _oracle(entity_raw: str, select: str, where: str = "") -> str:
    gate = f"{ts('updatedAt')} is not null and id is not null"
    if where:
        gate = f"{where} and {gate}"
    return f"with raw as ({raw_sql(entity_raw)})\nselect {select}\nfrom raw where {gate}"


TAIL = f"{ts('createdAt')} as createdAt, {ts('updatedAt')} as updatedAt"

SILVER_ORACLES = {
    "user": _oracle(
        "User",
        f"""id, case when lower(email) is null then 'unknown' else lower(email) end as email,
  {digits('phone')} as phone,
  case when upper(role) is null then 'USER' else upper(role) end as role,
  coalesce(try_cast(isVerified as boolean), false) as isVerified,
  coalesce(try_cast(isBlocked as boolean), false) as isBlocked,
  {to_int('fitnessCenterId')} as fitnessCenterId, {TAIL},
  cast({ts('createdAt')} as date) as createdDate, cast({ts('updatedAt')} as date) as updatedDate""",
    ),
    "user_info": _oracle(
        "UserInfo",
        f"""id, {title('firstName')} as firstName, {title('lastName')} as lastName,
  case when height <= 0 then null else height end as height,
  case when weight <= 0 then null else weight end as weight,
  {TAIL},
  concat_ws(' ', {title('firstName')}, {title('lastName')}) as fullName,
  case when height <= 0 or weight <= 0 or height is null or weight is null then null
       else {sround('weight / ((height / 100) ^ 2)', 2)} end as BMI,
  'postgres_bronze' as record_source, timestamp '{AS_OF}' as load_timestamp""",
    ),
    "fitness_center": _oracle(
        "FitnessCenter",
        f"""id, {title('name')} as name, {up('category')} as category,
  case when regexp_matches(lower(trim(officalemail)), '{EMAIL_RE}') then lower(trim(officalemail)) end
    as officalemail,
  case when length({digits('trim(phone)')}) between 9 and 11 then {digits('trim(phone)')} end as phone,
  try_cast(isVerified as boolean) as isVerified, {blank('description', 'description')} as description,
  addressId, {TAIL}, try_cast(isBlocked as boolean) as isBlocked, {ts('lastLoginAt')} as lastLoginAt""",
    ),
    "address": _oracle(
        "Address",
        f"""id, {title('street')} as street, {title('city')} as city, {title('state')} as state,
  case when length({digits('pincode')}) > 0 then {digits('pincode')} end as pincode,
  {title('country')} as country, {blank('landmark', title('landmark'))} as landmark, {TAIL}""",
    ),
    "staff": _oracle(
        "Staff",
        f"""id, {title('firstName')} as firstName, {title('lastName')} as lastName,
  concat_ws(' ', {title('firstName')}, {title('lastName')}) as fullName,
  {to_int('age')} as age, {up('role')} as role, {to_int('experience')} as experience,
  {blank('bio', 'bio')} as bio, addressId, userId, fitnessCenterId, {TAIL}""",
    ),
    "session": _oracle(
        "Session",
        f"""id, {title('name')} as name, {up('sessionType')} as sessionType,
  {ts('startTime')} as startTime, {ts('endTime')} as endTime,
  cast({sround(f"(epoch({ts('endTime')}) - epoch({ts('startTime')})) / 60", 0)} as double) as durationMinutes,
  maxCapacity, trainerId, fitnessCenterId, {TAIL}, availableSlots""",
    ),
    "workout_details": _oracle(
        "WorkOutDetails",
        f"""id, title, mode, {ts('startTime')} as startTime, {ts('endTime')} as endTime, durationMinutes,
  availableSlots, fitnessCenterId, {TAIL}, {up('goal')} as goal,
  {arr('trim(exercises)')} as exercises, {arr('trim(equipment)')} as equipment""",
    ),
    "booking": _oracle(
        "Booking",
        f"""id, userId, sessionId, fitnessCenterId, {ts('bookingDate')} as bookingDate,
  {up('status')} as status, {TAIL}""",
        "userId is not null and sessionId is not null and fitnessCenterId is not null",
    ),
    "membership_plan": _oracle(
        "MembershipPlan",
        f"""id, fitnessCenterId, {title('name')} as name, {blank('description', 'trim(description)')} as description,
  {to_dbl('price')} as price, {to_int('durationDays')} as durationDays, {pg_arr('features')} as features,
  {up('status')} as status, {TAIL}""",
    ),
    "user_membership": _oracle(
        "UserMembership",
        f"""id, userId, membershipPlanId, fitnessCenterId, {ts('startDate')} as startDate,
  {ts('endDate')} as endDate, {to_dbl('price')} as price, {up('status')} as status, {TAIL}""",
    ),
    "payment": _oracle(
        "Payment",
        f"""id, userId, membershipPlanId, {to_dbl('amount')} as amount, {up('currency')} as currency,
  {up('status')} as status, {up('provider')} as provider,
  regexp_replace(paymentId, '^"+|"+$', '', 'g') as paymentId, {TAIL}, fitnessCenterId""",
    ),
    "fitnesscentersubscription": _oracle(
        "FitnessCenterSubscription",
        f"""id, fitnessCenterId, membershipPlanId, {ts('startDate')} as startDate, {ts('endDate')} as endDate,
  {to_dbl('price')} as price, {up('status')} as status, {TAIL}""",
    ),
    "fitnesscentermembershipplan": _oracle(
        "FitnessCenterMembershipPlan",
        f"""id, {title('name')} as name, {blank('description', 'trim(description)')} as description,
  {to_dbl('price')} as price, {to_int('durationDays')} as durationDays, {pg_arr('features')} as features,
  {up('status')} as status, {TAIL}""",
    ),
}


def _make(entity: str):
    spec = silver.SILVER_SPECS[entity]

    def build(spark, sf_dir):
        raw = raw_frame(spark, sf_dir, spec.bronze)
        if entity == "user_info":
            return flatten_arrays(silver.clean_user_info(raw, CLOCK))
        return flatten_arrays(spec.clean(raw))

    build.__name__ = f"q_silver_{entity}"
    return build


for _entity in silver.SILVER_SPECS:
    register(f"silver_{_entity}", SILVER_ORACLES[_entity], "§2.12 PRJ-1 PRJ-2 PRJ-6 FLT-1")(_make(_entity))
