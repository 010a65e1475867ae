"""The employee feed: one configured instance of the generic operators."""

from __future__ import annotations

from feedloom.functions import rules as R
from feedloom.schema import BOOLEAN, DATE, LIST, LONG, STRUCT, Feed, Field

# Field names, limits, patterns and messages ---------------------
FIELDS = (
    Field("employee_id"),
    Field("first_name"),
    Field("last_name"),
    Field("email"),
    Field("phone_number", sensitive=True),
    Field("hire_date", DATE),
    Field("department"),
    Field("job_title"),
    Field("salary", LONG, sensitive=True),
    Field("currency"),
    Field("employment_status"),
    Field("manager_id"),
    Field("is_active", BOOLEAN),
    Field("skills", LIST),
    Field("address", STRUCT, ("street", "city", "state", "postal_code", "country")),
    Field(
        "emergency_contact", STRUCT, ("name", "relationship", "phone", "email"), sensitive_children=("phone",)
    ),
)

RULES = (
    R.Length("employee_id", 7, 7),
    R.Length("first_name", 3, 15),
    R.Length("last_name", 0, 15, required=False),
    R.Length("email", 13, 30),
    R.Length("phone_number", 10, 10),
    R.Length("hire_date", 10, 10),
    R.Length("department", 0, 20, required=False),
    R.Length("job_title", 0, 30, required=False),
    R.Length("currency", 3, 3),
    R.Length("employment_status", 3, 13),
    R.Length("manager_id", 7, 7),
    R.Matches("email", R.EMAIL_PATTERN, "email has an invalid format"),
    R.RealDate("hire_date"),
    R.Matches(
        "currency", R.CURRENCY_PATTERN, "currency must be a 3-letter uppercase ISO code such as INR or USD"
    ),
    R.NotNegative("salary"),
    R.Present("is_active", " (true or false)"),
    R.JoinedLength("skills", 100, ";"),
)

CONSTRAINTS = (
    R.NotNull("employee_id"),
    R.MaxLength("employee_id", 7),
    R.NotNull("first_name"),
    R.MaxLength("first_name", 15),
    R.MaxLength("last_name", 15),
    R.NotNull("email"),
    R.MaxLength("email", 30),
    R.MaxLength("department", 20),
    R.MaxLength("job_title", 30),
    R.MaxLength("currency", 3),
    R.MaxLength("employment_status", 13),
    R.MaxLength("manager_id", 7),
    R.NoNul("employee_id"),
    R.NoNul("first_name"),
    R.NoNul("last_name"),
    R.NoNul("email"),
    R.NoNul("department"),
    R.NoNul("job_title"),
    R.NoNul("employment_status"),
    R.NoNul("manager_id"),
)
# ------------------------------------------------------------------------------

EMPLOYEE = Feed("employee", "employee_id", FIELDS, RULES, CONSTRAINTS)
