"""Text clean-up: job titles, states, loan status, month dates, leading numbers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Job categories in order of precedence, each with the substrings that select it.
# A trailing blank is part of the keyword.
JOB_KEYWORDS = {
    "TRANSPORTATION": ["driver", "truck", "delivery", "cdl", "logistics", "freight", "pilot"],
    "HEALTHCARE": [
        "nurse", "doctor", "physician", "medical", "dental", "pharmacy", "therapist", "hospital",
        "clinical", "health",
    ],
    "EDUCATION": [
        "teacher", "professor", "instructor", "principal", "school", "education", "tutor", "lecturer",
    ],
    "TECHNOLOGY": [
        "software", "developer", "engineer", "programmer", "analyst", "data", "tech", "it ",
        "network", "cyber", "devops",
    ],
    "FINANCE": [
        "accountant", "finance", "bank", "loan", "credit", "mortgage", "financial", "cpa", "auditor",
    ],
    "MANAGEMENT": [
        "manager", "director", "supervisor", "lead", "head", "vp ", "president", "chief", "executive",
    ],
    "SALES_MARKETING": [
        "sales", "marketing", "realtor", "agent", "broker", "retail", "representative",
    ],
    "LEGAL": ["attorney", "lawyer", "paralegal", "legal", "judge"],
    "CONSTRUCTION": [
        "construction", "electrician", "plumber", "carpenter", "foreman", "mechanic", "welder",
    ],
    "MILITARY_GOV": [
        "military", "army", "navy", "marine", "police", "officer", "sergeant", "federal",
        "government", "gs-",
    ],
    "SERVICE": [
        "server", "bartender", "cook", "chef", "caregiver", "custodian", "housekeeper", "janitor",
    ],
}

# US states by census region.
REGION_STATES = {
    "Northeast": ("CT", "ME", "MA", "NH", "RI", "VT", "NJ", "NY", "PA"),
    "Midwest": ("IL", "IN", "MI", "OH", "WI", "IA", "KS", "MN", "MO", "NE", "ND", "SD"),
    "South": (
        "DE", "FL", "GA", "MD", "NC", "SC", "VA", "DC", "WV",
        "AL", "KY", "MS", "TN", "AR", "LA", "OK", "TX",
    ),
    "West": ("AZ", "CO", "ID", "MT", "NV", "NM", "UT", "WY", "AK", "CA", "HI", "OR", "WA"),
}
STATE_REGION = {
    state: region for region, states in REGION_STATES.items() for state in states
}
NO_STATE = "NA"

# Loan status categories in order of precedence, with the text that selects each.
STATUS_PHRASES = [
    ("fully paid", "FULLY_PAID"),
    ("current", "CURRENT"),
    ("grace", "GRACE_PERIOD"),
    ("late", "LATE"),
    ("charged off", "CHARGED_OFF"),
    ("default", "DEFAULT"),
]

MONTH_FORMAT = "MMM-yyyy"

# The characters Python counts as white space.
_BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _folded(text: Column | str) -> Column:
    return F.lower(F.trim(_col(text)))


def job_category(title: Column | str = "emp_title") -> Column:
    """Category of a free-form job title: the first category with a matching keyword.

    One pattern per category keeps the generated code small enough for the JIT compiler.
    """
    title = _col(title)
    folded = _folded(title)
    category = F.when(title.isNull(), "UNKNOWN")
    for name, keywords in JOB_KEYWORDS.items():
        category = category.when(folded.rlike("|".join(map(re.escape, keywords))), name)
    return category.otherwise("OTHER")


def _state_text(state: Column | str) -> Column:
    return F.upper(F.btrim(_col(state), F.lit(_BLANKS)))


def valid_state(state: Column | str = "address_state") -> Column:
    """The state code in capitals, or `NA` when it is missing or unknown."""
    cleaned = _state_text(state)
    return F.when(cleaned.isin(*STATE_REGION), cleaned).otherwise(NO_STATE)


def state_region(state: Column | str = "address_state") -> Column:
    """Census region of a state, null when it is missing or unknown."""
    cleaned = _state_text(state)
    region = None
    for name, states in REGION_STATES.items():
        test = cleaned.isin(*states)
        region = F.when(test, name) if region is None else region.when(test, name)
    return region


def loan_status_category(status: Column | str = "loan_status") -> Column:
    folded = _folded(status)
    category = None
    for phrase, name in STATUS_PHRASES:
        test = folded.contains(phrase)
        category = F.when(test, name) if category is None else category.when(test, name)
    return category.otherwise("OTHER")


def first_number(text: Column | str) -> Column:
    """The first run of digits as an int, null when there is none."""
    return F.regexp_extract(_col(text), r"(\d+)", 1).try_cast("int")


def month_date(text: Column | str) -> Column:
    """`Dec-2015` as the first day of that month, null when unreadable."""
    return F.try_to_date(_col(text), MONTH_FORMAT)
