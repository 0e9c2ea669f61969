"""Categories, ages and display names.

Fixed values: they appear in the published tables, so spelling and order matter (including the
misspelt gender category).
"""

from __future__ import annotations

AGES = {
    "mcs": [0, 3, 5, 7, 11, 14, 17],
    "next_steps": [14, 15, 16, 17, 18, 19, 20, 25],
    "bcs70": [0, 5, 10, 16, 26, 29, 34, 38, 42, 46],
    "ncds": [0, 7, 11, 16, 23, 33, 42, 44, 46, 50, 55],
}

STUDIES = {"mcs": "MCS", "next_steps": "Next Steps", "bcs70": "BCS70", "ncds": "NCDS"}


ATTRIBUTES = {
    "response": "Respondent",
    "sex": "Sex",
    "ethnic_group": "Ethnicity",
    "gender_identity": "Gender Identity",
    "sexuality": "Sexual Orientation",
    "country": "Country of Residence",
    "fsm": "Free School Meals",
    "sen": "Special Educational Needs",
    "religion": "Religion",
    "disabled": "Disabled",
    "nssec": "NS-SEC Social Class",
    "rgsc": "Registrar General's Social Class",
    "carer": "Carer",
    "marstat": "Marital Status",
}

ETHNIC = ["White", "Mixed", "Indian", "Pakistani or Bangladeshi", "Black", "Other"]
SEX = ["Male", "Female"]
GENDER = ["Cisgender", "Transgender", "Non-Binary/ Gender Fluid / Adrogynous", "Other"]
SEXUALITY = ["Heterosexual", "Bisexual", "Homosexual", "Other"]
COUNTRY = ["England", "Wales", "Scotland", "Northern Ireland"]
RELIGION = ["No Religion", "Christian", "Muslim", "Hindu", "Sikh", "Buddhist", "Jewish"]
NSSEC = [
    "Managerial & Professional",
    "Intermediate",
    "Small Employers or Self-Employed",
    "Lower Supervisory & Technical",
    "(Semi-)Routine",
    "Not Working",
]
RGSC = [
    "I Professional",
    "II Managerial & Technical",
    "III Skilled Non-Manual",
    "III Skilled Manual",
    "IV Partly Skilled",
    "V Unskilled",
    "Not Working",
]
MARITAL = ["Single / Never Married", "Married", "Separated", "Divorced", "Widowed"]
BINARY = ["No", "Yes"]

CATEGORIES = {
    "response": BINARY,
    "sex": SEX,
    "ethnic_group": ETHNIC,
    "gender_identity": GENDER,
    "sexuality": SEXUALITY,
    "country": COUNTRY,
    "fsm": BINARY,
    "sen": BINARY,
    "religion": RELIGION,
    "disabled": BINARY,
    "nssec": NSSEC,
    "rgsc": RGSC,
    "carer": BINARY,
    "marstat": MARITAL,
}
