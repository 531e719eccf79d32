"""Code dictionaries of the legacy system for one city variant.

Fixed values: these must equal the legacy mappings for results to match.
Select a variant with ``dictionaries(variant)``; only one is defined.
"""

from __future__ import annotations

# Special need code -> assistance basis.
SPECIAL_NEED = {207: "DEVELOPMENTAL_DISABILITY", 240: "EXTENDED_COMPULSORY_EDUCATION",
                252: "CHILD_ACCULTURATION_SUPPORT", 440: "INTENSIFIED_ASSISTANCE",
                441: "SPECIAL_ASSISTANCE_DECISION"}

# Special mean code -> assistance action value.
SPECIAL_MEAN = {379: 30, 415: 40, 416: 70, 432: 20, 434: 10, 436: 50, 438: 10, 446: 60}

# Application type code -> type (None = known, not migrated).
APPLICATION_TYPE = {999940001: "DAYCARE", 999940002: "DAYCARE", 999940003: None, 999940004: None,
                    999940005: None, 999940006: None, 999940010: None, 999940013: None, 999940016: None,
                    999940023: None, 999940027: None, 999940028: None, 999940029: None, 999940030: None,
                    999940031: None}

# Application status code -> status.
APPLICATION_STATUS = {999962042: "SENT"}

# Fee deviation type code -> (type, notes).
DEVIATION_TYPE = {5: ("DISCOUNT", "ALENNUS"), 39: ("DISCOUNT", "ALENNUS AP/IP"),
                  41: ("DISCOUNT", "MAKSUTON OSUUS"), 48: ("RELIEF", "ULKOKUNTALAINEN")}

# Decision types that are voucher value decisions.
VOUCHER_DECISION_TYPES = [426]

# Decision status code -> status (voucher decisions).
DECISION_STATUS = {82: "DRAFT", 999420001: "SENT"}

# Pay decision status code -> status (None = known, not migrated).
PAY_DECISION_STATUS = {82: "DRAFT", 403: None, 493: None, 999420001: "SENT", 999420002: None}

# Daily journal report code -> absence type / backup care flag
# (codes mapped to an empty entry are known but carry neither).
REPORT_CODE_ABSENCE = {169: "SICKLEAVE", 170: None, 171: "OTHER_ABSENCE", 172: "PLANNED_ABSENCE", 173: None,
                       174: None, 175: "OTHER_ABSENCE", 176: None, 177: None, 178: "FORCE_MAJEURE",
                       409: "TEMPORARY_RELOCATION", 410: "FORCE_MAJEURE", 447: "UNKNOWN_ABSENCE",
                       474: "OTHER_ABSENCE"}
BACKUP_CARE_CODES = [176]

# Income period coefficients (normalise to a monthly level).
INCOME_COEFFICIENTS = {"MONTHLY_NO_HOLIDAY_BONUS": "1.0", "MONTHLY_WITH_HOLIDAY_BONUS": "1.0417",
                       "BI_WEEKLY_WITH_HOLIDAY_BONUS": "2.2323", "BI_WEEKLY_NO_HOLIDAY_BONUS": "2.1429",
                       "YEARLY": "0.0833", "DAILY_ALLOWANCE_21_5": "21.5", "DAILY_ALLOWANCE_25": "25.0"}

# Income type code -> income type; types counted negative.
INCOME_TYPE = {84: "PENSION", 85: "MAIN_INCOME", 86: "HOLIDAY_BONUS", 87: "ALIMONY", 88: "PAID_ALIMONY",
               108: "OTHER_INCOME", 109: "DAILY_ALLOWANCE", 110: "BUSINESS_INCOME", 164: "ADJUSTED_DAILY_ALLOWANCE",
               275: "PERKS", 451: "HOME_CARE_ALLOWANCE", 452: "RELATIVE_CARE_SUPPORT", 453: "STUDENT_INCOME",
               454: "GRANT", 455: "STARTUP_GRANT", 456: "CAPITAL_INCOME", 457: "RENTAL_INCOME"}
INCOME_TYPES_ALL = list(INCOME_TYPE.values()) + ["SECONDARY_INCOME", "UNEMPLOYMENT_BENEFITS", "ALL_EXPENSES",
                                                 "PARENTAL_ALLOWANCE", "SICKNESS_ALLOWANCE"]
INCOME_SIGNS = {"PAID_ALIMONY": -1, "ALL_EXPENSES": -1}

# Income period code -> income period.
INCOME_PERIOD = {83: "MONTHLY_NO_HOLIDAY_BONUS", 111: "DAILY_ALLOWANCE_21_5", 112: "DAILY_ALLOWANCE_25"}

# The income type used for fee decisions and the default period.
FEE_DECISION_INCOME_TYPE = "MAIN_INCOME"
DEFAULT_INCOME_PERIOD = "MONTHLY_NO_HOLIDAY_BONUS"

# Stand-ins for codes missing from the dictionaries (the legacy job wrote
# placeholder keys here; we use explicit names).
UNKNOWN_INCOME_TYPE = "UNKNOWN"
UNKNOWN_INCOME_PERIOD = "UNKNOWN"
