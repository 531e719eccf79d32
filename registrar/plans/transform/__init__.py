"""Reconciliation jobs (D1-D15): staged legacy tables -> target-shaped
tables plus ``<table>_todo`` quarantine tables.

Every job takes a mapping of named DataFrames (staged tables, mapping files,
target dimensions and earlier job outputs) and returns a dict of lazy
DataFrames; nothing is executed until a runner writes them. Ids are
deterministic (``hash_uuid`` of the natural key, or the id map), so a rerun
or a recomputed task produces the same ids.
"""

from .assistance import special_means, special_needs
from .care import applications, cleanup, departments, placements, service_needs
from .finance import fee_deviations, income, pay_decisions, voucher_value_decisions
from .journals import daily_journals, timestamps
from .people import families, persons

# Chain order of the legacy transform stage; entries marked False were
# switched off in the legacy chain but can be run alone.
CHAIN = [
    ("persons", persons, True),
    ("families", families, True),
    ("special_needs", special_needs, False),
    ("special_means", special_means, False),
    ("income", income, True),
    ("departments", departments, True),
    ("placements", placements, True),
    ("service_needs", service_needs, True),
    ("fee_deviations", fee_deviations, True),
    ("applications", applications, True),
    ("voucher_value_decisions", voucher_value_decisions, True),
    ("pay_decisions", pay_decisions, True),
    ("daily_journals", daily_journals, True),
    ("timestamps", timestamps, False),
    ("cleanup", cleanup, True),
]

__all__ = [n for n, _, _ in CHAIN] + ["CHAIN"]
