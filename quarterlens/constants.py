"""Fixed values shared by every operator.

The first block holds values that must equal the revenue model we rebuild,
stated once, in their natural order.  The second block holds the parameters
of the mapping from the driver's TPC-H-like tables to the four billing
tables (see FIXTURES.md); they belong to the test fixture, not to the model.
"""

from __future__ import annotations

# --- Fixed values of the revenue model (must match for equal results) -----

# Plan tiers, cheapest first, with their annual recurring revenue in dollars.
TIER_ARR = {"Starter": 2400, "Growth": 14400, "Enterprise": 72000}
# Monthly list price per tier, used by the fixture to build billed MRR.
TIER_MRR = {"Starter": 200, "Growth": 1200, "Enterprise": 6000}
# Subscription statuses; any status other than "churned" counts as active.
STATUS_ACTIVE = "active"
STATUS_CHURNED = "churned"
STATUSES = [STATUS_ACTIVE, STATUS_CHURNED]
# Movement types in the order the classification tests them.
MOVEMENT_TYPES = ["new", "reactivation", "expansion", "contraction", "churn"]
# The fiscal year starts on 1 February; FY2026 = Feb 2025 .. Jan 2026.
FISCAL_YEAR_START_MONTH = 2
# Calendar of the original model: 36 months from 2023-02-01.
DEFAULT_CALENDAR_START = "2023-02-01"
DEFAULT_CALENDAR_MONTHS = 36
# NRR colour bands: >= 100 Strong, >= 80 At Risk, else Churning.
NRR_BAND_STRONG = ("Strong", 100.0)
NRR_BAND_AT_RISK = ("At Risk", 80.0)
NRR_BAND_CHURNING = "Churning"
# ARR bridge components, in display order, with their chart measure.
BRIDGE_COMPONENTS = [
    ("Beginning ARR", "beginning_arr", "absolute"),
    ("New", "new_arr", "relative"),
    ("Reactivation", "reactivation_arr", "relative"),
    ("Expansion", "expansion_arr", "relative"),
    ("Contraction", "contraction_arr", "relative"),
    ("Churn", "churn_arr", "relative"),
    ("Ending ARR", "ending_arr", "absolute"),
]
# A quarter whose churn rose this much over the prior quarter is a spike
# (the model's narrative: "churn spiked 30%").
CHURN_SPIKE_THRESHOLD_PCT = 30.0

# --- Fixture mapping parameters (FIXTURES.md section 2) --------------------

FIXTURE_TIER_BOUNDS = (300000.0, 450000.0)  # o_totalprice: < Starter, < Growth, else Enterprise
FIXTURE_CHURN_MODULUS = 10  # o_orderkey % 10 = 0 -> churned
FIXTURE_MISSING_TIER = (31, 97)  # (o_custkey*31 + year*12 + month) % 97 = 0 -> NULL tier
FIXTURE_MRR_NOISE = (7, 21, 90)  # mrr = price * (90 + (o_custkey*7 + year*12 + month) % 21) / 100
# Quarter of the single-quarter verified query; the fixture calendar runs
# FY1996-Q1 .. FY2002-Q2, and Q3 of FY1999 (Aug-Oct 1998) stands in for the
# original's "bad quarter" Q3.
FIXTURE_VERIFIED_QUARTER = "FY1999-Q3"
