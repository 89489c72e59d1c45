"""Controlled vocabulary, patterns and thresholds of the case register."""

from __future__ import annotations

import re
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Param:
    """One heading of the vocabulary; without a sheet it only ends the section above it."""

    id: str
    title: str
    sheet: str | None = None
    aliases: tuple[str, ...] = field(default=())


# The 21 scrutiny parameters and the 6 boundary headings, in official order.
PARAMS = (
    Param("A1", "Short paid of tax on taxable supplies reported in GSTR-09", "01 Short paid tax GSTR-09", ("Short payment of tax on taxable supplies reported in GSTR-09",)),
    Param("A2", "Reconciliation of GSTR-01 with GSTR-09", "02 Recon GSTR-01 vs GSTR-09"),
    Param("A3", "Comparison of tax payable reported in GSTR-9 and GSTR-9C", "03 GSTR-9 vs GSTR-9C"),
    Param("A4", "Reconciliation of E-way bill turnover with GSTR-01/GSTR-09", "04 Recon EWB vs GSTR-01_09", ("Reconciliation of E-way bill turnover with GSTR-01", "Reconciliation of E-way bill turnover with GSTR-09")),
    Param("A5", "Short payment of tax under RCM", "05 Short payment RCM"),
    Param("A6", "Rate of tax of supplies made to TDS deductors", "06 Rate of tax TDS deductors"),
    Param("B1", "Excess ITC availed on Reverse Charge", "07 Excess ITC Reverse Charge", ("Scrutiny of ITC availed on Reverse Charge",)),
    Param("B2", "Excess ITC availed under ISD", "08 Excess ITC under ISD", ("Scrutiny of ITC availed under ISD",)),
    Param("B3", "Excess ITC availed under Imports", "09 Excess ITC under Imports", ("Scrutiny of ITC availed under Imports",)),
    Param("B4", "Excess claim of ITC in GSTR-3B w.r.t GSTR-9", "10 Excess ITC 3B vs GSTR-9"),
    Param("B5", "Excess claim of ITC availed w.r.t GSTR-2A", "11 Excess ITC vs GSTR-2A"),
    Param("B6", "Scrutiny of ITC reversals", "12 Scrutiny of ITC reversals"),
    Param("B7", "ITC to be reversed on non-business transactions & exempt supplies", "13 ITC rev non-biz & exempt", ("ITC to be reversed on non business transactions and exempt supplies",)),
    Param("B8", "Claim of Ineligible ITC-Sec 17(5)", "14 Ineligible ITC Sec 17(5)", ("Claim of Ineligible ITC Sec 17(5)", "Claim of Ineligible ITC-Section 17(5)")),
    Param("B9", "Invalid ITC under Sec 16(4)", "15 Invalid ITC Sec 16(4)", ("Invalid ITC as the supplier has filed GSTR-01 after the cut-off date", "Invalid ITC as Supplier filed GSTR 1 after cut off date")),
    Param("B10", "ITC claimed from cancelled dealers, return defaulters & tax nonpayers", "16 ITC cancelled dealers", ("ITC claimed from cancelled dealers, return defaulters & tax non payers", "ITC claimed from cancelled dealers, return defaulters & tax non")),
    Param("C1", "GSTR-1 late fee", "17 GSTR-1 late fee"),
    Param("C2", "GSTR-9 late fee", "18 GSTR-9 late fee", ("GSTR-9/9C late fee", "GSTR-9 9C late fee")),
    Param("C3", "Interest on ITC reversed under Rule 37", "19 Interest ITC Rule 37"),
    Param("C4", "Interest on late reporting of invoices", "20 Interest late reporting"),
    Param("C5", "Interest on invoice value increased through amendments", "21 Interest on amendments"),
    Param("G1", "Under declaration of tax payable as per returns"),
    Param("G2", "Excess claim of ITC"),
    Param("G3", "Interest/Late fee calculation", None, ("Interest calculation", "Late fee calculation", "Interest/Late fee")),
    Param("Z1", "Zero rated supply (Export) without payment of tax"),
    Param("Z2", "Supply to SEZs without payment of tax"),
    Param("Z3", "Particulars of the transactions for the financial year declared in returns of the next financial year", None, ("Particulars of the transactions for the financial year declared in returns of the next",)),
)
REPORTED = tuple(p.id for p in PARAMS if p.sheet)
TITLES = {p.id: p.title for p in PARAMS}

# Limits of heading matching, routing, grounding, judging and coverage.
LEAD, SLACK, MAX_WRAP, LONGEST = 4, 12, 3, 200
FUZZY_KEY, FUZZY_OFF, FUZZY_HEAD, FUZZY_RATIO = 20, 3, 10, 0.95
MIN_CHARS_PAGE, MAX_CONTROL = 600, 0.02
MIN_REPLY_CHARS, MAX_REPLY_LINES, ARGUE_CHARS, MAX_REPLIES = 400, 1200, 60000, 2
WINDOW, OVERLAP, MIN_GROUND, GROUND_WORDS = 500, 50, 0.55, 5
MIN_WITNESS, MIN_OVERLAP, LONGER, SPARSE = 120, 0.15, 2.0, 400
TOLERANCE, MAX_CELL, REPAIR_CHARS = 0.9, 30000, 14000
NO_REPLY, NO_FINDING, BLANK = "No reply", "No finding", "<<BLANK>>"
VERDICTS = ("dropped", "confirmed", "partly confirmed", "unclear")

# Patterns, in the syntax that Java and Python share (apply with the flags named).
ROLE_NAMES = {"scn": "DRC01_SCN", "reply": "DRC 01 Reply", "order": "DRC 01 Order"}
ROLE_HINTS = (("reply", r"(?i)reply|response|submission"), ("order", r"(?i)order|adjudicat"), ("scn", r"(?i)scn|notice|drc[\s_-]*01(?![a-z])"))
GSTIN = r"(\d{2}[A-Z]{5}\d{4}[A-Z]\d[A-Z\d]{2})"
PREFIX = (
    r"^[\s•·\-–—*]*"
    r"(?:(?:discrepancy|defect|issue|point|para)\s*(?:no\.?|number)?\s*)?"
    r"(?:[\(\[]?(?:\d{1,2}|[ivxIVX]{1,5})[\)\]][\s.:]*|[\(\[]?\d{1,2}[\)\]]?\s*[.:]\s*)?"
    r"\s*"
)
SUMMARY = r"(?i)^\s*(summary\s*:?\s*$|the total tax payable on account of these deficiencies|therefore,?\s+it is proposed to assess the registered taxpayer)"
TAIL = r"(?i)^\s*(you are (hereby )?(requested|directed)|if no (reply|response)|designation of the proper officer|place\s*:|date\s*:\s*\d)"
CONTROL = r"[\x00-\x08\x0b\x0e-\x1f\x7f]"
ILLEGAL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
CONTINUED, SPLIT_NUMBER = r"^\s{6,}[\d\s]{1,40}$", r"\d{4,}\s\d{1,3}(?!\d)"
FIGURE, LONG_FIGURE = r"(?<![\w.])\d[\d,]{2,}(?:\.\d+)?(?![\w])", r"\d[\d,]{3,}"
ARGUES = (
    r"(?i)\b(we (would|have|had|submit|wish|request|reply|are|paid|reversed)"
    r"|kindly|hence|therefore|with reference to|in this regard|respectfully"
    r"|it is submitted|our reply|the notice|drop the (proposed )?proceeding"
    r"|not liable|no further liability|respected sir)"
)
SUPPORTS = {
    "dropped": (
        r"(?i)((is|are|be)\s+(hereby\s+)?(dropped|closed|concluded)|accept(ing|ed|s)?\b[^.]{0,40}(contention|submission|reply|taxpayer)|"
        r"repl(y|ies)[^.]{0,30}(is|was|are)\s+accepted|proceedings?[^.]{0,40}(conclud|dropp)|found (in order|to be satisfactory|satisfactory|correct)|"
        r"no further (action|liability|proceeding)|not sustainable|discharged the liability|no (dues|demand)[^.]{0,20}(pending|payable))"
    ),
    "confirmed": (
        r"(?i)((is|are|stands?)\s+(hereby\s+)?confirmed|liable to (pay|reverse)|demand[^.]{0,30}confirm|not accept(able|ed)|"
        r"contention[^.]{0,20}(rejected|not tenable)|(along with|together with) interest( and penalty)?|recover(ed|able|y)|penalty[^.]{0,20}impos|is payable|under [Ss]ection 73)"
    ),
    "partly confirmed": r"(?i)(partly|part of the|to the extent of|remaining[^.]{0,30}(amount|liab|demand)|balance amount|however[^.]{0,60}(confirm|payable|liable))",
}
RECITAL = r"(?i)(it is proposed to be (taxed|recovered)|you are hereby|proposed to assess|therefore,? you are|we (submit|wish to submit)|in this regard,? we|kindly drop)"
NAME, LEGAL = r"(?i)^\s*(?:Trade\s+)?Name\s*:\s*(.+?)\s*$", r"(?i)^\s*\(?Legal\s+Name\s*:\s*\(?(.+?)\)*\s*$"
LABEL, SUBJECT = r"(?i)^\s*(?:Trade|Legal)\s+Name\b\s*:?\s*(.*)$", r"(?i)Tvl\.?\s*(.+?)\s*[–—-]\s*(?:Scrutiny|Annual|Assessment)"
NOT_A_NAME = r"(?i)^\s*(details of the tax\s?payer|office details|gstin|reg\s*status|zone|circle|financial year|designation|trade\s+name|legal\s+name|date\s*:)\b"


def squashed(s: str) -> str:
    return re.sub(r"[^a-z0-9]", "", s.lower())


def heading_keys(params=PARAMS) -> list[tuple[str, str]]:
    """(squashed spelling, id), longest first and otherwise in vocabulary order, each spelling once."""
    keys = {}
    for p in params:
        for spelling in (p.title, *p.aliases):
            keys.setdefault(squashed(spelling), p.id)
    return sorted(keys.items(), key=lambda k: -len(k[0]))
