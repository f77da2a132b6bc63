"""Code lists of the register."""

from __future__ import annotations

# The first two digits of a legal category, and the company type.
COMPANY_TYPES = {
    "00": "Collective Investment",
    "10": "Entrepreneur",
    "21": "Joint Ownership",
    "22": "De facto Corporation",
    "23": "Joint-stock Company",
    "24": "Trust",
    "27": "Parish",
    "28": "Subject to VAT",
    "29": "Private Law Group without legal personality",
    "31": "Legal Entity Under Foreign Law, RCS registered",
    "32": "Legal Entity Under Foreign Law, not RCS registered",
    "41": "Public Company of industrial/commercial nature",
    "51": "Limited Liability Co-operative",
    "52": "SNC (General Partnership)",
    "53": "SCA (Limited Partnership)",
    "54": "SARL (Limited Liability Company)",
    "55": "SA (Limited Company with Board of Directors)",
    "56": "SA (Limited Company with Management Board)",
    "57": "SAS (Joint-Stock Company)",
    "58": "SE (EU Registered Company)",
    "61": "Pension Funds",
    "62": "Economic Interest Group",
    "63": "Agricultural Co-operative",
    "64": "Mutual Insurance",
    "65": "SC (Civil Company)",
    "69": "Other Registered Private Company",
    "71": "State Administration",
    "72": "Territorial Authority",
    "73": "Public Administration",
    "74": "Other Public Entity",
    "81": "Social Security",
    "82": "Mutual Organisation",
    "83": "Council",
    "84": "Professional Organisation",
    "85": "Non-compulsory pension",
    "91": "Union",
    "92": "1901 Association",
    "93": "Foundation",
    "99": "Other Legal Entity",
}

# Headcount codes and labels.
HEADCOUNTS = {
    "0": "0 fulltime employees",
    "00": "0 fulltime employees",
    "1": "1-2 employees",
    "01": "1-2 employees",
    "2": "2-3 employees",
    "02": "2-3 employees",
    "3": "6-9 employees",
    "03": "6-9 employees",
    "11": "10-19 employees",
    "12": "20-49 employees",
    "21": "50-99 employees",
    "22": "100-199 employees",
    "31": "200-249 employees",
    "32": "250-499 employees",
    "41": "500-999 employees",
    "42": "1000-1999 employees",
    "51": "2000-4999 employees",
    "52": "5000-9999 employees",
    "53": ">10000 employees",
    "null": "no number provided",
    "NN": "no number submitted",
}

# Fixed value: label of a company without a headcount code.
NO_HEADCOUNT = "NA"
