"""Fixed values of field reading, scrubbing and reconciliation."""

ANCHOR_LABELS = [
    "CARRIER", "NAIC CODE", "POLICY NUMBER", "EFFECTIVE DATE", "NAMED INSURED(S)", "CONSTRUCTION TYPE", "PRIMARY HEAT",
    "SECONDARY HEAT", "COVERAGES", "LIMITS", "SIGNATURE", "GENERAL INFORMATION", "CONTACT INFORMATION",
    "ADDITIONAL INTEREST", "UNDERLYING INSURANCE", "BLANKET SUMMARY", "TOTAL AREA", "YR BUILT",
]

# Printed labels that are never values.
KNOWN_LABELS = [
    "AGENCY", "CARRIER", "NAIC CODE", "COMPANY POLICY OR PROGRAM NAME", "PROGRAM CODE", "POLICY NUMBER", "CONTACT",
    "NAME:", "PHONE", "FAX", "E-MAIL", "ADDRESS:", "UNDERWRITER", "UNDERWRITER OFFICE", "CODE:", "SUBCODE:",
    "AGENCY CUSTOMER ID:", "STATUS OF", "TRANSACTION", "QUOTE", "ISSUE POLICY", "RENEW", "CHANGE", "CANCEL", "DATE",
    "TIME", "AM", "PM", "BOUND (Give Date and/or Attach Copy):", "LINES OF BUSINESS", "INDICATE LINES OF BUSINESS",
    "PREMIUM", "ATTACHMENTS", "POLICY INFORMATION", "APPLICANT INFORMATION", "PROPOSED EFF DATE", "PROPOSED EXP DATE",
    "BILLING PLAN", "PAYMENT PLAN", "METHOD OF PAYMENT", "AUDIT", "DEPOSIT", "MINIMUM", "POLICY PREMIUM", "DIRECT",
    "GL CODE", "SIC", "NAICS", "FEIN OR SOC SEC #", "BUSINESS PHONE #:", "WEBSITE ADDRESS", "CORPORATION",
    "JOINT VENTURE", "NOT FOR PROFIT ORG", "SUBCHAPTER \"S\" CORPORATION", "INDIVIDUAL", "LLC", "PARTNERSHIP", "TRUST",
    "NO. OF MEMBERS", "AND MANAGERS:", "(A/C, No, Ext):", "(A/C, No):", "LOC #", "BLD #", "STREET", "CITY:", "STATE:",
    "COUNTY:", "ZIP:", "CITY LIMITS", "INSIDE", "OUTSIDE", "INTEREST", "OWNER", "TENANT", "# FULL TIME EMPL",
    "# PART TIME EMPL", "ANNUAL REVENUES:", "$", "OCCUPIED AREA:", "OPEN TO PUBLIC AREA:", "TOTAL BUILDING AREA:",
    "SQ FT", "DESCRIPTION OF OPERATIONS:", "ANY AREA LEASED TO OTHERS? Y / N", "CONTACT TYPE:", "CONTACT NAME:",
    "PRIMARY", "SECONDARY", "PHONE #", "HOME", "BUS", "CELL", "PRIMARY E-MAIL ADDRESS:", "SECONDARY E-MAIL ADDRESS:",
    "PREMISES INFORMATION", "NATURE OF BUSINESS", "DESCRIPTION OF PRIMARY OPERATIONS",
]

# Geometry of label reading.
LABEL_MAX_GAP, LABEL_OVERLAP, LABEL_Y_TOL = 200.0, 2.0, 5.0
MARK_Y_TOL, MARK_X_RANGE, MARK = 6.0, 30.0, "X"

# Dark-pixel test of a checkbox.
PIXEL_DPI, PIXEL_DARK, PIXEL_INSET, PIXEL_THRESHOLD, PIXEL_MIN_CROP, PIXEL_MIN_INNER = 200, 140, 0.2, 0.18, 4, 2

# Option labels a model may emit for a checkbox, by the flat name of the option.
CHECKBOX_SYNONYMS = {
    "limitedliabilitycorporation": ["llc", "l.l.c", "limited liability corp"],
    "limitedpartnership": ["lp", "l.p", "limited partnership"],
    "subchapterscorporation": ["subchapter s", "subchapter \"s\"", "s-corp", "s corp"],
    "notforprofitorg": ["non-profit", "nonprofit", "not for profit"],
    "jointventure": ["joint venture", "jv"],
    "ownerscontractorsprotective": ["ocp"],
    "claimsmade": ["claims made", "claims-made"],
    "occurrence": ["occurrence", "per occurrence"],
    "perclaim": ["per claim"],
    "perpolicy": ["per policy"],
    "perproject": ["per project"],
    "perlocation": ["per location"],
    "directbill": ["direct", "direct bill"],
    "agencybill": ["agency", "agency bill"],
    "producerbill": ["agency", "producer", "agency bill", "producer bill"],
    "inside": ["inside"],
    "outside": ["outside"],
    "owner": ["owner"],
    "tenant": ["tenant"],
    "individual": ["individual"],
    "corporation": ["corporation", "corp", "corp."],
    "partnership": ["partnership"],
    "trust": ["trust"],
}
CHECKBOX_CONSTANTS = ["y", "n", "y/n", "yes", "no", "[ ]", "[x]", "x", "✓", "☐", "☑"]

# Form text a model returns where no data was filled in, normalized.
TEMPLATE_GARBAGE = [
    "signature", "producer's signature", "applicant's signature", "producer's name (please print)", "producer's name",
    "applicant's name", "national producer number", "state producer license no",
    "state producer license no (required in florida)", "agency customer id", "policy number", "date",
    "y/n", "[ ]", "[x]", "x", "yes/no",
    "accept coverage", "reject coverage", "accept", "reject", "per claim", "per occurrence", "per claim per occurrence",
    "prem / ops", "prem/ops", "premium / operations", "products / completed operations", "claims made", "occurrence",
    "home", "bus", "cell", "primary", "secondary",
    "inside", "outside", "owner", "tenant",
    "boiler", "solid fuel", "wood-fired", "wood fired", "resistive", "semi-resistive", "non-resistive", "combustible",
    "central station", "local gong", "with keys", "clock hourly",
    "quote", "issue policy", "renew", "change", "cancel", "bound",
    "see attached", "see attached additional coverages overflow.",
]
BOX_GLYPHS = ["☐", "☑", "□", "■", "◯"]
CHOICE_PREFIX = r"(?i)^I\s+(SELECT|HAVE\s+SELECTED|REJECT|ACCEPT)\b"
NUMBERED_QUESTION = r"^\d+\.\s+[A-Z]"
LEGACY_NUMBERED_QUESTION = r"^\d+\.?\s+[A-Z]"
QUESTION_LONGER_THAN, CAPITALS_LONGER_THAN, LABEL_LONGER_THAN, LABEL_AT_LEAST = 12, 25, 5, 3
BUSINESS_SUFFIX = (r"(?i)\b(LLC|L\.?L\.?C|LP|L\.?P|INC|CORP|CO|LTD|GROUP|HOLDINGS|PROPERTIES|APARTMENTS|PARTNERS|TRUST|"
                   r"ASSOCIATES|MANAGEMENT|REALTY|VENTURES|ENTERPRISES)\b")
STREET_START = r"^\d+\s+[A-Z]"
AMOUNT = r"^[$]?[\d,]+\.?\d*$"
ADDRESS_BLED = (r"(?i)\b\d+\s+[NSEW]?\s*\w+\s+(Ave|Street|St|Rd|Road|Blvd|Drive|Dr|Lane|Ln|Way|Circle|Cir|Suite|Ste)\b")
ZERO_TEXTS = ["0", "0.0", "$0.00"]
NULL_TEXTS = ["None", "null"]

SHORT_VALUE = 4
CLAIM_NUMBER = r"\b[A-Z]{0,4}-?\d[\dA-Z\-]{3,}\b"
CHECKED_LENGTH = 4
TOKEN_LENGTH = 2
RAW_LIMIT = 4000

OVERFLOW_HEADERS = ["ADDITIONAL COVERAGES OVERFLOW", "APPLIED 98 (2001/01)"]
OVERFLOW_PREFIX = "* Code"
OVERFLOW_MARK = "Description"
