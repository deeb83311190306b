"""Fixed values of page and file classification: patterns, phrases and thresholds."""

# Footer patterns, in order; the first that matches the end of the page wins.
FOOTER_TAIL = 300
FOOTERS = [
    (r"(?i)ACORD\s*125\s*\([\d/]+\)", "acord_125"),
    (r"(?i)ACORD\s*126\s*\(2014/\d+\)", "acord_126_2014"),
    (r"(?i)ACORD\s*126\s*\(\s*\d+/\d+\s*\)", "acord_126"),
    (r"(?i)ACORD\s*131\s*\(\s*\d+/\d+\s*\)", "acord_131"),
    (r"(?i)ACORD\s*140\s*\(\s*\d+/\d+\s*\)", "acord_140"),
    (r"(?i)ACORD\s*823\s*\(\s*\d+/\d+\s*\)", "acord_823"),
]

# Section headers printed on each form: strong phrases, then weak ones.
FINGERPRINTS = {
    "acord_125": (
        ["APPLICANT INFORMATION SECTION", "INDICATE LINES OF BUSINESS", "STATUS OF TRANSACTION", "POLICY INFORMATION",
         "NATURE OF BUSINESS", "PREMISES INFORMATION", "SCHEDULE OF HAZARDS", "GENERAL INFORMATION",
         "PRIOR CARRIER INFORMATION", "LOSS HISTORY"],
        ["AGENCY", "CARRIER", "NAIC CODE", "POLICY NUMBER", "AGENCY CUSTOMER ID", "PROPOSED EFF DATE"]),
    "acord_140": (
        ["PROPERTY SECTION", "BLANKET SUMMARY", "PREMISES INFORMATION", "COVERAGE INFORMATION", "ADDITIONAL COVERAGES",
         "CONSTRUCTION", "BUILDING IMPROVEMENTS", "FIRE PROTECTION", "BURGLAR ALARM", "ADDITIONAL INTEREST"],
        ["YEAR BUILT", "TOTAL AREA", "ROOF TYPE", "WIRING", "PLUMBING", "PROTECTION CLASS", "DEDUCTIBLE"]),
    "acord_126_2014": (
        ["COMMERCIAL GENERAL LIABILITY SECTION", "SCHEDULE OF HAZARDS", "CLAIMS MADE", "OWNERS & CONTRACTORS PROTECTIVE",
         "CONTRACTORS", "PRODUCTS / COMPLETED OPERATIONS", "DEDUCTIBLES"],
        ["OCCURRENCE", "GENERAL AGGREGATE", "PREMISES / OPERATIONS", "CLASSIFICATION", "EXPOSURE"]),
    "acord_126": (
        ["COMMERCIAL GENERAL LIABILITY SECTION", "SCHEDULE OF HAZARDS"],
        ["OCCURRENCE", "GENERAL AGGREGATE"]),
    "acord_131": (
        ["UMBRELLA", "EXCESS LIABILITY", "UNDERLYING INSURANCE", "FOLLOWING FORM"],
        ["RETROACTIVE DATE", "EACH OCCURRENCE", "AGGREGATE", "SELF-INSURED RETENTION"]),
    "acord_823": (
        ["ADDITIONAL PREMISES INFORMATION SCHEDULE", "ADDITIONAL PREMISES", "PREMISES SCHEDULE"],
        ["LOC #", "BLD #", "STREET", "OCCUPIED AREA"]),
}
# Integer weights keep sums exact: 10 and 3 stand for 1.0 and 0.3.
STRONG, WEAK = 10, 3
MIN_SCORE, MIN_MARGIN = 10, 10

EDITION_FALLBACK = {"acord_126_2014": "acord_126"}
TEMPLATE_PHRASE = r"\b[A-Z][A-Z0-9 \-/&]{6,}\b"

LOSS_SIGNALS = [
    r"(?i)\bloss\s+run",
    r"(?i)\bclaim\s*(summary|listing|history|details?|count)\b",
    r"(?i)\bclaim\s*(#|number|no\.?|id)\b",
    r"(?i)\b(date\s+of\s+loss|loss\s+date)\b",
    r"(?i)\b(total\s+)?(reserve|reserves|incurred|paid|recover(ed|y))\b",
    r"(?i)\bvaluation\s+date\b",
    r"(?i)\b(claimant|policy\s*term)\b",
    r"(?i)\bcause\s+of\s+loss\b",
    r"(?i)\beffective\s+date.*claim\s+count",
]
SCHEDULE_SIGNALS = [
    r"(?i)\bschedule\s+of\s+values\b",
    r"(?i)\bloc\.?\s*#",
    r"(?i)\bbuilding\s*#",
    r"(?i)\b(building|bpp|tiv|loss\s+of\s+rents)\b.*\b(building|bpp|tiv|loss)\b",
]
EMPTY_BELOW, LOSS_AT_LEAST, SCHEDULE_AT_LEAST, NARRATIVE_ABOVE = 30, 3, 2, 300
UNINFORMATIVE = ["EMPTY", "UNKNOWN"]

# File name -> document type, in order, over the lowercased name.
FILE_TYPES = [
    (r"\b(loss[\s_-]?run|lr[_\s-]|claims?[\s_-]history)|^lr_", "loss_run"),
    (r"\bacord[_\s-]*(125|126|127|130|131|137|140|163|823)\b|\b(acord.+app|app.+acord|application)\b", "acord_application"),
    (r"supp", "supplemental"),
    (r"questionnaire", "questionnaire"),
]
FILE_TYPE_DEFAULT = "other"
CONTENT_OVERRIDES = {"ACORD_FORM": "acord_application", "LOSS_RUN": "loss_run"}

# File name -> attachment type, in order, over the lowercased name.
ATTACHMENT_TYPES = [
    (r"\b(loss[\s_-]?run|claims?[\s_-]history|lr[\s_-])|^lr ", "LossRun"),
    (r"acord.*(125|126|131|140|823|app)|(125|126|131|140|823|app).*acord", "ACORD"),
    (r"sov|schedule of values|statement of values", "SOV"),
    (r"supp", "Supplemental"),
    (r"email|\.docx$", "Email"),
]
ATTACHMENT_DEFAULT = "Other"
MIME_TYPES = {
    ".pdf": "application/pdf",
    ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    ".xls": "application/vnd.ms-excel",
    ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
}
MIME_DEFAULT = "application/octet-stream"

# (document type, page number or NULL for all pages) -> prompt.
PROMPT_ROUTES = [("loss_run", None, "LOSS_RUN"), ("supplemental_application", None, "SUPPLEMENTAL"),
                 ("questionnaire", None, "QUESTIONNAIRE")]
PROMPT_DEFAULT = "GENERALIZED"

UNREADABLE_MARK = "(cid:"

# Document groups of the submission mapper: file name parts, any of which selects a file.
DISCOVERY = {
    "application": ["Acord", "ACORD"],
    "schedule": ["SOV", "Statement_of_Values", "Master", "Liability_Renewal_Exposures", "Renewal_Exposures",
                 "Schedule_of_Values"],
    "loss_run": ["Loss_Run", "LossRun", "_LR_", "_LR-", "Loss-Run", "LR_", "_GL_Loss"],
    "email": ["email", "EMAIL"],
    "note": ["_LLC", "_LP", "_Inc", "_Corp", "narrative", "note"],
}
