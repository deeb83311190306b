"""Fixed values of the canonical mapping: field names by priority, patterns and labels."""

# target -> (exact names in order, then keyword groups in order; a group needs all its keywords in the field name).
PICKS = {
    "box_name": (["NamedInsured_FullName_A[0]", "NamedInsured_FullName_B[0]"], []),
    "model_name": (["vlm_APPLICANT_INFORMATION_0_full_name", "vlm_NamedInsured_FullName_A"],
                   [("vlm_", "applicant", "full_name"), ("vlm_", "applicant", "name"), ("vlm_", "namedinsured", "full"),
                    ("vlm_", "named_insured", "name"), ("vlm_", "insured", "name")]),
    "naics": (["NamedInsured_NAICSCode_A[0]"], []),
    "sic": (["NamedInsured_SICCode_A[0]"], []),
    "fein": (["NamedInsured_FEINOrSocSecNumberIdentifier_A[0]"], []),
    "phone": (["NamedInsured_BusinessPhoneNumber_A[0]", "NamedInsured_Primary_PhoneNumber_A[0]",
               "NamedInsured_BusinessNumberContactPoint_A[0]", "vlm_APPLICANT_INFORMATION_0_business_phone"], []),
    "website": (["NamedInsured_WebsiteAddressUrl_A[0]", "NamedInsured_Primary_WebsiteAddress_A[0]", "vlm_APPLICANT_INFORMATION_0_website_address"], []),
    "street": (["vlm_APPLICANT_INFORMATION_0_address_line1", "vlm_applicant_address_line1", "vlm_APPLICANT_INFORMATION_0_street",
                "NamedInsured_AddressLine_StreetName_A[0]"], []),
    "city": (["NamedInsured_AddressLine_CityName_A[0]", "vlm_APPLICANT_INFORMATION_0_city"], []),
    "state": (["NamedInsured_AddressLine_StateOrProvinceCode_A[0]", "vlm_APPLICANT_INFORMATION_0_state"], []),
    "zip": (["NamedInsured_AddressLine_PostalCode_A[0]", "vlm_APPLICANT_INFORMATION_0_zip"], []),
    "combined_address": (["vlm_applicant_address", "vlm_APPLICANT_INFORMATION_0_full_address", "vlm_APPLICANT_INFORMATION_0_address"],
                         [("vlm_", "applicant", "mailing_address"), ("vlm_", "applicant", "address"),
                          ("vlm_", "namedinsured", "address"), ("vlm_", "named_insured", "address"), ("vlm_", "insured", "address")]),
    "city_line": (["NamedInsured_MailingAddress_LineOne_A[0]", "NamedInsured_MailingAddress_LineTwo_A[0]",
                   "vlm_APPLICANT_INFORMATION_0_city_state_zip"], []),
    "line_one": (["NamedInsured_MailingAddress_LineOne_A[0]"], []),
    "box_agent": (["Producer_FullName_A[0]"], []),
    "model_agent": (["vlm_HEADER_agency_name", "vlm_AGENCY"],
                    [("vlm_", "header", "agency"), ("vlm_agency",), ("vlm_", "agency_name"), ("vlm_", "agent", "name"),
                     ("vlm_", "producer_name"), ("vlm_", "broker_name")]),
    "npn": (["Insurer_ProducerIdentifier_A[0]", "Producer_NationalProducerNumber_A[0]"], []),
    "agent_street": (["vlm_HEADER_agency_address", "Producer_MailingAddress_LineOne_A[0]"], []),
    "agent_street2": (["Producer_MailingAddress_LineTwo_A[0]"], []),
    "agent_city": (["Producer_MailingAddress_CityName_A[0]"], []),
    "agent_state": (["Producer_MailingAddress_StateOrProvinceCode_A[0]"], []),
    "agent_zip": (["Producer_MailingAddress_PostalCode_A[0]"], []),
    "agent_city_line": (["vlm_HEADER_agency_city_state_zip"], []),
    "contact_name": (["Producer_ContactPerson_FullName_A[0]", "vlm_HEADER_contact_name"], []),
    "contact_phone": (["Producer_ContactPerson_PhoneNumber_A[0]", "vlm_HEADER_contact_phone"], []),
    "contact_email": (["Producer_ContactPerson_EmailAddress_A[0]", "vlm_HEADER_contact_email"], []),
    "effective": (["Policy_EffectiveDate_A[0]"],
                  [("vlm_", "proposed_eff"), ("vlm_", "effective_date"), ("vlm_", "policy_information", "proposed_eff"),
                   ("vlm_", "policy", "effective")]),
    "expiration": (["Policy_ExpirationDate_A[0]"],
                   [("vlm_", "proposed_exp"), ("vlm_", "expiration_date"), ("vlm_", "policy_information", "proposed_exp"),
                    ("vlm_", "policy", "expiration")]),
    "prior_policy": (["Policy_PolicyNumberIdentifier_A[0]"], [("vlm_", "policy_number"), ("vlm_", "policy_no")]),
}

ENTITY_INDICATORS = [
    ("NamedInsured_LegalEntity_IndividualIndicator_A", "Individual"),
    ("NamedInsured_LegalEntity_CorporationIndicator_A", "Corporation"),
    ("NamedInsured_LegalEntity_LimitedLiabilityCorporationIndicator_A", "Limited Liability Company"),
    ("NamedInsured_LegalEntity_PartnershipIndicator_A", "Partnership"),
    ("NamedInsured_LegalEntity_JointVentureIndicator_A", "Joint Venture"),
]
# Name endings, over the uppercased name without periods and commas.
ENTITY_SUFFIXES = [
    (r"\b(LLC|LIMITED LIABILITY (?:COMPANY|CORPORATION))\b", "Limited Liability Company"),
    (r"\b(LP|LIMITED PARTNERSHIP|L\.P)\b", "Partnership"),
    (r"\b(LLP|LIMITED LIABILITY PARTNERSHIP)\b", "Partnership"),
    (r"\b(LIMITED PARTNERS?HIP)\b", "Partnership"),
    (r"\b(GENERAL PARTNERSHIP|GP)\b", "Partnership"),
    (r"\bPARTNERSHIP\b", "Partnership"),
    (r"\b(INC|INCORPORATED|CORP|CORPORATION|CO)\b", "Corporation"),
    (r"\bTRUST\b", "Other"),
    (r"\bJOINT VENTURE\b", "Joint Venture"),
]
ENTITY_DEFAULT = "Other"

NAME_BEFORE_ADDRESS = (r"(?i)^(.*?)\s+\d+\s+[NSEW]?\s*\w+\s+(?:Ave|Avenue|Street|St|Rd|Road|Blvd|Boulevard|Drive|Dr|Lane|Ln|Way|Circle|Cir|Court|Ct|"
                       r"Place|Pl|Highway|Hwy|Parkway|Pkwy|Suite|Ste)")
STREET_IN_NAME = (r"(?i)\b(\d+\s+[NSEW]?\s*[A-Z][a-zA-Z .'-]+\s+(?:Ave|Avenue|Street|St|Rd|Road|Blvd|Boulevard|Drive|Dr|Lane|Ln|Way|Circle|Cir|"
                  r"Court|Ct|Place|Pl|Highway|Hwy|Parkway|Pkwy)(?:\s+(?:Suite|Ste)\s+\d+)?)")
CITY_LINE = r"^([A-Za-z\s.]+),\s*([A-Z]{2})\s+(\d{5}(?:-\d{4})?)"
SUITE_WORDS = ["suite", "ste", "unit", "apt"]

LOB_MARK, LOB_COVERAGE, LOB_SUFFIX = "LineOfBusinessIndicator", "Coverage", "_A"
LOBS = [("GeneralLiability", "General Liability"), ("Property", "Property")]

PARTY_PREFIX = "AdditionalInterest_"
PARTY_SUFFIXES = ["_A", "_B", "_C", "_A[0]", "_B[0]", "_C[0]"]
PARTY_NAME = (r"(?i)^(.+?(?:LLC|Inc\.?|Corporation|Corp\.?|Group|Trust|Bank|Mortgage[a-z]*|Holdings|Co\.?|Company))\s+\d+\s")
INTERESTS = [
    ("MortgageeIndicator", "Mortgagee"), ("LossPayeeIndicator", "Loss Payee"),
    ("LendersLossPayableIndicator", "Lenders Loss Payable"), ("LienholderIndicator", "Lienholder"),
    ("AdditionalInsuredIndicator", "Additional Insured"), ("OwnerIndicator", "Owner"), ("CoOwnerIndicator", "Co-Owner"),
    ("BreachOfWarrantyIndicator", "Breach of Warranty"), ("EmployeeAsLessorIndicator", "Employee as Lessor"),
    ("LeasebackOwnerIndicator", "Leaseback Owner"), ("RegistrantIndicator", "Registrant"), ("TrusteeIndicator", "Trustee"),
    ("OtherIndicator", "Other"), ("BailmentIndicator", "Bailment"),
]

OTHER_INSURED_SUFFIXES = ["_B[0]", "_C[0]", "_D[0]"]
OTHER_INSURED_PLACEHOLDERS = ["SECONDARY", "TERTIARY"]

HAZARD_SUFFIXES = ["_A", "_B", "_C", "_A[0]", "_B[0]"]
HAZARD_EXPOSURE = r"^([\d,]+)\s*([A-Z]?)$"
HAZARD_CODE = r"\b(\d{5})\b"
HAZARD_DESCRIPTION = r"(?i)^([A-Z][A-Z\s/&-]+?)(?:\s+\d|\s*$)"

SAFEGUARD_FIELDS = ["Alarm", "FireProtection", "Protective"]
SAFEGUARDS = [
    ("CentralStation", "Central Station Alarm"), ("LocalGong", "Local Gong"), ("WithKeys", "With Keys"),
    ("ClockHourly", "Clock Hourly"), ("GuardWatchman", "Guard / Watchman"), ("FireExtinguisher", "Fire Extinguisher"),
    ("Sprinkler", "Sprinkler"), ("SmokeDetector", "Smoke Detector"), ("Hydrant", "Hydrant Nearby"),
]
OPERATIONS_LIMIT = 2000
SUBMISSION_STATUS, PRODUCT_TYPE, RENEWAL_FLAG = "Cleared", "HabGen", "New"
