"""The submission schema fields that are reported on, as (section, field, tier)."""

HIGH, MEDIUM, UNKNOWN, INTERNAL = "HIGH", "MEDIUM", "UNKNOWN", "n/a"
TIERS = ["HIGH", "MEDIUM", "LOW", "UNKNOWN", "n/a"]
REACHABLE = ["HIGH", "MEDIUM", "LOW"]

_BY_SECTION = {
    "Submission": [("SubmissionNumber", INTERNAL), ("Status", INTERNAL), ("DateReceived", HIGH), ("QuoteNeededBy", MEDIUM),
                   ("GLSelected", HIGH), ("PropertySelected", HIGH), ("MasterCarrierRecordName", INTERNAL),
                   ("ProductType", INTERNAL), ("AssignedTo", INTERNAL), ("Notes", HIGH)],
    "PolicyInfo": [("RenewalFlag", MEDIUM), ("EffectiveDate", HIGH), ("ExpirationDate", HIGH), ("PriorPolicyNumber", UNKNOWN),
                   ("TargetQuoteDate", UNKNOWN), ("LOB", MEDIUM), ("TargetRates", UNKNOWN)],
    "Insured": [("Name", HIGH), ("DBANames", UNKNOWN), ("Website", HIGH), ("EntityType", HIGH), ("NAICSCode", UNKNOWN),
                ("SICCode", HIGH), ("DescriptionOfOperations", HIGH), ("Addresses", HIGH), ("Contacts", MEDIUM)],
    "OtherNamedInsureds": [("(none in this submission)", UNKNOWN)],
    "BrokerRef": [("BrokerId", INTERNAL), ("ProducerId", INTERNAL)],
    "Agent": [("Name", HIGH), ("NationalProducerNumber", UNKNOWN), ("FEIN", UNKNOWN), ("OtherName", UNKNOWN),
              ("Description", UNKNOWN), ("Website", UNKNOWN), ("Hierarchy", INTERNAL), ("Addresses", HIGH), ("Contacts", HIGH)],
    "GeneralLiability": [("CoverageSelected", HIGH), ("EmployeeBenefitsLiability", UNKNOWN)],
    "Property": [("CoverageSelected", HIGH), ("PerLocationTimeElementReporting", UNKNOWN), ("AggregateBusinessIncomeLimit", MEDIUM)],
    "Locations[]": [("LocationNumber", HIGH), ("LocationName", MEDIUM), ("Address", HIGH), ("GeneralLiability", MEDIUM)],
    "Buildings[]": [("BuildingNumber", HIGH), ("Description", MEDIUM), ("OccupancyClass", UNKNOWN), ("OccupancyType", HIGH),
                    ("YearOfConstruction", HIGH), ("ConstructionType", HIGH), ("RoofType", HIGH), ("TotalSqFt", HIGH),
                    ("NoOfStories", HIGH), ("TotalUnits", HIGH), ("BedCount", UNKNOWN), ("FullySprinklered", HIGH),
                    ("ProtectiveSafeguards", UNKNOWN), ("P9Description", UNKNOWN), ("Building.BuildingCoverageFlag", HIGH),
                    ("Building.BuildingLimit", HIGH), ("Building.Building100RcValue", HIGH), ("Building.Rate", INTERNAL),
                    ("Bpp.BppCoverageFlag", HIGH), ("Bpp.BppLimit", HIGH), ("Bpp.Rate", INTERNAL), ("BusinessIncomeLimit", HIGH)],
    "SecuredParties": [("(none in this submission)", UNKNOWN)],
    "LossRuns[]": [("Carrier", HIGH), ("PolicyNumber", HIGH), ("LOB", HIGH), ("EvaluationDate", HIGH),
                   ("PolicyEffectiveDate", UNKNOWN), ("PolicyExpirationDate", UNKNOWN), ("NoKnownLossesLast5Years", HIGH),
                   ("Claims[]", HIGH)],
    "Attachments[]": [("Type", HIGH), ("FileName", HIGH), ("MimeType", HIGH), ("Description", HIGH), ("AttachmentId", INTERNAL),
                      ("DestinationFolder", INTERNAL), ("Source", INTERNAL), ("UploadedDate", INTERNAL)],
}
SCHEMA_FIELDS = [(section, field, tier) for section, fields in _BY_SECTION.items() for field, tier in fields]
# Sections whose items sit inside the items of another section.
NESTED_IN = {"Buildings[]": "Locations"}
