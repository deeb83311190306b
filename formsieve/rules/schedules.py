"""Fixed values of property schedules and loss runs: header words, column aliases and record keys."""

SHEET_ROW_CELLS, DATA_ROW_CELLS = 5, 3
HEADER_PAIRS = [
    ("loc", "building #"), ("loc", "building#"), ("location", "address"), ("location #", "street"), ("location#", "street"),
    ("premises", "address"), ("entity", "address"), ("occupancy", "address"), ("street address", "city"),
]
COLUMNS = {
    "loc": ["Loc.#", "Loc #", "Location #", "Location#", "Location Number", "Location ID", "Loc ID"],
    "bldg": ["Building #", "Building#", "Bldg #", "Bldg#"],
    "occupancy": ["Occupancy", "Occupancy Type", "Occupancy Class"],
    "named": ["Location Named Insured", "Entity", "Location Name", "Property Name"],
    "street": ["Street Address", "Address", "Premise Address", "Property Address", "Property Street", "Site Address"],
    "city": ["City"],
    "state": ["State"],
    "zip": ["Zip", "Zip Code", "ZIP", "Postal Code"],
    "county": ["County"],
    "year": ["Year Built", "Year of Construction", "Construction Year"],
    "construction": ["Construction Type", "Construction"],
    "roof": ["Type of Roof", "Roof Type"],
    "sqft": ["# Sq. Ft. Bldg", "Sq Ft", "Square Feet", "Total Sq Ft", "Total Square Feet"],
    "stories": ["# of stories", "# Stories", "Stories", "No of Stories", "Number of Stories"],
    "units": ["# Hab Units", "# Units", "Units", "Total Units", "Number of Units", "Unit Count"],
    "sprinkler": ["Sprinklered %", "Sprinkler %", "Sprinklered", "Sprinkler", "Fully Sprinklered"],
    "rcv": ["Building RCV", "Building", "Bldg RCV", "Bldg", "Building Value", "Building Value (RC)", "Building Limit",
            " Building Value (R", "Building (RC)"],
    "bpp": ["BPP", "Contents", "Business Personal Property", "Business Personal", "Personal Property"],
    "bi": ["Loss of Rents", "Business Income", "BI", "Loss of Rents/BI", " Business \nIncome ", "Business Income/Loss of Rents"],
}
FULL_SPRINKLER = 100

CLAIM_HEADERS = ["claim #", "claim no", "claim number"]
TERM_RANGE = r"^(\d{1,2}/\d{1,2}/\d{2,4})\s*[-–to]+\s*(\d{1,2}/\d{1,2}/\d{2,4})"
LOSS_RUN_LOB = "General Liability"
CARRIER_KEYS = ["company", "carrier", "company/carrier"]
# Output column -> record keys in order: of parsed table rows, of model rows.
PARSED_CLAIM = {
    "claim_no": ["claim_no", "claim_number"], "status": ["status"], "loss_date": ["loss_date", "date_of_loss"],
    "description": ["cause_of_loss", "description"], "paid": ["total_paid", "paid"],
    "reserve": ["total_reserves", "reserves"], "incurred": ["total_incurred", "incurred"],
}
MODEL_CLAIM = {
    "claim_no": ["claim_number"], "status": ["status"], "loss_date": ["date_of_loss"],
    "description": ["type_cause", "description"], "paid": ["amount_paid"], "reserve": ["amount_reserved"],
    "incurred": ["net_incurred"],
}
MODEL_CLAIM_LISTS = ["claims", "detail"]
