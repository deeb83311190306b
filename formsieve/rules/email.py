"""Fixed values of e-mail parsing."""

TARGET = r"TARGET[:\s]*\$([\d,]+)([KMkm]?)"
URGENT = ["asap", "rush"]
URGENT_LABEL = "ASAP"
DEADLINE = r"(?:need\s+by|deadline|due|by)[:\s]+(\d{1,2}/\d{1,2}(?:/\d{2,4})?)"

# What an opened phrase ends a paragraph with, and a paragraph that may stand inside one.
OPEN_PHRASE = r"(?:deadline|due|by)[:\s]*$"
INSIDE_PHRASE = r"^[:\s]*$"

OPENER = r"(?i)^(thank you|thanks|--|best regards|sincerely|kind regards|cheers|warm regards)[,.!]?\s*$"
CLOSER = (r"(?i)^(from:|sent:|to:|subject:|cc:|bcc:|date:|on\s+\w+,\s+\w+|this e-mail|this email|please send|to unsubscribe|"
          r"please consider|disclaimer|confidentiality|wrote:)")

PHONE = (r"(?i)(?:T|D|Direct|Cell|Mobile|Office|Phone|Tel)?\s*[:.]?\s*(\+?\d?\s*\(?\d{3}\)?[\s.-]?\d{3}[\s.-]?\d{4})")
EMAIL = r"\b([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})\b"
LICENSE = r"(?i)(?:CA\s+)?License\s*#?\s*([A-Z0-9]+)"
TITLE = (r"(?i)\b(Founder|CEO|CFO|President|Director|Manager|Broker|Underwriter|Producer|Specialist|Agent|Marketing|VP|"
         r"Vice\s+President|Sr\.?\s*|Senior\s+|Owner|Partner)")
NAME_LINE = r"^([A-Z][a-z]+\s+[A-Z][a-zA-Z'-]+)(\s*[|,-]\s*(.+))?$"
COMPANY = r"\b(LLC|Inc\.?|Insurance|Brokerage|Group|Agency|Holdings|Corporation|Co\.?|Company)\b"
ADDRESS_ZIP = r"\b[A-Z]{2}\s+\d{5}"
ADDRESS_STREET = r"\d+\s+[A-Z][a-z]+\s+(Rd|Road|St|Street|Ave|Avenue|Blvd|Boulevard|Way|Suite|Ste)"
SHORT_LINE = 80
# Words that place a contact on the agent's side.
AGENT_SIDE = r"(?i)\b(insurance|brokerage|underwriter|broker|wholesale|mga|agency|specialty|amwins|crc|crest)\b"
CONTACT_TYPE = "Producer"
