"""Labels, bands and lists that the reports' results depend on."""

from __future__ import annotations

# Offline revenue band -> midpoint.
REVENUE_BAND_MIDPOINT = {
    "Up to $5,000": 2500,
    "$0 to $50,000": 25000,
    "$5,000 to $50,000": 27500,
    "$0 to $250,000": 125000,
    "$50,000 to $250,000": 150000,
    "$50,000 to $500,000": 275000,
    "$250,000 to $500,000": 375000,
    "$250,000 to $1,000,000": 625000,
    "$500,000 to $1,000,000": 750000,
    "$1,000,000+": 5000000,
    "$1,000,000 to $10,000,000": 5500000,
    "$10,000,000+": 15000000,
}
ENRICHED_REVENUE_CAP = 200000000

# Bands that make a lead count as marketing qualified in the retail funnel.
QUALIFYING_BANDS = [
    "$250K - $400k",
    "$250,000 to $500,000",
    "$250,000 to $1,000,000",
    "$400k - $500k",
    "$500,000 to $1,000,000",
    "$500k - $1M",
    "$1,000,000+",
    "$1,000,000 to $10,000,000",
    "$10,000,000+",
]
LOW_BAND_COUNTRIES = ["ES", "IT"]
LOW_BANDS = ["$50,000 to $250,000", "revenue_between_50000_250000"]

# Lead source (lower case) lists per bucket. The funnel and the
# conversion report use two different inbound lists.
OUTBOUND_SOURCES = [
    "outbound", "plus cross sell", "internal referral", "repeat customer", "zendesk",
    "intal", "marketing crm", "outblund", "n/a", "no pe",
]
PARTNER_SOURCES = ["partner directory inquiry", "partner referral", "partner pos referral", "partner"]
INBOUND_SOURCES_CONVERSION = [
    "3field", "3rd party lead gen", "contact us", "content", "content syndication", "demo", "direct mail",
    "drift", "event", "facebook lead ads", "guru pos referral", "guru referral - vault", "marketing campaign",
    "other", "paid", "spaces", "inbound call", "advertisement", "customer event", "inbound sales inquiry", "website",
]
INBOUND_SOURCES_FUNNEL = INBOUND_SOURCES_CONVERSION + [
    "event - booth scan", "event - sales meeting", "email management", "lead list", "webinar",
]

# Location bands of a lead.
LOCATION_BANDS = {
    "1": "01. 1",
    "2-5": "02. 2-5",
    "6-10": "03. 6-10",
    "More than 10": "04. 10+",
    "Opening location soon": "05. Opening soon",
    "No locations yet": "06. Unknown",
    "": "06. Unknown",
}

# Activity type (lower case) -> class.
ACTIVITY_CLASSES = {
    "email": "Email",
    "reply": "Email",
    "linkedin - connection request": "LinkedIn",
    "linkedin - inmail": "LinkedIn",
    "linkedin - research": "LinkedIn",
    "call": "Call",
    "message": "Call",
    "meeting": "Meeting",
    "in-person meeting": "Meeting",
}

# Sales team -> scorecard team group, for teams named exactly.
TEAM_GROUPS = {
    "Sales MM LA": "D2C MM Acquisition",
    "Sales Mid Market": "D2C MM Acquisition",
    "Sales Large": "D2C LA Acquisition",
    "Sales SMB": "D2C SMB Acquisition",
    "Sales Cross-Sell - MM": "D2C MM Acceleration",
    "Sales Cross-Sell - MM LA": "D2C MM Acceleration",
    "Sales Cross-Sell - SMB": "D2C SMB Acceleration",
    "Sales Cross-Sell - Large": "D2C LA Acceleration",
    "Sales Retail MM LA": "Retail MM Acquisition",
    "Sales Retail Mid Market": "Retail MM Acquisition",
    "Sales Retail Large": "Retail LA Acquisition",
    "Sales Retail SMB": "Retail SMB Acquisition",
    "Sales Retail Cross-Sell - MM": "Retail MM Acceleration",
    "Sales Retail Cross-Sell - MM LA": "Retail MM Acceleration",
    "Sales Retail Cross-Sell - SMB": "Retail SMB Acceleration",
    "Sales Retail Cross-Sell - Large": "Retail LA Acceleration",
}
ENTERPRISE_TEAM = "Sales Enterprise"
EMERGING_ROLE_PATTERNS = ["%DI%", "%EN-ALL-MFG%", "%EN-ALL-FAB%"]

# Segments of the quarterly review.
REVIEW_SEGMENTS = ["Enterprise", "Large Accounts", "Mid Market", "Cross-Sell", "SMB", "Retail"]

# Region labels that mean "unknown".
UNKNOWN_REGIONS = ["No Associated geographic_region_code", "Unknown geographic_region_code", "UNKNOWN"]

# Original lead sources.
PARTNER_LEAD_SOURCES = ["Partner POS Referral", "Partner Referral"]
NON_MARKETING_LEAD_SOURCES = PARTNER_LEAD_SOURCES + [
    "ZoomInfo", "LinkedIn Sales Navigator", "Outbound", "Business Development Rep", "Lead List",
]

# Quota attributes.
QUOTA_PROFIT = "INCREMENTAL PRODUCT PROFIT : PERIODIC : QUOTA"
QUOTA_REVENUE = "TOTAL REVENUE : PERIODIC : QUOTA"
QUOTA_ACTIVATIONS = "SOLUTION ACTIVATIONS : PERIODIC : QUOTA"

# Disciplines left out of the scorecard.
EXCLUDED_SUBDISCIPLINES = ["Account Management", "Incubation Sales", "Revenue Operations", "Program Management"]
EXCLUDED_DISCIPLINES = ["Legal", "Talent Density", "Engineering", "No discipline provided", "Support"]
