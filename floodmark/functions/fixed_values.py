"""Codes, spellings and rates that results depend on.

Everything in this module is data.  Values are written out in their natural
order so they can be checked against the published tables they come from.
"""

# Occupancy classes.
OCCUPANCIES = [
    "RES1", "RES2", "RES3A", "RES3B", "RES3C", "RES3D", "RES3E", "RES3F", "RES4", "RES5", "RES6",
    "COM1", "COM2", "COM3", "COM4", "COM5", "COM6", "COM7", "COM8", "COM9", "COM10",
    "IND1", "IND2", "IND3", "IND4", "IND5", "IND6",
    "AGR1", "REL1", "GOV1", "GOV2", "EDU1", "EDU2",
]
RESIDENTIAL = [o for o in OCCUPANCIES if o.startswith("RES")]

# Foundation spelling (trimmed, upper case) -> foundation code.
FOUNDATION_CODES = {
    "S": 7, "SLAB": 7, "SLAB ON GRADE": 7, "7": 7,
    "C": 5, "CRAWL": 5, "CRAWLSPACE": 5, "CRAWL SPACE": 5, "5": 5, "F": 5, "I": 5, "W": 5,
    "B": 4, "BASEMENT": 4, "4": 4,
    "P": 2, "PIER": 2, "PILE": 2, "PILES": 2, "PIER/PILE": 2, "2": 2,
}
FOUNDATION_DEFAULT = 7
FOUNDATION_BASEMENT = 4
FOUNDATION_SLAB = 7

# Content value as a multiple of structure cost, by occupancy.
CONTENT_HALF = [
    "RES1", "RES2", "RES3A", "RES3B", "RES3C", "RES3D", "RES3E", "RES3F", "RES4", "RES5", "RES6", "COM10",
]
CONTENT_EQUAL = [
    "COM1", "COM2", "COM3", "COM4", "COM5", "COM8", "COM9", "IND6", "AGR1", "REL1", "GOV1", "EDU1",
]
CONTENT_ONE_AND_HALF = ["COM6", "COM7", "IND1", "IND2", "IND3", "IND4", "IND5", "GOV2", "EDU2"]

# Occupancies that hold business inventory.
INVENTORY_OCCUPANCIES = ["COM1", "COM2", "IND1", "IND2", "IND3", "IND4", "IND5", "IND6", "AGR1"]

# Damage curves are tabulated at whole feet from -4 to 24.
CURVE_MIN_FT = -4
CURVE_MAX_FT = 24

# Flood class spelling (lower case) -> class code.
FLOOD_CLASS_CODES = {
    "": "",
    "riverine": "HazardRiverine", "hazardriverine": "HazardRiverine",
    "coastala": "CAE", "cae": "CAE",
    "coastalv": "V", "v": "V", "ve": "V",
}
# Flood class spelling used by run parameters.
FLOOD_CLASS_NAMES = {"coastala": "CoastalA", "coastalv": "CoastalV", "riverine": "Riverine"}

# Surge category code -> feet.
SURGE_FEET = {1: 1.0, 2: 1.0, 3: 3.0, 4: 6.0, 5: 9.0}
SURGE_NODATA = -9999.0

# Depth written for rows that are not computed.
INCOMPLETE_DEPTH = -99999.0

# Surge heights counted one by one in the geography table.
SURGE_HEIGHTS = [0, 1, 3, 6, 9]

# The fifteen logical engine fields, in order.
ENGINE_FIELDS = [
    "UserDefinedFltyId", "OCC", "Cost", "Area", "NumStories", "FoundationType", "FirstFloorHt",
    "ContentCost", "BDDF_ID", "CDDF_ID", "IDDF_ID", "InvCost", "SOID", "Latitude", "Longitude",
]
REQUIRED_ENGINE_FIELDS = [
    "UserDefinedFltyId", "OCC", "Cost", "Area", "NumStories", "FoundationType", "FirstFloorHt",
    "Latitude", "Longitude",
]
# Columns of the engine input export, in order.
ENGINE_INPUT_COLUMNS = [
    "FltyId", "Occ", "Cost", "Area", "NumStories", "FoundationType", "FirstFloorHt", "ContentCost",
    "Latitude", "Longitude",
]
# Columns added by the damage assessment, in order.
PREDICTION_COLUMNS = [
    "Depth_Grid", "Depth_in_Struc", "flExp", "SOID", "BDDF_ID", "BldgDmgPct", "BldgLossUSD",
    "ContentCostUSD", "CDDF_ID", "ContDmgPct", "ContentLossUSD",
    "InventoryCostUSD", "IDDF_ID", "InvDmgPct", "InventoryLossUSD",
    "DebrisID", "Debris_Fin", "Debris_Struc", "Debris_Found", "Debris_Tot",
    "Restor_Days_Min", "Restor_Days_Max", "GridName",
]

# Vulnerability columns joined to a geography.
SVI_COLUMNS = [
    "ST_ABBR", "COUNTY", "FIPS", "E_TOTPOP",
    "EP_POV150", "EP_HBURD", "EP_DISABL", "EP_MUNIT", "EP_MOBILE", "EP_CROWD", "EP_NOVEH", "EP_UNEMP",
    "EP_NOHSDP", "EP_UNINSUR", "EP_AGE65", "EP_AGE17", "EP_SNGPNT", "EP_LIMENG", "EP_MINRTY", "EP_GROUPQ",
]
# Order of the vulnerability columns in the published table.
SVI_OUTPUT_COLUMNS = [
    "E_TOTPOP", "EP_POV150", "EP_UNEMP", "EP_HBURD", "EP_NOHSDP", "EP_UNINSUR", "EP_AGE65", "EP_AGE17",
    "EP_DISABL", "EP_SNGPNT", "EP_LIMENG", "EP_MINRTY", "EP_MUNIT", "EP_MOBILE", "EP_CROWD", "EP_NOVEH",
    "EP_GROUPQ",
]

# Planning rates.
PERSONS_PER_HOUSEHOLD = 2.53
ZONES = ["LOW", "MEDIUM", "HIGH"]
SHELTER_RATE = {"LOW": 0.01, "MEDIUM": 0.03, "HIGH": 0.05}
FEEDING_RATE = {"LOW": 0.03, "MEDIUM": 0.07, "HIGH": 0.12}
IMPACT_RATE = {"LOW": 0.10, "MEDIUM": 0.30, "HIGH": 0.60}
FLAT_SHELTER_RATE = 0.0073

# Damage states, lower bound included (percent).
DAMAGE_STATES = [("Slight", 0.0, 15.0), ("Moderate", 15.0, 40.0), ("Extensive", 40.0, 60.0), ("Complete", 60.0, 100.0)]

# Severity of a geography, as fractions of buildings.
SEVERITY_DESTROYED = {"HIGH": 0.35, "MEDIUM": 0.11}
SEVERITY_MAJOR = {"HIGH": 0.35, "MEDIUM": 0.16}

# Surge threshold sets (low ft, medium ft, high ft).
THRESHOLD_VARIANTS = {
    "default": (4.0, 9.0, 12.0),
    "tight": (3.0, 8.0, 11.0),
    "loose": (5.0, 10.0, 13.0),
    "very_low": (2.0, 6.0, 10.0),
}
DAMAGE_THRESHOLDS = (0.0, 15.0, 35.0)
DAMAGE_VARIANTS = {
    "default": (4.0, 9.0, 12.0, 0.0, 15.0, 35.0),
    "minus_5_pct": (4.0, 9.0, 12.0, 0.0, 10.0, 30.0),
    "plus_5_pct": (4.0, 9.0, 12.0, 5.0, 20.0, 40.0),
}

# States (name, postal abbreviation, two-digit code).
STATES = [
    ("Alabama", "AL", "01"), ("Alaska", "AK", "02"), ("Arizona", "AZ", "04"), ("Arkansas", "AR", "05"),
    ("California", "CA", "06"), ("Colorado", "CO", "08"), ("Connecticut", "CT", "09"), ("Delaware", "DE", "10"),
    ("District Of Columbia", "DC", "11"), ("Florida", "FL", "12"), ("Georgia", "GA", "13"), ("Hawaii", "HI", "15"),
    ("Idaho", "ID", "16"), ("Illinois", "IL", "17"), ("Indiana", "IN", "18"), ("Iowa", "IA", "19"),
    ("Kansas", "KS", "20"), ("Kentucky", "KY", "21"), ("Louisiana", "LA", "22"), ("Maine", "ME", "23"),
    ("Maryland", "MD", "24"), ("Massachusetts", "MA", "25"), ("Michigan", "MI", "26"), ("Minnesota", "MN", "27"),
    ("Mississippi", "MS", "28"), ("Missouri", "MO", "29"), ("Montana", "MT", "30"), ("Nebraska", "NE", "31"),
    ("Nevada", "NV", "32"), ("New Hampshire", "NH", "33"), ("New Jersey", "NJ", "34"), ("New Mexico", "NM", "35"),
    ("New York", "NY", "36"), ("North Carolina", "NC", "37"), ("North Dakota", "ND", "38"), ("Ohio", "OH", "39"),
    ("Oklahoma", "OK", "40"), ("Oregon", "OR", "41"), ("Pennsylvania", "PA", "42"), ("Rhode Island", "RI", "44"),
    ("South Carolina", "SC", "45"), ("South Dakota", "SD", "46"), ("Tennessee", "TN", "47"), ("Texas", "TX", "48"),
    ("Utah", "UT", "49"), ("Vermont", "VT", "50"), ("Virginia", "VA", "51"), ("Washington", "WA", "53"),
    ("West Virginia", "WV", "54"), ("Wisconsin", "WI", "55"), ("Wyoming", "WY", "56"),
]
