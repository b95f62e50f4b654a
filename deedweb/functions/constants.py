"""Domain values of the US property records that the cleaners know. Other lists are arguments."""

# These lists, their spelling and their order decide results.

DIRECTIONS = {
    "NORTH": "N",
    "SOUTH": "S",
    "EAST": "E",
    "WEST": "W",
    "NORTHEAST": "NE",
    "SOUTHEAST": "SE",
    "NORTHWEST": "NW",
    "SOUTHWEST": "SW",
}

DIRECTIONAL_MAP = DIRECTIONS | {
    "NORTH EAST": "NE",
    "NORTH WEST": "NW",
    "SOUTH EAST": "SE",
    "SOUTH WEST": "SW",
}

STREET_SUFFIXES = {
    "STREET": "ST",
    "STREE": "ST",
    "AVENUE": "AVE",
    "AVENU": "AVE",
    "AV": "AVE",
    "LANE": "LN",
    "DRIVE": "DR",
    "BOULEVARD": "BLVD",
    "BULEVARD": "BLVD",
    "BOULEVAR": "BLVD",
    "ROAD": "RD",
    "COURT": "CT",
    "PLACE": "PL",
    "WAY": "WAY",
}

SECONDARY_KEYWORDS = ["#", "UNIT", "FLOOR", "FL", "SUITE", "STE", "APT", "ROOM"]

CORE_NAME_KEYS = [
    "CIR", "APARTMENTS", "SERVICES", "INVESTMENTS", "HOLDINGS",
    "LN", "COMPANY", "AUTHORITY", "INC", "FORECLOSURE",
    "ESTABLISHED", "CONDO TRUST", "COOPERATIVE", "PARTNERS", "CR",
    "PARTNERSHIP", "GROUP", "ASSOCIATION", "TRUSTEES", "TRUST",
    "PROPERTIES", "MANAGEMENT", "SQUARE", "MANAGERS", "EXCHANGE",
    "REAL ESTATE", "DEVELOPMENT", "REDEVELOPMENT", "MORTGAGE",
    "RESIDENTIAL", "REALTY TRUST", "CORPORATION", "LIMITED", "LLC",
    "ORGANIZATION", "REALTY", "PRT", "VENTURE", "RENTAL", "UNION",
    "CONDO",
]

TRUSTS = [
    "ATRUS", "TRUSTLAN", "TRUSTEE", "TRUSTE", "TRUSTTRU", "TRUSTU", "TRUSTAS", "TRUST", "TRUS", "TRU", "TRST", "TR",
    "TTEE", "TT",
]
TRUSTS_STRINGS = ["TRUSTEE", "TRUSTE", "TRUSTTRU", "TRUSTU", "TRUSTAS", "TRUST"]

PO_BOXES = ["POSTOFFICEBOX", "POSTBOX", "POBBOX", "POBOC", "POBOX", "PBOX", "POST", "POBX", "BOX", "POB", "PO"]
PO_BOXES_DEPT = ["TAXDEPT", "TAXDEP", "TXDEPT", "DEPT"]
PO_BOXES_REMOVE = [
    "LOUISAVE", "SSWANTST", "CHICAGO", "6890S2300E", "REDEPT", "RAVSTN", "RAVNIASTA", "RAVINIASTA", "RAVINIAST",
    "RAVINIA", "REVINIAST",
]

STATES = {
    "ALABAMA": "AL", "ALASKA": "AK", "ARIZONA": "AZ", "ARKANSAS": "AR", "CALIFORNIA": "CA", "COLORADO": "CO",
    "CONNECTICUT": "CT", "DELAWARE": "DE", "FLORIDA": "FL", "GEORGIA": "GA", "HAWAII": "HI", "IDAHO": "ID",
    "ILLINOIS": "IL", "INDIANA": "IN", "IOWA": "IA", "KANSAS": "KS", "KENTUCKY": "KY", "LOUISIANA": "LA",
    "MAINE": "ME", "MARYLAND": "MD", "MASSACHUSETTS": "MA", "MICHIGAN": "MI", "MINNESOTA": "MN", "MISSISSIPPI": "MS",
    "MISSOURI": "MO", "MONTANA": "MT", "NEBRASKA": "NE", "NEVADA": "NV", "NEW HAMPSHIRE": "NH", "NEW JERSEY": "NJ",
    "NEW MEXICO": "NM", "NEW YORK": "NY", "NORTH CAROLINA": "NC", "NORTH DAKOTA": "ND", "OHIO": "OH", "OKLAHOMA": "OK",
    "OREGON": "OR", "PENNSYLVANIA": "PA", "RHODE ISLAND": "RI", "SOUTH CAROLINA": "SC", "SOUTH DAKOTA": "SD",
    "TENNESSEE": "TN", "TEXAS": "TX", "UTAH": "UT", "VERMONT": "VT", "VIRGINIA": "VA", "WASHINGTON": "WA",
    "WEST VIRGINIA": "WV", "WISCONSIN": "WI", "WYOMING": "WY", "PUERTO RICO": "PR", "WASHINGTON DC": "DC", "GUAM": "GU",
}

#: Entities that stand for many owners and make no edge of the network.
IGNORED_ENTITIES = ["CHICAGO TITLE LAND TRUST COMPANY", "CHICAGO TITLE LAND"]

PUNCTUATION = "!\"#$%&'()*+,.:;<=>?@[\\]^_`{|}~"

#: Strings that stand for a missing value in delivered files.
NA_TOKENS = ["", "NA", "N/A", "n/a", "#N/A", "NULL", "null", "NaN", "nan", "None", "<NA>", "#NA", "-NaN", "-nan"]

UNITS = "ZERO ONE TWO THREE FOUR FIVE SIX SEVEN EIGHT NINE TEN ELEVEN TWELVE THIRTEEN FOURTEEN FIFTEEN SIXTEEN SEVENTEEN EIGHTEEN NINETEEN".split()
TENS = "TWENTY THIRTY FORTY FIFTY SIXTY SEVENTY EIGHTY NINETY".split()
ORDINAL_UNITS = "ZEROTH FIRST SECOND THIRD FOURTH FIFTH SIXTH SEVENTH EIGHTH NINTH TENTH ELEVENTH TWELFTH THIRTEENTH FOURTEENTH FIFTEENTH SIXTEENTH SEVENTEENTH EIGHTEENTH NINETEENTH".split()
ORDINAL_TENS = "TWENTIETH THIRTIETH FORTIETH FIFTIETH SIXTIETH SEVENTIETH EIGHTIETH NINETIETH".split()

#: Usual marks of organisations; a full list of a region's words is an argument of ``is_org``.
ORG_WORDS = ["LLC", "INC", "LLP", "PLLC", "CORPORATION", "COMPANY", "PROPERTIES", "ASSOCIATION", "FOUNDATION", "PARTNERSHIP"]
