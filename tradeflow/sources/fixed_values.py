"""Codes, distances and bounds that define the published study.

They are data, stated as given by the statistical sources.
"""

# Reporting countries, (statistical reporter code, ISO3).
REPORTERS = [
    (40, "AUT"),
    (56, "BEL"),
    (100, "BGR"),
    (191, "HRV"),
    (196, "CYP"),
    (203, "CZE"),
    (208, "DNK"),
    (233, "EST"),
    (246, "FIN"),
    (251, "FRA"),
    (276, "DEU"),
    (300, "GRC"),
    (348, "HUN"),
    (372, "IRL"),
    (380, "ITA"),
    (428, "LVA"),
    (440, "LTU"),
    (442, "LUX"),
    (470, "MLT"),
    (528, "NLD"),
    (616, "POL"),
    (620, "PRT"),
    (642, "ROU"),
    (703, "SVK"),
    (705, "SVN"),
    (724, "ESP"),
    (752, "SWE"),
    (757, "CHE"),
    (579, "NOR"),
    (826, "GBR"),
]

# Sea distance to Rotterdam, (origin, port, nautical miles, confidence).
DISTANCES = [
    ("Russian Federation", "Primorsk", 1532, "verified"),
    ("Saudi Arabia", "Ras Tanura", 7338, "verified"),
    ("USA", "Houston", 6137, "verified"),
    ("Kuwait", "Mina Al-Ahmadi", 7484, "verified"),
    ("India", "Mumbai (proxy for Jamnagar)", 7173, "verified_proxy_port"),
    ("United Arab Emirates", "Fujairah", 6830, "verified"),
    ("Qatar", "Ras Laffan", 7300, "estimated"),
    ("Rep. of Korea", "Ulsan", 11500, "estimated"),
    ("Türkiye", "Izmit", 3100, "estimated"),
    ("China", "Ningbo-Zhoushan", 11800, "estimated"),
    ("Singapore", "Singapore", 8300, "estimated"),
    ("Egypt", "Alexandria", 3100, "estimated"),
    ("Israel", "Haifa", 3300, "estimated"),
    ("Iraq", "Basra", 7600, "estimated"),
    ("Malaysia", "Port Dickson", 8300, "estimated"),
    ("Algeria", "Arzew", 1500, "estimated"),
    ("Bahrain", "Sitra", 7400, "estimated"),
    ("Oman", "Sohar", 6850, "estimated"),
]

# Partner codes that are placeholders, not countries
# (bunkers, free zones, special categories), and the name marker of regional catch-alls.
PLACEHOLDER_PARTNERS = (837, 838, 839)
CATCH_ALL_MARKER = ", nes"

# A "total" line carries these codes; any other line is a breakdown of it.
TOTAL_MOT, TOTAL_CUSTOMS, TOTAL_PARTNER2 = 0, "C00", 0
WORLD_PARTNER = 0

# Study constants.
CONSTANT_CODES = {"flowCode": ["M"], "cmdCode": ["271019"]}
YEARS = range(2019, 2027)
START_PERIOD, END_PERIOD = "2019-01", "2025-12"
CUTOVER = "2023-02-01"
LOW_SHARE_PCT = 2.0
TOP_N = 6
MAX_LAG = 6
GALLONS_PER_BARREL = 42
KG_PER_TONNE = 1000
CRUDE, PRODUCT = "brent_usd_bbl", "diesel_usd_gal"
PRICE_SERIES = (CRUDE, PRODUCT)
