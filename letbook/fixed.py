"""Fixed values.

Constants, URL forms and thresholds that the listing sites and the collected
data set; they have to stay as they are for results to agree.
"""

# Listing sources
ROOM_SOURCE = "spareroom"
ROOM_DOMAIN = "https://www.spareroom.co.uk"
ROOM_SEARCH_URL = "https://www.spareroom.co.uk/flatshare/search.pl"
SALE_DOMAIN = "https://www.rightmove.co.uk"
SALE_SEARCH_URL = "https://www.rightmove.co.uk/property-for-sale/find.html"
ROOM_ID_PARAM = "flatshare_id"
LOCATION_ID_PREFIX = "OUTCODE^"

# View names that existing SQL texts use
SALE_VIEW = "rightmove"
ROOM_VIEW = "spareroom"

# Paging
ROOM_PAGE_SIZE = 50
ROOM_FALLBACK_PAGES = 30
SALE_PAGE_SIZE = 24
SALE_MAX_PAGES = 50

# Search page markup
CARD_CLASS = "listing-result"
LINK_CLASS = "propertyCard-link"
LINK_PATH = "/properties/"
LINK_PATTERN = "/properties/[0-9]+"
TOTAL_CLASS = "navcurrent"
MODEL_START = r"(?s)window\.PAGE_MODEL[^{]*+(\{.*)"
MODEL_PATTERN = r"(?s)window\.PAGE_MODEL\s*=\s*(\{.*?\})\s*;</script>"

# Names of shard files
STREAMED_FILES = "shard_*.parquet"
DATED_FILES = "rightmove_*.parquet"
FAILED_URL_FILES = "failed_urls_worker*.txt"

# Output
SHARD_ROWS = 5000
MAX_PASSES = 3

# Crawl health
LATENCY_WINDOW = 300
ETA_CAP_SECONDS = 7200
THROTTLE_STATUSES = (429, 503)

# Characters that count as blank at either end of a text
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
