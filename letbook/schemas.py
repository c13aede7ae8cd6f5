"""Table schemas, as DDL strings."""

SALE_LISTINGS = (
    "url string, address string, postcode string, price bigint, bedrooms int, "
    "property_type string, floor_area string, status int, scraped_at timestamp"
)

# As loaded for analysis: numbers may hold fractions
SALE_TABLE = SALE_LISTINGS.replace("price bigint, bedrooms int", "price double, bedrooms double")

ROOM_LISTINGS = (
    "source string, postcode string, title string, url string, price_text string, "
    "location string, room_type string, available string, scraped_at timestamp, status int"
)

ROOM_TABLE = ROOM_LISTINGS + ", price_norm bigint"

ROOM_CARDS = (
    "source string, flatshare_id string, postcode string, title string, url string, "
    "price_text string, location string, room_type string, available string, "
    "fetched_at timestamp, page_idx int, pos int"
)

LOCATIONS = "outer_code int, postcode string"

LEDGER = "source string, key string, status string, run_id string, updated_at timestamp"

PAGES = (
    "key string, kind string, url string, page_idx int, offset int, "
    "http_status int, html string, fetched_at timestamp"
)

FETCH_LOG = (
    "worker int, pass_no int, attempt int, url string, http_status int, "
    "latency_s double, finished_at timestamp"
)

# Every leaf is read as text and typed afterwards, so that `250000.0` and `"250000"` stay apart.
PAGE_MODEL = (
    "propertyData: struct<"
    "address: struct<displayAddress: string, outcode: string, incode: string>, "
    "bedrooms: string, propertySubType: string, propertyType: string, "
    "sizings: array<struct<display: string>>>, "
    "analyticsInfo: struct<analyticsProperty: struct<postcode: string, price: string>>"
)

# Shards on disk. Scanning with a superset schema fills columns a file lacks with NULL.
SALE_SHARD_TEXT_STATUS = (
    "url string, address string, postcode string, price bigint, bedrooms bigint, "
    "property_type string, floor_area string, status string, scraped_at timestamp"
)
SALE_SHARD_INT_STATUS = SALE_SHARD_TEXT_STATUS.replace("status string", "status bigint")
ROOM_SHARD = (
    "source string, postcode string, title string, url string, price_text string, "
    "location string, locatiom string, room_type string, available string, "
    "scraped_at timestamp, status bigint"
)
