"""Column contracts of the tables (DDL strings) and the payload fields read from landed JSON."""

BRONZE = (
    "ingested_at string, source string, endpoint string, record_id string, payload string, "
    "year string, month string, day string"
)
ENVELOPE = ["ingested_at", "source", "endpoint", "record_id", "payload"]

# Scalars stay text until they are cast one by one; see functions.payload.parse_object.
DOMAIN_PAYLOAD = "domain_id string, domain_name string, category_id string, category_name string"
CATEGORY_PAYLOAD = (
    "id string, name string, picture string, total_items_in_this_category string, "
    "path_from_root array<struct<name:string>>, children_categories array<string>, "
    "attribute_types string, settings struct<adult_content:string>"
)
ITEM_PAYLOAD = (
    "id string, title string, price string, currency_id string, available_quantity string, "
    "sold_quantity string, status string, condition string, category_id string, "
    "listing_type_id string, permalink string, seller_id string, site_id string, "
    "date_created string, last_updated string"
)
PRICE_PAYLOAD = (
    "id string, item_id string, seller_id string, category_id string, price string, "
    "base_price string, original_price string, currency_id string, available_quantity string, "
    "sold_quantity string, status string, condition string, last_updated string"
)
DESCRIPTION_PAYLOAD = "id string, plain_text string"

SILVER = {
    "domain_discovery": (
        "domain_category_id string, query_domain_category_id string, domain_id string, "
        "domain_name string, category_id string, category_name string, search_query string, "
        "ingested_at timestamp, source string"
    ),
    "categories": (
        "category_id string, category_name string, picture_url string, "
        "total_items_in_this_category bigint, path_from_root string, "
        "children_categories_count bigint, attribute_types string, "
        "settings_adult_content boolean, ingested_at timestamp, source string"
    ),
    "item_details": (
        "item_id string, title string, price double, currency_id string, "
        "available_quantity bigint, sold_quantity bigint, status string, condition string, "
        "category_id string, listing_type_id string, permalink string, seller_id string, "
        "site_id string, date_created timestamp, last_updated timestamp, ingested_at timestamp, "
        "source string"
    ),
    "item_price_snapshots": (
        "item_id string, seller_id string, category_id string, price double, base_price double, "
        "original_price double, currency_id string, available_quantity bigint, "
        "sold_quantity bigint, status string, condition string, last_updated timestamp, "
        "snapshot_date timestamp, snapshot_date_key bigint, ingested_at timestamp, source string"
    ),
    "item_descriptions": (
        "item_id string, plain_text string, text_length bigint, ingested_at timestamp, source string"
    ),
}

GOLD = {
    "public_query_metrics": (
        "search_query string, category_count bigint, domain_count bigint, "
        "total_items_in_categories bigint, avg_catalog_coverage_score double, "
        "latest_ingestion_at timestamp"
    ),
}

MANIFEST = (
    "run_id string, status string, query string, started_at timestamp, finished_at timestamp, "
    "duration_seconds double, error string, tasks string"
)
