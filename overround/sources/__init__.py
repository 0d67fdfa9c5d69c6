"""Sources (landed JSON documents, HTML pages, request manifests) and sinks."""

from .document_files import LandedDocuments, land_documents, read_landed_documents
from .documents import (
    event_metadata, landed_records, parse_documents, quarantine_split, read_landed,
    read_nested_json, read_whole_files, sportsbet_selections, tab_selections,
)
from .identity import body_name, current_documents, current_responses, response_ledger
from .manifest import EVENT_ENDPOINTS, url_endpoint, url_manifest
from .ordered_csv import damaged_files, number_text, read_csv_ordered, read_manifest, write_csv_ordered
from .pages import (
    card_prices, card_teams, element_text, elements_by_class, hrefs, listing_cards,
    listing_rejects, nested_texts, page_links, read_html_files, read_pages, tag_text, texts,
)
from .sinks import (
    read_csv, read_market_csv, remove_folder, replace_partitions, swap_in, write_csv, write_landing, write_parquet,
)

__all__ = [
    "event_metadata", "parse_documents", "quarantine_split", "read_landed", "read_nested_json",
    "read_whole_files", "sportsbet_selections", "tab_selections", "EVENT_ENDPOINTS",
    "url_manifest", "card_prices", "card_teams", "element_text", "elements_by_class", "hrefs",
    "listing_cards", "page_links", "read_html_files", "read_pages", "tag_text", "texts",
    "read_csv", "read_market_csv", "write_csv", "write_landing", "write_parquet",
    "current_documents", "landed_records", "url_endpoint", "listing_rejects",
    "replace_partitions", "body_name", "nested_texts", "damaged_files", "number_text", "read_csv_ordered",
    "read_manifest", "write_csv_ordered", "LandedDocuments", "land_documents", "read_landed_documents", "current_responses", "response_ledger", "remove_folder", "swap_in",
]
