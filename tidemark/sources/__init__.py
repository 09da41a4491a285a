from tidemark.sources.extract import extract_all, extract_pages, extract_waves
from tidemark.sources.pages import in_sequence, page_folder, page_stream, parse_records, read_lines, read_pages, unwrap
from tidemark.sources.paged import Client, paged_source, register_source
from tidemark.sources.paging import incremental, numbered, page, pages

__all__ = [
    "Client",
    "extract_all",
    "extract_pages",
    "extract_waves",
    "in_sequence",
    "incremental",
    "numbered",
    "page",
    "page_folder",
    "page_stream",
    "paged_source",
    "pages",
    "parse_records",
    "read_lines",
    "read_pages",
    "register_source",
    "unwrap",
]
