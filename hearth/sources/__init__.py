"""Readers for landed files."""

from hearth.sources.delimited import read_delimited, read_delimited_raw, clean_name
from hearth.sources.by_name import numbered, resolve_by_name
from hearth.sources.preamble import read_preamble_tsv, MissingHeader
from hearth.sources.wide import read_wide_series, long_series
from hearth.sources.json_source import read_landed_json, read_json_documents, malformed_json, flatten_json, json_key_values
from hearth.sources.sql_view import sql_view_query
