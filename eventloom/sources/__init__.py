"""Readers: change events, re-index hints and requests, resource descriptions."""

from eventloom.sources.events import (  # noqa: F401
    malformed_events,
    parse_events,
    read_events,
    read_hints,
    read_legacy_events,
    read_reindex_requests,
)
from eventloom.sources.rdf import (  # noqa: F401
    ntriples_to_triples,
    rdfxml_to_triples,
    read_ntriples,
    read_rdfxml,
    unreadable_ntriples,
    unreadable_rdfxml,
)
from eventloom.sources.snapshot import read_edges, read_triples, write_edges, write_triples  # noqa: F401
