"""Vocabulary used in events, descriptions and audit records.

Everything below is a fixed value: these URIs appear in the data itself, so they must be
spelled exactly like this for results to be right.
"""

# --- fixed values: namespaces -------------------------------------------------------------
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
XSD = "http://www.w3.org/2001/XMLSchema#"
LDP = "http://www.w3.org/ns/ldp#"
PROV = "http://www.w3.org/ns/prov#"
PREMIS = "http://www.loc.gov/premis/rdf/v1#"
DC = "http://purl.org/dc/elements/1.1/"
ACTIVITY = "https://www.w3.org/ns/activitystreams#"
LEGACY_EVENT = "http://fedora.info/definitions/v4/event#"
REPOSITORY = "http://fedora.info/definitions/v4/repository#"
AUDIT = "http://fedora.info/definitions/v4/audit#"
INDEXING = "http://fedora.info/definitions/v4/indexing#"
EVENT_CODE = "http://id.loc.gov/vocabulary/preservation/eventType/"

# --- fixed values: event types (legacy spelling, current spelling) --------------------------
CREATE = (LEGACY_EVENT + "ResourceCreation", ACTIVITY + "Create")
UPDATE = (LEGACY_EVENT + "ResourceModification", ACTIVITY + "Update")
DELETE = (LEGACY_EVENT + "ResourceDeletion", ACTIVITY + "Delete")

# --- fixed values: classes and predicates ---------------------------------------------------
RDF_TYPE = RDF + "type"
XSD_STRING = XSD + "string"
XSD_DATETIME = XSD + "dateTime"
LANG_STRING = RDF + "langString"
CONTAINS = LDP + "contains"
BINARY = REPOSITORY + "Binary"
CONTAINER = REPOSITORY + "Container"
CREATED = REPOSITORY + "created"
LAST_MODIFIED = REPOSITORY + "lastModified"
INDEXABLE = INDEXING + "Indexable"
HAS_TRANSFORMATION = INDEXING + "hasIndexingTransformation"
TITLE = DC + "title"

AUDIT_CLASSES = (AUDIT + "InternalEvent", PREMIS + "Event", PROV + "InstantaneousEvent")
EVENT_DATE_TIME = PREMIS + "hasEventDateTime"
EVENT_OBJECT = PREMIS + "hasEventRelatedObject"
EVENT_AGENT = PREMIS + "hasEventRelatedAgent"
EVENT_TYPE = PREMIS + "hasEventType"
EVENT_OUTCOME = PREMIS + "hasEventOutcome"
MESSAGE_DIGEST = PREMIS + "hasMessageDigest"
SIZE = PREMIS + "hasSize"
CONTENT_LOCATION = PREMIS + "hasContentLocation"

# --- fixed values: audit event type by (change, is it a binary?) ----------------------------
AUDIT_TYPE = {
    ("create", True): EVENT_CODE + "ing",
    ("create", False): EVENT_CODE + "cre",
    ("delete", True): AUDIT + "contentRemoval",
    ("delete", False): EVENT_CODE + "del",
    ("update", True): AUDIT + "contentModification",
    ("update", False): AUDIT + "metadataModification",
}

# --- fixed values: preference names -> predicates they stand for ----------------------------
PREFER_CONTAINMENT = LDP + "PreferContainment"
PREFER_GROUPS = {PREFER_CONTAINMENT: (CONTAINS,)}

# --- fixed values: messages -----------------------------------------------------------------
INVALID_JSON = "Invalid JSON"
NO_RECIPIENTS = "No endpoints configured for indexing"
STARTED_AT = "Indexing started at "
NO_ENDPOINT = "Cannot forward message: no endpoint configured"
