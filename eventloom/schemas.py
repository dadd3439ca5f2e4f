"""Schemas of the tables the operators exchange. Nothing is ever inferred from data."""

from pyspark.sql import types as T

_STRINGS = T.ArrayType(T.StringType())


def _struct(*fields):
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


EVENT = _struct(
    ("event_id", T.StringType()),
    ("uri", T.StringType()),
    ("date_time", T.StringType()),
    ("ts", T.TimestampType()),
    ("event_types", _STRINGS),
    ("resource_types", _STRINGS),
    ("agents", _STRINGS),
    ("jms_event_type", T.StringType()),
    ("is_part_of", T.StringType()),
)

TRIPLE = _struct(
    ("graph", T.StringType()),
    ("subject", T.StringType()),
    ("predicate", T.StringType()),
    ("object", T.StringType()),
    ("object_kind", T.StringType()),
    ("datatype", T.StringType()),
    ("lang", T.StringType()),
    ("doc", T.StringType()),
    ("ord", T.LongType()),
)

# What makes two triples the same statement (doc and ord only say where it was read).
TRIPLE_KEY = ["graph", "subject", "predicate", "object", "object_kind", "datatype", "lang"]

SEARCH_DOC = _struct(
    ("id", T.StringType()),
    ("rdftype", _STRINGS),
    ("contains", T.StringType()),
    ("lastmodified", T.StringType()),
    ("created", T.StringType()),
)

# What the decisions need to know of a described resource.
FACTS = _struct(
    ("uri", T.StringType()),
    ("rdf_indexable", T.BooleanType()),
    ("own_transformation", T.StringType()),
    ("is_binary", T.BooleanType()),
)

REINDEX_REQUEST = _struct(
    ("request_id", T.StringType()),
    ("path", T.StringType()),
    ("content_type", T.StringType()),
    ("recipients_header", T.StringType()),
    ("body", T.StringType()),
)

HINT = _struct(("uri", T.StringType()), ("recipients", _STRINGS))

DEAD_LETTER = _struct(
    ("payload", T.StringType()),
    ("service", T.StringType()),
    ("attempts", T.IntegerType()),
    ("error", T.StringType()),
    ("failed_at", T.TimestampType()),
)

# JSON bodies of change events: current form, then the older provenance form.
ACTIVITY_BODY = _struct(
    ("id", T.StringType()),
    ("type", _STRINGS),
    ("published", T.StringType()),
    ("actor", T.ArrayType(_struct(("id", T.StringType()), ("name", T.StringType())))),
    (
        "object",
        _struct(("id", T.StringType()), ("type", _STRINGS), ("isPartOf", T.StringType())),
    ),
)
LEGACY_BODY = _struct(
    ("id", T.StringType()),
    ("type", _STRINGS),
    ("isPartOf", T.StringType()),
    (
        "wasGeneratedBy",
        _struct(
            ("type", _STRINGS), ("identifier", T.StringType()), ("atTime", T.StringType())
        ),
    ),
    ("wasAttributedTo", T.ArrayType(_struct(("name", T.StringType())))),
)
