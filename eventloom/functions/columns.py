"""Scalar column helpers. All of them are compositions of built-in expressions."""

from functools import reduce

from pyspark.sql import Column, functions as F

from eventloom import vocab


def as_col(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def with_value(df, name: str, column: Column):
    """Add a costly column that later filters use as a value.

    A filter on a plain derived column is moved below it and repeats its expression; one on
    a generated column stays above.
    """
    return df.withColumn(name, F.explode_outer(F.array(column)))


#: Column that rows are sorted by before texts that begin alike, as uris do.
NUMBER = "_number"


def number(*columns) -> Column:
    """A number of texts. Sorting compares it as it lies; equal numbers say nothing, so the texts
    stay among the keys."""
    return F.xxhash64(*columns).alias(NUMBER)


def join_numbered(left, right, key: str, how: str = "inner"):
    """``left.join(right, key, how)`` for a text key that begins alike in most rows: a join that
    sorts compares numbers, and texts where these are equal."""
    sides = [side.withColumn(NUMBER, number(key)) for side in (left, right)]
    return sides[0].join(sides[1], [NUMBER, key], how).drop(NUMBER)


def has_any(array, values) -> Column:
    """True if the list holds any of the values; a missing list holds nothing."""
    column = as_col(array)
    tests = [F.array_contains(column, v) for v in values]
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def strip(column) -> Column:
    """Trim every kind of white space, tabs and line breaks included."""
    return F.regexp_replace(as_col(column), r"^\s+|\s+$", "")


def is_blank(column) -> Column:
    column = as_col(column)
    return column.isNull() | (F.length(F.regexp_replace(column, r"\s", "")) == 0)


def blank_to(column, default) -> Column:
    """The column, or the default where it is null or the empty string."""
    column = as_col(column)
    default = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.nullif(column, F.lit("")), default)


def event_time(column) -> Column:
    """Parse an event date; a zone offset followed by a stray ``Z`` is read as the offset."""
    return F.try_to_timestamp(F.regexp_replace(as_col(column), r"([+-]\d{2}:\d{2})Z$", "$1"))


def under(uri, container: str) -> Column:
    """The uri is the container itself or lies below it (whole path steps only)."""
    uri = as_col(uri)
    return (uri == container) | uri.startswith(container + "/")


def path_prefixes(uri) -> Column:
    """Every container a uri lies under, as a list: one entry per ``/`` plus the uri itself."""
    steps = F.split(as_col(uri), "/", -1)
    return F.transform(
        F.sequence(F.lit(1), F.size(steps)),
        lambda n: F.array_join(F.slice(steps, F.lit(1), n), "/"),
    )


def without_brackets(column) -> Column:
    """``<uri>`` -> ``uri``"""
    column = as_col(column)
    return column.substr(F.lit(2), F.length(column) - 2)


def escape_literal(column) -> Column:
    """Escape literal text for an N-Triples line."""
    out = as_col(column)
    for raw, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    return out


def unescape_literal(column) -> Column:
    """Undo N-Triples escapes: split into escapes and plain runs, translate, join again."""
    column = as_col(column)
    controls = {"\\t": "\t", "\\n": "\n", "\\r": "\r", "\\b": "\b", "\\f": "\f"}

    def translate(token):
        numeric = F.decode(F.unhex(F.lpad(token.substr(3, 8), 8, "0")), "UTF-32")
        out = F.when(token.rlike(r"^\\[uU][0-9A-Fa-f]"), numeric)
        for escaped, raw in controls.items():
            out = out.when(token == escaped, F.lit(raw))
        return out.when(token.startswith("\\"), token.substr(2, 1)).otherwise(token)

    tokens = F.regexp_extract_all(
        column,
        F.lit(r"(?s)(\\U[0-9A-Fa-f]{8}|\\u[0-9A-Fa-f]{4}|\\.|[^\\]+)"),
        1,
    )
    return F.when(
        F.contains(column, F.lit("\\")), F.array_join(F.transform(tokens, translate), "")
    ).otherwise(column)


def escape_xml(column) -> Column:
    out = as_col(column)
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    return out


def term(value, kind, datatype, lang) -> Column:
    """One RDF term as N-Triples text. Plain strings carry no datatype."""
    value, kind, datatype, lang = map(as_col, (value, kind, datatype, lang))
    quoted = F.concat(F.lit('"'), escape_literal(value), F.lit('"'))
    return (
        F.when(kind == "uri", F.concat(F.lit("<"), value, F.lit(">")))
        .when(kind == "bnode", value)
        .when(lang.isNotNull(), F.concat(quoted, F.lit("@"), lang))
        .when(
            datatype.isNull() | datatype.isin(vocab.XSD_STRING, vocab.LANG_STRING), quoted
        )
        .otherwise(F.concat(quoted, F.lit("^^<"), datatype, F.lit(">")))
    )


def triple_line(subject, predicate, value, kind, datatype, lang) -> Column:
    """One N-Triples line, without the line break."""
    subject = as_col(subject)
    node = F.when(subject.startswith("_:"), subject).otherwise(
        F.concat(F.lit("<"), subject, F.lit(">"))
    )
    return F.concat(
        node,
        F.lit(" <"),
        as_col(predicate),
        F.lit("> "),
        term(value, kind, datatype, lang),
        F.lit(" ."),
    )


def form_encode(column) -> Column:
    """Body of a form post carrying an update statement."""
    return F.concat(F.lit("update="), F.url_encode(as_col(column)))


def basic_auth(username, password) -> Column:
    """Value of a basic-auth header; null where the user name is blank."""
    username, password = as_col(username), as_col(password)
    pair = F.concat(username, F.lit(":"), F.coalesce(password, F.lit("")))
    value = F.concat(F.lit("Basic "), F.base64(pair.cast("binary")))
    return F.when(~is_blank(username), value)


_DIGESTS = {
    "md5": F.md5,
    "sha1": F.sha1,
    "sha-256": lambda c: F.sha2(c, 256),
    "sha-512": lambda c: F.sha2(c, 512),
}


def digest(column, algorithm: str) -> Column:
    """Hex digest of a text or binary column."""
    if algorithm not in _DIGESTS:
        raise ValueError(f"unknown digest algorithm: {algorithm}")
    return _DIGESTS[algorithm](as_col(column))
