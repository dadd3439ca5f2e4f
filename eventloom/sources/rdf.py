"""Resource descriptions: N-Triples and RDF/XML to triple rows."""

from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from eventloom import vocab
from eventloom.functions import as_col, unescape_literal, with_value, without_brackets

_COLUMNS = ("subject", "predicate", "object", "object_kind", "datatype", "lang")

# --- fixed values: pieces of the N-Triples line format ---
_LANG = "[A-Za-z]+(?:-[A-Za-z0-9]+)*"
_END = r"\s*\.\s*(?:#.*)?$"
_SKIPPED = r"^\s*(#.*)?$"


def _with_triple(df, line):
    """Add ``t``, the parsed triple of a line; null if the line holds none.

    Works in steps, each using the columns of the step before once they are computed. The
    closing quote of a literal is found in a copy in which every escape pair is masked, so
    literals of any length need no backtracking expression.
    """
    keep = df.columns
    words = F.split(F.ltrim(as_col(line), F.lit(" \t")), r"\s+", 3)
    step = df.select(*keep, words.alias("_w")).select(
        *keep,
        F.get("_w", F.lit(0)).alias("_s"),
        F.get("_w", F.lit(1)).alias("_p"),
        F.get("_w", F.lit(2)).alias("_rest"),
    )
    rest = F.col("_rest")
    literal = rest.startswith('"')
    masked = F.when(F.contains(rest, F.lit("\\")), F.regexp_replace(rest, r"\\.", "__")).otherwise(rest)
    close = (
        F.when(literal, F.locate('"', masked, 2))
        .when(rest.startswith("<"), F.locate(">", rest))
        .when(rest.startswith("_:"), F.length(F.regexp_extract(rest, r"^_:[^\s.]*(?:\.+[^\s.]+)*", 0)))
        .otherwise(F.lit(0))
    )
    step = step.select("*", close.alias("_close")).select(
        "*", rest.substr(F.col("_close") + 1, F.length(rest)).alias("_tail")
    )
    tail, close = F.col("_tail"), F.col("_close")
    suffix = F.when(literal & ~tail.startswith(" "), tail)
    datatype = F.regexp_extract(suffix, rf"^\^\^<([^>]*)>{_END}", 1)
    lang = F.regexp_extract(suffix, rf"^@({_LANG}){_END}", 1)
    step = step.select("*", datatype.alias("_datatype"), lang.alias("_lang"))
    datatype, lang = F.nullif("_datatype", F.lit("")), F.nullif("_lang", F.lit(""))
    node, predicate = F.col("_s"), F.col("_p")
    good = (
        ((node.startswith("<") & node.endswith(">")) | node.startswith("_:"))
        & (predicate.startswith("<") & predicate.endswith(">"))
        & (close > 0)
        & ((tail == " .") | datatype.isNotNull() | lang.isNotNull() | tail.rlike("^" + _END))
    )
    is_uri = rest.startswith("<")
    triple = F.struct(
        F.when(node.startswith("<"), without_brackets(node)).otherwise(node).alias("subject"),
        without_brackets(predicate).alias("predicate"),
        F.when(literal, unescape_literal(rest.substr(F.lit(2), close - 2)))
        .when(is_uri, rest.substr(F.lit(2), close - 2))
        .otherwise(rest.substr(F.lit(1), close))
        .alias("object"),
        F.when(literal, "literal").when(is_uri, "uri").otherwise("bnode").alias("object_kind"),
        F.when(literal & lang.isNotNull(), vocab.LANG_STRING)
        .when(literal, F.coalesce(datatype, F.lit(vocab.XSD_STRING)))
        .alias("datatype"),
        F.when(literal, lang).alias("lang"),
    )
    return with_value(step, "t", F.when(good, triple)).select(*keep, "t")


def _as_triples(df, parts, doc, order, graph, scope=None):
    """Spread the parsed struct into the triple schema.

    Blank node labels hold within a text or file only; ``scope`` (the document by default)
    keeps equal labels of different ones apart.
    """
    mark = F.substring(F.md5((doc if scope is None else scope).cast("binary")), 1, 12)

    def own(label):
        """The label with the mark; one that bears it already (read again) stays."""
        named = F.concat(F.lit("_:"), mark, F.lit("-"))
        bare = label.substr(F.lit(3), F.length(label))
        return F.when(label.startswith(named), label).otherwise(F.concat(named, bare))

    subject, object_ = parts["subject"], parts["object"]
    values = {
        **{c: parts[c] for c in _COLUMNS},
        "subject": F.when(subject.startswith("_:"), own(subject)).otherwise(subject),
        "object": F.when(parts["object_kind"] == "bnode", own(object_)).otherwise(object_),
    }
    return df.select(
        F.lit(graph).cast("string").alias("graph"),
        *[values[c].alias(c) for c in _COLUMNS],
        F.when(doc.startswith("_:"), own(doc)).otherwise(doc).alias("doc"),
        order.cast("long").alias("ord"),
    )


def ntriples_to_triples(df: DataFrame, doc="uri", text="text", graph=None) -> DataFrame:
    """N-Triples texts, one per resource, to triples with their line order."""
    lines = df.select(
        as_col(doc).alias("doc"),
        F.posexplode_outer(F.split(as_col(text), r"\r?\n")).alias("ord", "line"),
    )
    parsed = _with_triple(lines, "line")
    return _as_triples(
        parsed.filter(F.col("t").isNotNull()), F.col("t"), F.col("doc"), F.col("ord"), graph
    )


def numbered_lines(spark: SparkSession, path: str, **options) -> DataFrame:
    """(value, file, number): lines of text files with their place in their file, from 0.

    Files are read in splits, each by one task from its first line to its last. A first pass
    counts the lines of each split without looking into them; running sums of these counts give
    the place of a split's first line. What is joined is a row for each split, of some hundred
    bytes, which adaptive execution broadcasts while it is small. No line is moved to be counted.
    """
    place = [
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"),
    ]
    reader = spark.read.options(**options)
    splits = reader.text(path).select(*place).groupBy("file", "start").agg(
        F.count("*").alias("lines"), F.min("id").alias("first")
    )
    before = F.sum("lines").over(Window.partitionBy("file").orderBy("start")) - F.col("lines")
    splits = splits.select("file", "start", (before - F.col("first")).alias("shift"))
    lines = reader.text(path).select("value", *place).join(splits, ["file", "start"])
    return lines.select("value", "file", (F.col("id") + F.col("shift")).alias("number"))


def read_ntriples(
    spark: SparkSession, path: str, streaming: bool = False, graph=None, ordered: bool = False, **options
) -> DataFrame:
    """N-Triples files of any size, split by line.

    A triple belongs to the description of its subject without the ``#fragment``. ``ordered``
    gives ``ord``, the number of the line in its file (see ``numbered_lines``; not for streams),
    so that first values are those that stand first. Without it ``ord`` is null and ties are
    broken by value.
    """
    if ordered and streaming:
        raise ValueError("lines of a stream are not numbered")
    if ordered:
        lines = numbered_lines(spark, path, **options)
    else:
        source = spark.readStream if streaming else spark.read
        lines = source.options(**options).text(path).select(
            "value", F.col("_metadata.file_path").alias("file"), F.lit(None).alias("number")
        )
    parsed = _with_triple(lines, "value").filter(F.col("t").isNotNull())
    home = F.substring_index(F.col("t.subject"), "#", 1)
    # A blank node of a file is described under its own, kept-apart name.
    return _as_triples(parsed, F.col("t"), home, F.col("number"), graph, F.col("file"))


def unreadable_ntriples(df: DataFrame, line: str = "value") -> DataFrame:
    """Lines that are neither triples nor comments nor blank."""
    lines = df.filter(~as_col(line).rlike(_SKIPPED))
    return _with_triple(lines, line).filter(F.col("t").isNull()).drop("t")


def _description_rows(text):
    """Property elements of the top-level descriptions of one RDF/XML text, in order."""
    if text is None:
        return None
    try:
        root = ElementTree.fromstring(text)
    except ElementTree.ParseError:
        return None

    def rdf(name):
        return "{%s}%s" % (vocab.RDF, name)

    lang_key = "{http://www.w3.org/XML/1998/namespace}lang"
    rows = []
    for number, node in enumerate(root.findall(rdf("Description"))):
        subject = node.get(rdf("about"))
        if subject is None:
            subject = "_:" + node.get(rdf("nodeID"), f"-{number}")
        for item in node:
            if not isinstance(item.tag, str):
                continue
            link = item.get(rdf("resource"), item.get(rdf("about")))
            lang = item.get(lang_key, node.get(lang_key, root.get(lang_key)))
            if link is not None:
                value = (link, "uri", None, None)
            elif item.get(rdf("nodeID")) is not None:
                value = ("_:" + item.get(rdf("nodeID")), "bnode", None, None)
            elif item.get(rdf("datatype")) is not None:
                value = (item.text or "", "literal", item.get(rdf("datatype")), None)
            else:
                datatype = vocab.LANG_STRING if lang else vocab.XSD_STRING
                value = (item.text or "", "literal", datatype, lang or None)
            predicate = item.tag[1:].replace("}", "", 1)
            rows.append(dict(zip(_COLUMNS, (subject, predicate, *value))))
    return rows


def _description_column(column):
    """Spark's XPath functions do not resolve namespaces, hence one Arrow-batched helper."""

    @F.pandas_udf("array<struct<%s>>" % ",".join(f"{c}:string" for c in _COLUMNS))
    def read(texts: pd.Series) -> pd.Series:
        return texts.map(_description_rows)

    return read(column)


def rdfxml_to_triples(df: DataFrame, doc="uri", text="text", graph=None) -> DataFrame:
    """RDF/XML texts, one per resource, to triples with their document order."""
    parsed = df.select(
        as_col(doc).alias("doc"),
        F.posexplode_outer(_description_column(as_col(text))).alias("ord", "t"),
    ).filter(F.col("t").isNotNull())
    return _as_triples(parsed, F.col("t"), F.col("doc"), F.col("ord"), graph)


def unreadable_rdfxml(df: DataFrame, text="text") -> DataFrame:
    """Rows whose text is no well-formed XML."""
    return df.filter(as_col(text).isNotNull() & _description_column(as_col(text)).isNull())


def read_rdfxml(
    spark: SparkSession, path: str, streaming: bool = False, graph=None, **options
) -> DataFrame:
    """One RDF/XML description per file; the document is named after its first subject."""
    source = spark.readStream if streaming else spark.read
    files = source.options(**options).text(path, wholetext=True)
    files = files.select("value", F.col("_metadata.file_path").alias("file"))
    parsed = files.select("file", _description_column(F.col("value")).alias("rows"))
    rows = parsed.select(
        F.try_element_at("rows", F.lit(1))["subject"].alias("doc"),
        "file",
        F.posexplode_outer("rows").alias("ord", "t"),
    ).filter(F.col("t").isNotNull())
    return _as_triples(rows, F.col("t"), F.col("doc"), F.col("ord"), graph, F.col("file"))
