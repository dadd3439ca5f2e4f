"""Operators on triple tables: text forms, update statements, look-ups, preferences."""

from pyspark.sql import DataFrame, functions as F

from eventloom import vocab
from eventloom.functions import form_encode, triple_line, without_brackets
from eventloom.operators.parts import with_part
from eventloom.schemas import TRIPLE_KEY

# Lines of a part of a text, on average; every text follows the same rule, whatever its size.
STATEMENT_ROWS = 10_000


def rdf_set(triples: DataFrame) -> DataFrame:
    """A graph is a set: repeated statements collapse, wherever they were read."""
    return triples.select(*TRIPLE_KEY).distinct()


def line_column():
    return triple_line("subject", "predicate", "object", "object_kind", "datatype", "lang")


def to_ntriples(triples: DataFrame) -> DataFrame:
    """Add the N-Triples text of each row as ``line``."""
    return triples.withColumn("line", line_column())


def collect_graph(
    triples: DataFrame, key: str = "subject", max_rows: int = STATEMENT_ROWS
) -> DataFrame:
    """Text of each group's triples in line order: (key, part, parts, text).

    The parts of a group together hold every distinct triple exactly once; ``parts`` is how
    many the group was dealt over.
    """
    lines = triples.select(F.col(key), line_column().alias("line"))
    dealt = with_part(lines, key, "line", max_rows)
    return dealt.groupBy(key, "part", "parts").agg(
        F.array_join(F.array_sort(F.collect_set("line")), "\n").alias("text")
    )


def _in_graph(body, graph):
    if not graph:
        return body
    return F.concat(F.lit(f"GRAPH <{graph}> {{ "), body, F.lit(" }"))


def delete_pattern(uri, graph=None):
    """Text that removes everything said about a uri."""
    uri = F.col(uri) if isinstance(uri, str) else uri
    pattern = _in_graph(F.concat(F.lit("<"), uri, F.lit("> ?p ?o")), graph)
    return F.concat(F.lit("DELETE WHERE { "), pattern, F.lit(" }"))


def insert_statement(
    triples: DataFrame, key: str = "subject", graph=None, max_rows: int = STATEMENT_ROWS
) -> DataFrame:
    """(key, part, parts, statement): plain inserts."""
    body = _in_graph(F.concat(F.col("text"), F.lit("\n")), graph)
    text = F.concat(F.lit("INSERT DATA { "), body, F.lit("}"))
    return collect_graph(triples, key, max_rows).select(key, "part", "parts", text.alias("statement"))


def update_statement(
    triples: DataFrame, graph=None, max_rows: int = STATEMENT_ROWS
) -> DataFrame:
    """(uri, part, parts, statement): clear the resource, then insert its description.

    Part 0 clears the resource and inserts its lines, further parts insert theirs. They belong
    together: send them in order, and none after one that failed (see ``delivery.with_retry``).
    """
    inserts = insert_statement(triples, "doc", graph, max_rows).withColumnRenamed("doc", "uri")
    clear = F.concat(delete_pattern("uri", graph), F.lit(";\n"))
    return inserts.withColumn(
        "statement",
        F.concat(F.when(F.col("part") == 0, clear).otherwise(""), F.col("statement")),
    )


def delete_statement(df: DataFrame, uri: str = "uri", graph=None) -> DataFrame:
    return df.withColumn("statement", delete_pattern(uri, graph))


def form_encoded(df: DataFrame, column: str = "statement") -> DataFrame:
    """Add the form-post body of a statement as ``body``."""
    return df.withColumn("body", form_encode(column))


def containment_edges(triples: DataFrame) -> DataFrame:
    """(parent, child) from triples: containment with a uri as object."""
    return triples.filter(
        (F.col("predicate") == vocab.CONTAINS) & (F.col("object_kind") == "uri")
    ).select(F.col("subject").alias("parent"), F.col("object").alias("child"))


def containment_edges_from_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """(parent, child) straight from N-Triples lines, without parsing whole triples."""
    words = F.split(F.trim(F.col(line)), r"\s+")
    return (
        lines.select(words.alias("w"))
        .filter(
            (F.size("w") > 2)
            & (F.col("w")[1] == f"<{vocab.CONTAINS}>")
            & F.col("w")[2].startswith("<")
        )
        .select(
            without_brackets(F.col("w")[0]).alias("parent"),
            without_brackets(F.col("w")[2]).alias("child"),
        )
    )


def apply_prefer(triples: DataFrame, include=(), omit=(), groups=None) -> DataFrame:
    """Leave out the predicates of the omitted preference groups unless also included.

    ``groups`` maps a preference name to predicates; only containment is known by default.
    A (prefer_value, predicate) table may be given instead; its rows are matched by join.
    """
    include, omit = set(include), set(omit)
    wanted = omit - include
    if not wanted:
        return triples
    if isinstance(groups, DataFrame):
        dropped = groups.filter(F.col("prefer_value").isin(sorted(wanted)))
        return triples.join(dropped.select("predicate").distinct(), "predicate", "left_anti")
    table = {**vocab.PREFER_GROUPS, **(groups or {})}
    unknown = wanted - set(table)
    if unknown:
        raise ValueError(f"no predicates known for {sorted(unknown)}")
    kept = {p for name in include for p in table.get(name, ())}
    predicates = sorted({p for name in wanted for p in table[name]} - kept)
    return triples.filter(~F.col("predicate").isin(predicates))


_ANY = object()


def match(triples: DataFrame, s=None, p=None, o=None, graph=_ANY) -> DataFrame:
    """Triples that fit a pattern; None matches anything. ``graph=None`` is the default graph."""
    for column, wanted in (("subject", s), ("predicate", p), ("object", o)):
        if wanted is not None:
            triples = triples.filter(F.col(column) == wanted)
    if graph is not _ANY:
        triples = triples.filter(F.col("graph").eqNullSafe(F.lit(graph)))
    return triples


def count_by_subject(triples: DataFrame) -> DataFrame:
    return triples.groupBy("subject").agg(F.count(F.lit(1)).alias("n"))


def in_named_graph(triples: DataFrame, graph) -> DataFrame:
    """Put triples into a named graph; an empty name is the default graph."""
    return triples.withColumn("graph", F.lit(graph or None).cast("string"))
