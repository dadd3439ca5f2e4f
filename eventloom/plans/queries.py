"""Registered queries: every operator over the whole sample tables."""

from pyspark.sql import DataFrame, functions as F

from eventloom import vocab
from eventloom.functions import escape_xml
from eventloom.operators import (
    audit,
    events as ev,
    fixity,
    forwarding,
    hierarchy,
    routing,
    search,
    triples as tr,
)
from eventloom.options import Options
from eventloom.plans import views
from eventloom.plans.views import AUDIT_CONTAINER, BASE, BRIEF, EVENT_BASE, GRAPH
from eventloom.session import work_dir
from eventloom.sources import (
    malformed_events as malformed_bodies,
    ntriples_to_triples,
    parse_events as parse_events_source,
    rdfxml_to_triples,
    read_edges,
    read_hints,
    read_ntriples,
    read_reindex_requests,
    read_triples,
    unreadable_ntriples as unreadable_lines,
    write_edges,
    write_triples,
)
from eventloom.streaming import delivery, edges, latest, state
from eventloom.streaming.services import (
    Inputs,
    build_services,
    search_step,
    triplestore_step,
)

REGISTRY = {}
CONTAINERS = [AUDIT_CONTAINER]
HINT_TIME = "2100-01-01"


def query(function):
    REGISTRY[function.__name__] = function
    return function


def _text(column, separator=","):
    return F.array_join(column, separator)


# --- events and audit -----------------------------------------------------------------------


def _audited(spark, sf):
    return audit.audit_input(views.events(spark, sf), CONTAINERS)


@query
def audit_event_type(spark, sf) -> DataFrame:
    typed = ev.with_audit_event_type(_audited(spark, sf))
    return ev.with_audit_event_uri(typed, EVENT_BASE).select(
        "event_id", "uri", "event_uri", "audit_event_type"
    )


@query
def audit_triples(spark, sf) -> DataFrame:
    return audit.audit_triples(_audited(spark, sf), EVENT_BASE).select(
        "subject", "predicate", "object", "object_kind", "datatype"
    )


@query
def audit_ntriples(spark, sf) -> DataFrame:
    rows = audit.audit_triples(_audited(spark, sf), EVENT_BASE)
    return tr.to_ntriples(rows).select("subject", "line")


@query
def audit_insert_statement(spark, sf) -> DataFrame:
    return audit.audit_insert_statement(_audited(spark, sf), EVENT_BASE)


@query
def canonical_events(spark, sf) -> DataFrame:
    return views.events(spark, sf).select(
        "event_id",
        "uri",
        "date_time",
        _text("event_types").alias("event_types"),
        _text("resource_types").alias("resource_types"),
        _text("agents").alias("agents"),
        F.size("event_types").cast("long").alias("n_types"),
    )


def _parsed_columns(df):
    return df.select(
        "event_id",
        "uri",
        "date_time",
        F.unix_micros("ts").alias("epoch"),
        _text("event_types").alias("event_types"),
        _text("resource_types").alias("resource_types"),
        _text("agents").alias("agents"),
        "is_part_of",
    )


@query
def parse_events(spark, sf) -> DataFrame:
    """Events rendered as current-form JSON and parsed back."""
    rows = views.events(spark, sf)
    # The first agent has an id, the others only a name.
    actors = F.transform(
        "agents",
        lambda a, i: F.struct(
            F.array(F.lit("Person")).alias("type"),
            F.when(i == 0, a).alias("id"),
            F.when(i > 0, a).alias("name"),
        ),
    )
    body = F.struct(
        F.col("event_id").alias("id"),
        F.col("event_types").alias("type"),
        F.lit("change").alias("name"),
        F.col("date_time").alias("published"),
        actors.alias("actor"),
        F.struct(
            F.col("uri").alias("id"),
            F.col("resource_types").alias("type"),
            F.lit(BASE).alias("isPartOf"),
        ).alias("object"),
    )
    return _parsed_columns(parse_events_source(rows.select(F.to_json(body).alias("value"))))


@query
def parse_legacy_events(spark, sf) -> DataFrame:
    """Events rendered as legacy-form JSON and parsed back."""
    rows = views.events(spark, sf)
    people = F.transform(
        "agents", lambda a: F.struct(F.lit("SoftwareAgent").alias("type"), a.alias("name"))
    )
    body = F.struct(
        F.col("uri").alias("id"),
        F.col("resource_types").alias("type"),
        F.lit(BASE).alias("isPartOf"),
        F.struct(
            F.col("event_types").alias("type"),
            F.col("event_id").alias("identifier"),
            F.col("date_time").alias("atTime"),
        ).alias("wasGeneratedBy"),
        people.alias("wasAttributedTo"),
    )
    return _parsed_columns(parse_events_source(rows.select(F.to_json(body).alias("value"))))


def _spoilt(spark, sf):
    """Event ids with bodies of which three of five hold no event."""
    rows = views.events(spark, sf)
    number = F.regexp_extract("event_id", "([0-9]+)$", 1).cast("long") % 5
    good = F.to_json(F.struct(F.col("event_id").alias("id"), F.struct(F.col("uri").alias("id")).alias("object")))
    body = (
        F.when(number == 0, F.lit("{}"))
        .when(number == 1, F.concat(F.lit('{"foo":"'), "event_id", F.lit('"}')))
        .when(number == 2, F.concat(F.lit("no event "), "event_id"))
        .otherwise(good)
    )
    return rows.select(body.alias("value"))


@query
def malformed_events(spark, sf) -> DataFrame:
    letters = malformed_bodies(_spoilt(spark, sf))
    return letters.groupBy("payload", "service", "error").agg(F.count(F.lit(1)).alias("n"))


@query
def rejected_events(spark, sf) -> DataFrame:
    """Events and unreadable bodies from one parse."""
    rows = parse_events_source(_spoilt(spark, sf), rejects=True)
    return rows.groupBy("event_id", "uri", "reject").agg(F.count(F.lit(1)).alias("n"))


@query
def exclude_containers(spark, sf) -> DataFrame:
    return ev.exclude_containers(views.events(spark, sf), CONTAINERS).select("event_id", "uri")


def _container_table(spark, sf):
    hints = views.hints(spark, sf)
    return hints.unionByName(hints.agg(F.lit(AUDIT_CONTAINER).alias("uri")))


@query
def exclude_containers_table(spark, sf) -> DataFrame:
    kept = ev.exclude_containers(views.events(spark, sf), _container_table(spark, sf))
    return kept.select("event_id", "uri")


@query
def change_kind(spark, sf) -> DataFrame:
    return ev.with_change_kind(views.events(spark, sf)).select("event_id", "change_kind")


@query
def split_deletes(spark, sf) -> DataFrame:
    deletes, others = ev.split_deletes(views.events(spark, sf))
    return deletes.select("event_id", "uri", F.lit("delete").alias("branch")).unionByName(
        others.select("event_id", "uri", F.lit("index").alias("branch"))
    )


@query
def indexable_by_event(spark, sf) -> DataFrame:
    return ev.indexable_by_event(views.events(spark, sf)).select("event_id", "uri")


@query
def merge_live_and_hints(spark, sf) -> DataFrame:
    merged = ev.merge_live_and_hints(views.events(spark, sf), views.hints(spark, sf))
    return merged.select("event_id", "uri", "from_hint")


@query
def read_hint_files(spark, sf) -> DataFrame:
    """Hints written as JSON lines and read back through the source."""
    path = work_dir(spark, "hints")
    hints = views.hints(spark, sf).withColumn("recipients", F.array(F.lit("queue:solr")))
    hints.write.json(path)
    return read_hints(spark, path).select("uri", _text("recipients").alias("recipients"))


# --- decisions ------------------------------------------------------------------------------


def _triplestore_actions(spark, sf, require_indexable, hints=None):
    return routing.triplestore_actions(
        views.events(spark, sf),
        views.hints(spark, sf) if hints is None else hints,
        views.triples(spark, sf),
        require_indexable,
        CONTAINERS,
    )


@query
def triplestore_actions(spark, sf) -> DataFrame:
    return _triplestore_actions(spark, sf, True).select("event_id", "uri", "action")


@query
def triplestore_actions_without_predicate(spark, sf) -> DataFrame:
    return _triplestore_actions(spark, sf, False).select("event_id", "uri", "action")


def _search_actions(spark, sf, require_indexable, check, hints=None):
    return routing.search_actions(
        views.events(spark, sf),
        views.hints(spark, sf) if hints is None else hints,
        views.triples(spark, sf),
        views.DEFAULT,
        require_indexable,
        check,
        CONTAINERS,
    )


_DECISION = ("event_id", "uri", "action", "transformation")


@query
def search_actions(spark, sf) -> DataFrame:
    return _search_actions(spark, sf, True, True).select(*_DECISION)


@query
def search_actions_without_predicate(spark, sf) -> DataFrame:
    return _search_actions(spark, sf, False, True).select(*_DECISION)


@query
def search_actions_without_lookup(spark, sf) -> DataFrame:
    return _search_actions(spark, sf, False, False).select(*_DECISION)


@query
def applicable_actions(spark, sf) -> DataFrame:
    return routing.applicable(_search_actions(spark, sf, False, True)).select(*_DECISION)


@query
def latest_action(spark, sf) -> DataFrame:
    latest = routing.latest_per_uri(_triplestore_actions(spark, sf, True))
    return latest.select("uri", "event_id", "action")


@query
def latest_action_undated(spark, sf) -> DataFrame:
    """Every eleventh action has no date and so counts from when it is seen."""
    actions = _triplestore_actions(spark, sf, True)
    number = F.regexp_extract("event_id", "([0-9]+)$", 1).cast("long")
    actions = actions.filter(F.col("event_id").isNotNull()).withColumn(
        "ts", F.when(number % 11 != 0, F.col("ts"))
    )
    return routing.latest_per_uri(actions, HINT_TIME).select("uri", "event_id", "action")


@query
def latest_action_stream(spark, sf) -> DataFrame:
    """The same for events that arrive in files dealt by hash, so that late ones come again and
    again: kept in the state store over five batches."""
    target = work_dir(spark, "latest-stream")
    events = views.events(spark, sf)
    part = F.pmod(F.xxhash64("event_id"), F.lit(5)).cast("int")
    for number in range(5):
        # The files of a part arrive, as many as the events have splits; the query takes them up.
        events.filter(part == number).write.mode("append").parquet(f"{target}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{target}/in")
        actions = routing.triplestore_actions(stream, None, None, False, CONTAINERS)
        latest.keep_latest(
            actions, f"{target}/latest", f"{target}/checkpoint", available_now=True
        ).awaitTermination()
    return latest.current_latest(spark, f"{target}/latest").select("uri", "event_id", "action")


@query
def indexable_by_rdf(spark, sf) -> DataFrame:
    kept = routing.indexable_by_rdf(views.events(spark, sf), views.triples(spark, sf))
    return kept.select("event_id", "uri")


@query
def with_transformation(spark, sf) -> DataFrame:
    facts = routing.resource_facts(views.triples(spark, sf))
    return routing.with_transformation(facts, views.DEFAULT).select(
        "uri", "rdf_indexable", "transformation"
    )


@query
def not_self_transform(spark, sf) -> DataFrame:
    facts = routing.resource_facts(views.triples(spark, sf))
    found = routing.with_transformation(facts, views.DEFAULT)
    return routing.not_self_transform(found).select("uri", "transformation")


@query
def has_transformation(spark, sf) -> DataFrame:
    facts = routing.resource_facts(views.triples(spark, sf))
    named = facts.withColumnRenamed("own_transformation", "transformation")
    return routing.has_transformation(named).select("uri", "transformation")


def _latest_updates(spark, sf):
    latest = routing.latest_per_uri(_triplestore_actions(spark, sf, False))
    return latest.filter(F.col("action") == routing.UPDATE)


@query
def enrich_with_resource(spark, sf) -> DataFrame:
    rows = routing.enrich_with_resource(_latest_updates(spark, sf), views.triples(spark, sf))
    return rows.select("uri", "event_id", "subject", "predicate", "object")


@query
def missing_resources(spark, sf) -> DataFrame:
    letters = routing.missing_resources(
        _latest_updates(spark, sf), views.triples(spark, sf), "triplestore"
    )
    return letters.select("payload", "service", "error")


# --- triples --------------------------------------------------------------------------------


def _text_documents(spark, sf):
    """Every description as one N-Triples text."""
    texts = tr.collect_graph(views.triples(spark, sf), "doc")
    return texts.select(F.col("doc").alias("uri"), "text")


_PARSED = ("doc", "subject", "predicate", "object", "object_kind", "datatype", "lang")


@query
def parse_ntriples(spark, sf) -> DataFrame:
    """Descriptions as N-Triples texts, parsed back."""
    return ntriples_to_triples(_text_documents(spark, sf)).select(*_PARSED)


@query
def read_ntriples_files(spark, sf) -> DataFrame:
    """All triples written as line files and read back through the source."""
    path = work_dir(spark, "ntriples")
    tr.to_ntriples(views.triples(spark, sf)).select("line").write.text(path)
    return read_ntriples(spark, path).select(*_PARSED)


@query
def ntriples_files_in_order(spark, sf) -> DataFrame:
    """Search documents of descriptions whose lines stand in reverse: their first values are
    those that stand first in the files."""
    path = work_dir(spark, "ntriples-order")
    rows = views.triples(spark, sf).repartitionByRange("doc").sortWithinPartitions("doc", F.desc("ord"))
    tr.to_ntriples(rows).select("line").write.text(path)
    return _doc_columns(search.default_search_doc(read_ntriples(spark, path, ordered=True)))


def _xml_documents(spark, sf):
    """Every description as one RDF/XML text."""
    split = r"^(.*[#/])([^#/]+)$"
    name = F.regexp_extract("predicate", split, 2)
    head = F.concat(
        F.lit("<p:"), name, F.lit(' xmlns:p="'), F.regexp_extract("predicate", split, 1), F.lit('"')
    )
    element = F.when(
        F.col("object_kind") == "uri",
        F.concat(head, F.lit(' rdf:resource="'), escape_xml("object"), F.lit('"/>')),
    ).otherwise(
        F.concat(
            head,
            F.lit(' rdf:datatype="'),
            F.col("datatype"),
            F.lit('">'),
            escape_xml("object"),
            F.lit("</p:"),
            name,
            F.lit(">"),
        )
    )
    node = F.concat(
        F.lit('<rdf:Description rdf:about="'), F.col("subject"), F.lit('">'), F.col("inner"),
        F.lit("</rdf:Description>"),
    )
    return (
        views.triples(spark, sf)
        .select("doc", "subject", "ord", element.alias("element"))
        .groupBy("doc", "subject")
        .agg(F.expr("listagg(element, '') within group (order by element)").alias("inner"))
        .select("doc", node.alias("node"))
        .groupBy(F.col("doc").alias("uri"))
        .agg(F.expr("listagg(node, '') within group (order by node)").alias("nodes"))
        .select(
            "uri",
            F.concat(
                F.lit(f'<?xml version="1.0"?><rdf:RDF xmlns:rdf="{vocab.RDF}">'),
                F.col("nodes"),
                F.lit("</rdf:RDF>"),
            ).alias("text"),
        )
    )


@query
def read_triple_snapshot(spark, sf) -> DataFrame:
    """The stored snapshot's buckets of the hinted resources, cut down to those resources."""
    path = work_dir(spark, "snapshot")
    write_triples(views.triples(spark, sf), path, 16)
    hints = views.hints(spark, sf)
    rows = read_triples(spark, path, hints)
    wanted = hints.select(F.col("uri").alias("doc")).distinct()
    return rows.join(wanted, "doc", "left_semi").select("subject", "predicate", "object", "ord")


@query
def unreadable_ntriples(spark, sf) -> DataFrame:
    """Every third line spoilt: what the reader leaves out."""
    lines = tr.to_ntriples(views.triples(spark, sf))
    spoilt = F.when(F.col("ord") % 3 == 0, F.concat(F.lit("broken "), "line")).otherwise(F.col("line"))
    return unreadable_lines(lines.select(spoilt.alias("value"))).select(F.col("value").alias("line"))


@query
def parse_rdfxml(spark, sf) -> DataFrame:
    """Descriptions as RDF/XML texts, parsed back."""
    return rdfxml_to_triples(_xml_documents(spark, sf)).select(*_PARSED)


@query
def rdf_set(spark, sf) -> DataFrame:
    rows = views.triples(spark, sf)
    twice = rows.unionByName(rows.withColumn("doc", F.lit("elsewhere")))
    return tr.rdf_set(twice).select("subject", "predicate", "object", "object_kind", "datatype")


@query
def collect_graph(spark, sf) -> DataFrame:
    return tr.collect_graph(views.triples(spark, sf), "subject")


@query
def insert_statement(spark, sf) -> DataFrame:
    return tr.insert_statement(views.triples(spark, sf), "subject")


@query
def update_statement(spark, sf) -> DataFrame:
    wanted = tr.apply_prefer(views.triples(spark, sf), omit=[vocab.PREFER_CONTAINMENT])
    rows = routing.enrich_with_resource(_latest_updates(spark, sf), wanted)
    return tr.update_statement(rows)


@query
def update_statement_in_graph(spark, sf) -> DataFrame:
    return tr.update_statement(views.triples(spark, sf), graph=GRAPH)


@query
def update_statement_parts(spark, sf) -> DataFrame:
    """Descriptions in parts of about three lines."""
    return tr.update_statement(views.triples(spark, sf), max_rows=3)


@query
def delete_statement(spark, sf) -> DataFrame:
    actions = _triplestore_actions(spark, sf, True)
    gone = actions.filter(F.col("action") == routing.DELETE)
    return tr.delete_statement(gone).select("event_id", "uri", "statement")


@query
def form_encoded_update(spark, sf) -> DataFrame:
    return tr.form_encoded(tr.update_statement(views.triples(spark, sf))).select("uri", "body")


@query
def apply_prefer(spark, sf) -> DataFrame:
    kept = tr.apply_prefer(views.triples(spark, sf), omit=[vocab.PREFER_CONTAINMENT])
    return kept.select("subject", "predicate", "object")


@query
def match_pattern(spark, sf) -> DataFrame:
    """Related objects of all audit records: ``SELECT ?s ?o WHERE { ?s <object> ?o }``."""
    rows = audit.audit_triples(_audited(spark, sf), EVENT_BASE)
    return tr.match(rows, p=vocab.EVENT_OBJECT).select("subject", "object")


@query
def count_by_subject(spark, sf) -> DataFrame:
    return tr.count_by_subject(views.triples(spark, sf))


@query
def named_graph(spark, sf) -> DataFrame:
    rows = views.triples(spark, sf)
    both = tr.in_named_graph(rows, GRAPH).unionByName(tr.in_named_graph(rows, ""))
    return both.groupBy("graph", "subject").agg(F.count(F.lit(1)).alias("n"))


@query
def containment_edges(spark, sf) -> DataFrame:
    return tr.containment_edges(views.triples(spark, sf))


@query
def containment_edges_from_lines(spark, sf) -> DataFrame:
    lines = tr.to_ntriples(views.triples(spark, sf)).select(F.col("line").alias("value"))
    return tr.containment_edges_from_lines(lines)


# --- search documents -----------------------------------------------------------------------


def brief():
    """A transform that keeps only the identifier and the last change."""
    empty = F.lit("")
    return {"rdftype": F.array().cast("array<string>"), "contains": empty, "created": empty}


def _transforms():
    return {BRIEF: brief()}


def _doc_columns(docs):
    return docs.select(
        "id", _text("rdftype").alias("rdftype"), "contains", "lastmodified", "created"
    )


@query
def search_doc(spark, sf) -> DataFrame:
    return _doc_columns(search.default_search_doc(views.triples(spark, sf)))


@query
def search_add_command(spark, sf) -> DataFrame:
    docs = search.default_search_doc(views.triples(spark, sf))
    return search.search_add_command(docs).select("id", "command")


@query
def search_delete_command(spark, sf) -> DataFrame:
    actions = _search_actions(spark, sf, True, True)
    gone = actions.filter(F.col("action") == routing.DELETE)
    return search.search_delete_command(gone).select("event_id", "command")


def _named_transforms(spark, sf):
    facts = routing.resource_facts(views.triples(spark, sf))
    named = routing.with_transformation(facts, views.DEFAULT)
    return routing.not_self_transform(named).select("uri", "transformation")


@query
def apply_transforms(spark, sf) -> DataFrame:
    docs = search.apply_transforms(
        _named_transforms(spark, sf), views.triples(spark, sf), _transforms()
    )
    return docs.select(
        "id", "transformation", _text("rdftype").alias("rdftype"), "contains", "lastmodified", "created"
    )


@query
def unknown_transforms(spark, sf) -> DataFrame:
    letters = search.unknown_transforms(_named_transforms(spark, sf), _transforms())
    return letters.select("payload", "service", "error")


# --- indexes --------------------------------------------------------------------------------


def _late_hints(spark, sf):
    return views.hints(spark, sf).withColumn("ts", F.lit(HINT_TIME).cast("timestamp"))


def _snapshot(spark, sf, target):
    """The descriptions as a stored snapshot, as the services read them."""
    write_triples(views.triples(spark, sf), f"{target}/snapshot", 16)
    return read_triples(spark, f"{target}/snapshot")


def _load_stale_triples(snapshot, target):
    """What an index may hold before: old titles, all else as described."""
    old = F.when(F.col("predicate") == vocab.TITLE, "old title").otherwise(F.col("object"))
    state.load_triples(snapshot.withColumn("object", old), f"{target}/triplestore", BUCKETS)


#: Buckets of the indexes over the sample tables.
BUCKETS = 16
_INDEX = ("subject", "predicate", "object", "object_kind", "datatype")


def _settings(target, **options):
    return Options(
        target=target,
        triplestore_containers=AUDIT_CONTAINER,
        search_containers=AUDIT_CONTAINER,
        audit_containers=AUDIT_CONTAINER,
        forward_containers=AUDIT_CONTAINER,
        index_buckets=BUCKETS,
        **options,
    )


def _updated_triple_index(spark, sf, target):
    """A loaded index after one batch of events and hints."""
    snapshot = _snapshot(spark, sf, target)
    _load_stale_triples(snapshot, target)
    inputs = views.events(spark, sf), _late_hints(spark, sf), snapshot
    triplestore_step(*inputs, _settings(target))
    return f"{target}/triplestore"


@query
def triple_index_state(spark, sf) -> DataFrame:
    index = _updated_triple_index(spark, sf, work_dir(spark, "triple-index"))
    return state.current_triples(spark, index).select(*_INDEX)


def _load_stale_docs(snapshot, target):
    rows = tr.apply_prefer(snapshot, omit=[vocab.PREFER_CONTAINMENT])
    stale = search.default_search_doc(rows).withColumn("lastmodified", F.lit("long ago"))
    state.load_docs(stale, f"{target}/search", BUCKETS)


@query
def search_index_state(spark, sf) -> DataFrame:
    """A loaded search index after one batch of events and hints."""
    target = work_dir(spark, "search-index")
    snapshot = _snapshot(spark, sf, target)
    _load_stale_docs(snapshot, target)
    inputs = views.events(spark, sf), _late_hints(spark, sf), snapshot
    search_step(*inputs, _settings(target, transforms=_transforms()))
    return _doc_columns(state.current_docs(spark, f"{target}/search"))


@query
def missing_in_search(spark, sf) -> DataFrame:
    """Dead letters of the same batch: resources nobody describes."""
    target = work_dir(spark, "search-missing")
    inputs = views.events(spark, sf), views.hints(spark, sf), _snapshot(spark, sf, target)
    search_step(*inputs, _settings(target, transforms=_transforms()))
    letters = delivery.read_dead_letters(spark, f"{target}/dead/search")
    return letters.select("payload", "service", "error")


@query
def compacted_triple_index(spark, sf) -> DataFrame:
    """The same index folded into a new base: the state must not change."""
    index = _updated_triple_index(spark, sf, work_dir(spark, "compacted-index"))
    state.compact_triples(spark, index, BUCKETS)
    return state.current_triples(spark, index).select(*_INDEX)


@query
def compacted_during_stream(spark, sf) -> DataFrame:
    """Three batches, a new base after the second: the state is that of one batch."""
    target = work_dir(spark, "compacted-stream")
    snapshot = _snapshot(spark, sf, target)
    _load_stale_triples(snapshot, target)
    third = F.regexp_extract("event_id", "([0-9]+)$", 1).cast("long") % 3
    for batch in range(3):
        rows = views.events(spark, sf).filter(third == batch)
        hints = _late_hints(spark, sf) if batch == 1 else None
        triplestore_step(rows, hints, snapshot, _settings(target, compact_every=1), batch)
    return state.current_triples(spark, f"{target}/triplestore").select(*_INDEX)


@query
def triple_index_lookup(spark, sf) -> DataFrame:
    """What the index says about the hinted resources."""
    index = _updated_triple_index(spark, sf, work_dir(spark, "index-lookup"))
    return state.current_triples(spark, index, views.hints(spark, sf)).select(*_INDEX)


@query
def triple_index_lookup_pruned(spark, sf) -> DataFrame:
    """The same look-up in an index whose log has been folded and that has moved on since: half
    of the events are in the base, half in the log, old generations are gone."""
    target = work_dir(spark, "pruned-lookup")
    snapshot = _snapshot(spark, sf, target)
    _load_stale_triples(snapshot, target)
    half = F.regexp_extract("event_id", "([0-9]+)$", 1).cast("long") % 2
    settings = _settings(target, compact_every=1, keep_generations=1)
    for batch in (0, 1):
        triplestore_step(views.events(spark, sf).filter(half == batch), None, snapshot, settings, batch)
    triplestore_step(
        views.events(spark, sf).limit(0), _late_hints(spark, sf), snapshot, _settings(target), 2
    )
    return state.current_triples(spark, f"{target}/triplestore", views.hints(spark, sf)).select(*_INDEX)


@query
def triplestore_actions_from_facts(spark, sf) -> DataFrame:
    """Decisions on events and hints by facts that the service for them keeps: loaded from half of
    the descriptions, brought up to date by the events, read without any triples."""
    target = work_dir(spark, "facts")
    snapshot = _snapshot(spark, sf, target)
    state.load_facts(snapshot.filter(F.length("doc") % 2 == 0), f"{target}/facts", BUCKETS)
    _run_service(spark, sf, "facts", target, hints=False)
    facts = state.current_facts(spark, f"{target}/facts")
    hints = _late_hints(spark, sf)
    actions = routing.triplestore_actions(views.events(spark, sf), hints, None, True, AUDIT_CONTAINER, facts)
    return actions.select("event_id", "uri", "action")


@query
def compacted_search_index(spark, sf) -> DataFrame:
    """The search index folded into a new base: the state must not change."""
    target = work_dir(spark, "compacted-search")
    snapshot = _snapshot(spark, sf, target)
    _load_stale_docs(snapshot, target)
    inputs = views.events(spark, sf), _late_hints(spark, sf), snapshot
    search_step(*inputs, _settings(target, transforms=_transforms()))
    state.compact_docs(spark, f"{target}/search", BUCKETS)
    return _doc_columns(state.current_docs(spark, f"{target}/search"))


@query
def clear_graph(spark, sf) -> DataFrame:
    """An index of two graphs with one of them emptied."""
    target = work_dir(spark, "cleared-index")
    rows = views.triples(spark, sf)
    both = tr.in_named_graph(rows, GRAPH).unionByName(tr.in_named_graph(rows, None))
    state.load_triples(both, target, BUCKETS)
    state.clear(spark, target, GRAPH)
    return state.current_triples(spark, target).select("graph", *_INDEX)


def _stream(spark, sf, name):
    """A sample table as a file stream."""
    reader = spark.readStream.schema(views.SCHEMAS[name]).option("pathGlobFilter", f"{name}.parquet")
    return reader.parquet(sf)


def _streams(spark, sf):
    events = views.from_text(
        spark.sql(views.SQL["repo_events"], events=_stream(spark, sf, "events"))
    )
    hints = spark.sql(views.SQL["repo_hints"], supplier=_stream(spark, sf, "supplier"))
    return events, hints


def _run_service(spark, sf, name, target, hints=True, **options):
    events, hint_stream = _streams(spark, sf)
    inputs = Inputs(
        events=events,
        hints=hint_stream if hints else None,
        triples=lambda uris: read_triples(spark, f"{target}/snapshot", uris),
    )
    settings = _settings(target, **{f"{name}_enabled": True}, **options)
    start = build_services(inputs, settings)[name]
    start(f"{target}/checkpoint-{name}", available_now=True).awaitTermination()


@query
def triple_index_stream(spark, sf) -> DataFrame:
    """The triple index kept by the running service, from a loaded start."""
    target = work_dir(spark, "triple-stream")
    _load_stale_triples(_snapshot(spark, sf, target), target)
    _run_service(spark, sf, "triplestore", target)
    return state.current_triples(spark, f"{target}/triplestore").select(*_INDEX)


@query
def search_index_stream(spark, sf) -> DataFrame:
    """The search index kept by the running service, from a loaded start."""
    target = work_dir(spark, "search-stream")
    _load_stale_docs(_snapshot(spark, sf, target), target)
    _run_service(spark, sf, "search", target, transforms=_transforms())
    return _doc_columns(state.current_docs(spark, f"{target}/search"))


@query
def audit_stream(spark, sf) -> DataFrame:
    target = work_dir(spark, "audit-stream")
    _run_service(spark, sf, "audit", target, hints=False, event_base_uri=EVENT_BASE)
    return state.current_audit(spark, f"{target}/audit").select(*_INDEX)


@query
def audit_replay(spark, sf) -> DataFrame:
    """All events delivered three times, the second time after the log was folded: the index is
    read as it lies, without telling repeats apart."""
    target = work_dir(spark, "audit-replay")
    events = views.events(spark, sf)
    for batch in range(3):
        state.append_audit(events, target, EVENT_BASE, AUDIT_CONTAINER, batch)
        if batch == 0:
            state.compact_audit(spark, target, BUCKETS)
    return state.current_audit(spark, target).select(*_INDEX)


@query
def forward_stream(spark, sf) -> DataFrame:
    """Messages of events and hints delivered by the running service, as (message, n)."""
    target = work_dir(spark, "forward-stream")
    _run_service(spark, sf, "forward", target, forward_url=f"{target}/sent")
    return _sent(spark, f"{target}/sent")


# --- hierarchy ------------------------------------------------------------------------------


@query
def traverse(spark, sf) -> DataFrame:
    """From the top and from every region."""
    edges = views.view(spark, sf, "repo_edges")
    top = edges.filter(F.col("parent") == BASE)
    roots = top.select(F.col("child").alias("uri")).unionByName(
        top.select(F.col("parent").alias("uri"))
    )
    return hierarchy.traverse(edges, roots)


def _changed_edges(spark, sf):
    """An edge table that knew half of the children and some that are gone, after the service
    for it has seen all events and hints."""
    target = work_dir(spark, "edges")
    snapshot = _snapshot(spark, sf, target)
    known = tr.containment_edges(snapshot)
    old = known.filter(F.length("child") % 2 == 0).unionByName(
        known.select("parent", F.concat("parent", F.lit("/gone")).alias("child"))
    )
    edges.load_edges(old, f"{target}/edges", BUCKETS)
    _run_service(spark, sf, "edges", target, edges_containers=AUDIT_CONTAINER)
    return f"{target}/edges"


@query
def edges_after_changes(spark, sf) -> DataFrame:
    return edges.current_edges(spark, _changed_edges(spark, sf))


@query
def traverse_after_changes(spark, sf) -> DataFrame:
    """From every resource that contains something, over the table that changes keep."""
    table = _changed_edges(spark, sf)
    roots = edges.current_edges(spark, table).select(F.col("parent").alias("uri"))
    return hierarchy.traverse(edges.edges_of(spark, table), roots)


def _requests(spark, sf):
    return views.view(spark, sf, "repo_requests")


@query
def merge_recipients(spark, sf) -> DataFrame:
    merged = hierarchy.merge_recipients(_requests(spark, sf))
    return merged.select("request_id", F.col("recipients_text").alias("recipients"))


@query
def admit_requests(spark, sf) -> DataFrame:
    return hierarchy.admit_requests(_requests(spark, sf), BASE).select(
        "request_id", "uri", F.col("status").cast("long").alias("status"), "message", "admitted"
    )


@query
def read_request_files(spark, sf) -> DataFrame:
    """Requests written as JSON lines and read back through the source."""
    path = work_dir(spark, "requests")
    _requests(spark, sf).write.json(path)
    return read_reindex_requests(spark, path)


@query
def reindex_fanout(spark, sf) -> DataFrame:
    edges = views.view(spark, sf, "repo_edges")
    return hierarchy.reindex(_requests(spark, sf), edges, BASE)


@query
def reindex_stream(spark, sf) -> DataFrame:
    """Hints that the running service writes, walking over stored edges."""
    target = work_dir(spark, "reindex-stream")
    _requests(spark, sf).write.json(f"{target}/in")
    write_edges(views.view(spark, sf, "repo_edges"), f"{target}/edges", 16)
    inputs = Inputs(
        requests=read_reindex_requests(spark, f"{target}/in", True),
        edges=lambda parents: read_edges(spark, f"{target}/edges", parents),
    )
    start = build_services(inputs, Options(target=target, base_url=BASE))["reindexing"]
    start(f"{target}/checkpoint", available_now=True).awaitTermination()
    reader = spark.read.schema(
        "request_id string, uri string, depth int, writer string, batch long, recipient string"
    )
    return reader.json(f"{target}/hints").select("request_id", "uri", "recipient", "depth")


# --- fixity ---------------------------------------------------------------------------------


def _binary_kinds(rows):
    return rows.select(
        F.lit(vocab.RDF_TYPE).alias("predicate"),
        F.col("resource_type").alias("object"),
        F.col("uri").alias("doc"),
    )


def _fixity(spark, sf, **options):
    rows = views.view(spark, sf, "repo_binaries")
    checked = fixity.only_binaries(rows.select("uri"), _binary_kinds(rows))
    manifest = rows.filter("recorded").select(
        "uri",
        F.concat(F.lit("urn:sha-256:"), F.sha2("recorded_text", 256)).alias("digest"),
        F.col("n_chars").alias("size"),
    )
    content = rows.select("uri", F.col("text").alias("content"))
    return fixity.verify_fixity(
        content, manifest, "sha-256", F.length("content"), only=checked, **options
    )


@query
def only_binaries(spark, sf) -> DataFrame:
    rows = views.view(spark, sf, "repo_binaries")
    return fixity.only_binaries(rows.select("uri", "n_chars"), _binary_kinds(rows))


@query
def verify_fixity_late(spark, sf) -> DataFrame:
    """The plan that digests first and joins digests only."""
    return _fixity(spark, sf, late=True)


@query
def verify_fixity(spark, sf) -> DataFrame:
    return _fixity(spark, sf)


@query
def split_fixity(spark, sf) -> DataFrame:
    good, bad = fixity.split_fixity(_fixity(spark, sf))
    return good.select("uri", F.lit("success").alias("branch")).unionByName(
        bad.select("uri", F.lit("failure").alias("branch"))
    )


@query
def fixity_report(spark, sf) -> DataFrame:
    return fixity.fixity_report(fixity.report_triples(_fixity(spark, sf)))


@query
def fixity_failures(spark, sf) -> DataFrame:
    """The failure log written by the sink, read back."""
    target = work_dir(spark, "fixity")
    results = _fixity(spark, sf)
    delivery.fixity_sinks(results, target)
    reader = spark.read.schema(results.schema).option("recursiveFileLookup", "true")
    return reader.json(target).select("uri", "actual_digest", "outcome")


@query
def fixity_stream(spark, sf) -> DataFrame:
    """Results that the running service writes for a stream of uris."""
    target = work_dir(spark, "fixity-stream")
    rows = views.view(spark, sf, "repo_binaries")
    rows.select("uri").write.json(f"{target}/in")
    manifest = rows.filter("recorded").select(
        "uri",
        F.concat(F.lit("urn:sha-256:"), F.sha2("recorded_text", 256)).alias("digest"),
        F.octet_length("text").alias("size"),
    )
    content = rows.select("uri", F.col("text").cast("binary").alias("content"))
    inputs = Inputs(
        checks=read_hints(spark, f"{target}/in", True),
        triples=lambda uris: _binary_kinds(rows),
        binaries=lambda uris: content.join(uris.select("uri"), "uri", "left_semi"),
        manifest=lambda: manifest,
    )
    settings = Options(target=target, fixity_enabled=True, reindexing_enabled=False)
    start = build_services(inputs, settings)["fixity"]
    start(f"{target}/checkpoint", available_now=True).awaitTermination()
    reader = spark.read.option("recursiveFileLookup", "true").schema(fixity.RESULT)
    return reader.parquet(f"{target}/fixity/results")


# --- forwarding -----------------------------------------------------------------------------


def _messages(spark, sf):
    return forwarding.forward_input(
        views.events(spark, sf), views.hints(spark, sf), CONTAINERS
    )


@query
def forward_message(spark, sf) -> DataFrame:
    return _messages(spark, sf).select("event_id", "uri", "forward_type", "message")


def _sent(spark, path):
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return lines.groupBy(F.col("value").alias("message")).agg(F.count(F.lit(1)).alias("n"))


@query
def forward_delivery(spark, sf) -> DataFrame:
    """Messages delivered to a folder, read back as (message, n)."""
    target = work_dir(spark, "forward")
    delivery.forward(_messages(spark, sf), target, endpoint=f"{target}/sent")
    return _sent(spark, f"{target}/sent")


@query
def forward_without_endpoint(spark, sf) -> DataFrame:
    """Nothing configured: nothing sent, every message a dead letter."""
    target = work_dir(spark, "forward-dead")
    delivery.forward(_messages(spark, sf), target)
    letters = delivery.read_dead_letters(spark, f"{target}/dead")
    return letters.groupBy("payload", "error").agg(F.count(F.lit(1)).alias("n"))


@query
def redelivered_later(spark, sf) -> DataFrame:
    """Messages to a folder that is not there yet: two attempts fail, one before its time is not
    made, and the third, after the folder has appeared, arrives: (message, attempts, n)."""
    target = work_dir(spark, "redelivery")
    inbox, how = f"{target}/inbox", delivery.Redelivery(pause=60, limit=5)
    drop = delivery.FileDrop(inbox, delivery.SHELVES)
    delivery.forward(_messages(spark, sf), target, drop, redelivery=how)
    for now in ("2100-01-01 00:00:00", "2100-01-01 00:01:00"):
        delivery.redeliver(spark, target, drop, how, now)
    spark.range(0).select(F.lit("").alias("value")).write.text(inbox)
    delivery.redeliver(spark, target, drop, how, "2100-01-01 00:02:00")
    arrived = delivery.dropped(spark, drop).groupBy("message").count()
    made = delivery.redelivered(spark, target).filter(F.col("error").isNull())
    made = made.groupBy("message").agg(F.max("attempts").cast("long").alias("attempts"))
    return arrived.join(made, "message").select("message", "attempts", F.col("count").alias("n"))


class FlakyReceiver:
    """Fails as often as the last digit of the uri says; from 4 on it never accepts."""

    def __init__(self):
        self.failures = {}

    def __call__(self, payload):
        wanted = int(payload.split('"')[3][-1])
        so_far = self.failures.get(payload, 0)
        if wanted >= 4:
            raise ConnectionError("refused")
        if so_far < wanted:
            self.failures[payload] = so_far + 1
            raise ConnectionError("busy")
        self.failures[payload] = 0


@query
def retry_dead_letters(spark, sf) -> DataFrame:
    """Redelivery up to three times: (message, attempts, error, n)."""
    target = work_dir(spark, "retry")
    delivery.forward(_messages(spark, sf), target, FlakyReceiver(), max_redeliveries=3)
    outcome = spark.read.schema("message string, attempts int, error string").option(
        "recursiveFileLookup", "true"
    )
    return (
        outcome.parquet(f"{target}/outcome")
        .groupBy("message", F.col("attempts").cast("long").alias("attempts"), "error")
        .agg(F.count(F.lit(1)).alias("n"))
    )
