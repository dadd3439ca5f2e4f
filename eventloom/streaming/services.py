"""The continuous services: each consumes a stream batch by batch and maintains its target."""

import hashlib
import time
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from eventloom import vocab
from eventloom.functions import form_encode, join_numbered
from eventloom.operators import fixity, forwarding, hierarchy, routing, search
from eventloom.operators.audit import audit_input, audit_insert_statement, unaudited_events
from eventloom.operators.events import listed, merge_live_and_hints
from eventloom.operators.triples import apply_prefer
from eventloom.options import Options, enabled_services
from eventloom.streaming import changelog, delivery, edges, state


@dataclass
class Inputs:
    """What the services read.

    Streams: ``events``, ``hints``, ``checks`` (uris to verify), ``requests``. Current
    snapshots, as functions so that every batch sees the latest: ``triples(uris)``, which may
    leave out other documents (see ``sources.read_triples``), ``edges(parents)`` (without it the
    walk takes the edge table that the service ``edges`` keeps), ``binaries(uris)``
    (uri, content) or (uri, path), of which only the asked-for ones are read, ``manifest()``
    (uri, digest, size). Rows of a stream that hold an unreadable body in ``reject`` (see
    ``sources.parse_events``) become dead letters of the service.
    """

    events: DataFrame | None = None
    hints: DataFrame | None = None
    checks: DataFrame | None = None
    requests: DataFrame | None = None
    triples: Callable[[DataFrame], DataFrame] | None = None
    edges: Callable[[DataFrame], DataFrame] | None = None
    binaries: Callable[[DataFrame], DataFrame] | None = None
    manifest: Callable[[], DataFrame] | None = None


def _live_input(inputs: Inputs) -> DataFrame:
    """Events and hints as one stream; a hint counts from when it is seen."""
    if inputs.hints is None:
        return inputs.events.withColumn("from_hint", F.lit(False))
    stamped = inputs.hints.select("uri", F.current_timestamp().alias("ts"))
    return merge_live_and_hints(inputs.events, stamped)


def _parts(batch: DataFrame):
    """(events, hints) of a batch of the live input."""
    return (
        batch.filter(~F.col("from_hint")).drop("from_hint"),
        batch.filter("from_hint").select("uri", "ts"),
    )


def _for_batch(triples: DataFrame, events: DataFrame, hints: DataFrame | None):
    """The descriptions a batch asks for, kept while it runs, so that they are read once.

    Adaptive execution broadcasts the batch's uris if they are few bytes.
    """
    uris = events.select("uri")
    if hints is not None:
        uris = uris.unionByName(hints.select("uri"))
    uris = uris.distinct().withColumnRenamed("uri", "doc")
    return join_numbered(triples, uris, "doc", "left_semi")


@contextmanager
def kept(*frames):
    """Persist frames for a while; they go whatever happens."""
    held = [f.persist() for f in frames]
    try:
        yield held if len(held) > 1 else held[0]
    finally:
        for f in held:
            f.unpersist()


def _accepted(batch: DataFrame, options: Options, service: str, batch_id, writer) -> DataFrame:
    """The readable rows of a batch; unreadable ones are written as dead letters."""
    if "reject" not in batch.columns:
        return batch
    bad = batch.filter(F.col("reject").isNotNull())
    letters = bad.select(
        F.col("reject").alias("payload"),
        F.lit(service).alias("service"),
        F.lit(1).alias("attempts"),
        F.lit("unreadable event").alias("error"),
        F.current_timestamp().alias("failed_at"),
    )
    folder = f"{options.target}/dead/{service}-input"
    delivery.write_dead_letters(letters, folder, batch_id, writer)
    return batch.filter(F.col("reject").isNull()).drop("reject")


_FORM = "application/x-www-form-urlencoded; charset=utf-8"


def _transport(options: Options, name: str, content_type: str, kind="", path=""):
    """The transport given for a service, else one posting to its url, else none."""
    given = options.transports.get(kind or name)
    url = getattr(options, f"{name}_url")
    if given is not None or not url.startswith("http"):
        return given
    username, password = (getattr(options, f"{name}_{x}") for x in ("username", "password"))
    return delivery.HttpPost(url + path, username, password, content_type)


def _redelivery(options: Options, target: str, transport, spark, service: str):
    """How failures wait, if they do; what is due from earlier batches is sent first."""
    if not options.redelivery_queue:
        return None
    how = delivery.Redelivery(options.redelivery_pause / 1000, 2.0, options.max_redeliveries)
    if transport is not None:
        try:
            delivery.redeliver(spark, target, transport, how, None, service, options.keep_generations)
        except changelog.BaseMoved:
            pass
    return how


def _send(messages, transport, options: Options, name: str, batch_id, writer, group=None, order=None):
    """Deliver a batch's messages; outcome and dead letters go under the service's folder."""
    target = f"{options.target}/sent/{name}"
    delivery.forward(
        messages,
        target,
        transport,
        None,
        options.max_redeliveries,
        options.redelivery_delay / 1000,
        batch_id=batch_id,
        writer=writer,
        service=name,
        group=group,
        order=order,
        redelivery=_redelivery(options, target, transport, messages.sparkSession, name),
    )


def _preferences(options: Options):
    """(omit, include) as far as their predicates are known; a preference is a wish, and one
    that nobody can read is passed over."""
    groups = options.prefer_groups
    named = listed(options.prefer_omit), listed(options.prefer_include)
    if isinstance(groups, DataFrame):
        return named
    known = {*vocab.PREFER_GROUPS, *(groups or {})}
    return tuple([name for name in names if name in known] for names in named)


def _compact(compact, spark, target, options: Options, batch_id) -> None:
    """Fold an index's log if it is time; somebody else's new base is as good."""
    if options.compact_every and batch_id and batch_id % options.compact_every == 0:
        try:
            compact(spark, target, options.index_buckets, options.keep_generations)
        except changelog.BaseMoved:
            pass


def triplestore_step(events, hints, triples, options: Options, batch_id=0, writer="main"):
    """Decide and apply one batch for the triple index; actions are worked out once.

    Another triplestore, if configured, gets the batch as update statements, the parts of one
    resource in order.
    """
    with kept(_for_batch(triples, events, hints)) as triples, kept(
        state.stamped(routing.triplestore_actions(
            events,
            hints,
            triples,
            options.triplestore_require_indexable,
            options.triplestore_containers,
        ))
    ) as actions:
        graph = options.named_graph
        prefer = _preferences(options)
        groups = options.prefer_groups
        target = f"{options.target}/triplestore"
        state.maintain_triple_index(
            actions, triples, target, graph, *prefer, batch_id, writer, groups
        )
        transport = _transport(options, "triplestore", _FORM)
        if transport is not None:
            messages = state.triple_messages(actions, triples, graph, *prefer, groups)
            _send(messages, transport, options, "triplestore", batch_id, writer, "uri", "part")
        _report_missing(actions, triples, options, "triplestore", batch_id, writer)
        _compact(state.compact_triples, events.sparkSession, target, options, batch_id)


def search_step(events, hints, triples, options: Options, batch_id=0, writer="main"):
    """Decide and apply one batch for the search index; actions are worked out once.

    A search server, if configured, gets the batch as add and delete commands.
    """
    if not options.include_containment:
        triples = apply_prefer(triples, omit=[vocab.PREFER_CONTAINMENT])
    with kept(_for_batch(triples, events, hints)) as triples, kept(
        state.stamped(routing.search_actions(
            events,
            hints,
            triples,
            options.default_transform,
            options.search_require_indexable,
            options.check_transformation,
            options.search_containers,
        ))
    ) as actions:
        todo = routing.applicable(actions)
        updates = todo.filter(F.col("action") == routing.UPDATE).select("uri", "transformation")
        with kept(updates.distinct()) as updates, kept(
            search.apply_transforms(updates, triples, options.transforms)
        ) as docs:
            target = f"{options.target}/search"
            state.maintain_search_index(todo, docs, target, batch_id, writer)
            path = f"/update?commitWithin={options.commit_within}"
            kinds = (("search-add", "text/xml"), ("search-delete", "application/json"))
            for messages, (name, content_type) in zip(state.doc_messages(todo, docs), kinds):
                transport = _transport(options, "search", content_type, name, path)
                if transport is not None:
                    _send(messages, transport, options, name, batch_id, writer)
            unknown = search.unknown_transforms(updates, options.transforms)
            folder = f"{options.target}/dead/search-transforms"
            delivery.write_dead_letters(unknown, folder, batch_id, writer)
        _report_missing(actions, triples, options, "search", batch_id, writer)
        _compact(state.compact_docs, events.sparkSession, target, options, batch_id)


def edges_step(events, hints, triples, options: Options, batch_id=0, writer="main"):
    """Apply one batch to the edge table under ``target``/edges, whatever the indexers leave out."""
    with kept(_for_batch(triples, events, hints)) as triples, kept(
        state.stamped(
            routing.triplestore_actions(events, hints, triples, False, options.edges_containers)
        )
    ) as actions:
        target = f"{options.target}/edges"
        edges.maintain_edges(actions, triples, target, batch_id, writer)
        _compact(edges.compact_edges, events.sparkSession, target, options, batch_id)


def facts_step(events, hints, triples, options: Options, batch_id=0, writer="main"):
    """Apply one batch to the facts under ``target``/facts."""
    with kept(_for_batch(triples, events, hints)) as triples, kept(
        state.stamped(routing.triplestore_actions(events, hints, triples, False))
    ) as actions:
        target = f"{options.target}/facts"
        state.maintain_facts(actions, triples, target, batch_id, writer)
        _compact(state.compact_facts, events.sparkSession, target, options, batch_id)


def _report_missing(actions, triples, options, service, batch_id, writer):
    lookups = actions.filter(F.col("action") != routing.DELETE).select("uri").distinct()
    letters = routing.missing_resources(lookups, triples, service)
    delivery.write_dead_letters(letters, f"{options.target}/dead/{service}", batch_id, writer)


def triplestore_batch(inputs: Inputs, options: Options, writer: str):
    def run(batch: DataFrame, batch_id: int):
        rows = _accepted(batch, options, "triplestore", batch_id, writer)
        triples = inputs.triples(rows.select("uri").distinct())
        triplestore_step(*_parts(rows), triples, options, batch_id, writer)

    return run


def edges_batch(inputs: Inputs, options: Options, writer: str):
    def run(batch: DataFrame, batch_id: int):
        rows = _accepted(batch, options, "edges", batch_id, writer)
        triples = inputs.triples(rows.select("uri").distinct())
        edges_step(*_parts(rows), triples, options, batch_id, writer)

    return run


def facts_batch(inputs: Inputs, options: Options, writer: str):
    def run(batch: DataFrame, batch_id: int):
        rows = _accepted(batch, options, "facts", batch_id, writer)
        triples = inputs.triples(rows.select("uri").distinct())
        facts_step(*_parts(rows), triples, options, batch_id, writer)

    return run


def search_batch(inputs: Inputs, options: Options, writer: str):
    def run(batch: DataFrame, batch_id: int):
        rows = _accepted(batch, options, "search", batch_id, writer)
        triples = inputs.triples(rows.select("uri").distinct())
        search_step(*_parts(rows), triples, options, batch_id, writer)

    return run


def audit_batch(inputs: Inputs, options: Options, writer: str):
    def run(batch: DataFrame, batch_id: int):
        rows = _accepted(batch, options, "audit", batch_id, writer)
        state.append_audit(
            rows,
            f"{options.target}/audit",
            options.event_base_uri,
            options.audit_containers,
            batch_id,
            writer,
        )
        transport = _transport(options, "audit", _FORM)
        if transport is not None:
            audited = audit_input(rows, options.audit_containers)
            statements = audit_insert_statement(audited, options.event_base_uri)
            messages = statements.select(form_encode("statement").alias("message"))
            _send(messages, transport, options, "audit", batch_id, writer)
        letters = unaudited_events(rows)
        delivery.write_dead_letters(letters, f"{options.target}/dead/audit", batch_id, writer)
        _compact(state.compact_audit, batch.sparkSession, f"{options.target}/audit", options, batch_id)

    return run


def forward_batch(inputs: Inputs, options: Options, writer: str):
    transport = _transport(options, "forward", "application/json")
    endpoint = None if transport else options.forward_url or None

    def run(batch: DataFrame, batch_id: int):
        rows = _accepted(batch, options, "forward", batch_id, writer)
        messages = forwarding.forward_input(
            rows.drop("from_hint"), None, options.forward_containers
        )
        target = f"{options.target}/forward"
        delivery.forward(
            messages,
            target,
            transport,
            endpoint,
            options.max_redeliveries,
            options.redelivery_delay / 1000,
            batch_id=batch_id,
            writer=writer,
            redelivery=_redelivery(options, target, transport, batch.sparkSession, "forward"),
        )

    return run


def fixity_batch(inputs: Inputs, options: Options, writer: str):
    def run(batch: DataFrame, batch_id: int):
        uris = batch.select("uri").distinct()
        checked = fixity.only_binaries(uris, inputs.triples(uris))
        binaries = inputs.binaries(checked)
        results = fixity.verify_fixity(binaries, inputs.manifest(), only=checked)
        folder = f"{options.target}/fixity/results/writer={writer}/batch={batch_id}"
        results.write.mode("overwrite").parquet(folder)
        delivery.fixity_sinks(
            batch.sparkSession.read.schema(results.schema).parquet(folder),
            f"{options.target}/fixity/failures",
            options.on_success,
            options.on_failure,
            batch_id,
            writer,
        )

    return run


def reindexing_batch(inputs: Inputs, options: Options, writer: str):
    def run(batch: DataFrame, batch_id: int):
        links = inputs.edges or edges.edges_of(batch.sparkSession, f"{options.target}/edges")
        hints = hierarchy.reindex(batch, links, options.base_url)
        here = f"{options.target}/hints/writer={writer}/batch={batch_id}"
        hints.write.mode("overwrite").partitionBy("recipient").json(here)
        answers = hierarchy.admit_requests(batch, options.base_url)
        answers.select("request_id", "uri", "status", "message").write.mode("overwrite").json(
            f"{options.target}/answers/writer={writer}/batch={batch_id}"
        )

    return run


_BATCHES = {
    "audit": audit_batch,
    "search": search_batch,
    "triplestore": triplestore_batch,
    "fixity": fixity_batch,
    "forward": forward_batch,
    "reindexing": reindexing_batch,
    "edges": edges_batch,
    "facts": facts_batch,
}


def _stream_of(name: str, inputs: Inputs) -> DataFrame | None:
    if name == "audit":
        # No watermark: late events count, and repeated ones vanish in the audit set.
        return inputs.events
    if name == "fixity":
        return inputs.checks
    if name == "reindexing":
        return inputs.requests
    return None if inputs.events is None else _live_input(inputs)


def _redelivered(run, options: Options):
    """Run a batch on rows read once. If it fails it is run again after a pause, as every batch
    may be repeated; sends have attempts of their own and do not fail a batch. Mistakes in the
    program are not tried again. A batch that keeps failing stops the query rather than losing
    its rows; a restart takes it up again."""

    def attempt(batch: DataFrame, batch_id: int):
        with kept(batch) as rows:
            for left in range(options.max_redeliveries, -1, -1):
                try:
                    return run(rows, batch_id)
                except (TypeError, AttributeError, NameError, KeyError, AnalysisException):
                    raise
                except Exception:
                    if not left:
                        raise
                    time.sleep(options.redelivery_delay / 1000)

    return attempt


def _spaced(run, delay: int):
    """Batches at least ``delay`` milliseconds apart."""
    last = [None]

    def attempt(batch: DataFrame, batch_id: int):
        if last[0] is not None:
            time.sleep(max(0.0, last[0] + delay / 1000 - time.monotonic()))
        last[0] = time.monotonic()
        return run(batch, batch_id)

    return attempt


def build_services(inputs: Inputs, options: Options) -> dict[str, Callable]:
    """Starters of the enabled services that have an input.

    ``starter(checkpoint, available_now=False)`` starts one and returns its query. The commit
    window is the trigger interval of the search service, the fixity delay that of the
    fixity service, whose batches also keep that distance when all is taken at once; the file
    sources take ``maxFilesPerTrigger`` as their throttle.
    """
    intervals = {"search": options.commit_within, "fixity": options.fixity_delay}

    def starter(name, stream):
        def step(writer, available_now):
            run = _BATCHES[name](inputs, options, writer)
            return _spaced(run, options.fixity_delay) if name == "fixity" and available_now else run

        def start(checkpoint: str, available_now: bool = False):
            writer = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
            query = (
                stream.writeStream.queryName(f"{name}-{writer}")
                .option("checkpointLocation", checkpoint)
                .foreachBatch(_redelivered(step(writer, available_now), options))
            )
            if available_now:
                query = query.trigger(availableNow=True)
            elif intervals.get(name):
                query = query.trigger(processingTime=f"{intervals[name]} milliseconds")
            return query.start()

        return start

    streams = {name: _stream_of(name, inputs) for name in enabled_services(options)}
    return {name: starter(name, s) for name, s in streams.items() if s is not None}
