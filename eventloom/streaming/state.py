"""Current-state indexes kept up to date by actions: triples, search documents, audit."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from eventloom import schemas
from eventloom.functions import NUMBER, form_encode, join_numbered, number
from eventloom.operators.audit import audit_input, audit_set, audit_triples, audited_once  # noqa: F401
from eventloom.operators.routing import DELETE, UPDATE, known_facts
from eventloom.operators.search import search_add_command, search_delete_command
from eventloom.operators.triples import (
    apply_prefer,
    delete_statement,
    in_named_graph,
    rdf_set,
    update_statement,
)
from eventloom.schemas import TRIPLE_KEY
from eventloom.streaming import changelog

#: Buckets of a base by default, and the slots that log rows carry (buckets divide them).
BUCKETS = SLOTS = 1_024

_SEQ = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("batch", T.LongType()),
    ]
)
_SLOT = T.StructField("slot", T.IntegerType())
TRIPLE_CHANGE = T.StructType(
    [T.StructField("op", T.StringType()), T.StructField("seq", _SEQ)]
    + [f for f in schemas.TRIPLE.fields if f.name in TRIPLE_KEY]
)
DOC_CHANGE = T.StructType(
    [T.StructField("op", T.StringType()), T.StructField("seq", _SEQ)]
    + list(schemas.SEARCH_DOC.fields)
)
FACT_CHANGE = T.StructType(
    [T.StructField("op", T.StringType()), T.StructField("seq", _SEQ)] + list(schemas.FACTS.fields)
)
AUDIT_CHANGE = T.StructType([f for f in schemas.TRIPLE.fields if f.name in TRIPLE_KEY])


def _slot(key) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SLOTS)).cast("int")


def stamped(actions: DataFrame) -> DataFrame:
    """Actions with a time: an undated one counts from when it is seen. Kept once per batch, all
    that is worked out from the batch orders its actions alike."""
    return actions.withColumn("ts", F.coalesce(F.col("ts").cast("timestamp"), F.current_timestamp()))


def _seq(batch_id):
    """Order of actions: event time (an undated one counts from when it is seen), then id."""
    return F.struct(
        F.coalesce(F.col("ts").cast("timestamp"), F.current_timestamp()).alias("ts"),
        F.col("event_id").cast("string").alias("event_id"),
        F.lit(batch_id).cast("long").alias("batch"),
    )


def write_slotted(changes: DataFrame, key: str, target: str, batch_id: int, writer: str) -> None:
    """A batch of the log with each row's slot, in order of slots within files, so that a look-up
    skips what cannot hold its keys."""
    rows = changes.withColumn("slot", _slot(key)).sortWithinPartitions("slot", key)
    changelog.write_batch(rows, target, batch_id, writer)


def _slots_of(keys: DataFrame) -> list:
    """The slots that keys (one column) can be in: at most ``SLOTS`` numbers."""
    return [r.s for r in keys.select(_slot(F.col(keys.columns[0])).alias("s")).distinct().collect()]


def _log(spark, target, schema, manifest, batches=None, slots=None):
    """The log's rows since the base, with ``slots`` only those in these; None without any."""
    rows = changelog.read_log(spark, target, T.StructType([*schema.fields, _SLOT]), manifest, batches)
    if rows is None:
        return None
    return (rows if slots is None else rows.filter(F.col("slot").isin(slots))).drop("slot")


def _write_base(rows: DataFrame, key: str, manifest, target: str, buckets: int, layout, order) -> str:
    """A new base: folders by ``layout``, files cut by range, so that a bucket or key of any size
    takes as many files as it needs. Folders come first in the order, as the writer wants them: so
    rows are sorted once."""
    base = changelog.new_base(manifest)
    files = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("bucket", _slot(key) % buckets).repartitionByRange(files, "bucket", *order)
    by = [*layout, *[c for c in order if c not in layout]]
    dealt.sortWithinPartitions(*by).write.partitionBy(*layout).parquet(changelog.base_path(target, base))
    return base


def _load(rows: DataFrame, key: str, target: str, buckets: int, layout, order) -> None:
    """Start an index from rows; what has been written before is gone."""
    if SLOTS % buckets:
        raise ValueError(f"buckets must divide {SLOTS}")
    spark = rows.sparkSession
    before = changelog.manifest(spark, target)
    batches = changelog.finished_batches(spark, target, before)
    base = _write_base(rows, key, before, target, buckets, layout, order)
    changelog.publish(
        spark, target, before, parts={base: list(range(buckets))}, buckets=buckets, voids=(),
        covered=changelog.ranges(batches, before.covered),
    )


def _compact(spark, target, schema, key, merge, buckets, layout, order, keep, beside=None) -> None:
    """Fold the log into the base, bucket by bucket: only buckets that the log touches are written
    anew, the others stay where they lie.

    ``merge(base, log)`` gives a bucket's new rows. If a graph was emptied, or the base has no
    buckets, all are written. ``beside(name, before, batches)`` writes what goes with a base.
    """
    before = changelog.manifest(spark, target)
    batches = changelog.finished_batches(spark, target, before)
    log = _log(spark, target, schema, before, batches)
    flat = any(held is None for held in before.parts.values())
    count = before.buckets or buckets
    if log is None and not flat and not before.voids:
        return changelog.expire(spark, target, keep)
    touched = None
    if not flat and not before.voids and before.parts:
        touched = sorted({s % count for s in _slots_of(log.select(key))})
    base = changelog.read_base(spark, target, schema, before, touched)
    if base is None and log is None:
        changelog.publish(spark, target, before, parts={}, voids=())
        return changelog.expire(spark, target, keep)
    rows = merge(None if base is None else base.drop("bucket"), log)
    name = _write_base(rows, key, before, target, count, layout, order)
    fresh = list(range(count)) if touched is None else touched
    parts = {} if touched is None else {
        b: left for b, held in before.parts.items() if (left := sorted(set(held) - set(touched)))
    }
    if beside is not None:
        beside(name, before, batches)
    changelog.publish(
        spark, target, before, parts={**parts, name: fresh}, buckets=count, voids=(),
        covered=changelog.ranges(batches, before.covered),
    )
    changelog.expire(spark, target, keep)


def _last_of_each(actions: DataFrame, batch_id: int) -> DataFrame:
    """(uri, action, seq): the last update and the last delete of each uri, map-side first."""
    return (
        actions.filter(F.col("action").isin(UPDATE, DELETE))
        .groupBy(number("uri"), "uri", "action")
        .agg(F.max(_seq(batch_id)).alias("seq"))
        .drop(NUMBER)
    )


# --- triples --------------------------------------------------------------------------------


def _effective(actions: DataFrame, triples: DataFrame, batch_id: int) -> DataFrame:
    """Last update and last delete of each uri, without updates that find no description."""
    described = triples.select(F.col("doc").alias("uri"), F.lit(True).alias("described"))
    known = join_numbered(_last_of_each(actions, batch_id), described.distinct(), "uri", "left")
    return known.filter((F.col("action") == DELETE) | F.col("described"))


def triple_messages(
    actions: DataFrame, triples: DataFrame, graph=None, omit=(), include=(), groups=None
) -> DataFrame:
    """(uri, part, message): form-post bodies that bring another triplestore up to date.

    One update or delete statement per uri, from its last action; parts as in
    ``update_statement``.
    """
    effective = _effective(actions, triples, 0)
    last = effective.groupBy("uri").agg(F.max_by("action", "seq").alias("action"))
    updates = last.filter(F.col("action") == UPDATE).select(F.col("uri").alias("doc"))
    wanted = apply_prefer(triples, include, omit, groups).join(updates, "doc")
    deletes = delete_statement(last.filter(F.col("action") == DELETE), graph=graph)
    statements = update_statement(wanted, graph).select("uri", "part", "statement")
    deletes = deletes.select("uri", F.lit(0).alias("part"), "statement")
    return statements.unionByName(deletes).select(
        "uri", "part", form_encode("statement").alias("message")
    )


def triple_changes(
    actions: DataFrame,
    triples: DataFrame,
    graph=None,
    omit=(),
    include=(),
    batch_id: int = 0,
    groups=None,
) -> DataFrame:
    """Actions as log rows: ``purge`` of a subject, ``add`` of a triple.

    An update purges what is said about the uri itself and adds its whole description, which
    may hold other subjects; those are only ever added to. Actions are folded per uri first:
    the last purge and the last update decide, because the description is the current one.
    An update without a description does nothing.
    """
    known = _effective(actions, triples, batch_id)
    none = [F.lit(None).cast("string").alias(c) for c in TRIPLE_KEY[2:]]
    purges = known.select(
        F.lit("purge").alias("op"),
        "seq",
        F.lit(graph or None).cast("string").alias("graph"),
        F.col("uri").alias("subject"),
        *none,
    )
    updates = known.filter(F.col("action") == UPDATE).select(F.col("uri").alias("doc"), "seq")
    wanted = in_named_graph(apply_prefer(triples, include, omit, groups), graph)
    adds = join_numbered(wanted, updates, "doc").select(
        F.lit("add").alias("op"), "seq", *TRIPLE_KEY
    )
    return purges.unionByName(adds)


def _home() -> Column:
    return F.concat_ws("\u0001", F.coalesce("graph", F.lit("")), "subject")


def _homed(rows: DataFrame) -> DataFrame:
    """Rows with ``_home`` and a number of it, by which they are sorted before the text."""
    return rows.withColumn("_home", _home()).withColumn("_at", F.xxhash64("_home"))


def _unpurged(adds: DataFrame, purges: DataFrame) -> DataFrame:
    """Added triples (with ``_home``) that no later purge of their subject removes."""
    last = _homed(purges).groupBy("_at", "_home").agg(F.max("seq").alias("_purged"))
    return (
        adds.join(last, ["_at", "_home"], "left")
        .filter(
            F.col("_purged").isNull() | F.coalesce(F.col("seq") >= F.col("_purged"), F.lit(False))
        )
        .drop("_purged")
    )


def fold_triples(changes: DataFrame) -> DataFrame:
    """Current triples: those added no earlier than the last purge of their subject.

    An update's own triples carry the sequence of its purge and so survive it. Equal triples
    meet first, spread by their whole content; the join with the purges comes last, so that
    adaptive execution may broadcast these or split a subject with very many triples.
    """
    adds = _latest(changes.filter(F.col("op") == "add"))
    purges = changes.filter(F.col("op") == "purge")
    return _unpurged(_homed(adds), purges).drop("_home", "_at")


def _latest(rows: DataFrame) -> DataFrame:
    """Each triple once with its last ``seq``; sorted by a number first."""
    return rows.groupBy(number(*TRIPLE_KEY), *TRIPLE_KEY).agg(F.max("seq").alias("seq")).drop(NUMBER)


def _same(left: DataFrame, right: DataFrame) -> Column:
    """Equal triples, of rows with their numbers: texts are compared where numbers are equal."""
    texts = [left[c].eqNullSafe(right[c]) for c in TRIPLE_KEY]
    return reduce(lambda x, y: x & y, texts, left[NUMBER] == right[NUMBER])


def _with_log(base: DataFrame, log: DataFrame) -> tuple:
    """(what is left of the base's triples, what the log adds to them), both with ``seq`` and number.

    The base is folded already: it meets only the log's last purges and added triples, and its
    own purges only the subjects that the log adds to. All these come from the log, so adaptive
    execution broadcasts them while the log is small, and the base is not shuffled. Of a triple
    that both hold, the later addition counts.
    """
    names = [number(*TRIPLE_KEY), *TRIPLE_KEY, "seq"]
    held = _unpurged(_homed(base.filter("op = 'add'")), log.filter("op = 'purge'"))
    fresh = _homed(fold_triples(log))
    homes = fresh.select("_at", "_home").distinct()
    purges = _homed(base.filter("op = 'purge'")).join(homes, ["_at", "_home"], "left_semi")
    purges = purges.drop("_at", "_home")
    return held.select(names), _unpurged(fresh, purges).select(names)


def _merged_triples(base: DataFrame | None, log: DataFrame | None) -> DataFrame:
    """New base rows: triples that count, each once with its latest addition, and the last purge
    of each subject, as an older update may still arrive.

    All rows are written anew anyway, so base and log are folded as one: each row is shuffled to
    its equals and to the purges of its subject, however large the log is."""
    both = reduce(DataFrame.unionByName, [c for c in (base, log) if c is not None])
    purges = _latest(both.filter("op = 'purge'")).select(F.lit("purge").alias("op"), "seq", *TRIPLE_KEY)
    adds = fold_triples(both)
    return adds.select(F.lit("add").alias("op"), "seq", *TRIPLE_KEY).unionByName(purges)


#: A base's folders: kind of row, then graph, then bucket of the subject.
_TRIPLE_LAYOUT = ["op", "graph", "bucket"]
_TRIPLE_ORDER = ["op", "graph", "subject", "predicate", "object"]


def maintain_triple_index(
    actions: DataFrame,
    triples: DataFrame,
    target: str,
    graph=None,
    omit=(),
    include=(),
    batch_id: int = 0,
    writer: str = "main",
    groups=None,
) -> None:
    """Apply one batch of actions to the triple index at ``target``."""
    changes = triple_changes(actions, triples, graph, omit, include, batch_id, groups)
    write_slotted(changes, "subject", target, batch_id, writer)


def load_triples(triples: DataFrame, target: str, buckets: int = BUCKETS) -> None:
    """Start an index from existing triples; any action is later than they are."""
    undated = F.lit(None).cast(_SEQ)
    rows = rdf_set(triples).select(F.lit("add").alias("op"), undated.alias("seq"), *TRIPLE_KEY)
    _load(rows, "subject", target, buckets, _TRIPLE_LAYOUT, _TRIPLE_ORDER)


def current_triples(spark: SparkSession, target: str, subjects=None, at=None) -> DataFrame:
    """The triple index as a table; with ``subjects`` (one column) what is said about these.

    The base lies by graph and bucket of the subject: a look-up reads only the buckets its
    subjects can be in, and of the log the row groups with their slots. Without a log the base is
    the answer as it lies. ``at`` may be a pinned generation (``changelog.pinned``).
    """
    known = at or changelog.manifest(spark, target)
    slots = None if subjects is None else _slots_of(subjects)
    count = known.buckets or 1
    buckets = None if slots is None or not known.buckets else {s % count for s in slots}
    base = changelog.read_base(spark, target, TRIPLE_CHANGE, known, buckets)
    log = _log(spark, target, TRIPLE_CHANGE, known, slots=slots)
    if subjects is not None:
        wanted = subjects.select(F.col(subjects.columns[0]).alias("subject")).distinct()
        base, log = (
            None if rows is None else join_numbered(rows, wanted, "subject", "left_semi") for rows in (base, log)
        )
    if base is None:
        found = fold_triples(spark.createDataFrame([], TRIPLE_CHANGE) if log is None else log)
    elif log is None:
        found = base.filter("op = 'add'")
    else:
        held, fresh = _with_log(base, log)
        found = held.join(fresh, _same(held, fresh), "left_anti").unionByName(fresh)
    return found.select(*TRIPLE_KEY)


def compact_triples(spark: SparkSession, target: str, buckets: int = BUCKETS, keep: int = 2) -> None:
    """Fold the log into the base and remove what the newest ``keep`` generations do not need."""
    _compact(
        spark, target, TRIPLE_CHANGE, "subject", _merged_triples, buckets, _TRIPLE_LAYOUT, _TRIPLE_ORDER, keep
    )


_ALL = object()


def clear(spark: SparkSession, target: str, graph=_ALL) -> None:
    """Empty the index, or one named graph of it (null: the unnamed one).

    Nothing is read or written but a manifest that says so: the graph's folders of the base and
    its rows in the batches written so far are passed over from now on, and go when the log is
    folded next. Batches that come later count.
    """
    before = changelog.manifest(spark, target)
    batches = changelog.finished_batches(spark, target, before)
    now = changelog.ranges(batches, before.covered)
    if graph is _ALL:
        changelog.publish(spark, target, before, parts={}, covered=now, voids=())
    else:
        changelog.publish(spark, target, before, voids=(*before.voids, (graph or None, now)))


# --- search documents -----------------------------------------------------------------------


def doc_changes(actions: DataFrame, docs: DataFrame, batch_id: int = 0) -> DataFrame:
    """Actions as log rows: ``put`` of a document, ``remove`` of an id.

    ``docs`` is (doc, id, …) as the transforms build it. An update without a document
    changes nothing, so the last delete is kept next to the last update.
    """
    last = _last_of_each(actions, batch_id)
    removed = last.filter(F.col("action") == DELETE).select(
        F.lit("remove").alias("op"),
        "seq",
        F.col("uri").alias("id"),
        F.lit(None).cast("array<string>").alias("rdftype"),
        *[F.lit(None).cast("string").alias(c) for c in ("contains", "lastmodified", "created")],
    )
    updated = last.filter(F.col("action") == UPDATE).select(F.col("uri").alias("doc"), "seq")
    put = join_numbered(docs, updated, "doc").select(
        F.lit("put").alias("op"), "seq", *schemas.SEARCH_DOC.fieldNames()
    )
    return removed.unionByName(put)


def doc_messages(actions: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(add commands, delete commands), column ``message``: the last change of each id."""
    last = _last_docs(doc_changes(actions, docs))
    adds = search_add_command(last.filter(F.col("op") == "put"))
    deletes = search_delete_command(last.filter(F.col("op") == "remove"), "id")
    return tuple(c.select(F.col("command").alias("message")) for c in (adds, deletes))


def _last_rows(changes: DataFrame, fields: list) -> DataFrame:
    """Last change of each key, which is the first field: (key, op, seq, other fields)."""
    key, rest = fields[0], ["op", "seq", *fields[1:]]
    order = F.struct(F.col("seq").isNotNull(), F.col("seq"), F.col("op"))
    last = changes.groupBy(number(key), key).agg(F.max_by(F.struct(*rest), order).alias("_last"))
    return last.select(key, *[F.col("_last")[c].alias(c) for c in rest])


def _last_docs(changes: DataFrame) -> DataFrame:
    """Last change of each id: (id, op, seq, fields)."""
    return _last_rows(changes, schemas.SEARCH_DOC.fieldNames())


def maintain_search_index(
    actions: DataFrame, docs: DataFrame, target: str, batch_id: int = 0, writer: str = "main"
) -> None:
    """Apply one batch of actions to the search index at ``target``."""
    write_slotted(doc_changes(actions, docs, batch_id), "id", target, batch_id, writer)


_DOC_LAYOUT, _DOC_ORDER = ["bucket"], ["id"]


def load_docs(docs: DataFrame, target: str, buckets: int = BUCKETS) -> None:
    undated = F.lit(None).cast(_SEQ)
    rows = docs.select(
        F.lit("put").alias("op"), undated.alias("seq"), *schemas.SEARCH_DOC.fieldNames()
    )
    _load(rows, "id", target, buckets, _DOC_LAYOUT, _DOC_ORDER)


def _merged_rows(fields: list):
    """Merge of base and log of an index with one row a key, the first field: the last change of
    each (removals stay, as an older update may still arrive).

    The base holds one row a key: it meets the last changes of the log, which are few.
    """
    key, names = fields[0], ["op", "seq", *fields]

    def merge(base: DataFrame | None, log: DataFrame | None) -> DataFrame:
        if log is None:
            return base.select(names)
        last = _last_rows(log, fields).select(names)
        if base is None:
            return last
        rank = lambda: F.struct(F.col("seq").isNotNull(), F.col("seq"), F.col("op"))
        newest = last.select(key, rank().alias("_new"))
        stays = F.col("_new").isNull() | (rank() > F.col("_new"))
        held = join_numbered(base.select(names), newest, key, "left").filter(stays).drop("_new")
        met = join_numbered(base.select(key, "seq", "op"), newest, key)
        older = met.filter(rank() > F.col("_new")).select(key)
        return held.unionByName(join_numbered(last, older, key, "left_anti").select(names))

    return merge


def _current_rows(spark, target, schema, fields, keys, at) -> DataFrame:
    """Rows of such an index; with ``keys`` (one column) only these, from the buckets they can be in."""
    known = at or changelog.manifest(spark, target)
    slots = None if keys is None else _slots_of(keys)
    count = known.buckets or 1
    buckets = None if slots is None or not known.buckets else {s % count for s in slots}
    base = changelog.read_base(spark, target, schema, known, buckets)
    log = _log(spark, target, schema, known, slots=slots)
    if base is None and log is None:
        base = spark.createDataFrame([], schema)
    rows = _merged_rows(fields)(base, log).filter("op = 'put'").select(fields)
    if keys is None:
        return rows
    wanted = keys.select(F.col(keys.columns[0]).alias(fields[0])).distinct()
    return join_numbered(rows, wanted, fields[0], "left_semi")


def current_docs(spark: SparkSession, target: str, ids=None, at=None) -> DataFrame:
    """The search index as a table; with ``ids`` (one column) these documents."""
    return _current_rows(spark, target, DOC_CHANGE, schemas.SEARCH_DOC.fieldNames(), ids, at)


def compact_docs(spark: SparkSession, target: str, buckets: int = BUCKETS, keep: int = 2) -> None:
    """Fold the log into the base and remove what the newest ``keep`` generations do not need."""
    merge = _merged_rows(schemas.SEARCH_DOC.fieldNames())
    _compact(spark, target, DOC_CHANGE, "id", merge, buckets, _DOC_LAYOUT, _DOC_ORDER, keep)


# --- facts ----------------------------------------------------------------------------------


def fact_changes(actions: DataFrame, triples: DataFrame, batch_id: int = 0) -> DataFrame:
    """Actions as log rows: ``put`` of what the decisions need to know of a resource, worked out
    from its description once, when it changed; ``remove`` of a deleted one. An update without a
    description changes nothing."""
    last = _last_of_each(actions, batch_id)
    names = schemas.FACTS.fieldNames()
    removed = last.filter(F.col("action") == DELETE).select(
        F.lit("remove").alias("op"), "seq", "uri",
        *[F.lit(None).cast(schemas.FACTS[c].dataType).alias(c) for c in names[1:]],
    )
    updated = last.filter(F.col("action") == UPDATE).select("uri", "seq")
    put = join_numbered(known_facts(triples), updated, "uri").select(F.lit("put").alias("op"), "seq", *names)
    return removed.unionByName(put)


def maintain_facts(
    actions: DataFrame, triples: DataFrame, target: str, batch_id: int = 0, writer: str = "main"
) -> None:
    """Apply one batch of actions to the facts at ``target``."""
    write_slotted(fact_changes(actions, triples, batch_id), "uri", target, batch_id, writer)


def load_facts(triples: DataFrame, target: str, buckets: int = BUCKETS) -> None:
    """Start facts from descriptions; any action is later than they are."""
    rows = known_facts(triples).select(F.lit("put").alias("op"), F.lit(None).cast(_SEQ).alias("seq"), "*")
    _load(rows, "uri", target, buckets, ["bucket"], ["uri"])


def current_facts(spark: SparkSession, target: str, uris=None, at=None) -> DataFrame:
    """(uri, rdf_indexable, own_transformation, is_binary) of each described resource, as the last
    change left it; with ``uris`` (one column) of these, from the buckets they can be in."""
    return _current_rows(spark, target, FACT_CHANGE, schemas.FACTS.fieldNames(), uris, at)


def compact_facts(spark: SparkSession, target: str, buckets: int = BUCKETS, keep: int = 2) -> None:
    merge = _merged_rows(schemas.FACTS.fieldNames())
    _compact(spark, target, FACT_CHANGE, "uri", merge, buckets, ["bucket"], ["uri"], keep)


# --- audit ----------------------------------------------------------------------------------

#: Bits of an audit index's Bloom filter, and how many of them stand for an event.
AUDIT_BITS, AUDIT_HASHES = 1 << 27, 4
_FILTER = "bucket long, bitmap binary"


def _bits(subjects: DataFrame) -> DataFrame:
    """(subject, k, bucket, bit): the places of the filter that stand for a subject. The filter
    is cut into buckets of 32,768 bits; only those with a bit set are stored."""
    places = [F.pmod(F.xxhash64(F.lit(k), F.col("subject")), F.lit(AUDIT_BITS)) + 1 for k in range(AUDIT_HASHES)]
    rows = subjects.select("subject", F.posexplode(F.array(*places)).alias("k", "place"))
    return rows.select(
        "subject", "k", F.bitmap_bucket_number("place").alias("bucket"),
        F.bitmap_bit_position("place").cast("int").alias("bit"),
    )


def _filter_paths(target: str, manifest, batches) -> list:
    bases = [f"{target}/filters/base={b}" for b in manifest.parts]
    return bases + [f"{target}/filters/writer={w}/batch={b}" for w, b in sorted(batches) if not manifest.covers(w, b)]


def _perhaps_known(subjects: DataFrame, paths: list) -> DataFrame:
    """Subjects all of whose bits are set in some filter: few that are new are among them."""
    filters = subjects.sparkSession.read.schema(_FILTER).parquet(*paths)
    byte = F.expr("cast(conv(hex(substring(bitmap, bit div 8 + 1, 1)), 16, 10) as int)")
    met = _bits(subjects).join(filters, "bucket").filter(F.expr("shiftleft(1, bit % 8)").bitwiseAND(byte) > 0)
    found = met.groupBy("subject").agg(F.bit_or(F.expr("shiftleft(1, k)")).alias("ks"))
    return found.filter(F.col("ks") == (1 << AUDIT_HASHES) - 1).select("subject")


def append_audit(
    events: DataFrame,
    target: str,
    base_uri: str,
    containers=(),
    batch_id: int = 0,
    writer: str = "main",
) -> None:
    """Append the audit records of a batch; deletions obey the exclusion list as well.

    What the index holds already is not written again: the batch's event uris are looked up in
    Bloom filters, one for each batch since the base and one for the base. Only for those that
    hit are stored rows read, from the buckets they can be in, and equal triples left out.
    Batches of one index are appended one after the other, as a query does; what writers append
    at the same time is told apart when the log is folded.
    """
    spark = events.sparkSession
    # Events are kept, not their triples, which are many times as large.
    once = audited_once(audit_input(events, containers), base_uri).persist()
    try:
        known = changelog.manifest(spark, target)
        batches = changelog.finished_batches(spark, target, known) - {(writer, batch_id)}
        paths = _filter_paths(target, known, batches)
        subjects = once.select(F.col("event_uri").alias("subject")).distinct()
        hits = _perhaps_known(subjects, paths).persist() if paths else None
        try:
            slots = [] if hits is None else _slots_of(hits)
            fresh = audit_set(once, base_uri)
            if slots:
                fresh = _not_stored(spark, fresh, hits, target, known, batches, slots)
            write_slotted(fresh, "subject", target, batch_id, writer)
        finally:
            if hits is not None:
                hits.unpersist()
        bitmaps = _bits(subjects).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
        bitmaps.write.mode("overwrite").parquet(f"{target}/filters/writer={writer}/batch={batch_id}")
    finally:
        once.unpersist()


def _not_stored(spark, records, hits, target, known, batches, slots) -> DataFrame:
    """Records without the triples that are stored, looked up for ``hits`` only."""
    buckets = {s % known.buckets for s in slots} if known.buckets else None
    base = changelog.read_base(spark, target, AUDIT_CHANGE, known, buckets)
    log = _log(spark, target, AUDIT_CHANGE, known, batches, slots)
    stored = [p.select(*TRIPLE_KEY) for p in (base, log) if p is not None]
    if not stored:
        return records
    stored = reduce(DataFrame.unionByName, stored).join(hits, "subject", "left_semi")
    records, stored = (rows.withColumn(NUMBER, number(*TRIPLE_KEY)) for rows in (records, stored))
    return records.join(stored, _same(records, stored), "left_anti").drop(NUMBER)


def current_audit(spark: SparkSession, target: str, at=None) -> DataFrame:
    """All audit triples, as they lie: repeats were dropped when they were written."""
    return changelog.read_changes(spark, target, AUDIT_CHANGE, at=at)


def compact_audit(spark: SparkSession, target: str, buckets: int = BUCKETS, keep: int = 2) -> None:
    """Fold the log into the base, with the filter of both."""

    def merge(base, log):
        return rdf_set(reduce(DataFrame.unionByName, [p for p in (base, log) if p is not None]))

    def filters(name, before, batches):
        paths = _filter_paths(target, before, batches)
        rows = spark.read.schema(_FILTER).parquet(*paths).groupBy("bucket")
        rows.agg(F.bitmap_or_agg("bitmap").alias("bitmap")).write.parquet(f"{target}/filters/base={name}")

    _compact(
        spark, target, AUDIT_CHANGE, "subject", merge, buckets, ["bucket"], ["subject", "predicate", "object"],
        keep, filters,
    )
