"""Check SQL for the registered queries, written for DuckDB on the sample tables."""

from eventloom import vocab as v
from eventloom.plans import views
from eventloom.plans.views import (
    AUDIT_CONTAINER,
    BASE,
    BRIEF,
    DEFAULT,
    EVENT_BASE,
    GRAPH,
    UNKNOWN,
    with_views,
)

CHECKS = {}


def check(name, body, *names, ctes=""):
    CHECKS[name] = with_views(names, (",\n" + ctes if ctes else "") + "\n" + body)


def _has(column, *values):
    tests = [f"list_contains(string_split({column}, ','), '{x}')" for x in values]
    return f"coalesce({' or '.join(tests)}, false)"


IS_DELETE = _has("event_types_text", *v.DELETE)
KEPT = f"(uri <> '{AUDIT_CONTAINER}' and not starts_with(uri, '{AUDIT_CONTAINER}/'))"
_BINARY = _has("resource_types_text", v.BINARY)
AUDIT_CASE = f"""case
  when {_has("event_types_text", *v.CREATE)} then
    case when {_BINARY} then '{v.EVENT_CODE}ing' else '{v.EVENT_CODE}cre' end
  when {IS_DELETE} then
    case when {_BINARY} then '{v.AUDIT}contentRemoval' else '{v.EVENT_CODE}del' end
  when {_has("event_types_text", *v.UPDATE)} then
    case when {_BINARY} then '{v.AUDIT}contentModification'
         else '{v.AUDIT}metadataModification' end end"""

# --- events and audit -----------------------------------------------------------------------

check(
    "audit_event_type",
    f"select event_id, uri, concat('{EVENT_BASE}/', event_id) as event_uri, "
    f"{AUDIT_CASE} as audit_event_type from repo_events where {KEPT}",
    "repo_events",
)

_RECORD = f"""
audited as (
  select concat('{EVENT_BASE}/', event_id) as subject, uri, date_time, agents_text,
    {AUDIT_CASE} as kind from repo_events where {KEPT}),
record as (
  select subject, '{v.RDF_TYPE}' as predicate, c as object, 'uri' as object_kind,
    cast(null as string) as datatype
  from audited cross join (values {", ".join(f"('{c}')" for c in v.AUDIT_CLASSES)}) t(c)
  union
  select subject, '{v.EVENT_DATE_TIME}', date_time, 'literal', '{v.XSD_DATETIME}' from audited
  union
  select subject, '{v.EVENT_OBJECT}', uri, 'uri', null from audited
  union
  select subject, '{v.EVENT_AGENT}', unnest(string_split(agents_text, ',')), 'literal',
    '{v.XSD_STRING}' from audited
  union
  select subject, '{v.EVENT_TYPE}', kind, 'uri', null from audited where kind is not null)
"""


def _line(subject="subject"):
    """N-Triples line of the current row."""
    text = "replace(replace(replace(replace(replace(object, '\\', '\\\\'), '\"', '\\\"'), "
    text += "chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t')"
    return (
        f"concat('<', {subject}, '> <', predicate, '> ', case when object_kind = 'uri' "
        f"then concat('<', object, '>') when datatype is null or datatype = '{v.XSD_STRING}' "
        f"then concat('\"', {text}, '\"') else concat('\"', {text}, '\"^^<', datatype, '>') end, "
        "' .')"
    )


check("audit_triples", "select * from record", "repo_events", ctes=_RECORD)
check(
    "audit_ntriples", f"select subject, {_line()} as line from record", "repo_events", ctes=_RECORD
)
check(
    "audit_insert_statement",
    f"""select subject as event_uri, concat('INSERT DATA {{ ',
      string_agg(line, chr(10) order by line), chr(10), '}}') as statement
    from (select subject, {_line()} as line from record) group by subject""",
    "repo_events",
    ctes=_RECORD,
)
check(
    "canonical_events",
    """select event_id, uri, date_time, coalesce(event_types_text, '') as event_types,
      resource_types_text as resource_types, agents_text as agents,
      cast(coalesce(len(string_split(event_types_text, ',')), 0) as bigint) as n_types
    from repo_events""",
    "repo_events",
)
_PARSED_EVENT = f"""select event_id, uri, date_time,
  cast(epoch_us(ts) as bigint) as epoch,
  coalesce(event_types_text, '') as event_types, resource_types_text as resource_types,
  agents_text as agents, '{BASE}' as is_part_of from repo_events"""
check("parse_events", _PARSED_EVENT, "repo_events")
check("parse_legacy_events", _PARSED_EVENT, "repo_events")
_BODIES = """
numbered as (select event_id, uri, cast(regexp_extract(event_id, '([0-9]+)$', 1) as bigint) % 5 as k
  from repo_events),
bodies as (select event_id, uri, k, case k when 0 then '{}'
    when 1 then concat('{"foo":"', event_id, '"}') else concat('no event ', event_id) end as bad
  from numbered)
"""
check(
    "malformed_events",
    """select bad as payload, 'events' as service, 'unreadable event' as error,
      cast(count(*) as bigint) as n from bodies where k < 3 group by bad""",
    "repo_events",
    ctes=_BODIES,
)
check(
    "rejected_events",
    """select case when k > 2 then event_id end as event_id,
      case when k > 2 then uri else '' end as uri, case when k < 3 then bad end as reject,
      cast(count(*) as bigint) as n from bodies group by 1, 2, 3""",
    "repo_events",
    ctes=_BODIES,
)
check("exclude_containers", f"select event_id, uri from repo_events where {KEPT}", "repo_events")
check(
    "exclude_containers_table",
    """select event_id, uri from repo_events where not exists (
      select 1 from listed where uri = c or starts_with(uri, concat(c, '/')))""",
    "repo_events",
    "repo_hints",
    ctes=f"listed as (select uri as c from repo_hints union all select '{AUDIT_CONTAINER}')",
)
_KIND = f"case when {IS_DELETE} then 'delete' else 'index' end"
check("change_kind", f"select event_id, {_KIND} as change_kind from repo_events", "repo_events")
check("split_deletes", f"select event_id, uri, {_KIND} as branch from repo_events", "repo_events")
_EVENT_INDEXABLE = _has("resource_types_text", v.INDEXABLE)
check(
    "indexable_by_event",
    f"select event_id, uri from repo_events where {_EVENT_INDEXABLE}",
    "repo_events",
)
check(
    "merge_live_and_hints",
    """select event_id, uri, false as from_hint from repo_events
    union all select null, uri, true from repo_hints""",
    "repo_events",
    "repo_hints",
)
check("read_hint_files", "select uri, 'queue:solr' as recipients from repo_hints", "repo_hints")

# --- decisions ------------------------------------------------------------------------------

_FACTS = f"""
facts as (
  select doc as uri,
    max(case when predicate = '{v.RDF_TYPE}' and object = '{v.INDEXABLE}' then 1 else 0 end) = 1
      as rdf_indexable,
    min_by(object, ord) filter (where predicate = '{v.HAS_TRANSFORMATION}'
      and object_kind = 'uri') as own
  from repo_triples group by doc)
"""
_INPUT = f"""
others as (
  select event_id, uri, ts, {_EVENT_INDEXABLE} as event_indexable, false as from_hint
  from repo_events where not {IS_DELETE} and {KEPT}
  union all
  select null, uri, timestamp '2100-01-01 00:00:00', false, true from repo_hints where {KEPT}),
deletes as (select event_id, uri, ts from repo_events where {IS_DELETE})
"""
_DECIDE = f"{_FACTS}, {_INPUT}"
_DECIDED_VIEWS = ("repo_events", "repo_hints", "repo_triples")
_STORE = """
store_actions as (
  select event_id, uri, ts, 'delete' as action from deletes
  union all
  select event_id, uri, ts, case when rdf_indexable is null then 'missing'
    when rdf_indexable then 'update' else 'delete' end
  from others left join facts using (uri))
"""
check(
    "triplestore_actions",
    "select event_id, uri, action from store_actions",
    *_DECIDED_VIEWS,
    ctes=f"{_DECIDE}, {_STORE}",
)
check(
    "triplestore_actions_from_facts",
    "select event_id, uri, action from store_actions",
    *_DECIDED_VIEWS,
    ctes=f"""{_FACTS}, {_INPUT},
      deleted as (select uri, max(ts) as at from deletes group by uri),
      updated as (select uri, max(ts) as at from repo_events where not {IS_DELETE} group by uri),
      known as (select facts.* from facts left join deleted d using (uri) left join updated u using (uri)
        where case when u.at is null then d.at is null and length(uri) % 2 = 0
          else d.at is null or d.at < u.at end),
      {_STORE.replace("join facts", "join known")}""",
)
_PLAIN = """
store_actions as (
  select event_id, uri, ts, 'delete' as action from deletes
  union all select event_id, uri, ts, 'update' from others)
"""
check(
    "triplestore_actions_without_predicate",
    "select event_id, uri, action from store_actions",
    *_DECIDED_VIEWS,
    ctes=f"{_DECIDE}, {_PLAIN}",
)


def _search(update_when):
    return f"""
search_actions as (
  select event_id, uri, ts, 'delete' as action, cast(null as string) as transformation
  from deletes
  union all
  select event_id, uri, ts, case when rdf_indexable is null then 'missing'
    when {update_when} then 'update' else 'delete' end,
    case when rdf_indexable is not null then coalesce(nullif(own, ''), '{DEFAULT}') end
  from others left join facts using (uri))
"""


_JUDGED = _search("case when from_hint then rdf_indexable else event_indexable end")
_ALL = _search("true")
_DECISION = "select event_id, uri, action, transformation from search_actions"
check("search_actions", _DECISION, *_DECIDED_VIEWS, ctes=f"{_DECIDE}, {_JUDGED}")
check("search_actions_without_predicate", _DECISION, *_DECIDED_VIEWS, ctes=f"{_DECIDE}, {_ALL}")
check(
    "search_actions_without_lookup",
    f"""select event_id, uri, 'delete' as action, cast(null as string) as transformation
    from deletes union all select event_id, uri, 'update', '{DEFAULT}' from others""",
    *_DECIDED_VIEWS,
    ctes=_DECIDE,
)
_DOES = "(action = 'delete' or (action = 'update' and transformation <> uri))"
check("applicable_actions", f"{_DECISION} where {_DOES}", *_DECIDED_VIEWS, ctes=f"{_DECIDE}, {_ALL}")
# A hint of the plain queries has no time, so any event on the same uri is later.
_LATEST = """
latest as (
  select * from (
    select uri, event_id, action, row_number() over (partition by uri
      order by event_id is null, ts desc, event_id desc) as n from store_actions)
  where n = 1)
"""
check(
    "latest_action",
    "select uri, event_id, action from latest",
    *_DECIDED_VIEWS,
    ctes=f"{_DECIDE}, {_STORE}, {_LATEST}",
)
check(
    "latest_action_stream",
    "select uri, event_id, action from latest",
    *_DECIDED_VIEWS,
    ctes=f"""{_INPUT}, {_PLAIN}, {_LATEST.replace("from store_actions", "from store_actions where event_id is not null")}""",
)
check(
    "latest_action_undated",
    """select uri, event_id, action from (
      select uri, event_id, action, row_number() over (partition by uri order by
        case when cast(regexp_extract(event_id, '([0-9]+)$', 1) as bigint) % 11 = 0
          then timestamp '2100-01-01' else ts end desc, event_id desc) as n
      from store_actions where event_id is not null) where n = 1""",
    *_DECIDED_VIEWS,
    ctes=f"{_DECIDE}, {_STORE}",
)
check(
    "indexable_by_rdf",
    "select event_id, uri from repo_events where uri in (select uri from facts where rdf_indexable)",
    "repo_events",
    "repo_triples",
    ctes=_FACTS,
)
_NAMED = f"{_FACTS}, named as (select *, coalesce(own, '{DEFAULT}') as transformation from facts)"
check(
    "with_transformation",
    "select uri, rdf_indexable, transformation from named",
    "repo_triples",
    ctes=_NAMED,
)
check(
    "not_self_transform",
    "select uri, transformation from named where transformation <> uri",
    "repo_triples",
    ctes=_NAMED,
)
check(
    "has_transformation",
    "select uri, own as transformation from facts where own <> ''",
    "repo_triples",
    ctes=_FACTS,
)
_UPDATES = f"{_DECIDE}, {_PLAIN}, {_LATEST}, updates as (select * from latest where action = 'update')"
check(
    "enrich_with_resource",
    """select uri, event_id, subject, predicate, object
    from updates join repo_triples on doc = uri""",
    *_DECIDED_VIEWS,
    ctes=_UPDATES,
)
check(
    "missing_resources",
    """select concat('{"uri":"', uri, '"}') as payload, 'triplestore' as service,
      'resource not found' as error
    from updates where uri not in (select doc from repo_triples)""",
    *_DECIDED_VIEWS,
    ctes=_UPDATES,
)

# --- triples --------------------------------------------------------------------------------

_TYPED = """select doc, subject, predicate, object, object_kind, datatype, lang from repo_triples"""
for _name in ("parse_ntriples", "read_ntriples_files", "parse_rdfxml"):
    check(_name, _TYPED, "repo_triples")
check(
    "unreadable_ntriples",
    f"select concat('broken ', {_line()}) as line from repo_triples where ord % 3 = 0",
    "repo_triples",
)
check(
    "read_triple_snapshot",
    """select subject, predicate, object, ord from repo_triples
    where doc in (select uri from repo_hints)""",
    "repo_triples",
    "repo_hints",
)
check(
    "rdf_set",
    "select distinct subject, predicate, object, object_kind, datatype from repo_triples",
    "repo_triples",
)


def _graph_text(key):
    return f"""
texts as (
  select {key}, string_agg(line, chr(10) order by line) as text
  from (select distinct {key}, {_line()} as line from repo_triples) group by {key})
"""


_ONE_PART = "cast(0 as int) as part, cast(1 as int) as parts"
check(
    "collect_graph",
    f"select subject, {_ONE_PART}, text from texts",
    "repo_triples",
    ctes=_graph_text("subject"),
)
check(
    "insert_statement",
    f"""select subject, {_ONE_PART},
      concat('INSERT DATA {{ ', text, chr(10), '}}') as statement from texts""",
    "repo_triples",
    ctes=_graph_text("subject"),
)
_UPDATE_TEXT = "concat('DELETE WHERE { <', {uri}, '> ?p ?o };', chr(10), 'INSERT DATA { ', text, chr(10), '}')"
check(
    "update_statement",
    f"""select uri, {_ONE_PART},
      {_UPDATE_TEXT.replace("{uri}", "uri")} as statement
    from (select uri, string_agg(line, chr(10) order by line) as text from (
      select uri, {_line()} as line from updates join repo_triples on doc = uri
      where predicate <> '{v.CONTAINS}') group by uri)""",
    *_DECIDED_VIEWS,
    ctes=_UPDATES,
)
check(
    "update_statement_parts",
    """select uri, part, parts, concat(
        case when part = 0 then concat('DELETE WHERE { <', uri, '> ?p ?o };', chr(10)) else '' end,
        'INSERT DATA { ', string_agg(line, chr(10) order by line), chr(10), '}') as statement
    from (select distinct uri, line, cast(case when md5(line) = least then 0
        else cast(concat('0x', substr(md5(line), 1, 8)) as bigint) % parts end as int) as part, parts
      from lines join sizes using (uri)) group by uri, part, parts""",
    "repo_triples",
    ctes=f"""lines as (select doc as uri, {_line()} as line from repo_triples),
sizes as (select uri, cast(ceil(count(*) / 3.0) as int) as parts, min(md5(line)) as least
  from lines group by uri)""",
)
check(
    "update_statement_in_graph",
    f"""select doc as uri, {_ONE_PART},
      concat('DELETE WHERE {{ GRAPH <{GRAPH}> {{ <', doc, '> ?p ?o }} }};', chr(10),
        'INSERT DATA {{ GRAPH <{GRAPH}> {{ ', text, chr(10), ' }}}}') as statement from texts""",
    "repo_triples",
    ctes=_graph_text("doc"),
)
check(
    "delete_statement",
    """select event_id, uri, concat('DELETE WHERE { <', uri, '> ?p ?o }') as statement
    from store_actions where action = 'delete'""",
    *_DECIDED_VIEWS,
    ctes=f"{_DECIDE}, {_STORE}",
)
check(
    "form_encoded_update",
    f"""select doc as uri, concat('update=', replace(replace(
      url_encode({_UPDATE_TEXT.replace("{uri}", "doc")}), '%20', '+'), '%2A', '*')) as body
    from texts""",
    "repo_triples",
    ctes=_graph_text("doc"),
)
check(
    "apply_prefer",
    f"select subject, predicate, object from repo_triples where predicate <> '{v.CONTAINS}'",
    "repo_triples",
)
check(
    "match_pattern",
    f"select concat('{EVENT_BASE}/', event_id) as subject, uri as object from repo_events where {KEPT}",
    "repo_events",
)
check(
    "count_by_subject",
    "select subject, cast(count(*) as bigint) as n from repo_triples group by subject",
    "repo_triples",
)
check(
    "named_graph",
    f"""select g as graph, subject, cast(count(*) as bigint) as n
    from repo_triples cross join (values ('{GRAPH}'), (null)) t(g) group by g, subject""",
    "repo_triples",
)
_CONTAINED = f"select subject as parent, object as child from repo_triples where predicate = '{v.CONTAINS}'"
check("containment_edges", _CONTAINED, "repo_triples")
check("containment_edges_from_lines", _CONTAINED, "repo_triples")

# --- search documents -----------------------------------------------------------------------


def _docs(where="true"):
    def first(predicate, kind):
        return (
            f"coalesce(min_by(object, ord) filter (where predicate = '{predicate}' and "
            f"object_kind {kind} 'uri'), '')"
        )

    return f"""
docs as (
  select doc, min_by(subject, ord) as id,
    string_agg(object, ',' order by ord) filter (where predicate = '{v.RDF_TYPE}') as rdftype,
    {first(v.CONTAINS, "=")} as contains, {first(v.LAST_MODIFIED, "<>")} as lastmodified,
    {first(v.CREATED, "<>")} as created
  from repo_triples where {where} group by doc)
"""


_DOC = "id, rdftype, contains, lastmodified, created"
check("search_doc", f"select {_DOC} from docs", "repo_triples", ctes=_docs())
check(
    "ntriples_files_in_order",
    f"select {_DOC} from docs",
    "repo_triples",
    ctes=_docs().replace(", ord)", ", -ord)").replace("order by ord", "order by -ord"),
)
check(
    "search_add_command",
    """select id, concat('<add><doc><field name="id">', id, '</field><field name="rdftype">',
      replace(rdftype, ',', '</field><field name="rdftype">'), '</field><field name="contains">',
      contains, '</field><field name="lastmodified">', lastmodified,
      '</field><field name="created">', created, '</field></doc></add>') as command from docs""",
    "repo_triples",
    ctes=_docs(),
)
check(
    "search_delete_command",
    """select event_id, concat('{"delete":{"id":"', uri, '"}}') as command
    from search_actions where action = 'delete'""",
    *_DECIDED_VIEWS,
    ctes=f"{_DECIDE}, {_JUDGED}",
)


def _transformed(transformation):
    brief = f"{transformation} = '{BRIEF}'"
    return f"""case when {brief} then '' else rdftype end as rdftype,
      case when {brief} then '' else contains end as contains, lastmodified,
      case when {brief} then '' else created end as created"""


check(
    "apply_transforms",
    f"""select id, transformation, {_transformed("transformation")}
    from docs join named on doc = uri
    where transformation in ('{DEFAULT}', '{BRIEF}')""",
    "repo_triples",
    ctes=f"{_NAMED}, {_docs()}",
)
check(
    "unknown_transforms",
    f"""select concat('{{"uri":"', uri, '","transformation":"', transformation, '"}}') as payload,
      'search' as service, 'unknown transformation' as error
    from named where transformation = '{UNKNOWN}'""",
    "repo_triples",
    ctes=_NAMED,
)

# --- indexes --------------------------------------------------------------------------------

# Hints come after all events here. Last purge per subject: any delete, or an update that finds
# a description; a described triple lives if its document's last update is no earlier.
_TRIPLE_STATE = f"""
done as (
  select uri, ts, 'delete' as action from deletes
  union all
  select uri, ts, 'update' from others where uri in (select doc from repo_triples)),
purged as (select uri, max(ts) as purged_at from done group by uri),
updated as (select uri, max(ts) as updated_at from done where action = 'update' group by uri),
state as (
  select subject, predicate, case when predicate = '{v.TITLE}' then 'old title' else object end
    as object, object_kind, datatype
  from repo_triples where subject not in (select uri from purged)
  union
  select subject, predicate, object, object_kind, datatype
  from repo_triples join updated on doc = updated.uri left join purged on subject = purged.uri
  where predicate <> '{v.CONTAINS}' and (purged_at is null or purged_at <= updated_at))
"""
_INDEXES = "triple_index_state triple_index_stream compacted_triple_index compacted_during_stream"
for _name in _INDEXES.split():
    check(
        _name,
        "select subject, predicate, object, object_kind, datatype from state",
        *_DECIDED_VIEWS,
        ctes=f"{_INPUT}, {_TRIPLE_STATE}",
    )
for _name in ("triple_index_lookup", "triple_index_lookup_pruned"):
    check(
        _name,
        """select subject, predicate, object, object_kind, datatype from state
        where subject in (select uri from repo_hints)""",
        *_DECIDED_VIEWS,
        ctes=f"{_INPUT}, {_TRIPLE_STATE}",
    )
_DOC_STATE = f"""
built as (
  select uri, id, {_transformed("transformation")}
  from docs join named on doc = uri
  where transformation in ('{DEFAULT}', '{BRIEF}') and transformation <> uri),
removed as (select uri, max(ts) as removed_at from deletes group by uri),
updated as (
  select uri, max(ts) as updated_at from others
  where uri in (select uri from built) group by uri)
select {_DOC} from built join updated using (uri) left join removed using (uri)
where removed_at is null or updated_at > removed_at
union all
select id, rdftype, contains, 'long ago', created from docs
where id not in (select uri from updated) and id not in (select uri from removed)
"""
for _name in ("search_index_state", "search_index_stream", "compacted_search_index"):
    check(
        _name,
        "",
        *_DECIDED_VIEWS,
        ctes=f"{_NAMED}, {_INPUT}, {_docs(f"predicate <> '{v.CONTAINS}'")}, {_DOC_STATE}",
    )
check(
    "missing_in_search",
    """select distinct concat('{"uri":"', uri, '"}') as payload, 'search' as service,
      'resource not found' as error
    from others where uri not in (select doc from repo_triples)""",
    *_DECIDED_VIEWS,
    ctes=_INPUT,
)
check(
    "clear_graph",
    """select cast(null as string) as graph, subject, predicate, object, object_kind, datatype
    from repo_triples""",
    "repo_triples",
)
for _name in ("audit_stream", "audit_replay"):
    check(_name, "select * from record", "repo_events", ctes=_RECORD)

# --- hierarchy ------------------------------------------------------------------------------

_WALK = """
walk as (
  select uri as root, uri, cast(0 as int) as depth from roots
  union
  select root, child, cast(depth + 1 as int) from walk join repo_edges on parent = walk.uri)
"""
check(
    "traverse",
    "select root, uri, depth from walk",
    "repo_edges",
    ctes=f"""roots as (select '{BASE}' as uri union all
      select child from repo_edges where parent = '{BASE}'), {_WALK}""",
)
# Edges that were known before, but for changed parents, and what those contain now.
_CURRENT_EDGES = f"""
known as (
  select subject as parent, object as child, doc from repo_triples
  where predicate = '{v.CONTAINS}' and object_kind = 'uri'),
loaded as (
  select parent, child from known where length(child) % 2 = 0
  union select parent, concat(parent, '/gone') from known),
current_edges as (
  select parent, child from loaded where parent not in (select uri from purged)
  union
  select parent, child from known join updated on doc = updated.uri
  left join purged on parent = purged.uri where purged_at is null or purged_at <= updated_at)
"""
check(
    "edges_after_changes",
    "select parent, child from current_edges",
    *_DECIDED_VIEWS,
    ctes=f"{_INPUT}, {_TRIPLE_STATE}, {_CURRENT_EDGES}",
)
check(
    "traverse_after_changes",
    "select root, uri, depth from walk",
    *_DECIDED_VIEWS,
    ctes=f"""{_INPUT}, {_TRIPLE_STATE}, {_CURRENT_EDGES},
      roots as (select distinct parent as uri from current_edges),
      {_WALK.replace("repo_edges", "current_edges")}""",
)
_BODY = "(content_type = 'application/json' and regexp_matches(body, '\\S'))"
_RECIPIENTS = rf"""
asked as (
  select *, coalesce({_BODY}, false) as has_body,
    coalesce({_BODY}, false) and not json_valid(body) as invalid from repo_requests),
entries as (
  select request_id, regexp_replace(unnest(string_split(recipients_header, ',')),
    '^\s+|\s+$', '', 'g') as r from asked where recipients_header is not null
  union
  select request_id, unnest(cast(json(body) as varchar[])) from asked
  where has_body and not invalid),
merged as (
  select request_id, string_agg(r, ',' order by r) as recipients
  from entries where r <> '' group by request_id),
answered as (
  select request_id, concat('{BASE}', path) as uri, coalesce(recipients, '') as recipients,
    invalid, not invalid and recipients is not null as admitted
  from asked left join merged using (request_id))
"""
check(
    "merge_recipients",
    "select request_id, recipients from answered",
    "repo_requests",
    ctes=_RECIPIENTS,
)
check(
    "admit_requests",
    f"""select request_id, uri, cast(case when invalid then 400 else 200 end as bigint) as status,
      case when invalid then '{v.INVALID_JSON}' when admitted then concat('{v.STARTED_AT}', uri)
        else '{v.NO_RECIPIENTS}' end as message, admitted from answered""",
    "repo_requests",
    ctes=_RECIPIENTS,
)
check(
    "read_request_files",
    "select request_id, path, content_type, recipients_header, body from repo_requests",
    "repo_requests",
)
for _name in ("reindex_fanout", "reindex_stream"):
    check(
        _name,
        """select request_id, walk.uri, unnest(string_split(recipients, ',')) as recipient, depth
        from answered join walk on root = answered.uri where admitted""",
        "repo_requests",
        "repo_edges",
        ctes=f"{_RECIPIENTS}, roots as (select distinct uri from answered where admitted), {_WALK}",
    )

# --- fixity ---------------------------------------------------------------------------------

_FIXITY = f"""
results as (
  select uri, 'sha-256' as algorithm,
    case when recorded then sha256(recorded_text) end as expected_digest,
    sha256(text) as actual_digest, case when recorded then n_chars end as expected_size,
    cast(length(text) as bigint) as actual_size,
    case when recorded and sha256(recorded_text) = sha256(text) and n_chars = length(text)
      then 'SUCCESS' else 'FAILURE' end as outcome
  from repo_binaries where resource_type = '{v.BINARY}')
"""
check(
    "only_binaries",
    f"select uri, n_chars from repo_binaries where resource_type = '{v.BINARY}'",
    "repo_binaries",
)
check(
    "fixity_stream",
    f"""select uri, 'sha-256' as algorithm,
      case when recorded then sha256(recorded_text) end as expected_digest,
      sha256(text) as actual_digest,
      case when recorded then cast(strlen(text) as bigint) end as expected_size,
      cast(strlen(text) as bigint) as actual_size,
      case when recorded and sha256(recorded_text) = sha256(text)
        then 'SUCCESS' else 'FAILURE' end as outcome
    from repo_binaries where resource_type = '{v.BINARY}'""",
    "repo_binaries",
)
for _name in ("verify_fixity", "verify_fixity_late"):
    check(_name, "select * from results", "repo_binaries", ctes=_FIXITY)
check(
    "split_fixity",
    """select uri, case when outcome = 'SUCCESS' then 'success' else 'failure' end as branch
    from results""",
    "repo_binaries",
    ctes=_FIXITY,
)
check(
    "fixity_report",
    """select uri, outcome, algorithm, actual_digest as digest, actual_size as size,
      uri as location from results""",
    "repo_binaries",
    ctes=_FIXITY,
)
check(
    "fixity_failures",
    "select uri, actual_digest, outcome from results where outcome = 'FAILURE'",
    "repo_binaries",
    ctes=_FIXITY,
)

# --- forwarding -----------------------------------------------------------------------------

_MESSAGES = f"""
messages as (
  select event_id, uri, coalesce(nullif(jms_event_type, ''), '{v.UPDATE[1]}') as forward_type
  from (select event_id, uri, jms_event_type from repo_events
    union all select null, uri, null from repo_hints) where {KEPT}),
rendered as (
  select *, concat('{{"id":"', uri, '","type":"', forward_type, '"}}') as message from messages)
"""
_BOTH = ("repo_events", "repo_hints")
check("forward_message", "select * from rendered", *_BOTH, ctes=_MESSAGES)
for _name in ("forward_delivery", "forward_stream"):
    check(
        _name,
        "select message, cast(count(*) as bigint) as n from rendered group by message",
        *_BOTH,
        ctes=_MESSAGES,
    )
check(
    "forward_without_endpoint",
    f"""select message as payload, '{v.NO_ENDPOINT}' as error, cast(count(*) as bigint) as n
    from rendered group by message""",
    *_BOTH,
    ctes=_MESSAGES,
)
check(
    "redelivered_later",
    """select message, cast(3 as bigint) as attempts, cast(count(*) as bigint) as n
    from rendered group by message""",
    *_BOTH,
    ctes=_MESSAGES,
)
check(
    "retry_dead_letters",
    """select message, cast(least(cast(right(uri, 1) as int), 3) + 1 as bigint) as attempts,
      case when cast(right(uri, 1) as int) >= 4 then 'ConnectionError: refused' end as error,
      cast(count(*) as bigint) as n
    from rendered group by all""",
    *_BOTH,
    ctes=_MESSAGES,
)
