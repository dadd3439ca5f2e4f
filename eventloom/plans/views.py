"""Repository-shaped views over the sample tables.

Each view is one SQL text that Spark and DuckDB both read, so that a query and its check
start from the same input. ``{table}`` names a sample table or another view.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventloom import vocab as v
from eventloom.operators.events import canonicalise

BASE = "http://localhost:8080/rest"
AUDIT_CONTAINER = BASE + "/audit"
EVENT_BASE = "http://example.com/event"
BRIEF = "urn:transform:brief"
UNKNOWN = "urn:transform:unknown"
DEFAULT = "default"
GRAPH = "urn:graph:main"
RESOURCE = v.REPOSITORY + "Resource"
AGENT = "client/1.0"

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Schemas of the tables the views use; stated, so that no job is spent on finding them out.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def _typed(names):
    """Event type of the vocabulary the event uses: legacy for odd ids."""
    return f"case when event_id % 2 = 1 then '{names[0]}' else '{names[1]}' end"


_EVENTS = f"""
select concat('urn:uuid:evt-', cast(event_id as string)) as event_id, ts,
  concat(replace(cast(ts as string), ' ', 'T'), 'Z') as date_time,
  case when user_id % 6 = 0 and event_id % 5 = 0 then '{BASE}/audit'
       when user_id % 6 = 0 then concat('{BASE}/audit/', cast(user_id as string))
       when user_id % 6 = 1 then concat('{BASE}/auditions/', cast(user_id as string))
       else concat('{BASE}/objects/', cast(user_id as string)) end as uri,
  case event_type
    when 'signup' then {_typed(v.CREATE)}
    when 'click' then {_typed(v.UPDATE)}
    when 'error' then {_typed(v.DELETE)}
    when 'purchase' then concat({_typed(v.CREATE)}, ',', {_typed(v.UPDATE)})
  end as event_types_text,
  concat_ws(',', '{RESOURCE}',
    case when cast(regexp_extract(props, '([0-9]+)', 1) as int) % 3 = 0
         then '{v.BINARY}' else '{v.CONTAINER}' end,
    case when cast(regexp_extract(props, '([0-9]+)', 1) as int) % 4 = 0
         then '{v.INDEXABLE}' end) as resource_types_text,
  concat_ws(',', concat('user:', cast(user_id as string)), '{AGENT}',
    case when event_id % 7 = 0 then concat('user:', cast(user_id as string)) end) as agents_text,
  case event_type
    when 'signup' then {_typed(v.CREATE)}
    when 'click' then {_typed(v.UPDATE)}
    when 'error' then {_typed(v.DELETE)}
    when 'purchase' then {_typed(v.UPDATE)}
  end as jms_event_type
from {{events}}
"""

_HINTS = f"""
select concat('{BASE}/objects/', cast(s_suppkey as string)) as uri from {{supplier}}
"""

_EDGES = f"""
select '{BASE}' as parent, concat('{BASE}/regions/', cast(r_regionkey as string)) as child
from {{region}}
union all
select concat('{BASE}/regions/', cast(n_regionkey as string)),
       concat('{BASE}/nations/', cast(n_nationkey as string)) from {{nation}}
union all
select concat('{BASE}/nations/', cast(c_nationkey as string)),
       concat('{BASE}/objects/', cast(c_custkey as string)) from {{customer}}
union all
select concat('{BASE}/objects/', cast(o_custkey as string)),
       concat('{BASE}/orders/', cast(o_orderkey as string)) from {{orders}}
"""


def _customer_triples(ord, predicate, value, kind, datatype="", where="true", subject="uri"):
    datatype = f"'{datatype}'" if datatype else "cast(null as string)"
    return (
        f"select {subject} as subject, '{predicate}' as predicate, {value} as object, "
        f"'{kind}' as object_kind, {datatype} as datatype, uri as doc, "
        f"cast({ord} as bigint) as ord from {{repo_customers}} where {where}"
    )


_CUSTOMERS = f"""
select c_custkey, concat('{BASE}/objects/', cast(c_custkey as string)) as uri,
  concat(c_name, ' "', c_mktsegment, '" & Co') as title,
  concat('2020-01-', lpad(cast(1 + c_custkey % 28 as string), 2, '0'), 'T08:00:00Z') as created,
  concat('2021-02-', lpad(cast(1 + c_custkey % 27 as string), 2, '0'), 'T09:30:00Z') as modified,
  case when c_custkey % 30 = 0 then concat('{BASE}/objects/', cast(c_custkey as string))
       when c_custkey % 70 = 0 then '{UNKNOWN}'
       when c_custkey % 10 = 0 then '{BRIEF}' end as transformation
from {{customer}}
"""

_DESCRIPTIONS = "\nunion all\n".join(
    [
        _customer_triples(1, v.RDF_TYPE, f"'{v.CONTAINER}'", "uri"),
        _customer_triples(2, v.RDF_TYPE, f"'{v.INDEXABLE}'", "uri", where="c_custkey % 4 = 0"),
        _customer_triples(3, v.CREATED, "created", "literal", v.XSD_DATETIME),
        _customer_triples(4, v.LAST_MODIFIED, "modified", "literal", v.XSD_DATETIME),
        _customer_triples(5, v.TITLE, "title", "literal", v.XSD_STRING),
        _customer_triples(
            6, v.HAS_TRANSFORMATION, "transformation", "uri", where="transformation is not null"
        ),
        _customer_triples(
            7, v.HAS_TRANSFORMATION, "'default'", "literal", v.XSD_STRING, "c_custkey % 10 = 5"
        ),
        _customer_triples(
            8, v.RDF_TYPE, f"'{RESOURCE}'", "uri", where="c_custkey % 5 = 0",
            subject="concat(uri, '#meta')",
        ),
    ]
)

_TRIPLES = f"""
select cast(null as string) as graph, subject, predicate, object, object_kind, datatype,
  cast(null as string) as lang, doc, ord
from (
{_DESCRIPTIONS}
union all
select concat('{BASE}/objects/', cast(o_custkey as string)), '{v.CONTAINS}',
  concat('{BASE}/orders/', cast(o_orderkey as string)), 'uri', cast(null as string),
  concat('{BASE}/objects/', cast(o_custkey as string)), 100 + o_orderkey
from {{orders}}
) t
"""

_BINARIES = f"""
select concat('{BASE}/documents/', cast(doc_id as string)) as uri, text, n_chars,
  case when doc_id % 10 = 0 then '{v.CONTAINER}' else '{v.BINARY}' end as resource_type,
  case when doc_id % 13 = 0 then concat(text, 'x') else text end as recorded_text,
  doc_id % 29 <> 0 as recorded
from {{documents}}
"""

_REQUESTS = f"""
select concat('c', cast(c_custkey as string)) as request_id,
  concat('/objects/', cast(c_custkey as string)) as path,
  case c_custkey % 3 when 0 then 'application/json' when 1 then 'text/plain' end as content_type,
  case c_custkey % 5 when 0 then null when 1 then 'queue:solr'
    when 2 then concat(' queue:solr,', chr(9), chr(10), 'queue:triple , queue:solr  ')
    when 3 then '  ' else 'queue:fixity,queue:http' end as recipients_header,
  case c_custkey % 7 when 0 then '["queue:json","queue:solr"]' when 1 then '["queue:broken"'
    when 2 then concat('   ', chr(10)) when 3 then null when 4 then '["queue:triple"]'
    when 5 then '[]' else '["queue:other", "queue:other"]' end as body
from {{customer}}
union all
select concat('r', cast(r_regionkey as string)), concat('/regions/', cast(r_regionkey as string)),
  'application/json', 'queue:solr', '["queue:fixity"]'
from {{region}}
"""

SQL = {
    "repo_events": _EVENTS,
    "repo_hints": _HINTS,
    "repo_edges": _EDGES,
    "repo_customers": _CUSTOMERS,
    "repo_triples": _TRIPLES,
    "repo_binaries": _BINARIES,
    "repo_requests": _REQUESTS,
}
_NEEDS = {
    "repo_events": ["events"],
    "repo_hints": ["supplier"],
    "repo_edges": ["region", "nation", "customer", "orders"],
    "repo_customers": ["customer"],
    "repo_triples": ["repo_customers", "orders"],
    "repo_binaries": ["documents"],
    "repo_requests": ["customer", "region"],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a Spark frame."""
    if name not in SQL:
        return table(spark, sf_dir, name)
    parts = {need: view(spark, sf_dir, need) for need in _NEEDS[name]}
    return spark.sql(SQL[name], **parts)


def from_text(rows: DataFrame) -> DataFrame:
    """The event view's comma texts as lists, in canonical form."""
    lists = {
        c: F.split(F.col(f"{c}_text"), ",") for c in ("event_types", "resource_types", "agents")
    }
    rows = rows.withColumns(lists).withColumn("ts", F.col("ts").cast("timestamp"))
    return canonicalise(rows.drop(*[f"{c}_text" for c in lists]))


def events(spark, sf_dir) -> DataFrame:
    return from_text(view(spark, sf_dir, "repo_events"))


def hints(spark, sf_dir) -> DataFrame:
    return view(spark, sf_dir, "repo_hints")


def triples(spark, sf_dir) -> DataFrame:
    return view(spark, sf_dir, "repo_triples")


def with_views(names, body: str) -> str:
    """Check SQL: the wanted views as common table expressions in front of ``body``."""
    wanted = []

    def add(name):
        if name in SQL:
            for need in _NEEDS[name]:
                add(need)
            if name not in wanted:
                wanted.append(name)

    for name in names:
        add(name)
    plain = {n: n for n in list(TABLES) + list(SQL)}
    ctes = [f"{n} as ({SQL[n].format(**plain)})" for n in wanted]
    return "with recursive " + ",\n".join(ctes) + body
