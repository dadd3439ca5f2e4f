"""Options of the services, with their defaults and their property names."""

from dataclasses import dataclass, field, fields

from eventloom import vocab

_LOCAL = "http://localhost:8080/rest"

# Property name -> option; names are matched as they are.
_PROPERTIES = {
    "audit.enabled": "audit_enabled",
    "solr.indexing.enabled": "search_enabled",
    "triplestore.indexing.enabled": "triplestore_enabled",
    "fixity.enabled": "fixity_enabled",
    "http.enabled": "forward_enabled",
    "reindexing.enabled": "reindexing_enabled",
    "audit.filter.containers": "audit_containers",
    "solr.filter.containers": "search_containers",
    "triplestore.filter.containers": "triplestore_containers",
    "http.filter.containers": "forward_containers",
    "solr.indexing.predicate": "search_require_indexable",
    "triplestore.indexing.predicate": "triplestore_require_indexable",
    "search.checkTransformation": "check_transformation",
    "search.defaultTransform": "default_transform",
    "solr.commitWithin": "commit_within",
    "solr.include.containment": "include_containment",
    "triplestore.prefer.include": "prefer_include",
    "triplestore.prefer.omit": "prefer_omit",
    "triplestore.namedGraph": "named_graph",
    "audit.event.baseUri": "event_base_uri",
    "fixity.delay": "fixity_delay",
    "http.baseUrl": "forward_url",
    "http.authUsername": "forward_username",
    "http.authPassword": "forward_password",
    "triplestore.baseUrl": "triplestore_url",
    "triplestore.authUsername": "triplestore_username",
    "triplestore.authPassword": "triplestore_password",
    "audit.triplestore.baseUrl": "audit_url",
    "audit.triplestore.authUsername": "audit_username",
    "audit.triplestore.authPassword": "audit_password",
    "solr.baseUrl": "search_url",
    "solr.username": "search_username",
    "solr.password": "search_password",
    "error.maxRedeliveries": "max_redeliveries",
    "repository.baseUrl": "base_url",
    "error.redeliveryDelay": "redelivery_delay",
    "error.redeliveryQueue": "redelivery_queue",
    "error.redeliveryPause": "redelivery_pause",
    "index.compactEvery": "compact_every",
    "index.buckets": "index_buckets",
    "index.keepGenerations": "keep_generations",
    "index.edges.enabled": "edges_enabled",
    "index.facts.enabled": "facts_enabled",
    "index.edges.filter.containers": "edges_containers",
}


@dataclass
class Options:
    """Everything that can be configured. Containers are comma-separated uris."""

    audit_enabled: bool = False
    search_enabled: bool = False
    triplestore_enabled: bool = False
    fixity_enabled: bool = False
    forward_enabled: bool = False
    reindexing_enabled: bool = True
    edges_enabled: bool = False
    facts_enabled: bool = False

    audit_containers: str = _LOCAL + "/audit"
    search_containers: str = _LOCAL + "/audit"
    triplestore_containers: str = _LOCAL + "/audit"
    forward_containers: str = _LOCAL + "/audit"
    edges_containers: str = ""

    search_require_indexable: bool = False
    triplestore_require_indexable: bool = False
    check_transformation: bool = True
    default_transform: str = "default"
    commit_within: int = 10_000
    include_containment: bool = False
    prefer_include: str = ""
    prefer_omit: str = vocab.PREFER_CONTAINMENT
    named_graph: str = ""
    event_base_uri: str = "http://example.com/event"
    fixity_delay: int = 0
    forward_url: str = ""
    forward_username: str = ""
    forward_password: str = ""
    # Other systems to be told of changes as well; empty keeps to the tables under ``target``.
    triplestore_url: str = ""
    triplestore_username: str = ""
    triplestore_password: str = ""
    audit_url: str = ""
    audit_username: str = ""
    audit_password: str = ""
    search_url: str = ""
    search_username: str = ""
    search_password: str = ""
    max_redeliveries: int = 10
    # Milliseconds between two attempts, and batches between two new bases of an index (0: none).
    redelivery_delay: int = 0
    # Failed messages wait in a queue for later batches instead of being tried again at once;
    # the first pause in milliseconds, each next one twice as long.
    redelivery_queue: bool = False
    redelivery_pause: int = 60_000
    compact_every: int = 0
    # Buckets of a new base (a divisor of 1,024), and generations of it that stay readable.
    index_buckets: int = 1_024
    keep_generations: int = 2
    base_url: str = _LOCAL

    # Not properties: where the services read and write, and how they reach other systems.
    target: str = ""
    transforms: dict = field(default_factory=dict)
    transports: dict = field(default_factory=dict)
    on_success: object = None
    on_failure: object = None
    # Predicates of preference groups beside containment: a mapping or a table.
    prefer_groups: object = None

    @classmethod
    def from_properties(cls, properties: dict) -> "Options":
        """Options from property names and text values; unknown names are ignored."""
        kinds = {f.name: f.type for f in fields(cls)}
        values = {}
        for name, text in properties.items():
            option = _PROPERTIES.get(name)
            if option is None:
                continue
            if kinds[option] is bool:
                text = str(text).strip().lower() == "true"
            elif kinds[option] is int:
                text = int(text)
            values[option] = text
        return cls(**values)


# Service name -> the flag that enables it.
FLAGS = {
    "audit": "audit_enabled",
    "search": "search_enabled",
    "triplestore": "triplestore_enabled",
    "fixity": "fixity_enabled",
    "forward": "forward_enabled",
    "reindexing": "reindexing_enabled",
    "edges": "edges_enabled",
    "facts": "facts_enabled",
}


def enabled_services(options: Options) -> list[str]:
    """Names of the services whose flag is on."""
    return [name for name, flag in FLAGS.items() if getattr(options, flag)]
