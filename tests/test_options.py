from eventloom import vocab
from eventloom.options import Options, enabled_services
from eventloom.streaming.services import Inputs, build_services


def test_defaults():
    options = Options()
    assert enabled_services(options) == ["reindexing"]
    assert (options.max_redeliveries, options.commit_within, options.fixity_delay) == (10, 10_000, 0)
    assert options.prefer_omit == vocab.PREFER_CONTAINMENT and options.check_transformation
    assert not options.search_require_indexable and not options.include_containment


def test_property_names():
    options = Options.from_properties(
        {
            "audit.enabled": "true",
            "solr.indexing.enabled": "TRUE",
            "reindexing.enabled": "false",
            "fixity.enabled": "yes",
            "error.maxRedeliveries": "3",
            "triplestore.namedGraph": "urn:g",
            "search.checkTransformation": "false",
            "search.defaultTransform": "own",
            "http.baseUrl": "http://localhost/in",
            "repository.baseUrl": "http://h/rest",
            "whatever.baseUrl": "http://elsewhere",
            "solr.baseUrl": "http://search",
            "triplestore.baseUrl": "http://store",
            "audit.triplestore.authUsername": "me",
            "unheard.of": "1",
        }
    )
    assert enabled_services(options) == ["audit", "search"]
    assert (options.max_redeliveries, options.named_graph) == (3, "urn:g")
    assert not options.check_transformation and options.default_transform == "own"
    assert (options.search_url, options.triplestore_url) == ("http://search", "http://store")
    assert options.audit_username == "me"
    assert (options.forward_url, options.base_url) == ("http://localhost/in", "http://h/rest")


def test_disabled_services_are_not_built(spark):
    stream = spark.readStream.format("rate").load()
    assert build_services(Inputs(events=stream), Options(reindexing_enabled=False)) == {}
    started = build_services(Inputs(events=stream), Options(audit_enabled=True))
    assert set(started) == {"audit"}
