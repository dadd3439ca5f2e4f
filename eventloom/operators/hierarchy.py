"""Re-index requests and the walk over the containment hierarchy."""

from pyspark.sql import DataFrame, functions as F

from eventloom import vocab
from eventloom.functions import NUMBER, is_blank, join_numbered, number, strip
from eventloom.operators.events import resource_uri
from eventloom.session import work_dir


def _json_body():
    return (F.col("content_type") == "application/json") & ~is_blank("body")


def merge_recipients(requests: DataFrame) -> DataFrame:
    """Recipients of a request: the header's entries and, for a JSON body, its elements.

    A JSON object stands for its values. Entries are distinct and sorted, blanks dropped.
    Adds ``recipients`` (list) and ``recipients_text`` (joined with commas).
    """
    header = F.transform(F.split(F.coalesce("recipients_header", F.lit("")), ","), strip)
    body = F.try_parse_json("body")
    # Elements of a list, values of an object (of a repeated name the last); what is nested
    # has no text of its own.
    entries = F.coalesce(
        F.try_variant_get(body, "$", "array<variant>"),
        F.map_values(F.try_variant_get(body, "$", "map<string,variant>")),
    )

    def text(entry):
        kind = F.schema_of_variant(entry)
        nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
        return F.when(~nested, F.try_variant_get(entry, "$", "string"))

    elements = F.when(_json_body(), F.transform(entries, text))
    none = F.array().cast("array<string>")
    merged = F.array_union(header, F.coalesce(elements, none))
    named = F.filter(merged, lambda r: r.isNotNull() & ~is_blank(r))
    return requests.withColumn("recipients", F.array_sort(named)).withColumn(
        "recipients_text", F.array_join("recipients", ",")
    )


def admit_requests(requests: DataFrame, base_url: str) -> DataFrame:
    """Answer each request: adds uri, recipients, status, message and ``admitted``."""
    invalid = F.coalesce(_json_body() & F.try_parse_json("body").isNull(), F.lit(False))
    nobody = F.size("recipients") == 0
    merged = resource_uri(merge_recipients(requests), base_url)
    return merged.withColumns(
        {
            "status": F.when(invalid, 400).otherwise(200),
            "message": F.when(invalid, vocab.INVALID_JSON)
            .when(nobody, vocab.NO_RECIPIENTS)
            .otherwise(F.concat(F.lit(vocab.STARTED_AT), F.col("uri"))),
            "admitted": ~invalid & ~nobody,
        }
    )


def _folders(spark, path: str) -> list:
    """Values of the partition folders under a path: names only, no rows."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    return [s.getPath().getName().partition("=")[2] for s in files.listStatus(place) if s.isDirectory()]


_LEVEL = "uri string, roots array<long>, bucket int"


class _Walk:
    """The tables of a walk in the shared work folder: per depth the nodes that it reaches first
    from some roots, as rows (uri, roots), by bucket of the uri."""

    def __init__(self, spark, buckets: int):
        self.spark, self.buckets, self.path = spark, buckets, work_dir(spark, "walk")

    def bucket(self, uri):
        return F.pmod(F.xxhash64(uri), F.lit(self.buckets)).cast("int")

    def write(self, rows: DataFrame, table: str, depth: int) -> list:
        """Store a level; the buckets that it has rows in."""
        rows.write.partitionBy("bucket").parquet(f"{self.path}/{table}/depth={depth}")
        return sorted(map(int, _folders(self.spark, f"{self.path}/{table}/depth={depth}")))

    def read(self, table: str, depth: int) -> DataFrame:
        return self.spark.read.schema(_LEVEL).parquet(f"{self.path}/{table}/depth={depth}")

    def visited(self, buckets: list) -> DataFrame:
        """Nodes of all depths so far that lie in these buckets; other folders are not read."""
        rows = self.spark.read.schema(f"{_LEVEL}, depth int").parquet(f"{self.path}/nodes")
        return rows.filter(F.col("bucket").isin(buckets)).select("uri", "roots")

    def reached(self, links: DataFrame, frontier: DataFrame) -> DataFrame:
        """(uri, roots): the children of a level. A child moves once for each link to it, with the
        roots of that parent as a list; roots that meet at a child become one set."""
        met = join_numbered(links, frontier.select(F.col("uri").alias("parent"), "roots"), "parent")
        met = met.select(self.bucket(F.col("child")).alias("bucket"), F.col("child").alias("uri"), "roots")
        dealt = met.repartition("bucket").select(
            number("uri"), "bucket", "uri", F.explode("roots").alias("root")
        )
        # Sets are collected from sorted rows: by number, as texts of uris begin alike.
        met = dealt.groupBy(NUMBER, "bucket", "uri").agg(F.collect_set("root").alias("roots"))
        return met.drop(NUMBER)

    def new(self, arrived: DataFrame, buckets: list) -> DataFrame:
        """What arrived, without the roots from which a node was reached before."""
        before = join_numbered(self.visited(buckets), arrived.select("uri"), "uri")
        before = before.groupBy(number("uri"), "uri").agg(F.flatten(F.collect_list("roots")).alias("before"))
        fresh = F.array_except("roots", F.coalesce("before", F.array().cast("array<long>")))
        known = join_numbered(arrived, before.drop(NUMBER), "uri", "left")
        rows = known.select("bucket", "uri", fresh.alias("roots"))
        return rows.filter(F.size("roots") > 0).repartition("bucket")


def traverse(edges, roots: DataFrame, max_depth: int | None = None) -> DataFrame:
    """(root, uri, depth): the roots and all that is contained in them, each node once.

    Level by level. ``roots`` is (uri); ``edges`` is (parent, child), or a function that gives
    the edges of asked-for parents (see ``sources.read_edges``): then a level reads only the
    buckets its nodes can be in. A frame is worked out once and kept while the walk runs.

    A level's row is a node with the set of roots from which it is reached first at this depth,
    as numbers: what a level shuffles is bounded by its links and distinct nodes, however many
    roots lead to them, and pairs are made only in the result, which has one row for each root
    and node by definition. Levels lie in the shared work folder by bucket of the node, so the
    test against nodes visited before reads only the buckets that have arrivals. Levels cut the
    lineage and outlive executors; the driver sees names of folders. Cycles end at nodes already
    seen. A set holds at most one number for each root.
    """
    spark = roots.sparkSession
    walk = _Walk(spark, int(spark.conf.get("spark.sql.shuffle.partitions")))
    numbered = roots.select(F.col("uri").alias("root")).distinct()
    numbered.select("root", F.monotonically_increasing_id().alias("number")).write.parquet(f"{walk.path}/roots")
    names = spark.read.schema("root string, number long").parquet(f"{walk.path}/roots")
    start = names.select(
        F.col("root").alias("uri"), F.array("number").alias("roots"), walk.bucket(F.col("root")).alias("bucket")
    )
    live, depth = walk.write(start, "nodes", 0), 0
    asked = callable(edges)
    pairs = None if asked else edges.select("parent", "child").filter(F.col("child").isNotNull()).persist()
    try:
        while live and (max_depth is None or depth < max_depth):
            frontier = walk.read("nodes", depth)
            links = edges(frontier.select(F.col("uri").alias("parent"))) if asked else pairs
            links = links.select("parent", "child").filter(F.col("child").isNotNull())
            depth += 1
            arrivals = walk.write(walk.reached(links, frontier), "arrived", depth)
            if not arrivals:
                break
            live = walk.write(walk.new(walk.read("arrived", depth), arrivals), "nodes", depth)
    finally:
        if pairs is not None:
            pairs.unpersist()
    nodes = spark.read.schema(f"{_LEVEL}, depth int").parquet(f"{walk.path}/nodes")
    found = nodes.select(F.explode("roots").alias("number"), "uri", "depth").join(names, "number")
    return found.select("root", "uri", "depth")


def fan_out(hints: DataFrame) -> DataFrame:
    """One row per (node, recipient); blank recipients are ignored."""
    return hints.select(
        *[c for c in hints.columns if c != "recipients"],
        F.explode_outer("recipients").alias("recipient"),
    ).filter(~is_blank("recipient"))


def reindex(requests: DataFrame, edges, base_url: str, **walk) -> DataFrame:
    """(request_id, uri, recipient, depth) for every node under every admitted request."""
    admitted = (
        admit_requests(requests, base_url)
        .filter("admitted")
        .select("request_id", F.col("uri").alias("root"), "recipients")
    )
    nodes = traverse(edges, admitted.select(F.col("root").alias("uri")), **walk)
    return fan_out(join_numbered(nodes, admitted, "root")).select(
        "request_id", "uri", "recipient", "depth"
    )
