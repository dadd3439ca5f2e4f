"""Content checks: recompute digests and compare them with the record."""

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventloom import vocab
from eventloom.functions import digest

SUCCESS, FAILURE = "SUCCESS", "FAILURE"
RESULT = (
    "uri string, algorithm string, expected_digest string, actual_digest string, "
    "expected_size long, actual_size long, outcome string"
)
#: Bytes read at a time.
CHUNK = 4 << 20


def binary_uris(triples: DataFrame) -> DataFrame:
    is_binary = (F.col("predicate") == vocab.RDF_TYPE) & (F.col("object") == vocab.BINARY)
    return triples.filter(is_binary).select(F.col("doc").alias("uri")).distinct()


def only_binaries(df: DataFrame, triples: DataFrame | None, facts: DataFrame | None = None) -> DataFrame:
    """Keep rows whose description has a binary in it; with ``facts`` (see
    ``state.current_facts``) no triples are read."""
    known = binary_uris(triples) if facts is None else facts.filter("is_binary").select("uri")
    return df.join(known, "uri", "left_semi")


def read_binaries(spark: SparkSession, path: str, **options) -> DataFrame:
    """(uri, content) of files; a file is read whole by the task that digests it."""
    files = spark.read.format("binaryFile").options(**options).load(path)
    return files.select(F.col("path").alias("uri"), "content")


def digest_files(files: DataFrame, algorithm: str = "sha-256") -> DataFrame:
    """(uri, actual_digest, actual_size) of files, ``files`` being (uri, path).

    Each file is opened by the task that has its row and read in chunks, so its size does not
    matter, and only files that are asked for are opened. A file that cannot be read has no
    digest and so fails its check without failing the batch.
    """
    name = algorithm.replace("-", "").lower()

    def run(batches):
        from pyarrow import fs

        for batch in batches:
            digests, sizes = [], []
            for path in batch.column("path").to_pylist():
                summed, size = hashlib.new(name), 0
                try:
                    store, place = fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")
                    with store.open_input_stream(place) as file:
                        while chunk := file.read(CHUNK):
                            summed.update(chunk)
                            size += len(chunk)
                    digests.append(summed.hexdigest())
                    sizes.append(size)
                except (OSError, pa.ArrowInvalid):
                    digests.append(None)
                    sizes.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("uri"), pa.array(digests, pa.string()), pa.array(sizes, pa.int64())],
                names=["uri", "actual_digest", "actual_size"],
            )

    schema = "uri string, actual_digest string, actual_size long"
    return files.select("uri", "path").mapInArrow(run, schema)


def verify_fixity(
    binaries: DataFrame,
    manifest: DataFrame,
    algorithm: str = "sha-256",
    size: Column | None = None,
    only: DataFrame | None = None,
    late: bool = False,
) -> DataFrame:
    """Digest and size of every binary against the recorded ones, one row per binary.

    ``binaries`` is (uri, content) or (uri, path), ``manifest`` (uri, digest as ``urn:<algorithm>:<hex>``,
    size). Success needs equal digest and size; a binary without a record is a failure.
    ``size`` replaces the byte length where the content column is not the stored bytes.

    ``only`` (uri, each once) restricts the check, by choice before or (``late``) after
    digesting: after it only digests are shuffled, before it nothing else is digested. Where
    content lies in files, ``digest_files`` reads just those asked for and needs neither.
    """
    early = only is not None and not late
    if early:
        binaries = binaries.join(only.select("uri"), "uri", "left_semi")
    if "path" in binaries.columns:
        actual = digest_files(binaries, algorithm)
    else:
        actual = binaries.select(
            "uri",
            digest("content", algorithm).alias("actual_digest"),
            (F.octet_length("content") if size is None else size).cast("long").alias("actual_size"),
        )
    if only is not None and not early:
        actual = actual.join(only.select("uri"), "uri", "left_semi")
    urn = F.split("digest", ":", 3)
    recorded = manifest.filter(F.lower(F.get(urn, F.lit(1))) == algorithm).select(
        "uri",
        F.lower(F.get(urn, F.lit(2))).alias("expected_digest"),
        F.col("size").cast("long").alias("expected_size"),
    )
    same = (F.col("actual_digest") == F.col("expected_digest")) & (
        F.col("actual_size") == F.col("expected_size")
    )
    return actual.join(recorded, "uri", "left").select(
        "uri",
        F.lit(algorithm).alias("algorithm"),
        "expected_digest",
        "actual_digest",
        "expected_size",
        "actual_size",
        F.when(same, SUCCESS).otherwise(FAILURE).alias("outcome"),
    )


def fixity_report(triples: DataFrame) -> DataFrame:
    """(uri, outcome, algorithm, digest, size, location) of each report graph.

    The outcome is a success as soon as one outcome says exactly so.
    """

    def first(predicate):
        found = F.col("predicate") == predicate
        order = F.struct(F.coalesce("ord", F.lit(0)), F.col("object"))
        return F.min_by(F.when(found, F.col("object")), F.when(found, order))

    passed = (F.col("predicate") == vocab.EVENT_OUTCOME) & (F.col("object") == SUCCESS)
    wanted = [vocab.EVENT_OUTCOME, vocab.MESSAGE_DIGEST, vocab.SIZE, vocab.CONTENT_LOCATION]
    graphs = triples.groupBy(F.col("doc").alias("uri")).agg(
        F.max(passed).alias("passed"),
        *[first(p).alias(f"_{i}") for i, p in enumerate(wanted)],
    )
    urn = F.split("_1", ":", 3)
    return graphs.select(
        "uri",
        F.when(F.col("passed"), SUCCESS).otherwise(F.col("_0")).alias("outcome"),
        F.get(urn, F.lit(1)).alias("algorithm"),
        F.get(urn, F.lit(2)).alias("digest"),
        F.col("_2").try_cast("long").alias("size"),
        F.col("_3").alias("location"),
    )


def split_fixity(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(success, failure); anything but a plain success is a failure."""
    good = F.coalesce(F.col("outcome") == SUCCESS, F.lit(False))
    return results.filter(good), results.filter(~good)


def report_triples(results: DataFrame) -> DataFrame:
    """Results of a check as report graphs, one document per checked resource."""

    def entry(predicate, value, kind, datatype=None):
        return F.struct(
            F.lit(predicate).alias("predicate"),
            value.cast("string").alias("object"),
            F.lit(kind).alias("object_kind"),
            F.lit(datatype).cast("string").alias("datatype"),
        )

    urn = F.concat(F.lit("urn:"), F.col("algorithm"), F.lit(":"), F.col("actual_digest"))
    entries = F.array(
        entry(vocab.EVENT_OUTCOME, F.col("outcome"), "literal", vocab.XSD_STRING),
        entry(vocab.MESSAGE_DIGEST, urn, "uri"),
        entry(vocab.SIZE, F.col("actual_size"), "literal", vocab.XSD + "long"),
        entry(vocab.CONTENT_LOCATION, F.col("uri"), "uri"),
    )
    none = F.lit(None).cast("string")
    return results.select("uri", F.posexplode_outer(entries).alias("ord", "t")).select(
        none.alias("graph"),
        F.concat(F.col("uri"), F.lit("#fixity")).alias("subject"),
        "t.predicate",
        "t.object",
        "t.object_kind",
        "t.datatype",
        none.alias("lang"),
        F.col("uri").alias("doc"),
        F.col("ord").cast("long").alias("ord"),
    )
