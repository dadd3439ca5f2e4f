"""A table as a log of changes plus a folded base, on plain Parquet, described by a manifest.

Every micro-batch writes its changes to a folder named after writer and batch, so a replayed
batch replaces itself and the cost of a batch does not grow with the table. A base names the
batches it holds; readers take the newest base and every finished batch it does not name. So a
base may be made while writers go on: a batch that ends meanwhile is simply not in it.

Each change of the base is a generation with a manifest of its own: where the base's buckets lie,
which batches they hold (as ranges of numbers, so that a manifest does not grow with a writer's
history) and which graphs have been emptied since. A generation's number is taken by creating its
file, which fails for all but one: what was worked out from an older generation is refused. Old
generations, bases and batches that no kept or pinned generation needs are removed by ``expire``.
"""

import json
import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


class BaseMoved(RuntimeError):
    """Another base was made meanwhile; what was worked out from the old one is not used."""


@dataclass(frozen=True)
class Manifest:
    """A generation. ``parts``: base -> its buckets that count (None: all, not bucketed).
    ``covered``: writer -> ranges of batches in the base. ``voids``: (graph, ranges by writer):
    rows of that graph in the base and in those batches are gone."""

    generation: int = 0
    buckets: int = 0
    parts: dict = field(default_factory=dict)
    covered: dict = field(default_factory=dict)
    voids: tuple = ()

    def covers(self, writer: str, batch: int) -> bool:
        return any(a <= batch <= b for a, b in self.covered.get(writer, ()))


def _files(spark: SparkSession, path: str):
    """(file system, path object) of a place in any store Spark reads."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _listed(spark: SparkSession, path: str, folders: bool = True) -> list:
    files, place = _files(spark, path)
    if not files.exists(place):
        return []
    return [s.getPath().getName() for s in files.listStatus(place) if s.isDirectory() == folders]


def _removed(spark: SparkSession, path: str) -> None:
    files, place = _files(spark, path)
    files.delete(place, True)


# --- batches --------------------------------------------------------------------------------


def finished_batches(spark: SparkSession, path: str, beyond: Manifest | None = None) -> set:
    """(writer, batch) of every batch that was written to its end; names only, no rows.

    Batches that ``beyond`` covers are left out without a look at their folders.
    """
    found = set()
    for folder in _listed(spark, f"{path}/changes"):
        writer = folder.partition("=")[2]
        for name in _listed(spark, f"{path}/changes/{folder}"):
            batch = int(name.partition("=")[2])
            if beyond is not None and beyond.covers(writer, batch):
                continue
            files, done = _files(spark, f"{path}/changes/{folder}/{name}/_SUCCESS")
            if files.exists(done):
                found.add((writer, batch))
    return found


def write_batch(changes: DataFrame, path: str, batch_id: int, writer: str = "main") -> None:
    """Store one batch; replaying the same batch of the same writer is harmless."""
    folder = f"{path}/changes/writer={writer}/batch={batch_id}"
    changes.write.mode("overwrite").parquet(folder)


def ranges(batches, known: dict | None = None) -> dict:
    """Batches and known ranges as ranges by writer, neighbours joined."""
    out: dict = {w: [tuple(r) for r in rs] for w, rs in (known or {}).items()}
    for writer, batch in batches:
        out.setdefault(writer, []).append((batch, batch))
    for writer, found in out.items():
        joined: list = []
        for a, b in sorted(found):
            if joined and a <= joined[-1][1] + 1:
                joined[-1] = (joined[-1][0], max(b, joined[-1][1]))
            else:
                joined.append((a, b))
        out[writer] = joined
    return out


def _inside(covered: dict) -> Column:
    """Whether a log row's batch is in the ranges."""
    tests = [
        (F.col("writer") == w) & F.col("batch").between(a, b) for w, rs in covered.items() for a, b in rs
    ]
    return reduce(lambda x, y: x | y, tests, F.lit(False))


def read_log(spark: SparkSession, path: str, schema, manifest: Manifest, batches=None):
    """Rows of the finished batches that the manifest's base does not hold; None without any.

    ``batches`` may name the finished batches to look at.
    """
    found = finished_batches(spark, path, manifest) if batches is None else batches
    later = sorted((w, b) for w, b in found if not manifest.covers(w, b))
    if not later:
        return None
    kind = T.StructType([
        *schema.fields, T.StructField("writer", T.StringType()), T.StructField("batch", T.LongType())
    ])
    reader = spark.read.schema(kind).option("basePath", f"{path}/changes")
    rows = reader.parquet(*[f"{path}/changes/writer={w}/batch={b}" for w, b in later])
    for graph, covered in manifest.voids:
        rows = rows.filter(~(F.col("graph").eqNullSafe(F.lit(graph)) & _inside(covered)))
    return rows.select(schema.fieldNames())


# --- generations ----------------------------------------------------------------------------


def _manifest_path(path: str, generation: int) -> str:
    return f"{path}/manifest/{generation:012}.json"


def generations(spark: SparkSession, path: str) -> list:
    """Numbers of the generations whose manifests are there, newest first."""
    names = _listed(spark, f"{path}/manifest", folders=False)
    return sorted((int(n.partition(".")[0]) for n in names if n.endswith(".json") and n[0] != "."), reverse=True)


def manifest(spark: SparkSession, path: str, generation: int | None = None) -> Manifest:
    """The newest generation that was written to its end, or a certain one."""
    for number in generations(spark, path) if generation is None else [generation]:
        files, place = _files(spark, _manifest_path(path, number))
        stream = files.open(place)
        try:
            text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            told = json.loads(text)
        except ValueError:  # its maker died, or has not finished
            continue
        return Manifest(
            number, told["buckets"], told["parts"], ranges((), told["covered"]),
            tuple((g, ranges((), c)) for g, c in told["voids"]),
        )
    return Manifest()


def publish(spark: SparkSession, path: str, after: Manifest, **changes) -> Manifest:
    """The generation that follows ``after``; refused if that is no longer the newest."""
    numbers = generations(spark, path)
    if numbers and manifest(spark, path).generation != after.generation:
        raise BaseMoved(f"{path} has moved on from generation {after.generation}")
    new = replace(after, generation=max([0, *numbers]) + 1, **changes)
    told = {k: getattr(new, k) for k in ("buckets", "parts", "covered", "voids")}
    files, place = _files(spark, _manifest_path(path, new.generation))
    try:
        out = files.create(place, False)
    except Exception as problem:
        raise BaseMoved(f"{path} is being moved on to generation {new.generation}") from problem
    try:
        out.write(bytearray(json.dumps(told | {"made_at": int(time.time())}).encode()))
    finally:
        out.close()
    return new


def new_base(after: Manifest) -> str:
    """A name for a base that ``after``'s successor will hold; each attempt has its own."""
    return f"{after.generation + 1:012}-{uuid.uuid4().hex}"


def base_path(path: str, base: str) -> str:
    return f"{path}/bases/base={base}"


def read_base(spark: SparkSession, path: str, schema, manifest: Manifest, buckets=None):
    """The base's rows (with ``bucket`` if bucketed); None before the first.

    ``buckets`` names those wanted: others are not read. A base that the manifest names and that
    is not there is an error, never an empty table.
    """
    extra = T.StructType([
        *schema.fields, T.StructField("base", T.StringType()), T.StructField("bucket", T.IntegerType())
    ])
    reader = spark.read.schema(extra).option("basePath", f"{path}/bases")
    names, found = [*schema.fieldNames(), "bucket"], []
    bucketed = {b: set(held) for b, held in manifest.parts.items() if held is not None}
    if buckets is not None:
        bucketed = {b: held & set(buckets) for b, held in bucketed.items()}
    bucketed = {b: held for b, held in bucketed.items() if held}
    if bucketed:
        rows = reader.parquet(*[base_path(path, b) for b in sorted(bucketed)])
        counts = [(F.col("base") == b) & F.col("bucket").isin(sorted(held)) for b, held in bucketed.items()]
        found.append(rows.filter(reduce(lambda x, y: x | y, counts)).select(names))
    for base, held in manifest.parts.items():
        if held is None:
            flat = spark.read.schema(schema).parquet(base_path(path, base))
            found.append(flat.withColumn("bucket", F.lit(None).cast("int")))
    for graph, _ in manifest.voids:
        found = [f.filter(~F.col("graph").eqNullSafe(F.lit(graph))) for f in found]
    if not found:
        return None if not manifest.parts else spark.createDataFrame([], extra).select(names)
    return reduce(DataFrame.unionByName, found)


def read_changes(spark: SparkSession, path: str, schema, batches=None, at: Manifest | None = None) -> DataFrame:
    """The base's rows and all changes since, unordered."""
    known = at or manifest(spark, path)
    base = read_base(spark, path, schema, known)
    log = read_log(spark, path, schema, known, batches)
    parts = [p.select(schema.fieldNames()) for p in (base, log) if p is not None]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def rebase(spark: SparkSession, path: str, state, covered=None, after: Manifest | None = None) -> Manifest:
    """Make a new base, without buckets, of ``state``: a frame, or a function of the finished
    batches' names. The manifest comes after the base is complete, so a failed attempt changes
    nothing."""
    before = after or manifest(spark, path)
    batches = finished_batches(spark, path, before) if covered is None else covered
    rows = state(batches) if callable(state) else state
    base = new_base(before)
    rows.write.parquet(base_path(path, base))
    return publish(
        spark, path, before, parts={base: None}, covered=ranges(batches, before.covered), voids=(), buckets=0
    )


@contextmanager
def pinned(spark: SparkSession, path: str):
    """The newest generation, kept readable meanwhile whatever is compacted and expired."""
    while True:
        known = manifest(spark, path)
        name = f"{path}/pins/{known.generation:012}-{uuid.uuid4().hex}"
        files, place = _files(spark, name)
        files.create(place, False).close()
        if not generations(spark, path) or known.generation in generations(spark, path):
            break
        _removed(spark, name)
    try:
        yield known
    finally:
        _removed(spark, name)


def expire(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove what only generations before the newest ``keep`` and the pinned ones need.

    Gone are their manifests, bases that no kept generation names (a base being made for the next
    generation is not touched), and batches that all kept generations cover. A reader that takes
    longer than ``keep`` further generations pins its own.
    """
    numbers = generations(spark, path)
    if not numbers:
        return
    pins = {int(n.partition("-")[0]) for n in _listed(spark, f"{path}/pins", folders=False) if n[0] != "."}
    kept = sorted({*numbers[:keep], *(pins & set(numbers))})
    known = [manifest(spark, path, n) for n in kept]
    known = [m for m in known if m.generation]
    if not known or any(p not in numbers and p < kept[0] for p in pins):
        return  # nothing readable, or a reader from before the first generation
    named = {base for m in known for base in m.parts}
    for folder in _listed(spark, f"{path}/bases"):
        base = folder.partition("=")[2]
        if base not in named and int(base.partition("-")[0]) <= numbers[0]:
            _removed(spark, f"{path}/bases/{folder}")
            _removed(spark, f"{path}/filters/{folder}")
    for folder in _listed(spark, f"{path}/changes"):
        writer = folder.partition("=")[2]
        for name in _listed(spark, f"{path}/changes/{folder}"):
            if all(m.covers(writer, int(name.partition("=")[2])) for m in known):
                _removed(spark, f"{path}/changes/{folder}/{name}")
                _removed(spark, f"{path}/filters/{folder}/{name}")
    for number in set(numbers) - set(kept):
        _removed(spark, _manifest_path(path, number))
