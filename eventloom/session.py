"""Session for tests and benchmarks, and the shared folder long jobs write through."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus="8", memory="12g", app="eventloom") -> SparkSession:
    """A session on this machine. On a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Folders of this process's applications that are there and marked for removal.
_HOMES: set = set()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder the session names.

    Only where the session names none (a single machine, as in tests) a temporary folder
    is made and recorded in the session, so that every later job uses the same one. What an
    application writes here lies in one folder of its own, which goes when its session ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="eventloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    context = spark.sparkContext
    home = f"{root.rstrip('/')}/eventloom/{context.applicationId}"
    if home not in _HOMES:
        place = context._jvm.org.apache.hadoop.fs.Path(home)
        files = place.getFileSystem(context._jsc.hadoopConfiguration())
        files.mkdirs(place)
        files.deleteOnExit(place)
        _HOMES.add(home)
    return f"{home}/{name}-{uuid.uuid4().hex}"
