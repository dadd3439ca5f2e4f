"""Corpus pipeline: documents go through quality, line dedup, near-dedup, mixing and packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's documents.
"""

from pyspark.sql import functions as F

from eventloom.llm import line_dedup, mixing, packing, quality, simhash
from eventloom.llm.common import recorded, removed, stored, table


def measured(docs):
    """``n_chars`` follows the text where a stage has shortened it."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), "n_chars"))


def quality_stage(spark, docs, sf_dir):
    """Documents that the classifier rejects go; it learns from the labels of ``sf_dir``."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_stage(spark, docs, sf_dir):
    """Passages that an earlier document holds go from the later one."""
    return measured(line_dedup.without_repeats(docs))


def near_stage(spark, docs, sf_dir):
    """Of each group of near-copies one document stays: SimHash fingerprints within two bits,
    found by pigeonring, or a Jaccard similarity of 0.8 of five-word shingles, beyond their reach."""
    return simhash.near_dedup(docs)


def mixing_stage(spark, docs, sf_dir):
    """Documents appear as often as the mixture takes them."""
    return measured(mixing.mix_documents(docs))


def packing_stage(spark, docs, sf_dir):
    """Pieces of documents with their places in sequences."""
    return packing.pack(docs, packing.word_vocabulary())


#: What the stage before has stored for itself.
_BEFORE: list = []


def staged(stage, first=False):
    """The stage; when it begins, its predecessor's result has been written and is read from
    there, so what the predecessor stored for itself goes."""

    def run_stage(spark, docs, sf_dir):
        if first:
            _BEFORE.clear()
        removed(spark, _BEFORE)
        with recorded() as paths:
            out = stage(spark, docs, sf_dir)
        _BEFORE.extend(paths)
        return out

    return run_stage


STAGES = [
    ("quality classifier", staged(quality_stage, first=True)),
    ("line dedup", staged(line_stage)),
    ("SimHash near-dedup", staged(near_stage)),
    ("mixing sources to target weights", staged(mixing_stage)),
    ("packing", staged(packing_stage)),
]

#: The classifier and the cube method cannot be told in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; each stage's rows are stored before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{number}")
    return docs
