"""Licence scan: a positional index of rare licence words, verified by key phrases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import stored, table, whole_text

#: A word of either case: ASCII letters and digits, and all that is not ASCII.
WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
#: Rare words of a key phrase that have to agree on a place before it is verified.
ANCHORS = 2
#: Share of a template's words that must stand at their places.
COVERAGE = 0.6

# Phrases whose every place counts, by label.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# Licence notices as (label, template); the mandatory key phrase is in brackets.
TEMPLATES = (
    ("mit", "[permission is hereby granted free of charge to any person obtaining a copy] of this "
            "software and associated documentation files"),
    ("apache-2", "[licensed under the apache license version 2] 0 the license you may not use this "
                 "file except in compliance with the license"),
    ("gpl-2", "[gnu general public license version 2]"),
    ("gpl-2", "gnu general public license as published by the [free software foundation either "
              "version 2 of the license]"),
    ("gpl-3", "[gnu general public license version 3]"),
    ("gpl-3", "gnu general public license as published by the [free software foundation either "
              "version 3 of the license]"),
    ("lgpl", "[gnu lesser general public license]"),
    ("agpl", "[gnu affero general public license]"),
    ("bsd", "[redistribution and use in source and binary forms with or without modification] are "
            "permitted provided that the following conditions are met"),
    ("isc", "[permission to use copy modify and or distribute this software] for any purpose with "
            "or without fee is hereby granted"),
    ("mpl-2", "this source code form is subject to the terms of the [mozilla public license v 2] 0"),
    ("epl", "[eclipse public license]"),
    ("cc-by", "[creative commons attribution 4 0 international]"),
    ("cc-by-sa", "[cc by sa]"),
    ("cc-by-sa", "[creative commons attribution sharealike]"),
    ("cc-by-nc", "[creative commons attribution noncommercial]"),
    ("cc0", "[cc0 1 0 universal]"),
    ("unlicense", "this is [free and unencumbered software released into the public domain]"),
)


def index() -> tuple[list, list]:
    """Templates as (template, label, base, words, keys) and their words as
    (template, place, word, key)."""
    heads, places = [], []
    all_templates = [(label, f"[{text}]", True) for label, text in BASE]
    all_templates += [(label, text, False) for label, text in TEMPLATES]
    for t, (label, text, base) in enumerate(all_templates):
        inside, keys, words = False, 0, text.split()
        for q, word in enumerate(words):
            inside |= word.startswith("[")
            places.append((t, q, word.strip("[]"), inside))
            keys += inside
            inside &= not word.endswith("]")
        heads.append((t, label, base, len(words), keys))
    return heads, places


def read_words(docs: DataFrame) -> DataFrame:
    """(row, doc_id, n_words, present, hits), stored.

    ``present`` holds the licence words of a whole text; ``hits`` their places, only where all
    words of some key phrase are present, as nothing else can match.
    """
    _, places = index()
    vocabulary = sorted({word for _, _, word, _ in places})
    keys: dict[int, set] = {}
    for t, _, word, key in places:
        if key:
            keys.setdefault(t, set()).add(word)
    words = F.regexp_extract_all(whole_text(), F.lit(WORD), F.lit(0))
    placed = F.filter(
        F.transform("words", lambda w, i: F.struct(F.lower(w).alias("w"), i.alias("p"), w.alias("raw"))),
        # Only words that are ASCII all through; others merely look alike in lower case.
        lambda x: x["w"].isin(vocabulary) & (F.length(x["raw"]) == F.octet_length(x["raw"])),
    )
    possible = F.lit(False)
    for needed in {tuple(sorted(k)) for k in keys.values()}:
        wanted = F.array(*[F.lit(w) for w in needed])
        possible |= F.size(F.array_except(wanted, F.col("present"))) == 0
    rows = (
        docs.select("doc_id", words.alias("words"))
        .select("doc_id", F.size("words").cast("long").alias("n_words"), placed.alias("hits"))
        .withColumn("present", F.array_distinct(F.transform("hits", lambda x: x["w"])))
    )
    return stored(
        rows.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "n_words", "present",
            F.when(
                possible, F.transform("hits", lambda x: F.struct(x["w"].alias("w"), x["p"].alias("p")))
            ).otherwise(F.array()).alias("hits"),
        ),
        "licence-words",
    )


def anchors(spark: SparkSession, texts: DataFrame) -> DataFrame:
    """(template, q, w, wanted): of each key phrase the words with the highest IDF.

    Document frequencies are counted over all texts; the table is bounded by the templates.
    """
    _, places = index()
    seen = texts.select(F.explode("present").alias("w")).groupBy("w").agg(F.count("*").alias("df"))
    expected = spark.createDataFrame(places, "template int, q int, w string, key boolean")
    ranked = expected.where("key").join(F.broadcast(seen), "w", "left").groupBy("template").agg(
        F.slice(
            F.sort_array(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "q", "w"))),
            1, ANCHORS,
        ).alias("rare")
    )
    return ranked.select(
        "template", F.size("rare").alias("wanted"), F.inline("rare")
    ).select("template", "wanted", "q", "w")


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``n_base`` counts all places of the base phrases; ``first_word`` and ``last_word`` are the
    smallest and largest word at which one starts, null if there is none. ``labels`` adds the
    notices found by templates: a place counts if the rarest words of the key phrase agree on
    it, the whole key phrase stands there and at least ``COVERAGE`` of the template's words do.
    ``score`` is the best share of words in place (1 for a base phrase, 0 if nothing is found).
    Label lists are empty strings if nothing is found. A null text is empty; whole texts are
    read, of any length; repeated rows are rows of their own; an empty table gives no rows;
    further columns are not read.

    Only places of licence words in texts that hold a whole key phrase's words are shuffled, in
    proportion to their number; the index is broadcast, bounded by the templates above.
    """
    spark = docs.sparkSession
    heads, places = index()
    texts = read_words(docs.select("doc_id", "text"))
    hits = texts.where(F.size("hits") > 0).select("row", F.inline("hits"))
    starts = (
        hits.join(F.broadcast(anchors(spark, texts)), "w")
        .groupBy("row", "template", (F.col("p") - F.col("q")).alias("start"))
        .agg(F.count("*").alias("votes"), F.first("wanted").alias("wanted"))
        .where("votes = wanted and start >= 0")
        .select("row", "template", "start")
    )
    heads = spark.createDataFrame(heads, "template int, label string, base boolean, words int, keys int")
    expected = spark.createDataFrame(places, "template int, q int, w string, key boolean")
    found = (
        starts.join(F.broadcast(expected), "template")
        .withColumn("p", F.col("start") + F.col("q"))
        .join(hits, ["row", "p", "w"])
        .groupBy("row", "template", "start")
        .agg(F.count("*").alias("in_place"), F.count_if("key").alias("verified"))
        .join(F.broadcast(heads), "template")
        .where((F.col("verified") == F.col("keys")) & (F.col("in_place") >= COVERAGE * F.col("words")))
    )
    base_start = F.when(F.col("base"), F.col("start").cast("long"))

    def listed(label):
        return F.array_join(F.sort_array(F.collect_set(label)), ",")

    per_row = found.groupBy("row").agg(
        F.count_if("base").alias("n_base"),
        F.min(base_start).alias("first_word"),
        F.max(base_start).alias("last_word"),
        listed(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
        listed(F.col("label")).alias("labels"),
        F.max(F.col("in_place") / F.col("words")).alias("score"),
    )
    return texts.select("row", "doc_id", "n_words").join(per_row, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def op6_license_scan(spark, sf_dir):
    return license_scan(table(spark, sf_dir, "documents"))


def _sql_templates() -> str:
    """The templates as rows (label, base, parts, before, inside) of SQL."""
    heads, places = index()

    def listed(words):
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    rows = []
    for t, label, base, _, _ in heads:
        own = [(q, word, key) for h, q, word, key in places if h == t]
        inside = [word for _, word, key in own if key]
        before = min(q for q, _, key in own if key)
        rows.append(f"('{label}', {str(base).lower()}, {listed([w for _, w, _ in own])}, {before}, {listed(inside)})")
    return ",\n        ".join(rows)


#: Every place of every key phrase, found by its first word and compared whole.
OP6_SQL = rf"""
with templates(label, base, parts, before, inside) as (
    values {_sql_templates()}
), docs as (
    select row_number() over () as row, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents
), words as (
    select row, unnest(range(len(w))) as i, unnest(w) as word from docs
), found as (
    select x.row, x.i - t.before as s, t.label, t.base, t.parts, d.w
    from words x join templates t on x.word = t.inside[1] join docs d on d.row = x.row
    where x.i >= t.before and d.w[x.i + 1 : x.i + len(t.inside)] = t.inside
), judged as (
    select row, s, label, base, len(parts) as n,
           len(list_filter(range(len(parts)), lambda j: w[s + 1 + j] = parts[j + 1])) as same
    from found
), hits as (
    select row, s, label, base, case when base then 1.0::double else same / n::double end as score
    from judged where base or same >= {COVERAGE}::double * n
), told as (
    select row, count(*) filter (where base) as n_base,
           min(s) filter (where base) as first_word, max(s) filter (where base) as last_word,
           string_agg(distinct label, ',' order by label) filter (where base) as base_labels,
           string_agg(distinct label, ',' order by label) as labels, max(score) as score
    from hits group by row
)
select doc_id, len(w) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
       coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
       coalesce(score, 0.0::double) as score
from docs left join told using (row)
"""
