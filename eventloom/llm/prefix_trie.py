"""Prefix trie of conversations by truncation peeling: from the deepest turn to the root."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventloom.llm.common import stored, table
from eventloom.session import work_dir

#: Conversations of one block begin alike: a block is this many ids, a beginning at most 8 turns.
BLOCK, BEGINNINGS = 5, 9
#: Ids that may meet in one list: those that differ in this many low bits.
CHUNK_BITS = 12

TURNS = "array<struct<sig: binary, upto: long>>"
NODE = (
    f"path {TURNS}, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends string, own_a long, own_b long, parent_a long, parent_b long"
)
EMPTY = hashlib.sha256(b"").hexdigest()


def beginning(conv_id: Column) -> Column:
    """Turns that a conversation takes from the first of its block."""
    return F.crc32(conv_id.cast("string").cast("binary")) % BEGINNINGS


def first_of_block(conv_id: Column) -> Column:
    return conv_id - conv_id % BLOCK


def keys(path, a: str, b: str) -> list:
    """128 bits that stand for a path: two hashes of different beginnings."""
    return [F.xxhash64(path).alias(a), F.xxhash64(F.lit("other"), path).alias(b)]


def signed(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, sig, bytes): 16 bytes of a hash of role and text stand for a turn's words."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.substring(F.unhex(F.sha2(told.cast("binary"), 256)), 1, 16).alias("sig"),
        F.octet_length(text).cast("long").alias("bytes"),
    )


def paths(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, ``upto`` adding up their bytes.

    Turns of equal number stand in order of their hash.
    """
    by = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "sig")
    placed = turns.select(
        "conv_id", F.row_number().over(by).alias("place"), "sig", F.sum("bytes").over(by).alias("upto")
    )
    return placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "sig", "upto"))).alias("turns")
    ).select("conv_id", F.expr("transform(turns, t -> struct(t.sig as sig, t.upto as upto))").alias("turns"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, turns) of conversations that begin as the first one of their block does.

    One shuffle by block: within it turns are numbered, the first eight of a block's first
    conversation are handed to the others, and what belongs together is gathered. Only hashes and
    lengths move, one row of some 24 bytes a turn; a row gathers the turns of one conversation.
    """
    dealt = turns.withColumn("block", first_of_block(F.col("conv_id"))).repartition("block")
    order = W.partitionBy("block", "conv_id").orderBy(F.col("turn").asc_nulls_first(), "sig")
    placed = dealt.withColumn("place", F.row_number().over(order))
    own = F.struct(
        F.col("conv_id").alias("to"), F.lit(1).alias("part"),
        (F.col("place") > beginning(F.col("conv_id"))).alias("used"),
    )
    # A conversation whose turns all come from the block's first one still has its own first row.
    mine = F.when((F.col("place") == 1) | own.used, F.array(own)).otherwise(F.array().cast("array<struct<to: long, part: int, used: boolean>>"))
    near = F.filter(
        F.sequence(F.col("block") - BLOCK + 1, F.col("block") + BLOCK - 1),
        lambda c: (first_of_block(c) == F.col("block")) & (F.col("place") <= beginning(c)),
    )
    handed = F.when(
        (F.col("conv_id") == F.col("block")) & (F.col("place") < BEGINNINGS),
        F.transform(near, lambda c: F.struct(c.alias("to"), F.lit(0).alias("part"), F.lit(True).alias("used"))),
    )
    rows = placed.select("block", "place", "sig", "bytes", F.inline(F.concat(mine, F.coalesce(handed, F.array()))))
    along = W.partitionBy("block", "to").orderBy("part", "place")
    rows = rows.withColumn("upto", F.sum(F.when(F.col("used"), F.col("bytes")).otherwise(0)).over(along))
    turn = F.when(F.col("used"), F.struct("part", "place", "sig", "upto"))
    return (
        rows.groupBy("block", "to")
        .agg(F.max("part").alias("part"), F.sort_array(F.collect_list(turn)).alias("turns"))
        .where("part = 1")
        .select(
            F.col("to").alias("conv_id"),
            F.expr("transform(turns, t -> struct(t.sig as sig, t.upto as upto))").alias("turns"),
        )
    )


def merged(conversations: DataFrame) -> DataFrame:
    """(turns, conv_id, n, ends): distinct conversations, their smallest id, their number and the
    hash of all their ids.

    Ids meet in lists of at most 4,096 neighbours, so that copies of one conversation are spread
    by id; a hash reads its list in order, so the lists of one conversation pass through one task,
    a row at a time and none of them kept.
    """
    lists = (
        conversations.groupBy("turns", F.shiftright("conv_id", CHUNK_BITS).alias("chunk"))
        .agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
        .select(
            *keys("turns", "a", "b"), "chunk", "turns",
            F.get("ids", F.lit(0)).alias("first"), F.size("ids").cast("long").alias("n"),
            F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"),
        )
    )
    dealt = lists.repartition("a", "b").sortWithinPartitions("a", "b", "chunk")

    def run(batches):
        held = None

        def told():
            turns, first, n, hasher, _ = held
            columns = [turns, pa.array([first]), pa.array([n]), pa.array([hasher.hexdigest()])]
            return pa.RecordBatch.from_arrays(columns, ["turns", "conv_id", "n", "ends"])

        for batch in batches:
            out = []
            a, b, first, n, ids = (batch.column(c).to_pylist() for c in ("a", "b", "first", "n", "ids"))
            for k in range(batch.num_rows):
                if held and held[4] == (a[k], b[k]):
                    held[3].update(b"," + ids[k].encode())
                    held[2] += n[k]
                    continue
                if held:
                    out.append(told())
                turns = batch.column("turns").slice(k, 1)
                held = [turns, first[k], n[k], hashlib.sha256(ids[k].encode()), (a[k], b[k])]
            if out:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()
        if held:
            yield told()

    return dealt.mapInArrow(run, f"turns {TURNS}, conv_id long, n long, ends string")


def entering(distinct: DataFrame) -> DataFrame:
    """Distinct conversations with ``entry``: the depth at which they join the peeling.

    Of its prefixes of 1, 2, 4, ... turns the shortest that no other conversation has is enough:
    the turns after it are met by no other, so they are stripped at once. A conversation without
    such a prefix enters with its last turn. Prefixes are counted map-side; what moves is a hash
    for each of them.
    """
    powers = F.expr("filter(transform(sequence(0, 30), j -> shiftleft(1, j)), d -> d <= size(turns))")
    prefixes = distinct.select("conv_id", "turns", F.explode(powers).alias("depth"))
    prefixes = prefixes.select("conv_id", "depth", *keys(F.slice("turns", F.lit(1), F.col("depth")), "a", "b"))
    alone = (
        prefixes.groupBy("a", "b", "depth")
        .agg(F.count("*").alias("sharing"), F.min("conv_id").alias("conv_id"))
        .where("sharing = 1")
        .groupBy("conv_id")
        .agg(F.min("depth").alias("alone"))
    )
    return distinct.join(alone, "conv_id", "left").select(
        *distinct.columns, F.coalesce("alone", F.size("turns")).alias("entry")
    )


def peeled(entrants: DataFrame, place: str) -> DataFrame:
    """Nodes of every depth from the greatest entry to the root, written level by level.

    A level takes the nodes one deeper without their last turn and the conversations that enter,
    and groups equal paths: all sums are combined map-side, so neither the root nor a first turn
    that a third of all conversations share meets in one task before it is one row a task. Each
    level is written to the shared folder: the result, and all that the next level reads.
    """
    spark = entrants.sparkSession
    top = entrants.agg(F.max("entry").alias("top")).first()["top"]
    deeper = None
    for depth in range(top if top is not None else -1, -1, -1):
        ended = F.size("turns") == depth
        upto = lambda d: F.coalesce(F.get("turns", F.lit(d - 1)).upto, F.lit(0)) if d else F.lit(0)
        last = F.coalesce(F.get("turns", F.size("turns") - 1).upto, F.lit(0))
        level = entrants.where(F.col("entry") == depth).select(
            F.slice("turns", 1, depth).alias("path"), "conv_id", F.col("n").alias("n_convs"),
            F.when(ended, 0).otherwise(1).alias("n_children"),
            F.when(ended, 0).otherwise(1).alias("n_leaves"),
            ((F.col("n") - 1) * (last - upto(depth))).alias("saved_tokens"),
            F.when(ended, F.col("ends")).alias("ends"),
        )
        if deeper is not None:
            level = level.unionByName(deeper.select(
                F.slice("path", 1, depth).alias("path"), "conv_id", "n_convs", F.lit(1).alias("n_children"),
                "n_leaves", "saved_tokens", F.lit(None).cast("string").alias("ends"),
            ))
        own = F.get("path", F.lit(depth - 1)).upto if depth else F.lit(0)
        before = F.get("path", F.lit(depth - 2)).upto if depth > 1 else F.lit(0)
        nodes = level.groupBy("path").agg(
            F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
            F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
            F.sum("saved_tokens").alias("saved_tokens"), F.max("ends").alias("ends"),
        ).select(
            "path", "conv_id", "n_convs", "n_children",
            F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).alias("n_leaves"),
            (F.col("saved_tokens") + (F.col("n_convs") - 1) * (own - before)).alias("saved_tokens"),
            "ends", *keys("path", "own_a", "own_b"),
            *keys(F.slice("path", 1, max(depth - 1, 0)), "parent_a", "parent_b"),
        )
        nodes.write.parquet(f"{place}/depth={depth}")
        deeper = spark.read.schema(NODE).parquet(f"{place}/depth={depth}")
    if deeper is None:
        return spark.createDataFrame([], f"{NODE}, depth int")
    return spark.read.schema(f"{NODE}, depth int").parquet(place)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of (conv_id, turns) rows, one row a node: conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    Nodes are named by depth and smallest member. A conversation without turns is a member of the
    root and ends there; without conversations there is no node. Members of a node are never
    gathered; a row holds the turns of one path (24 bytes each). The levels that are peeled by
    jobs of their own are those down to the longest path that two different conversations share
    and the powers of two after it, however long the longest conversation is.
    """
    spark = conversations.sparkSession
    distinct = stored(merged(conversations), "trie-conversations")
    place = work_dir(spark, "llm-trie-entering")
    rows = entering(distinct)
    rows.write.partitionBy("entry").parquet(place)
    entrants = spark.read.schema(rows.schema).parquet(place)
    nodes = peeled(entrants, work_dir(spark, "llm-trie-nodes"))
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("own_a").alias("parent_a"),
        F.col("own_b").alias("parent_b"), F.col("conv_id").alias("parent_conv_id"),
    )
    upper = nodes.join(parents, ["depth", "parent_a", "parent_b"], "left")
    tails = entrants.where("entry < size(turns)").select(
        "*", F.explode(F.sequence(F.col("entry") + 1, F.size("turns"))).alias("depth")
    )
    ends = F.col("depth") == F.size("turns")
    below = F.get("turns", F.size("turns") - 1).upto - F.coalesce(F.get("turns", F.col("depth") - 2).upto, F.lit(0))
    lower = tails.select(
        "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(ends, 0).otherwise(1).alias("n_children"), F.lit(1).alias("n_leaves"),
        ((F.col("n") - 1) * below).alias("saved_tokens"), F.when(ends, F.col("ends")).alias("ends"),
    )
    columns = lower.columns
    return upper.select(columns).unionByName(lower).select(
        "conv_id",
        *(F.col(c).cast("long").alias(c) for c in columns[1:-1]),
        F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of a table (conv_id, turn, role, text) as it stands.

    Null role or text is empty, a null turn comes first, turns of equal number stand in order of
    their hash and repeated rows are turns of their own; rows without conv_id belong to no
    conversation and are left out; other columns are not read. Texts count whole, by their hash.
    """
    return prefix_trie(paths(signed(conversations)))


def op12_prefix_trie(spark, sf_dir):
    """The trie of conversations rebuilt on the beginning of their block's first one."""
    return prefix_trie(rebuilt(signed(table(spark, sf_dir, "conversations"))))


#: Every prefix of every rebuilt conversation, grouped; sums over a node's subtree by its prefixes.
OP12_SQL = r"""
with crc_table as (
    select list(c order by i) as entries from (
        select i, list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) as c
        from range(256) as r(i)
    )
), ids as (
    select conv_id, conv_id - conv_id % 5 as base,
           xor(list_reduce(list_transform(string_split(conv_id::varchar, ''), lambda x: ord(x)::bigint),
               lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 9 as h
    from (select distinct conv_id from conversations where conv_id is not null), crc_table
), signed as (
    select conv_id, turn, strlen(coalesce(text, '')) as bytes,
           sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))[1:32] as sig
    from conversations where conv_id is not null
), placed as (
    select *, row_number() over (partition by conv_id order by turn nulls first, sig) as place from signed
), turns as (
    select i.conv_id, 0 as part, place, sig, bytes from ids i join placed p on p.conv_id = i.base where place <= h
    union all
    select i.conv_id, 1, place, sig, bytes from ids i join placed p on p.conv_id = i.conv_id where place > h
), prefixes as (
    select conv_id, bytes, list(sig) over w as path, row_number() over w as depth,
           count(*) over (partition by conv_id) as turns
    from turns window w as (partition by conv_id order by part, place)
    union all
    select i.conv_id, 0, [], 0, (select count(*) from turns t where t.conv_id = i.conv_id) from ids i
), nodes as (
    select path, depth, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(bytes) as saved,
           sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (turns = depth), '')) as ends_sha256
    from prefixes group by path, depth
), children as (
    select path[1:depth - 1] as path, count(*) as n from nodes where depth > 0 group by 1
), known as (
    select n.*, coalesce(c.n, 0) as n_children from nodes n left join children c using (path)
), above as (
    select path[1:k] as path, saved, (n_children = 0)::bigint as leaf
    from (select *, unnest(range(depth + 1)) as k from known)
), sums as (
    select path, sum(saved)::bigint as saved_tokens, sum(leaf)::bigint as n_leaves from above group by path
)
select k.conv_id, k.depth, p.conv_id as parent_conv_id, k.n_convs, k.n_children, s.n_leaves, s.saved_tokens, k.ends_sha256
from known k join sums s using (path)
left join nodes p on k.depth > 0 and p.depth = k.depth - 1 and p.path = k.path[1:k.depth - 1]
"""
