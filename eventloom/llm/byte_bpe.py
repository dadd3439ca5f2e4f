"""Byte-level BPE by recursive DuckDB queries that run inside each Spark partition."""

from __future__ import annotations

import base64
import sys
import types
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import table, whole_text

#: Bytes of text (or of ids) taken at a time, and entries of each of a worker's two generations.
SLICE, REMEMBERED = 4_000_000, 200_000
#: Words of more bytes than this use the statement that keeps one row for each position.
SHORT = 255

TABLES = """
create table tokens as select id, token, hex(token) as h from given;
create table single as select ('0x' || h)::int as byte, id from tokens where octet_length(token) = 1;
create table merges as
  with cuts as (
    select id, h[1 : 2 * k] as a, h[2 * k + 1 :] as b
    from tokens, unnest(range(1, octet_length(token))) as u(k)
  )
  select (l.id << 20) + r.id as pair, c.id as merged
  from cuts c join tokens l on l.h = c.a join tokens r on r.h = c.b;
create table early as
  select distinct x.merged
  from merges x join (
    select pair >> 20 as part, merged from merges
    union all
    select pair & 1048575 as part, merged from merges
  ) y on y.part = x.merged and y.merged < x.merged;
"""

#: One row for each byte of a word; ``spot`` is the word's number and the byte's position.
START = """
select (w.word << {bits}) + k as spot, s.id from words w, unnest(range(octet_length(w.token))) as u(k)
join single s on s.byte = ('0x' || hex(w.token)[2 * k + 1 : 2 * k + 2])::int
"""

#: Positions have no gaps, so the next token stands at the next number. A turn contracts the
#: leftmost pair of lowest rank in each word; a word without a pair is left as it was.
CONTRACT = f"""
with recursive step(spot, id, turn) as (
  (select spot, id, 0 from ({START.format(bits=16)}))
  union all
  (with pairs as materialized (
     select a.spot, a.id, a.turn, m.merged
     from step a left join step b on b.spot = a.spot + 1
     left join merges m on m.pair = (a.id << 20) + b.id
   ), best as materialized (
     select spot >> 16 as word, min((merged << 16) + (spot & 65535)) as score
     from pairs where merged is not null group by 1
   )
   select case when p.spot & 65535 > b.score & 65535 then p.spot - 1 else p.spot end,
          case when p.spot & 65535 = b.score & 65535 then b.score >> 16 else p.id end,
          p.turn + 1
   from pairs p join best b on b.word = p.spot >> 16
   where p.spot & 65535 <> (b.score & 65535) + 1)
), last as (select spot >> 16 as word, max(turn) as turn from step group by 1)
select s.spot >> 16 as word, s.id from step s join last l on l.word = s.spot >> 16 and l.turn = s.turn
order by s.spot
"""

#: The same for long words: the table keeps a position's latest token (none once it is merged).
#: All separate places of a word's best pair are contracted in one turn, from the left, unless
#: the new token is part of a pair of lower rank, which would then come first.
CONTRACT_LONG = f"""
with recursive step(spot, id) using key (spot) as (
  ({START.format(bits=32)})
  union
  (with live as (
     select r.spot, r.id, lead(r.spot) over w as next, lead(r.id) over w as after,
            row_number() over w as n
     from recurring.step r
     where r.id is not null and r.spot >> 32 in (select spot >> 32 from step)
     window w as (order by r.spot)
   ), hits as (
     select l.spot, l.next, l.n, l.spot >> 32 as word, m.merged
     from live l join merges m on m.pair = (l.id << 20) + l.after and l.spot >> 32 = l.next >> 32
   ), best as (select word, min(merged) as merged from hits group by 1
   ), places as (
     select h.*, row_number() over (partition by h.word order by h.spot) as k
     from hits h join best using (word, merged)
   ), picked as (
     select *, row_number() over (partition by word, n - k order by spot) % 2 as odd from places
   ), chosen as (
     select * from picked p left join early e using (merged)
     where k = 1 or (odd = 1 and e.merged is null)
   )
   select spot, merged from chosen union all select next, null from chosen)
)
select spot >> 32 as word, id from step where id is not null order by spot
"""

DECODE = """
select s.run, case when count(t.id) = count(*) then string_agg(t.h, '' order by s.place) end as h
from runs s left join tokens t on t.id = s.id group by s.run
"""


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> tuple[bytes, str]:
    """A rank file's content and the pattern that splits a text before merging."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read(), public_tokenizers.PATTERN


class Remembered:
    """Two generations of a dictionary: what was used since the last change survives the next."""

    def __init__(self, limit):
        self.limit, self.values, self.old = limit, {}, {}

    def missing(self, keys: set) -> set:
        """Keys to be added; the others are in ``values`` now."""
        if len(self.values) > self.limit:
            self.old, self.values = self.values, {}
        rest = keys.difference(self.values)
        back = rest.intersection(self.old)
        self.values.update({k: self.old[k] for k in back})
        return rest - back


class Codec:
    """The vocabulary in an in-memory DuckDB, and what this worker has coded lately."""

    def __init__(self, content: bytes, pattern: str):
        import duckdb
        import regex

        pairs = [line.split() for line in content.splitlines() if line]
        tokens = [base64.b64decode(t) for t, _ in pairs]
        ids = [int(i) for _, i in pairs]
        self.ranks = dict(zip(tokens, ids))
        self.findall = regex.compile(pattern).findall
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        self.put("given", {"id": pa.array(ids, pa.int64()), "token": pa.array(tokens, pa.binary())})
        self.db.execute(TABLES)
        self.inside = np.zeros(65_536, bool)
        for t in tokens:
            b = np.frombuffer(t, np.uint8).astype(np.int32)
            self.inside[b[:-1] * 256 + b[1:]] = True
        #: Ids whose bytes begin with a space: a decoder may cut a document's ids before them.
        self.opens = np.zeros(max(ids) + 2, bool)
        self.opens[[i for t, i in self.ranks.items() if t[:1] == b" "]] = True
        self.coded, self.decoded = Remembered(REMEMBERED), Remembered(REMEMBERED)

    def put(self, name, columns):
        self.db.register(f"{name}_rows", pa.table(columns))
        self.db.execute(f"create or replace temp table {name} as select * from {name}_rows")
        self.db.unregister(f"{name}_rows")

    def contracted(self, words: list[bytes], sql: str) -> dict:
        """Packed ids of each word after merging."""
        if not words:
            return {}
        self.put("words", {
            "word": pa.array(range(len(words)), pa.int64()), "token": pa.array(words, pa.binary()),
        })
        rows = self.db.execute(sql).fetchnumpy()
        ends = np.searchsorted(rows["word"], np.arange(len(words)), "right").tolist()
        data, at, out = rows["id"].astype("<u4").tobytes(), 0, {}
        for word, end in zip(words, ends):
            out[word] = data[4 * at : 4 * end]
            at = end
        return out

    def parts(self, word: bytes) -> list[bytes]:
        """A long word cut where two bytes meet that no token holds: nothing merges across."""
        b = np.frombuffer(word, np.uint8).astype(np.int32)
        cuts = [0, *(np.flatnonzero(~self.inside[b[:-1] * 256 + b[1:]]) + 1).tolist(), len(word)]
        return [word[i:j] for i, j in zip(cuts, cuts[1:])]

    def words_coded(self, words: set) -> dict:
        """Packed ids of words: a word that is a token is that token, the others are merged."""
        out, cut, merge = {}, {}, set()
        for word in words:
            rank = self.ranks.get(word)
            if rank is not None:
                out[word] = rank.to_bytes(4, "little")
            elif len(word) <= SHORT:
                merge.add(word)
            else:
                cut[word] = self.parts(word)
                merge.update(cut[word])
        short = self.contracted([w for w in merge if len(w) <= SHORT], CONTRACT)
        long = self.contracted([w for w in merge if len(w) > SHORT], CONTRACT_LONG)
        done = short | long
        for word in words:
            if word in cut:
                out[word] = b"".join([done[p] for p in cut[word]])
            elif word not in out:
                out[word] = done[word]
        return out

    def pieces(self, texts: list[bytes]) -> list:
        """For each text the packed ids of its words, little-endian unsigned 32-bit numbers."""
        split = [self.findall(t.decode("utf-8", "replace")) for t in texts]
        wanted = set()
        for words in split:
            wanted.update(words)
        new = {w: w.encode() for w in self.coded.missing(wanted)}
        ids = self.words_coded(set(new.values()))
        known = self.coded.values
        known.update({w: ids[b] for w, b in new.items()})
        return [list(map(known.__getitem__, words)) for words in split]

    def runs(self, packed: bytes):
        """A document's ids cut before each token that begins with a space; None if cut amiss."""
        if len(packed) % 4:
            return None
        ids = np.minimum(np.frombuffer(packed, "<u4"), len(self.opens) - 1)
        cuts = (4 * np.flatnonzero(self.opens[ids])).tolist()
        starts = cuts if cuts[:1] == [0] else [0, *cuts]
        return [packed[i:j] for i, j in zip(starts, [*starts[1:], len(packed)])] if packed else []

    def decode(self, split: list) -> list:
        """The bytes that each list of packed ids stands for; None where an id is unknown.

        What repeats is decoded once: ids become rows, meet the vocabulary and are put together
        in the order of their places.
        """
        wanted = set()
        for pieces in split:
            wanted.update(pieces or ())
        new = list(self.decoded.missing(wanted))
        known = self.decoded.values
        if new:
            ids = np.frombuffer(b"".join(new), "<u4").astype(np.int64)
            self.put("runs", {
                "run": np.repeat(np.arange(len(new)), [len(r) // 4 for r in new]),
                "place": np.arange(len(ids)), "id": ids,
            })
            rows = self.db.execute(DECODE).fetchall()
            known.update({new[k]: bytes.fromhex(h) for k, h in rows if h is not None})
            if any(h is None for _, h in rows):
                return [None if p is None or any(r not in known for r in p) else self.joined(p, known) for p in split]
        return [None if p is None else self.joined(p, known) for p in split]

    @staticmethod
    def joined(pieces, known):
        return b"".join(map(known.__getitem__, pieces))


def worker_codec(content: bytes, pattern: str) -> Codec:
    """This Python worker's codec; it outlives the task."""
    name = f"eventloom_codec_{zlib.crc32(pattern.encode(), zlib.crc32(content)):08x}"
    if name not in sys.modules:
        module = types.ModuleType(name)
        module.codec = Codec(content, pattern)
        sys.modules[name] = module
    return sys.modules[name].codec


def slices(values: pa.Array, limit: int = SLICE):
    """(first row, bytes of each row) of stretches of about ``limit`` bytes, one row at least."""
    sizes = np.cumsum([0, *(len(v.as_buffer()) for v in values)])
    at = 0
    while at < len(values):
        end = max(at + 1, int(np.searchsorted(sizes, sizes[at] + limit, "right")) - 1)
        yield at, values.slice(at, end - at).to_pylist()
        at = end


def encode(docs: DataFrame, rank_file: tuple[bytes, str], decoded: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids): every text's tokens, as tiktoken's ``encode_ordinary`` gives them;
    with ``decoded`` also the bytes that these ids stand for, as ``decode`` gives them.

    ``ids`` packs little-endian unsigned 32-bit numbers, as token files hold them. A null text is
    empty and has no tokens; a null id stays null; repeated rows are coded each; an empty table
    gives no rows; other columns are not read. Bytes that are no UTF-8 count as the replacement
    character. A text is coded whole, however long; a long word costs a turn for each pair that
    it merges.

    No shuffle. Each partition takes some megabytes of text at a time and sends their distinct
    new words through one recursive query; words met lately are remembered by the worker. What
    travels to tasks is the rank file, whose size does not depend on the input.
    """
    sent = docs.sparkSession.sparkContext.broadcast(rank_file)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_tokens", "ids", *["decoded"] * decoded]

    def run(batches):
        codec = worker_codec(*sent.value)
        for batch in batches:
            for at, texts in slices(batch.column(1)):
                pieces = codec.pieces(texts)
                packed = [b"".join(p) for p in pieces]
                counts = pa.array([len(p) // 4 for p in packed], pa.int64())
                columns = [batch.column(0).slice(at, len(texts)), counts, pa.array(packed, pa.binary())]
                if decoded:
                    columns.append(pa.array(codec.decode(pieces), pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select("doc_id", whole_text().cast("binary").alias("text"))
    kinds = f"doc_id {id_type}, n_tokens long, ids binary"
    return rows.mapInArrow(run, f"{kinds}, decoded binary" if decoded else kinds)


def decode(coded: DataFrame, rank_file: tuple[bytes, str]) -> DataFrame:
    """(doc_id, ids, decoded): the bytes that a stored document's packed ids stand for.

    Null ids are none; ids that the vocabulary lacks, or a length that is no multiple of four
    bytes, give null. Nothing is shuffled; each partition joins its ids with the vocabulary and
    puts the tokens together in order, ids that repeat between two spaces once.
    """
    sent = coded.sparkSession.sparkContext.broadcast(rank_file)
    id_type = coded.schema["doc_id"].dataType.simpleString()

    def run(batches):
        codec = worker_codec(*sent.value)
        for batch in batches:
            for at, packed in slices(batch.column(1)):
                columns = batch.slice(at, len(packed)).columns
                told = pa.array(codec.decode([codec.runs(p) for p in packed]), pa.binary())
                yield pa.RecordBatch.from_arrays([*columns, told], ["doc_id", "ids", "decoded"])

    rows = coded.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids"))
    return rows.mapInArrow(run, f"doc_id {id_type}, ids binary, decoded binary")


def op11_byte_bpe(spark, sf_dir):
    """Token counts and the hashes of ids and of the bytes that they decode to."""
    return encode(table(spark, sf_dir, "documents"), vocabulary(), decoded=True).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
