"""Prefix trie of conversations by partition refinement.

All conversations start in one class, that of the root. Each round looks at the next turn only and splits every active class by it; a part is a node of
the trie. A class left with one sequence is retired: the rest of it is a unary chain, emitted at once from the turns, whatever its length. So there
are as many rounds as the deepest turn that different sequences share, and a round reads the turns of one position. Then values are folded back from
the deepest round to the root.

Equal conversations are one sequence with a weight from the start (digests of 256 bits, summed up map-side), so groups of copies don't pass through the rounds.
Joins and groupings are plain equi-joins and sums that combine map-side; turns are numbered by ``ranking.running``, which spreads a long conversation over tasks.
A list of the members that end at a node is hashed in the order of their ids: pieces of it are put together in parallel, and one stream of pieces feeds the digest
of a node (SHA-256 is a sequence by nature; memory stays that of a piece).

Defined results: rows without conv_id take no part. Null role or text is empty. Ties of turn go by role, then text (by its first 256 characters, then by a digest); equal rows
count each. A conversation
without turns is a member of the root and ends there. Extra columns are ignored. Without conversations there are no nodes, and no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventpulse.operators import ranking

from .common import CRC_TABLE, SPACES, crc32_sql, materialize, table

BLOCK, FOLDS = 20, 4
_NOTHING = hashlib.sha256(b"").hexdigest()
_PIECE = 1 << 14
_MARKS = ("_m0", "_m1", "_m2", "_m3")


def ordered(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, key, words): turns numbered from 1; key is a digest of role and text, words counts those of the text."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    key = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256))
    words = F.regexp_count("text", F.lit(rf"[^{SPACES}]+")).cast("long")
    own = rows.select("conv_id", "turn", F.substring("role", 1, 64).alias("role"), F.substring("text", 1, 256).alias("start"), key.alias("key"), words.alias("words"))
    # The start of the text orders like the text where it differs; what it doesn't tell apart goes by the digest of the whole.
    return ranking.ranked(own, ["conv_id"], [F.col("turn").asc_nulls_first(), "role", "start", "key"], "at").select("conv_id", "at", "key", "words")



def rebuilt(turns: DataFrame, block: int = BLOCK, folds: int = FOLDS) -> tuple[DataFrame, DataFrame]:
    """Conversations that share beginnings: the first h turns of conversation c - c % block, then c's own after its first h, h = crc32(c) % folds.

    From ``ordered`` rows to (conv_id, pos, key, words) and all conv_ids, those left without turns included.
    """
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(folds))
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n")).withColumn("h", h)
    donors = convs.where(F.col("conv_id") % block == 0).select(F.col("conv_id").alias("donor"), F.col("n").alias("has"))
    convs = convs.withColumn("donor", F.col("conv_id") - F.col("conv_id") % block).join(donors, "donor", "left")
    convs = materialize(convs.select("conv_id", "donor", "h", F.least("h", F.coalesce("has", F.lit(0))).alias("taken")), "trie-convs")
    first = turns.where((F.col("conv_id") % block == 0) & (F.col("at") < folds)).select(F.col("conv_id").alias("donor"), "at", "key", "words")
    heads = convs.where("taken > 0").join(first, "donor").where("at <= taken").select("conv_id", F.col("at").alias("pos"), "key", "words")
    tails = turns.join(convs, "conv_id").where("at > h").select("conv_id", (F.col("at") - F.col("h") + F.col("taken")).alias("pos"), "key", "words")
    return materialize(heads.union(tails), "trie-turns"), convs.select("conv_id")


def _pieces(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (rep, conv_id) to (rep, first, ids): ids joined by commas, at most _PIECE of them together."""
    rep, own = None, []

    def done() -> pa.RecordBatch:
        return pa.record_batch({"rep": pa.array([rep], pa.int64()), "first": pa.array([own[0]], pa.int64()), "ids": pa.array([",".join(map(str, own))], pa.string())})

    for part in parts:
        for r, c in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            if own and (r != rep or len(own) >= _PIECE):
                yield done()
                own = []
            rep = r
            own.append(c)
    if own:
        yield done()


def _digests(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (rep, first, ids) to (rep, ends): one digest over all pieces of a rep."""
    rep, digest = None, None
    for part in parts:
        reps, ends = [], []
        for r, ids in zip(part.column(0).to_pylist(), part.column(2)):
            if r != rep:
                if rep is not None:
                    reps.append(rep)
                    ends.append(digest.hexdigest())
                rep, digest = r, hashlib.sha256(ids.as_py().encode())
            else:
                digest.update(b"," + ids.as_py().encode())
        yield pa.record_batch({"rep": pa.array(reps, pa.int64()), "ends": pa.array(ends, pa.string())})
    if rep is not None:
        yield pa.record_batch({"rep": pa.array([rep], pa.int64()), "ends": pa.array([digest.hexdigest()], pa.string())})


def members_digest(members: DataFrame) -> DataFrame:
    """(rep, ends): SHA-256 of each rep's conv_ids, ascending, joined by commas."""
    pieces = members.select("rep", "conv_id").repartitionByRange("rep", "conv_id").sortWithinPartitions("rep", "conv_id").mapInArrow(_pieces, "rep long, first long, ids string")
    return pieces.repartition("rep").sortWithinPartitions("rep", "first").mapInArrow(_digests, "rep long, ends string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the trie of (conv_id, pos, key, words), pos from 1 without gaps; ``convs`` has every conv_id once."""
    marks = [F.bit_xor(F.xxhash64(F.lit(m), "pos", "key")).alias(m) for m in _MARKS]
    whole = convs.join(turns.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum("words").alias("total"), *marks), "conv_id", "left").fillna(0)
    whole = materialize(whole, "trie-whole")
    same = ["n", *_MARKS]
    groups = materialize(whole.groupBy(*same).agg(F.min("conv_id").alias("rep"), F.count("*").alias("weight"), F.first("total").alias("total")), "trie-groups")
    ends = members_digest(whole.join(groups, same).select("rep", "conv_id"))
    reps = groups.select("rep", "weight", "n")
    # Sorted by position, so that a round reads the row groups of its position only.
    own = turns.withColumnRenamed("conv_id", "rep").join(reps, "rep")
    own = materialize(own.select("rep", "pos", "key", "words", "weight", "n").repartitionByRange("pos", "rep").sortWithinPartitions("pos", "rep"), "trie-own")

    ender = F.min(F.when(F.col("n") == F.col("depth"), F.col("rep"))).alias("ender")
    counts = [F.min("rep").alias("conv_id"), F.sum("weight").alias("n_convs"), F.count("*").alias("reps"), F.max("n").alias("n"), ender]
    root = groups.withColumn("depth", F.lit(0).cast("long")).groupBy("depth").agg(*counts).withColumns({"parent": F.lit(None).cast("long"), "words": F.lit(0).cast("long")})
    shape = ("depth", "conv_id", "parent", "n_convs", "reps", "n", "words", "ender")
    levels, depth = [materialize(root.select(*shape), "trie-level")], 0
    start = levels[0].where("reps > 1").select("conv_id").first()  # the root, if it isn't retired at once
    # What a class is called is its node's smallest member.
    active = materialize(reps.where(F.lit(start is not None) & (F.col("n") > 0)).select("rep", F.lit(start and start[0]).cast("long").alias("class")), "trie-active")
    while not active.isEmpty():
        depth += 1
        met = own.where(F.col("pos") == depth).join(active, "rep").withColumn("depth", F.lit(depth).cast("long"))
        classes = materialize(met.groupBy("depth", "class", "key").agg(*counts, F.first("words").alias("words")), "trie-level")
        levels.append(classes.withColumnRenamed("class", "parent").select(*shape))
        split = classes.where("reps > 1").select("class", "key", F.col("conv_id").alias("_to"))
        active = materialize(met.where("n > depth").join(split, ["class", "key"]).select("rep", F.col("_to").alias("class")), "trie-active")

    # Retired classes: their nodes are rows of their level, and what follows is a chain.
    retired = [x.where("reps = 1").select(F.col("conv_id").alias("rep"), F.col("depth").alias("from")) for x in levels]
    chain = retired[0]
    for x in retired[1:]:
        chain = chain.union(x)
    tails = own.join(chain, "rep").where("pos > from")
    saving = ranking.running(tails.where("weight > 1"), ["rep"], [F.desc("pos")], {"later": F.col("words")})
    tail = [F.col("rep").alias("conv_id"), F.col("pos").alias("depth"), F.col("rep").alias("parent"), F.col("weight").alias("n_convs"), (F.col("pos") < F.col("n")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves")]
    ends_here = F.when(F.col("pos") == F.col("n"), F.col("rep")).alias("ender")
    saving = materialize(saving.select(*tail, ((F.col("weight") - 1) * F.col("later")).alias("saved"), ends_here), "trie-tails")
    plain = tails.where("weight = 1").select(*tail, F.lit(0).cast("long").alias("saved"), ends_here)
    below = saving.join(chain.withColumn("depth", F.col("from") + 1), (saving["conv_id"] == F.col("rep")) & (saving["depth"] == F.col("from") + 1), "left_semi").select("conv_id", F.col("depth").alias("_at"), "saved")

    folded: DataFrame | None = None
    done = []
    for level in reversed(levels):
        kids = below.select("conv_id", (F.col("_at") - 1).alias("depth"), F.lit(1).cast("long").alias("n_leaves"), "saved", F.lit(1).cast("long").alias("kids"))
        if folded is not None:
            kids = kids.union(folded.select(F.col("parent").alias("conv_id"), F.col("depth") - 1, "n_leaves", "saved", F.lit(1).cast("long")))
        kids = kids.groupBy("conv_id", "depth").agg(F.sum("n_leaves").alias("_leaves"), F.sum("saved").alias("_saved"), F.sum("kids").alias("_kids"))
        met = level.join(kids, ["conv_id", "depth"], "left")
        one = F.col("reps") == 1
        folded = materialize(
            met.select(
                "conv_id", "depth", "parent", "n_convs", F.when(one, (F.col("n") > F.col("depth")).cast("long")).otherwise(F.coalesce("_kids", F.lit(0))).alias("n_children"),
                F.when(one, 1).otherwise(F.coalesce("_leaves", F.lit(1))).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words") + F.coalesce("_saved", F.lit(0))).alias("saved"), "ender",
            ),
            "trie-folded",
        )
        done.append(folded)
    nodes = plain.union(saving)
    for x in done:
        nodes = nodes.union(x.select(*nodes.columns))
    named = [F.col("conv_id"), F.col("depth"), F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens")]
    ended = nodes.where("ender is not null").join(ends.withColumnRenamed("rep", "ender"), "ender").select(*named, F.col("ends").alias("ends_sha256"))
    return ended.union(nodes.where("ender is null").select(*named, F.lit(_NOTHING).alias("ends_sha256")))


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*rebuilt(ordered(table(spark, sf_dir, "conversations"))))


QUERIES = {"op11_conversation_prefix_trie": op11_conversation_prefix_trie}
ORACLES = {
    "op11_conversation_prefix_trie": f"""with {CRC_TABLE},
turns as (select conv_id c, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) i, coalesce(role, '') r, coalesce(text, '') x from conversations where conv_id is not null),
own as (select c, list(struct_pack(r := r, x := x) order by i) l from turns group by c),
lists as (select c, l, {crc32_sql("c::varchar")} % {FOLDS} h from own, crc),
whole as (select o.c, list_concat(coalesce(d.l[1:o.h], []), o.l[o.h + 1:]) s from lists o left join lists d on d.c = o.c - o.c % {BLOCK}),
begun as (select c, d, s[1:d] p, s[d].x last, len(s) n from whole, unnest(range(0, len(s) + 1)) u(d)),
nodes as (select p, d, min(c) conv_id, count(*) n_convs, case when d = 0 then 0 else len(regexp_extract_all(any_value(last), '[^\\x20\\x09-\\x0D]+')) end words, string_agg(c::varchar, ',' order by c) filter (n = d) ids from begun group by p, d),
kids as (select d - 1 d, p[1:d - 1] p, count(*) k from nodes where d > 0 group by all),
full_nodes as (select n.*, coalesce(k.k, 0) k, u.conv_id parent from nodes n left join kids k on k.d = n.d and k.p = n.p left join nodes u on u.d = n.d - 1 and u.p = n.p[1:n.d - 1])
select a.conv_id, a.d depth, any_value(a.parent) parent_conv_id, any_value(a.n_convs) n_convs, any_value(a.k) n_children, count(*) filter (b.k = 0) n_leaves, sum((b.n_convs - 1) * b.words)::bigint saved_tokens, sha256(coalesce(any_value(a.ids), '')) ends_sha256
from full_nodes a join full_nodes b on b.d >= a.d and b.p[1:a.d] = a.p group by a.conv_id, a.d, a.p"""
}
