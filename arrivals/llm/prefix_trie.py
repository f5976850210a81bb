"""Prefix trie of conversations by whole-sequence collapse.

Every distinct sequence of the first d turns (role, text) of a conversation is a
node. The trie is never built by following edges:

1. Identical conversations collapse into one *sequence* with a weight and the
   list of the conversations that end there. A conversation is identified by
   the sum of its turns' position-keyed hashes (four lanes, 128 bits), so the
   identity of every prefix is a running sum.
2. Sequences that are proper prefixes of others are dropped by an anti-join;
   what stays are the leaves.
3. The weighted prefixes of the sequences are aggregated into nodes. A node is
   *owned* by its smallest member, so the amounts of a subtree (leaves, saved
   words) are sums over the sequences through the node of what each owns from
   there on: a running sum per sequence, and no walk over ancestors.

Hot groups: a conversation copied into a third of all collapses by partial
aggregation before any join; its list of ends is ranked across range
partitions and travels in runs of ``RUN`` ids, which one task only streams
through SHA-256. Turns are ranked within range partitions (a conversation with
a third of all rows spans many) and summed in blocks of ``BLOCK`` positions, so
no task holds a conversation whole. Only digests of texts are shuffled.

Edge cases: turns are ordered by ``turn`` (null first), ties by the digest of
(role, text); a null role or text counts as empty; rows with a null conv_id
belong to no conversation and are left out; repeated rows are separate turns;
an empty table has no node, not even a root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrivals.llm.common import text_or_empty, words, written

BLOCK = 4096     # positions summed by one window group
RUN = 256        # ids of one piece of a list of ends
LANES = ("h1", "h2", "h3", "h4")
NODE = ("depth", *LANES)
_LOW = (1 << 32) - 1


def ranked(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``rows`` plus ``pos``: 1, 2, ... within each key by ``order`` (nulls first), with no key in one task.

    Rows are range-partitioned by key and order (identical rows by the input
    partition they come from), ranked within their partition, and moved on by the
    rows of the key in the partitions before.
    """
    by = [*keys, *order]
    ranged = written(
        rows.withColumn("salt", F.spark_partition_id()).repartitionByRange(*by, "salt").drop("salt")
        .withColumn("part", F.spark_partition_id()), "trie-ranged")
    own = Window.partitionBy(*keys, "part").orderBy(*order)
    earlier = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*keys, "part").agg(F.count("*").alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    )
    return (
        ranged.withColumn("pos", F.row_number().over(own)).join(offsets, [*keys, "part"])
        .withColumn("pos", F.col("before") + F.col("pos")).drop("part", "before")
    )


def hashed_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, n_words): a turn without its text; the digest is of role and text."""
    role, text = text_or_empty(F.col("role")), text_or_empty(F.col("text"))
    return turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.size(words(text)).cast("long").alias("n_words"))


def conversations_in_order(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations (conv_id) and their turns (conv_id, pos, digest, n_words), as they stand in the table."""
    rows = written(ranked(hashed_turns(turns), ["conv_id"], ["turn", "digest"]).drop("turn"), "trie-turns")
    return rows.filter("pos = 1").select("conv_id"), rows


def head_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its block: 0 to 3."""
    return F.crc32(conv_id.cast("string").cast("binary")) % 4


def rebuilt(turns: DataFrame, block: int = 20) -> tuple[DataFrame, DataFrame]:
    """The conversations and their turns after every one took its head from the first conversation of its block.

    Conversation c starts with the first h turns of conversation c - c % block
    (all if it has fewer, none if it is absent) and goes on with its own after
    its first h; h is ``head_turns(c)``.
    """
    conv, h = F.col("conv_id"), head_turns(F.col("conv_id"))
    convs, rows = conversations_in_order(turns)
    heads = rows.filter("pos <= 3").select(F.col("conv_id").alias("base"), "pos", "digest", "n_words")
    taken = (
        convs.withColumn("base", conv - conv % block).withColumn("h", h).join(heads, "base")
        .filter("pos <= h").select("conv_id", "pos", "digest", "n_words")
    )
    n_taken = taken.groupBy("conv_id").agg(F.count("*").alias("k"))
    own = rows.filter(F.col("pos") > h)
    # Only own turns of conversations that took fewer than h need moving, and few bases are that short.
    short = (
        convs.withColumn("h", h).join(n_taken, "conv_id", "left")
        .select("conv_id", (F.col("h") - F.coalesce("k", F.lit(0))).alias("missing")).filter("missing > 0")
    )
    moved = own.join(short, "conv_id", "left").select(
        "conv_id", (F.col("pos") - F.coalesce("missing", F.lit(0))).alias("pos"), "digest", "n_words")
    return convs, written(taken.unionByName(moved), "trie-rebuilt")


def _lanes() -> list[Column]:
    a, b = (F.xxhash64(F.lit(seed), "pos", "digest") for seed in (11, 12))
    parts = (a.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(a, 32),
             b.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(b, 32))
    return [p.alias(name) for p, name in zip(parts, LANES, strict=True)]


def _running(rows: DataFrame, key: str, at: str, columns: list[str], down: bool = False) -> DataFrame:
    """``columns`` replaced by their running sums along ``at`` per key (from the end if ``down``), block by block."""
    rows = rows.withColumn("block", F.floor(F.col(at) / BLOCK))
    along = F.col(at).desc() if down else F.col(at)
    blocks = F.col("block").desc() if down else F.col("block")
    local = Window.partitionBy(key, "block").orderBy(along).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(key).orderBy(blocks).rowsBetween(Window.unboundedPreceding, -1)
    # The sums of whole blocks: only keys of several blocks have any to carry over.
    carried = (
        rows.groupBy(key, "block").agg(*[F.sum(c).alias(c) for c in columns])
        .select(key, "block", *[F.sum(c).over(before).alias(f"{c}_before") for c in columns])
        .filter(F.col(f"{columns[0]}_before").isNotNull())
    )
    return (
        rows.withColumns({c: F.sum(c).over(local) for c in columns}).join(carried, [key, "block"], "left")
        .withColumns({c: F.col(c) + F.coalesce(f"{c}_before", F.lit(0)) for c in columns})
        .drop("block", *[f"{c}_before" for c in columns])
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined runs of each node; the runs of a node come in order."""
    key, sha, done = None, None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in NODE]
        for *node, ids in zip(*columns, batch.column("ids").to_pylist(), strict=True):
            if node != key:
                if key is not None:
                    done.append((*key, sha.hexdigest()))
                key, sha = node, hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        if done:
            yield _digest_batch(done)
            done = []
    if key is not None:
        yield _digest_batch([(*key, sha.hexdigest())])


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64()] * len(NODE) + [pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[*NODE, "ends_sha256"])


def _ends(whole: DataFrame) -> DataFrame:
    """(node, ends_sha256) for nodes at which a conversation ends."""
    runs = (
        ranked(whole.select(*NODE, "conv_id"), list(NODE), ["conv_id"])
        .groupBy(*NODE, F.floor((F.col("pos") - 1) / RUN).alias("run"))
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
             .alias("ids"))
    )
    schema = ", ".join(f"{c} long" for c in NODE) + ", ends_sha256 string"
    return runs.repartition(*NODE).sortWithinPartitions(*NODE, "run").select(*NODE, "ids").mapInArrow(_digests, schema)


def prefix_trie(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per node of the trie of conversations.

    ``convs`` has the conversations (conv_id, also those without turns),
    ``rows`` their turns (conv_id, pos from 1 without gaps, digest, n_words).
    Returns conv_id (the smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256.
    """
    keyed = rows.select("conv_id", "pos", "n_words", *_lanes())
    totals = keyed.groupBy("conv_id").agg(F.count("*").alias("depth"), *[F.sum(c).alias(c) for c in LANES])
    whole = written(
        convs.join(totals, "conv_id", "left").select("conv_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in NODE]),
        "trie-whole")

    # 1. Identical conversations become one weighted sequence, standing for them under the smallest id.
    sequences = written(
        whole.groupBy(*NODE).agg(F.min("conv_id").alias("seq"), F.count("*").alias("weight")), "trie-sequences")
    named = sequences.select("seq", "weight", F.col("depth").alias("length"))
    own = keyed.withColumnRenamed("conv_id", "seq").join(named, "seq")
    hashes = own.withColumns({f"own_{c}": F.col(c) for c in LANES})
    prefixes = _running(hashes, "seq", "pos", list(LANES)).select(
        "seq", "weight", "length", F.col("pos").alias("depth"), *LANES,
        *[(F.col(c) - F.col(f"own_{c}")).alias(f"up_{c}") for c in LANES], "n_words")
    roots = named.select("seq", "weight", "length", F.lit(0).cast("long").alias("depth"),
                         *[F.lit(0).cast("long").alias(c) for c in LANES],
                         *[F.lit(None).cast("long").alias(f"up_{c}") for c in LANES],
                         F.lit(0).cast("long").alias("n_words"))
    prefixes = written(prefixes.unionByName(roots), "trie-prefixes")

    # 2. Nodes, and the leaves: sequences that are no proper prefix of another.
    nodes = written(
        prefixes.groupBy(*NODE).agg(
            F.sum("weight").alias("n_convs"), F.min("seq").alias("conv_id"), F.max("length").alias("reach"),
            F.max("n_words").alias("n_words"), *[F.max(f"up_{c}").alias(f"up_{c}") for c in LANES]),
        "trie-nodes")
    inner = nodes.filter("reach > depth").select(*NODE)
    leaves = sequences.join(inner, list(NODE), "left_anti").select(F.col("seq"), "depth", F.lit(1).alias("leaf"))

    # 3. Amounts of subtrees: what every sequence owns from a depth on, summed over the sequences through a node.
    owned = (
        nodes.select(F.col("conv_id").alias("seq"), "depth", ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved"))
        .join(leaves, ["seq", "depth"], "left")
    )
    below = (
        prefixes.select("seq", *NODE).join(owned, ["seq", "depth"], "left")
        .withColumns({"saved": F.coalesce("saved", F.lit(0)), "leaf": F.coalesce("leaf", F.lit(0)).cast("long")})
    )
    amounts = _running(below, "seq", "depth", ["saved", "leaf"], down=True).groupBy(*NODE).agg(
        F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    up = [F.col(f"up_{c}").alias(c) for c in LANES]
    children = (
        nodes.filter("depth > 0").select((F.col("depth") - 1).alias("depth"), *up)
        .groupBy(*NODE).agg(F.count("*").alias("n_children"))
    )
    parents = nodes.select((F.col("depth") + 1).alias("depth"), *[F.col(c).alias(f"up_{c}") for c in LANES],
                           F.col("conv_id").alias("parent_conv_id"))
    linked = written(
        nodes.join(parents, ["depth", *[f"up_{c}" for c in LANES]], "left")
        .select(*NODE, "conv_id", "parent_conv_id", "n_convs"), "trie-linked")
    return (
        linked.join(amounts, list(NODE)).join(children, list(NODE), "left").join(_ends(whole), list(NODE), "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs",
                F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens",
                F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
    )


def rebuilt_trie(turns: DataFrame, block: int = 20) -> DataFrame:
    """The trie of the rebuilt conversations of a ``conversations`` table."""
    return prefix_trie(*rebuilt(turns, block))
