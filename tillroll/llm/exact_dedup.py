"""Exact deduplication by deterministic block naming, in DataFrame operations only.

Each text is cut into fixed-size blocks of bytes.  The distinct blocks of the
whole corpus are sorted and each gets an integer name; then adjacent pairs of
names are named the same way, level by level, until one name is left for each
document.  Two texts have the same (level, name) if and only if they are equal:
names are positions of distinct values, never hashes.

Blocks cross the network once, in the aggregation that finds the distinct ones
(combined on the map side, so a block shared by a third of all rows is one row
per task).  Documents find their block's name by the block's 64-bit hash, which
is eight bytes instead of a block; hashes that two different blocks share are
found by counting and their blocks are named and joined by content.  Every
level is a written table, so a lost executor repeats tasks of one level only.

Defined cases: a null text counts as empty; an empty text is one empty block; a
null ``doc_id`` is smaller than any other; of repeated rows (same id, same text)
one stays; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import pick
from tillroll.session import materialize

BLOCK_BYTES = 2048


def _blocks(text: Column, size: int) -> Column:
    """Array of the text's blocks; the bytes are bound once, so cutting is linear."""
    last = F.greatest(F.lit(0), F.ceil(F.octet_length(text) / size).cast("int") - 1)
    return F.flatten(F.transform(
        F.array(text.cast("binary")),
        lambda raw: F.transform(F.sequence(F.lit(0), last),
                                lambda i: F.substring(raw, i * size + 1, F.lit(size)))))


def _named(distinct: DataFrame, *by: str) -> DataFrame:
    """Sort distinct rows and name each by its position (unique, not gapless)."""
    return distinct.sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id())


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES, block_hash=F.xxhash64) -> DataFrame:
    """One row per input row: rid, doc_id, text_sha256, level, name.

    Rows have equal (level, name) exactly when their texts are equal.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = pick(docs, "doc_id", "text").select("doc_id", text.alias("text"))
    blocks = rows.select(F.explode(_blocks(F.col("text"), block_bytes)).alias("block"))
    blocks = blocks.select(block_hash("block").alias("h"), "block")

    by_hash = materialize(
        materialize(_named(blocks.distinct(), "h", "block").select("h", "name"), "block_names")
        .groupBy("h").agg(F.min("name").alias("name"), F.count("*").alias("blocks")), "hash_names")
    shared = by_hash.filter("blocks > 1").select("h")
    clash = not shared.isEmpty()

    cut = _blocks(F.col("text"), block_bytes)
    base = materialize(rows.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", F.sha2("text", 256).alias("text_sha256"),
        F.transform(cut, lambda b: block_hash(b)).alias("hashes"), *([cut.alias("blocks")] if clash else [])), "doc_blocks")
    cells = F.arrays_zip("hashes", "blocks") if clash else F.transform("hashes", lambda h: F.struct(h.alias("hashes")))
    at = (base.select("rid", F.size("hashes").alias("n"), F.posexplode(cells).alias("pos", "cell"))
          .select("rid", "n", "pos", F.col("cell.hashes").alias("h"), *(["cell.blocks"] if clash else [])))
    named = at.join(by_hash.select("h", "name"), "h")
    if clash:
        own = materialize(_named(blocks.join(shared, "h", "left_semi").distinct(), "h", "block")
                          .select("h", F.col("block").alias("blocks"), (-2 - F.col("name")).alias("own")), "clash_names")
        named = named.join(own, ["h", "blocks"], "left").withColumn("name", F.coalesce("own", "name"))

    level = 0
    names = materialize(named.select("rid", "n", "pos", "name"), "names")
    done = []
    longest = base.agg(F.max(F.size("hashes"))).first()[0] or 1
    while True:
        done.append(names.filter("n = 1").select("rid", F.lit(level).alias("level"), "name"))
        if longest == 1:
            break
        pairs = materialize(
            names.filter("n > 1").groupBy("rid", "n", F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
                F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b")), "pairs")
        pair_names = materialize(_named(pairs.select("a", "b").distinct(), "a", "b"), "pair_names")
        names = materialize(pairs.join(pair_names, ["a", "b"]).select(
            "rid", F.ceil(F.col("n") / 2).cast("int").alias("n"), "pos", "name"), "names")
        level, longest = level + 1, (longest + 1) // 2
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return base.select("rid", "doc_id", "text_sha256").join(found, "rid")


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES, block_hash=F.xxhash64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest ``doc_id`` is kept.
    """
    ids = materialize(identities(docs, block_bytes, block_hash), "identities")
    groups = materialize(ids.groupBy("level", "name").agg(
        F.max(F.struct("doc_id", "rid")).alias("keep"), F.count("*").alias("group_size")), "groups")
    return ids.join(groups, ["level", "name"]).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("keep.rid")).alias("kept"), "text_sha256")


def kept_keys(docs: DataFrame) -> DataFrame:
    """Keys (see ``row_key``) of the rows that stay."""
    return exact_dedup(docs).filter("kept").select(
        F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text_sha256").alias("key"))
