"""Exact duplicates by deterministic block naming (operator 7).

A text without its ASCII white space is cut into blocks of a fixed number of code points.
All distinct blocks are sorted and numbered, so that equal blocks, and
only those, have the same integer name.  Then each pair of neighbouring names is
named in the same way, again and again, until a document has a single name.
Documents are equal exactly when they have the same number of blocks and the same name.

No name rests on a hash alone.  Blocks are distinct by their contents; a 64-bit
hash sorts them, and where several contents share a hash, they are told apart by their
contents.  Block contents are shuffled once, combined on the map side; all else
moves integers.  A name is a rank in a total order, so it's the same in every run.

Null texts are empty, and all empty texts are equal.  Among equal texts stays the row with the most code
points in its original text, then the smallest id (null ids last), then, among
repeated rows, one of them.  Columns other than id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewpulse.llm.common import cut, text_or_empty

SPACE = " \t\n\x0b\x0c\r"


def without_space(text: Column) -> Column:
    return F.translate(text, SPACE, "")


def _blocks(size: int) -> Column:
    found = F.regexp_extract_all("norm", F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.when(F.col("norm") == "", F.array(F.lit(""))).otherwise(found)


def ranked(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Add ``name``: the rank of each row (from 0) in the order of distinct ``order`` columns.

    Rows are sorted into ranges; only the size of each range reaches the driver.
    """
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # the id's low 33 bits count the rows of a partition
    at = F.monotonically_increasing_id()
    placed = cut(parts.select("*", F.shiftright(at, 33).alias("_part"), at.bitwiseAND((1 << 33) - 1).alias("_row")), "naming-ranks")
    sizes = sorted((r["_part"], r["count"]) for r in placed.groupBy("_part").count().collect())
    before, offset = [], 0
    for part, n in sizes:
        before.append((part, offset))
        offset += n
    if not before:
        return placed.select(*df.columns, F.col("_row").alias(name))
    start = F.element_at(F.create_map(*[F.lit(x) for pair in before for x in pair]), F.col("_part"))
    return placed.select(*df.columns, (start + F.col("_row")).cast("long").alias(name))


def _name_pairs(named: DataFrame) -> DataFrame:
    """One step up: neighbours (pos 2i, 2i + 1) become one name at pos i."""
    side = lambda odd: F.max(F.when(F.col("pos") % 2 == odd, F.col("name")))
    pairs = named.groupBy("row", F.shiftright("pos", 1).alias("up")).agg(
        side(0).alias("a"), F.coalesce(side(1), F.lit(-1)).alias("b"))
    pairs = cut(pairs, "naming-pairs")
    names = ranked(pairs.select("a", "b").distinct(), ["a", "b"], "name")
    return pairs.join(names, ["a", "b"]).select("row", F.col("up").alias("pos"), "name")


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = 16384,
               hash_bits: int = 64, tie_col: str | None = None) -> DataFrame:
    """``row, id, tie, chars, sha256, n_blocks, name`` of every row: equal (n_blocks, name) means equal texts.

    ``tie`` is the column ``tie_col``, by default the id.

    ``hash_bits`` below 64 weakens the sorting hash, for tests of shared hashes.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(tie_col or id_col).alias("tie"), text_or_empty(text_col).alias("text"))
    base = base.select("id", "tie", F.length("text").cast("long").alias("chars"), without_space(F.col("text")).alias("norm"))
    h = F.xxhash64("block") if hash_bits == 64 else F.xxhash64("block").bitwiseAND((1 << hash_bits) - 1)

    contents = base.select(F.explode(_blocks(block)).alias("block")).withColumn("h", h).distinct()
    hashes = cut(contents.groupBy("h").agg(F.count("*").alias("n")), "naming-hashes")
    shared = hashes.where("n > 1").select("h")
    any_shared = not shared.isEmpty()

    rows = (base.select("id", "tie", "chars", F.sha2(F.encode("norm", "UTF-8"), 256).alias("sha256"), _blocks(block).alias("blocks"))
            .withColumn("row", F.monotonically_increasing_id()).withColumn("n_blocks", F.size("blocks")))
    rows = rows.select("row", "id", "tie", "chars", "sha256", "n_blocks", F.posexplode("blocks").alias("pos", "block")).withColumn("h", h)
    if any_shared:
        rows = rows.join(shared.withColumn("is_shared", F.lit(True)), "h", "left").withColumn("block", F.when(F.col("is_shared"), F.col("block")))
    else:
        rows = rows.withColumn("block", F.lit(None).cast("string"))
    # the id, size and digest of a row stand beside its first block only
    first = F.col("pos") == 0
    rows = cut(rows.select("row", "pos", "h", "block", "n_blocks", *[F.when(first, F.col(c)).alias(c) for c in ("id", "tie", "chars", "sha256")]),
               "naming-rows")

    single = ranked(hashes.where("n = 1").select("h"), ["h"], "name")
    named = rows.join(single, "h").select("row", "pos", "name")
    if any_shared:  # contents that share a hash are named after all others, by hash and contents
        several = ranked(contents.join(shared, "h", "left_semi"), ["h", "block"], "rank")
        taken = hashes.where("n = 1").count()
        named = named.unionByName(rows.join(several, ["h", "block"]).select("row", "pos", (F.col("rank") + taken).alias("name")))

    heads = rows.where("pos = 0").select("row", "id", "tie", "chars", "sha256", "n_blocks")
    most, size = rows.agg(F.max("n_blocks")).first()[0] or 1, 1
    roots = named.join(heads.where("n_blocks = 1").select("row"), "row", "left_semi")
    while size < most:
        active = heads.where(F.col("n_blocks") > size).select("row")
        named = _name_pairs(named.join(active, "row", "left_semi"))
        size *= 2
        ended = heads.where((F.col("n_blocks") > size // 2) & (F.col("n_blocks") <= size)).select("row")
        roots = roots.unionByName(named.join(ended, "row", "left_semi"))
    return heads.join(roots.select("row", "name"), "row")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = 16384,
                     hash_bits: int = 64, tie_col: str | None = None) -> DataFrame:
    """``id, keep_id, group_size, kept, text_sha256`` for every row, ``id`` under the name of ``id_col``.

    Texts of one length are decided by the smallest ``tie_col``, by default the id.
    """
    rows = identities(docs, id_col, text_col, block, hash_bits, tie_col)
    order = F.struct((-F.col("chars")).alias("less"), F.col("tie").isNull().alias("unnamed"), "tie", "row", "id")
    groups = rows.groupBy("n_blocks", "name").agg(F.count("*").alias("group_size"), F.min(order).alias("stays"))
    out = rows.join(groups, ["n_blocks", "name"])
    return out.select(F.col("id").alias(id_col), F.col("stays.id").alias("keep_id"), "group_size",
                      (F.col("row") == F.col("stays.row")).alias("kept"), F.col("sha256").alias("text_sha256"))
