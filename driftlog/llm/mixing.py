"""Mixing sources to target weights: DataFrame operations only.

The words of a source's documents, in a pseudorandom order of the documents, are one stream, packed
into blocks of ``BLOCK_WORDS`` words that cross document borders. A source's target is its share of
all words by weight, at most ``MAX_REPEATS`` times its own size; what is cut off is shared among the
others by weight (``targets``). The output is a row of slots, ``SHARD_SLOTS`` to a shard, each holding
one block:

* every source owns as many slots as its target needs. A pseudorandom permutation of all slots deals
  them out, so each shard's counts by source are multinomial draws given the totals, and the totals
  come out to within a block (independent draws would miss a small source's target by 1/sqrt(n));
* a source's k-th slot holds its block ``perm(k mod n)``, a pseudorandom permutation of the block
  numbers that changes with each pass ``k div n``: no block is used a (k+1)-th time before all were
  used k times, and none more than ``MAX_REPEATS`` times;
* slots and blocks meet in an equi-join on (source, block).

Permutations are swap-or-not shuffles: bijections of 0..n-1 for any n, evaluated for one number at a
time from md5 bits, so nothing is sorted or collected and reruns agree.

Defined results: null and empty texts have size 0 and are never taken. A null source is a source of
its own and sorts last. Rows with a null id, and repeated rows, are documents of their own. An empty
table gives no rows. Other columns are ignored by ``taken`` and kept by ``mixed_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftlog.llm.common import WORD, cut

BLOCK_WORDS = 256
SHARD_SLOTS = 4096
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
ROUNDS = 12
SEED = "mix-1"
#: Prefix sums run over hash buckets of the documents: three hex digits of an md5.
BUCKET_DIGITS = 3
#: Slots find their source through so many equal cells of the slot range.
CELLS = 1024


def hash_number(*parts: Column | str) -> Column:
    """60 bits of the md5 of the parts, joined by colons, as a long."""
    text = F.concat_ws(":", *(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def permuted(x: Column, n: Column, key: Column) -> Column:
    """The image of x under a pseudorandom permutation of 0..n-1 chosen by ``key`` (a swap-or-not shuffle)."""

    def swap(acc: Column, r: Column) -> Column:
        other = F.pmod(hash_number(key, "k", r) - acc, n)
        bit = F.substring(F.md5(F.concat_ws(":", key, r.cast("string"), F.greatest(acc, other).cast("string")).cast("binary")), 1, 1)
        return F.when(bit >= "8", other).otherwise(acc)

    return F.aggregate(F.array(*(F.lit(r) for r in range(ROUNDS))), x, swap)


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source and size (words of the whole text) of every row, ``same`` numbering rows alike in all of these and the text."""
    out = docs.select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)).cast("long"), F.lit(0)).alias("size"), F.xxhash64("text").alias("text_key")
    )
    return out.withColumn("same", F.row_number().over(Window.partitionBy("doc_id", "source", "text_key").orderBy(F.lit(0))))


def targets(sized: DataFrame) -> DataFrame:
    """One row for each source: rank (by code point, null last), source_size, weight, target, n_blocks, slots, first_slot.

    Sources in ascending order of the ratio of cap to weight reach their caps in that order, so the
    capped ones are a prefix: a source is capped if its cap is within its share of what those before it
    leave. The windows run over one row for each source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*(F.lit(w) for w in WEIGHTS)), ((rank - 1) % len(WEIGHTS) + 1).cast("int"))
    per = per.withColumns({"rank": rank.cast("long"), "weight": weight.cast("long")})
    size, w = F.col("source_size"), F.col("weight")
    by_ratio = Window.orderBy((MAX_REPEATS * size / w), "rank")
    before, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    per = per.withColumns(
        {
            "left": F.sum("source_size").over(everything) - MAX_REPEATS * F.coalesce(F.sum("source_size").over(before), F.lit(0)),
            "weights": F.sum("weight").over(after),
        }
    )
    per = per.withColumn("open", F.when(MAX_REPEATS * size * F.col("weights") > F.col("left") * w, F.struct((-F.col("weights")).alias("k"), "left", "weights")))
    level = F.min("open").over(everything)  # of the first source that is not capped
    per = per.withColumn("level", level)
    share = F.col("level.left") * w / F.col("level.weights")
    cap = (MAX_REPEATS * size).cast("double")
    per = per.withColumn("target", F.when(F.col("open").isNull(), cap).otherwise(F.least(cap, share)))
    blocks = F.ceil(size / BLOCK_WORDS)
    per = per.withColumn("n_blocks", blocks.cast("long"))
    slots = F.least(F.floor(F.col("target") * F.col("n_blocks") / F.greatest(size, F.lit(1)) + 0.5), MAX_REPEATS * F.col("n_blocks"))
    per = per.withColumn("slots", slots.cast("long"))
    first = F.coalesce(F.sum("slots").over(Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return per.withColumn("first_slot", first).select("source", "rank", "source_size", "weight", "target", "n_blocks", "slots", "first_slot")


def layout(sized: DataFrame, per: DataFrame, seed: str = SEED) -> DataFrame:
    """Documents with words, with their source's rank and their first word's place in the source's stream.

    A two-step prefix sum: over the hash buckets of a source (``16 ** BUCKET_DIGITS`` rows at most), then
    inside each bucket, so a source of any size spreads over the tasks.
    """
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("size").cast("string")).cast("binary"))
    docs = (
        sized.where("size > 0")
        .join(F.broadcast(per.select(F.col("source").alias("_s"), "rank")), F.col("source").eqNullSafe(F.col("_s")))
        .drop("_s")
        .withColumn("key", key)
        .withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    )
    sums = docs.groupBy("rank", "bucket").agg(F.sum("size").alias("n"))
    over = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("rank", "bucket", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("bucket_start"))
    within = Window.partitionBy("rank", "bucket").orderBy("key", "doc_id", "text_key", "same").rowsBetween(Window.unboundedPreceding, -1)
    docs = docs.withColumn("inner_start", F.coalesce(F.sum("size").over(within), F.lit(0)))
    return docs.join(sums, ["rank", "bucket"]).withColumn("start", F.col("bucket_start") + F.col("inner_start")).drop("bucket", "bucket_start", "inner_start", "key")


def slots(per: DataFrame, seed: str = SEED) -> DataFrame:
    """Every output slot: slot, shard, rank of its source, block of that source."""
    spark = per.sparkSession
    total = int(per.agg(F.coalesce(F.sum("slots"), F.lit(0)).alias("n")).collect()[0]["n"])  # one number
    width = max(1, -(-total // CELLS))
    last = F.col("first_slot") + F.col("slots") - 1
    cell = F.explode(F.sequence(F.expr(f"first_slot div {width}"), F.floor(last / width))).alias("cell")
    ranges = per.where("slots > 0").select("rank", "n_blocks", "first_slot", last.alias("last_slot"), cell)
    drawn = spark.range(total).select(F.col("id").alias("slot"), permuted(F.col("id"), F.lit(total), F.lit(f"{seed}:slots")).alias("dealt"))
    drawn = drawn.withColumn("cell", F.expr(f"dealt div {width}"))
    placed = drawn.join(F.broadcast(ranges), "cell").where("dealt between first_slot and last_slot")  # at most CELLS + sources rows
    k = F.col("dealt") - F.col("first_slot")
    each = F.concat_ws(":", F.lit(seed), F.col("rank").cast("string"), F.expr("(dealt - first_slot) div n_blocks").cast("string"))
    block = permuted(k % F.col("n_blocks"), F.col("n_blocks"), each)
    return placed.select("slot", F.expr(f"slot div {SHARD_SLOTS}").alias("shard"), "rank", block.alias("block"))


def pieces(placed: DataFrame) -> DataFrame:
    """The documents' parts: block, and from/to in the document's words (0-based, end excluded)."""
    b = BLOCK_WORDS
    blocks = F.sequence(F.expr(f"start div {b}"), F.expr(f"(start + size - 1) div {b}"))
    out = placed.withColumn("block", F.explode(blocks))
    return out.withColumns(
        {
            "from_word": F.greatest(F.col("block") * b - F.col("start"), F.lit(0)),
            "to_word": F.least((F.col("block") + 1) * b - F.col("start"), F.col("size")),
        }
    )


def used(docs: DataFrame, seed: str = SEED):
    """(sizes, targets, pieces with ``times``, how often the mix takes them)."""
    sized = cut(sizes(docs))  # ids and numbers only; read by four branches below
    per = cut(targets(sized))
    times = slots(per, seed).groupBy("rank", "block").agg(F.count("*").alias("times"))
    parts = pieces(layout(sized, per, seed)).join(times, ["rank", "block"], "left")
    return sized, per, parts.withColumn("times", F.coalesce("times", F.lit(0)))


def mixed_blocks(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mix itself: one row for each part of a document in each slot, in block order:
    shard, slot, source rank, block, first word in the block, doc_id, text of the part."""
    sized, per, parts = used(docs, seed)
    keys = ["doc_id", "source", "text_key", "same"]
    texts = docs.select("doc_id", "source", F.xxhash64("text").alias("text_key"), F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"))
    texts = texts.withColumn("same", F.row_number().over(Window.partitionBy("doc_id", "source", "text_key").orderBy(F.lit(0))))
    same = [F.col(f"p.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys]
    full = parts.where("times > 0").alias("p").join(texts.alias("t"), same)
    text = F.array_join(F.slice("t.words", (F.col("from_word") + 1).cast("int"), (F.col("to_word") - F.col("from_word")).cast("int")), " ")
    full = full.select("rank", "block", (F.col("start") + F.col("from_word") - F.col("block") * BLOCK_WORDS).alias("first_word"), "p.doc_id", text.alias("text"))
    return slots(per, seed).join(full, ["rank", "block"])


def taken(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Every row of ``docs``: doc_id, size, source_size, target (of its source), taken (words of it in the mix)."""
    sized, per, parts = used(docs, seed)
    some = parts.groupBy("rank", "start", "doc_id", "size").agg(F.sum((F.col("to_word") - F.col("from_word")) * F.col("times")).alias("taken"))
    some = some.join(F.broadcast(per.select("rank", "source_size", "target")), "rank")
    none = sized.where("size = 0").select("doc_id", "size", F.col("source").alias("_s"))
    none = none.join(F.broadcast(per), F.col("_s").eqNullSafe(F.col("source"))).withColumn("taken", F.lit(0).cast("long"))
    out = ["doc_id", "size", "source_size", "target", "taken"]
    return some.select(out).unionByName(none.select(out))


def mixed_documents(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: a document comes once for each pass that takes
    any of its parts, with the words that pass takes. A pass that takes all of them leaves the text as it
    is; otherwise its words are joined by spaces. ``n_chars`` (if there is one) follows the text."""
    sized, per, parts = used(docs, seed)
    keys = ["doc_id", "source", "text_key", "same"]
    part = F.struct("from_word", "to_word", "times")
    each = parts.groupBy(*keys, "size").agg(F.sort_array(F.collect_list(part)).alias("_parts"), F.max("times").alias("_passes"))  # a document's own parts
    each = each.where("_passes > 0").select(*(F.col(k).alias(f"_{k}") for k in keys), "_parts", "_passes", F.col("size").alias("_size"))
    numbered = docs.select(F.struct(*docs.columns).alias("_row"), F.xxhash64("text").alias("_key"))  # no column of docs can clash
    numbered = numbered.withColumn("_nth", F.row_number().over(Window.partitionBy("_row.doc_id", "_row.source", "_key").orderBy(F.lit(0))))
    match = (
        F.col("_row.doc_id").eqNullSafe(F.col("_doc_id")) & F.col("_row.source").eqNullSafe(F.col("_source"))
        & F.col("_key").eqNullSafe(F.col("_text_key")) & (F.col("_nth") == F.col("_same"))
    )
    rows = numbered.join(each, match).withColumn("_pass", F.explode(F.sequence(F.lit(1).cast("long"), "_passes")))
    rows = rows.withColumn("_in", F.filter("_parts", lambda p: p["times"] >= F.col("_pass")))
    words = F.regexp_extract_all("_row.text", F.lit(WORD), F.lit(0))
    kept = F.aggregate("_in", F.lit(0).cast("long"), lambda n, p: n + p["to_word"] - p["from_word"])
    cuts = F.transform("_in", lambda p: F.array_join(F.slice(F.col("_words"), (p["from_word"] + 1).cast("int"), (p["to_word"] - p["from_word"]).cast("int")), " "))
    rows = rows.withColumn("_words", F.when(kept < F.col("_size"), words))
    rows = rows.withColumn("_text", F.when(F.col("_words").isNull(), F.col("_row.text")).otherwise(F.array_join(cuts, " ")))
    new = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("_text").cast(docs.schema["n_chars"].dataType)
    return rows.select(*(new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns))
