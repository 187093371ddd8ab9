"""Mixing sources to target weights with a multivariate hypergeometric splitting tree, in DataFrame functions only.

Every source is dealt into a fixed number of random blocks of documents. Its target says how often all of its blocks
are drawn, and how far one more pass reaches. Block draws are shared out among output shards by a tree: every node
halves its number of draws, and each source's share of the left half is drawn without replacement. Shards then take
disjoint runs of each source's permuted draws.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.common import WORD, query, table
from tickloom.session import publish

#: Weights by a source's rank, repeating; the share of all words that is mixed; times a source may be repeated.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
#: Hexadecimal digits of a document's hash that name its block: 16^3 = 4,096 blocks a source, whatever its size.
BLOCK_DIGITS = 3


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """(source, source_size, target) from (source, source_size): weighted shares of ``share`` of all words.

    A target stops at ``repeats`` times its source; what is above goes to the others by weight until none is above.
    In order of the ratio of limit to weight, the sources that stop come first, so one running sum settles it. The
    windows run over one row per source.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") - 1) % len(weights) + 1)
    ranked = ranked.withColumn("weight", weight).withColumn("limit", F.col("source_size") * repeats)
    order = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (share * F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0))) / F.sum("weight").over(after)
    ranked = ranked.withColumn("level", level)
    free = F.when(F.col("limit") > F.col("level") * F.col("weight"), F.struct("limit", "weight", "level", "rank"))
    first = F.min_by("level", F.when(free.isNotNull(), F.struct(F.col("limit") / F.col("weight"), F.col("rank")))).over(whole)
    target = F.least(F.col("limit").cast("double"), F.coalesce(first * F.col("weight"), F.col("limit").cast("double")))
    return ranked.select("source", "rank", "source_size", target.alias("target"))


def split_tree(quotas: DataFrame, levels: int, seed: int) -> DataFrame:
    """(shard, rank, quota): ``quotas`` (rank, quota) split exactly among 2^levels shards of even size.

    A node is one row with one number per source. Its left half gets half of its draws, and each source's part of it
    is a hypergeometric draw, made block by block without replacement with hashes as random numbers.
    """
    nodes = quotas.agg(F.sort_array(F.collect_list(F.struct("rank", "quota"))).alias("q")).select(F.lit(0).alias("node"), "q")
    for level in range(levels):
        drawn = F.expr(f"""
          aggregate(q,
            named_struct('left', cast(floor(aggregate(q, 0L, (a, x) -> a + x.quota) / 2) as bigint),
                         'all', aggregate(q, 0L, (a, x) -> a + x.quota), 'out', cast(array() as array<bigint>)),
            (acc, x) -> aggregate(sequence(0L, x.quota),
              named_struct('left', acc.left, 'all', acc.all, 'got', 0L, 'out', acc.out),
              (d, i) -> if(i = 0, d,
                if((xxhash64({seed}, {level}, node, x.rank, i) & 1048575) * d.all < d.left * 1048576L,
                   named_struct('left', d.left - 1, 'all', d.all - 1, 'got', d.got + 1, 'out', d.out),
                   named_struct('left', d.left, 'all', d.all - 1, 'got', d.got, 'out', d.out))),
              d -> named_struct('left', d.left, 'all', d.all, 'out', concat(d.out, array(d.got)))),
            acc -> acc.out)""")
        nodes = nodes.withColumn("got", drawn)
        nodes = nodes.select("node", "q", "got", F.explode(F.array(F.lit(0), F.lit(1))).alias("side")).select(
            (F.col("node") * 2 + F.col("side")).alias("node"),
            F.expr("transform(q, (x, i) -> named_struct('rank', x.rank, 'quota', if(side = 0, got[i], x.quota - got[i])))").alias("q"))
    return nodes.select(F.col("node").alias("shard"), F.inline("q"))


def mix(docs: DataFrame, levels: int = 5, seed: int = 7) -> DataFrame:
    """``docs`` with size, source_size, target, taken and copies (an array of shard and words per copy).

    size counts the words of the text; taken is the sum of the copies' words: all of them, but for the one document
    per source at which the last pass reaches the target, which is cut there. Null and empty texts have size 0 and no
    copies. A null source is a source of its own; documents with a null id share one block. Rows that agree in id and
    size may stand for one another. Empty tables give no rows. Reruns agree, since all choices are hashes of ids. A
    column of ``docs`` whose name is also a result's gives way to the result.

    Blocks are found by partial sums; the documents of a source are never sorted as a whole, only those of a block.
    """
    docs = docs.drop("size", "source_size", "target", "taken", "copies")
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))
    rows = docs.withColumns({"size": word_count(), "__key": key}).withColumn("__block", F.substring("__key", 1, BLOCK_DIGITS))
    blocks = publish(rows.groupBy("source", "__block").agg(F.sum("size").alias("words")), "blocks")
    goals = targets(blocks.groupBy("source").agg(F.sum("words").alias("source_size")))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    goals = goals.withColumn("passes", passes).withColumn(
        "rest", F.floor(F.col("target") - F.col("passes") * F.col("source_size") + 0.5).cast("long"))
    order = Window.partitionBy("rank").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.join(goals, blocks.source.eqNullSafe(goals.source)).drop(goals.source).withColumn(
        "before", F.coalesce(F.sum("words").over(order), F.lit(0)))
    draws = blocks.where("words > 0").select("rank", "__block", F.explode(
        F.expr("sequence(0, passes - if(before < rest, 0, 1))")).alias("turn")).where("turn >= 0")
    draws = publish(draws, "draws")
    shares = split_tree(draws.groupBy("rank").agg(F.count("*").alias("quota")), levels, seed)
    upto = F.sum("quota").over(Window.partitionBy("rank").orderBy("shard"))
    shares = shares.where("quota > 0").select("rank", "shard", upto.alias("upto"), (upto - F.col("quota")).alias("from"))
    place = F.row_number().over(Window.partitionBy("rank").orderBy(F.md5(F.concat_ws(":", "__block", "turn").cast("binary")), "__block", "turn")) - 1
    placed = draws.withColumn("place", place).join(shares, "rank").where("place >= from and place < upto")
    shards = placed.groupBy("rank", "__block").agg(F.sort_array(F.collect_list(F.struct("turn", "shard"))).alias("turns"))
    plan = publish(blocks.join(shards, ["rank", "__block"], "left").select(
        F.col("source").alias("__source"), F.col("__block").alias("__of"), "source_size", "target", "passes", "rest", "before", "turns"), "plan")
    rows = rows.join(plan, rows.source.eqNullSafe(plan["__source"]) & (rows["__block"] == plan["__of"]))
    inside = Window.partitionBy("source", "__block").orderBy("__key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    last = F.least("size", F.greatest(F.lit(0), F.col("rest") - F.col("before") - F.coalesce(F.sum("size").over(inside), F.lit(0))))
    rows = rows.withColumn("__last", last)
    copies = F.expr("filter(transform(coalesce(turns, cast(array() as array<struct<turn:int,shard:int>>)), "
                    "t -> named_struct('shard', t.shard, 'words', if(t.turn < passes, size, __last))), c -> c.words > 0)")
    rows = rows.withColumn("copies", copies).withColumn("taken", F.expr("aggregate(copies, 0L, (a, c) -> a + c.words)"))
    return rows.select(*docs.columns, "size", "source_size", "target", "taken", "copies")


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of the mix with the columns of ``docs``: one per copy, in random order within a partition.

    The one document per source that is cut keeps its first words, joined by single blanks.
    """
    own = docs.columns
    carried = docs.select(F.struct(*own).alias("__row"), *[c for c in ("doc_id", "text", "source") if c in own])
    rows = mix(carried).select("__row", "doc_id", "size", F.posexplode("copies").alias("turn", "copy"))
    words = F.slice(F.regexp_extract_all(F.col("__row.text"), F.lit(WORD), F.lit(0)), F.lit(1), F.col("copy.words").cast("int"))
    text = F.when(F.col("copy.words") < F.col("size"), F.array_join(words, " ")).otherwise(F.col("__row.text"))
    shuffled = rows.sortWithinPartitions(F.xxhash64("copy.shard"), F.xxhash64("doc_id", "turn"))
    return shuffled.select(*[text.alias(c) if c == "text" else F.col("__row").getField(c).alias(c) for c in own])


_ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sized GROUP BY source),
weighed AS (SELECT *, [3, 1, 2][(rank - 1) % 3 + 1] AS weight, 2 * source_size AS lim FROM sources),
levels AS (
  SELECT *, (1.5::DOUBLE * CAST(sum(source_size) OVER () AS BIGINT)
             - coalesce(CAST(sum(lim) OVER (ORDER BY lim / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0))
            / CAST(sum(weight) OVER (ORDER BY lim / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS level FROM weighed),
final AS (SELECT arg_min(level, lim / weight) AS level FROM levels WHERE lim > level * weight),
goals AS (
  SELECT w.source, w.source_size, least(CAST(w.lim AS DOUBLE), coalesce(f.level * w.weight, CAST(w.lim AS DOUBLE))) AS target
  FROM weighed w LEFT JOIN final f ON true),
passed AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM goals),
placed AS (
  SELECT s.*, g.source_size, g.target, g.passes, CAST(floor(g.target - g.passes * g.source_size + 0.5) AS BIGINT)
         - coalesce(CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS room
  FROM sized s JOIN passed g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, CAST(passes * size + least(size, greatest(0, room)) AS BIGINT) AS taken FROM placed
"""


@query("op5_source_mixture", _ORACLE)
def _mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")
