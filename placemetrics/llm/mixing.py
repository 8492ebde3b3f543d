"""Mixing sources to target weights by a low-discrepancy schedule. DataFrame functions only.

Sources, in code-point order with null last, get the weights in turn and share the words to be mixed; a source stops at
``repeats`` times its own words and what is left over goes to the others by weight. The schedule is a run of slots:
slot i has the point frac(0.5 + i * golden ratio), which falls into the stretch of one source on the line of
cumulative targets. A source's documents, shuffled by MD5, form one run of words that repeats. A source's slots, by rank,
take blocks of that run one after the other, as many words in every slot of every source; only the block in which the
target falls is cut, so that a source is taken to its target, to the word. The points give a source about its share of
slots: a slot past the target takes nothing, and slots that a source lacks, by the schedule's discrepancy, follow after the
last point, in turns of all sources. Read in the order of slots, the mix holds every source near its share in any stretch.

Ranks, running sums and the numbers of equal rows are made in two levels (parts, then offsets of parts), so no task holds a
whole source or all repeats of a row. A null text has no words; documents without words are taken 0 times. Equal rows are
told apart by a number, so each is a document of its own. An empty table gives an empty table; other columns are ignored.
Only sources are ordered and summed in one task, a row a source. Points find their source by one sort of points and
stretches in each cell of the line, so that a cell costs as much as it holds, whatever the number of sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placemetrics.llm.common import stored, table

WEIGHTS = (5, 2, 1)
REPEATS = 3
#: Slots that a small corpus is cut into, and about how many words a slot of a large one has.
SLOTS, SLOT_WORDS = 65536, 4096
GOLDEN = 0.6180339887498949
#: Cells of the line: at least so many; more for many sources (up to a bound) or slots.
CELLS, MOST_CELLS, CELL_SLOTS = 1024, 1 << 20, 1 << 20
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, share: float = 1.0) -> DataFrame:
    """One row a source: sid, source, source_size, target, words (the target, whole), slot (a slot's words), n_parts, low (where its stretch begins)."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    named = Window.orderBy(F.col("source").asc_nulls_last())  # a row a source
    per = per.withColumn("sid", F.row_number().over(named))
    turn = F.element_at(F.array(*(F.lit(w) for w in weights)), ((F.col("sid") - 1) % len(weights) + 1).cast("int"))
    per = per.withColumns({"weight": turn.cast("double"), "cap": F.col("source_size") * F.lit(float(repeats))})
    whole = Window.partitionBy()
    filled = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("all_words", F.sum("source_size").over(whole))
    level = (F.col("all_words") * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    per = per.withColumn("level", level)
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))
    per = per.withColumn("level", F.first(fits, ignorenulls=True).over(filled.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    per = per.withColumns(
        {
            "target": F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))),
            "slot": F.greatest(F.lit(1), F.least(F.lit(SLOT_WORDS), F.expr(f"all_words div {SLOTS}"))).cast("long"),
        }
    )
    per = per.withColumns({"words": F.floor(F.col("target") + 0.5).cast("long"), "n_parts": F.ceil(F.sqrt("n_docs")).cast("long")})
    # whole words on the line, so that stretches do not depend on the order of a sum
    start = F.coalesce(F.sum("words").over(named.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return per.withColumn("low", F.coalesce(F.try_divide(start, F.sum("words").over(whole)), F.lit(0.0)))


def schedule(per: DataFrame) -> DataFrame:
    """One row a slot: its number i, sid, rank among its source's slots."""
    spark = per.sparkSession
    words, slot, sources = per.agg(F.coalesce(F.sum("words"), F.lit(0)), F.coalesce(F.max("slot"), F.lit(1)), F.count("*")).first()
    n = -(-words // slot)
    part, cells = max(1, int(n**0.5)), max(CELLS, min(sources, MOST_CELLS), n // CELL_SLOTS)
    used = per.filter("words > 0")
    point = F.lit(0.5) + F.col("i") * F.lit(GOLDEN)
    points = spark.range(n).select(F.col("id").alias("i"), F.lit(None).cast("int").alias("sid")).withColumn("at", point - F.floor(point))
    points = points.withColumn("cell", F.floor(F.col("at") * cells).cast("int"))
    following = F.lead("low", 1, 1.0).over(Window.orderBy("sid"))  # a row a source
    over = F.sequence(F.floor(F.col("low") * cells).cast("int"), F.least(F.floor(following * cells), F.lit(cells - 1)).cast("int"))
    stretches = used.select("sid", F.col("low").alias("at"), over.alias("cells")).select(F.lit(None).cast("long").alias("i"), "sid", "at", F.explode("cells").alias("cell"))
    line = Window.partitionBy("cell").orderBy("at", F.col("i").asc_nulls_first(), "sid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = points.unionByName(stretches).withColumn("sid", F.last("sid", ignorenulls=True).over(line)).filter("i is not null")
    slots = stored(met.select("i", F.expr(f"i div {part}").alias("part"), "sid"), "mix-slots")
    sums = slots.groupBy("sid", "part").agg(F.count("*").alias("held"))
    offset = F.coalesce(F.sum("held").over(Window.partitionBy("sid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rank = F.row_number().over(Window.partitionBy("sid", "part").orderBy("i")) - 1 + F.col("offset")
    ranked = slots.join(sums.select("sid", "part", offset.alias("offset")), ["sid", "part"]).select("i", "sid", rank.cast("long").alias("rank"))
    met = F.coalesce("met", F.lit(0)).cast("long")
    lacking = used.join(sums.groupBy("sid").agg(F.sum("held").alias("met")), "sid", "left").select("sid", met.alias("met"), F.expr("(words + slot - 1) div slot").alias("all"))
    lacking = lacking.filter("met < all").select("sid", "met", F.explode(F.expr("sequence(met, all - 1)")).alias("rank"))
    turn = F.lit(n) + (F.col("rank") - F.col("met")) * F.lit(sources) + F.col("sid")
    return ranked.unionByName(lacking.select(turn.cast("long").alias("i"), "sid", "rank"))


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with a number among their equals, column ``copy``; ``held_by`` names the part in which a row was written."""
    same = ["doc_id", "source", "content"]
    sums = rows.groupBy(*same, "held_by").agg(F.count("*").alias("held")).withColumn("more", F.count("*").over(Window.partitionBy(*same)))
    before = F.sum("held").over(Window.partitionBy(*same).orderBy("held_by").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.filter("more > 1").select(*(F.col(c).alias(f"s_{c}") for c in (*same, "held_by")), F.coalesce(before, F.lit(0)).alias("offset"))
    own = F.row_number().over(Window.partitionBy(*same, "held_by").orderBy("size")) - 1
    met = F.col("held_by") == F.col("s_held_by")
    for c in same:
        met &= F.col(c).eqNullSafe(F.col(f"s_{c}"))
    return rows.withColumn("own", own).join(sums, met, "left").withColumn("copy", F.col("own") + F.coalesce("offset", F.lit(0))).select(*rows.columns, "copy")


def blocks(
    df: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, share: float = 1.0, key: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """The mix: slot, sid, and the words [low, high) of a document that the slot takes; documents that none takes have null slots.

    With doc_id, source, content (MD5 of the text), copy (number among equal rows), size, source_size and target.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    sizes = df.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), n_words(text).alias("size"), F.md5(body.cast("binary")).alias("content"))
    sizes = stored(sizes.withColumn("held_by", F.spark_partition_id()), "mix-sizes")
    per = stored(targets(sizes, weights, repeats, share), "mix-targets")
    slots = schedule(per)

    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "content", F.col("copy").cast("string"))
    docs = _numbered(sizes).withColumn("shuffle", F.md5(name.cast("binary"))).drop("held_by")
    names = per.select(F.col("source").alias("name"), "sid", "source_size", "target", "words", "n_parts", F.col("slot").alias("slot_words"))
    docs = docs.join(names, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    place = F.conv(F.substring("shuffle", 1, 8), 16, 10).cast("double") / 2.0**32
    docs = docs.withColumn("part", F.floor(place * F.col("n_parts")))
    sums = docs.groupBy("sid", "part").agg(F.sum("size").alias("held"))
    before = F.sum("held").over(Window.partitionBy("sid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("sid", "part", F.coalesce(before, F.lit(0)).alias("offset"))
    order = Window.partitionBy("sid", "part").orderBy("shuffle", "source", "doc_id")
    start = F.col("offset") + F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    docs = docs.join(sums, ["sid", "part"]).withColumn("start", start)
    # a document's places on the repeated run, as far as the target goes, cut into blocks
    turns = F.when((F.col("size") > 0) & (F.col("start") < F.col("words")), F.expr("sequence(start, words - 1, source_size)"))
    docs = docs.withColumn("first", F.explode_outer(turns)).withColumn("last", F.least(F.col("first") + F.col("size"), "words"))
    docs = docs.withColumn("block", F.explode_outer(F.expr("sequence(first div slot_words, (last - 1) div slot_words)")))
    low = F.greatest("first", F.col("block") * F.col("slot_words")) - F.col("first")
    high = F.least("last", (F.col("block") + 1) * F.col("slot_words")) - F.col("first")
    taken = docs.join(slots.select(F.col("i").alias("slot"), F.col("sid").alias("slot_sid"), "rank"), (F.col("sid") == F.col("slot_sid")) & (F.col("block") == F.col("rank")), "left")
    return taken.select("slot", "sid", low.alias("low"), high.alias("high"), "doc_id", "source", "content", "copy", "size", "source_size", "target")


def mix(
    df: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, share: float = 1.0, key: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """doc_id, source, content, size, source_size, target; taken: how many of a document's words the mix takes, repeats counted;
    first_slot and n_slots: the first slot that takes some of it (-1: none) and how many do; starts: in which slot each repeat begins."""
    one = ["doc_id", "source", "content", "copy", "size", "source_size", "target"]
    words = F.when(F.col("slot").isNotNull(), F.col("high") - F.col("low")).otherwise(0)
    taken = blocks(df, weights, repeats, share, key, text, source).groupBy(*one).agg(
        F.sum(words).cast("long").alias("taken"),
        F.coalesce(F.min("slot"), F.lit(-1).cast("long")).alias("first_slot"),
        F.count("slot").alias("n_slots"),
        F.array_sort(F.collect_list(F.when(F.col("low") == 0, F.col("slot")))).alias("starts"),  # ``repeats`` slots at most
    )
    return taken.drop("copy")


def copies(size: str = "size", taken: str = "taken", key: str = "doc_id") -> Column:
    """Whole copies of a document for a mix by documents: taken / size, rounded up or down by a number drawn from its id."""
    draw = F.pmod(F.xxhash64(F.coalesce(F.col(key), F.lit(-1)), F.lit("copies")), F.lit(1 << 20)) / float(1 << 20)
    return F.when(F.col(size) > 0, F.floor(F.col(taken) / F.col(size) + draw)).otherwise(0).cast("int")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "first_slot", "n_slots")


QUERIES = {"op3_mixing": op3_mixing}

SQL = {
    "op3_mixing": r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(coalesce(text, '')) AS content FROM documents),
numbered AS (
  SELECT *, md5(concat_ws(':', coalesce(doc_id::VARCHAR, ''), content, (row_number() OVER (PARTITION BY doc_id, source, content) - 1)::VARCHAR)) AS shuffle FROM docs),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
named AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS sid, sum(source_size) OVER () ::BIGINT AS words FROM per),
weighed AS (
  SELECT *, ([5.0, 2.0, 1.0])[((sid - 1) % 3 + 1)::INT]::DOUBLE AS weight, (source_size * 3)::DOUBLE AS cap FROM named),
levels AS (
  SELECT *, (words::DOUBLE - coalesce(sum(cap) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS lv
  FROM weighed WINDOW b AS (ORDER BY cap / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT arg_min(lv, cap / weight * 1000000 + sid) AS lv FROM levels WHERE lv <= cap / weight),
targets AS (
  SELECT source, sid, source_size, least(cap, coalesce(l.lv * weight, cap)) AS target,
         floor(least(cap, coalesce(l.lv * weight, cap)) + 0.5)::BIGINT AS goal, greatest(1, least(4096, words // 65536)) AS slot_words
  FROM weighed w, level l),
line AS (
  SELECT *, coalesce(sum(goal) OVER (ORDER BY sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE / sum(goal) OVER () AS low
  FROM targets WHERE goal > 0),
n_points AS (SELECT ((sum(goal) + any_value(slot_words) - 1) // any_value(slot_words))::BIGINT AS n FROM targets),
points AS (SELECT i, 0.5::DOUBLE + i * 0.6180339887498949::DOUBLE AS x FROM n_points, range(0, n_points.n) r(i)),
dealt AS (SELECT p.i, l.sid FROM (SELECT i, x - floor(x) AS at FROM points) p ASOF JOIN line l ON p.at >= l.low),
met AS (SELECT sid, count(*) AS met FROM dealt GROUP BY sid),
lacking AS (SELECT l.sid, coalesce(m.met, 0) AS met, unnest(range(coalesce(m.met, 0), (goal + slot_words - 1) // slot_words)) AS rank FROM line l LEFT JOIN met m ON m.sid = l.sid),
slots AS (
  SELECT i, sid, row_number() OVER (PARTITION BY sid ORDER BY i) - 1 AS rank FROM dealt
  UNION ALL SELECT n + (rank - met) * (SELECT count(*) FROM targets) + sid, sid, rank FROM lacking, n_points),
placed AS (
  SELECT d.doc_id, d.source, d.size, d.shuffle, t.sid, t.source_size, t.target, t.goal, t.slot_words,
         coalesce(sum(size) OVER (PARTITION BY t.sid ORDER BY shuffle, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM numbered d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
turns AS (
  SELECT *, start + t.n * source_size AS first, least(start + t.n * source_size + size, goal) AS last FROM placed, (SELECT unnest([0, 1, 2]) AS n) t
  WHERE size > 0 AND start + t.n * source_size < goal),
blocks AS (
  SELECT *, unnest(range(first // slot_words, (last - 1) // slot_words + 1)) AS block FROM turns),
taken AS (
  SELECT b.sid, b.shuffle, b.doc_id, min(s.i) AS first_slot, count(s.i) AS n_slots,
         sum(least(last, (block + 1) * slot_words) - greatest(first, block * slot_words)) AS taken
  FROM blocks b JOIN slots s ON s.sid = b.sid AND s.rank = b.block GROUP BY ALL)
SELECT p.doc_id, p.size, p.source_size, p.target, coalesce(k.taken, 0)::BIGINT AS taken, p.source,
       coalesce(k.first_slot, -1)::BIGINT AS first_slot, coalesce(k.n_slots, 0)::BIGINT AS n_slots
FROM placed p LEFT JOIN taken k ON k.sid = p.sid AND k.shuffle = p.shuffle AND k.doc_id IS NOT DISTINCT FROM p.doc_id
"""
}
