"""Secret scans by corpus-wide ownership frequency. DataFrame functions only.

Patterns find candidates; the hash of each candidate's value is counted over the whole corpus by distinct repositories and
owners. A value that ``WIDE`` or more owners hold, or ``SPREAD`` or more repositories, is a widely copied example, also if
one owner alone has spread it. Any other value that looks generated (``DISTINCT`` different characters or more, a digit
among them) is a live-looking credential of its owner.

In ``documents`` a text of an owner stands for a repository and ``source`` for the owner. A null text is an empty one; a
null source is an owner of its own. Equal rows have equal spans; copies of a text at one owner count as one repository. An
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placemetrics.llm.common import stored, table, text_or_empty

# Fixed values of the contract: kinds in listed order, pattern, the group that holds the value, least length of the value.
KINDS = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
LIVE = "live"
#: Owners, and repositories, from which on a value is a widely copied example; different characters of a generated value.
WIDE, SPREAD, DISTINCT = 3, 20, 8
#: Matches whose places are summed up at a time.
STRIDE = 512

_HIT = "array<struct<start:int,kind:int,end:int,value_start:int,value:string>>"


def _places(text: Column, number: int, pattern: str, group: int, least: int) -> Column:
    """Every match of one kind with its place in code points: the pieces between matches give the distances."""
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    rows = F.transform(F.arrays_zip(F.slice(pieces, 1, F.size(found)).alias("gap"), found.alias("match"), values.alias("value")), lambda x: F.struct(
        F.length(x["gap"]).alias("gap"), F.length(x["match"]).alias("length"), x["value"].alias("value")))

    def step(acc: Column, x: Column) -> Column:
        start, n = acc["at"] + x["gap"], F.length(x["value"])
        hit = F.struct(start.alias("start"), F.lit(number).alias("kind"), (start + x["length"]).alias("end"), (start + x["length"] - n).alias("value_start"), x["value"].alias("value"))
        kept = F.when(n >= least, F.array_append(acc["hits"], hit)).otherwise(acc["hits"])
        return F.struct((start + x["length"]).alias("at"), kept.alias("hits"))

    def block(acc: Column, i: Column) -> Column:
        start = F.struct(acc["at"].alias("at"), F.array().cast(_HIT).alias("hits"))
        part = F.aggregate(F.slice(acc["rows"], i * STRIDE + 1, F.lit(STRIDE)), start, step)
        return F.struct(acc["rows"].alias("rows"), part["at"].alias("at"), F.concat(acc["hits"], part["hits"]).alias("hits"))

    zero = F.struct(rows.alias("rows"), F.lit(0).alias("at"), F.array().cast(_HIT).alias("hits"))
    blocks = F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / STRIDE).cast("int"))
    return F.when(text.rlike(pattern), F.aggregate(blocks, zero, block)["hits"]).otherwise(F.array().cast(_HIT))


def candidates(df: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source") -> DataFrame:
    """doc_id, owner, two hashes that name the row, and its hits in order of start and kind."""
    body = F.col("__text")
    rows = df.select(F.col(key).alias("doc_id"), F.col(owner).alias("owner"), text_or_empty(text).alias("__text"))
    hits = F.concat(*(_places(body, i, p, g, n) for i, (_, p, g, n) in enumerate(KINDS)))
    return rows.select("doc_id", "owner", F.xxhash64("doc_id", "owner").alias("row"), F.xxhash64("__text").alias("content"), F.array_sort(hits).alias("hits"))


def ownership(hits: DataFrame) -> DataFrame:
    """value_hash, n_repositories, n_owners over all rows of (value_hash, owner, content)."""
    each = hits.groupBy("value_hash", "owner", "content").agg(F.lit(1).alias("one"))
    by_owner = each.groupBy("value_hash", "owner").agg(F.count("*").alias("n_repositories"))
    return by_owner.groupBy("value_hash").agg(F.sum("n_repositories").alias("n_repositories"), F.count("*").alias("n_owners"))


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source") -> DataFrame:
    """One row a document: doc_id, row, content, hits, live (places of live-looking values), n_examples (hits that are widely copied)."""
    base = stored(candidates(df, key, text, owner), "secret-candidates")
    hit = base.filter(F.size("hits") > 0).select("doc_id", "owner", "row", "content", F.explode("hits").alias("hit"))
    value = F.col("hit.value")
    hit = hit.withColumns({"value_hash": F.sha2(value, 256), "generated": (F.size(F.array_distinct(F.split(value, ""))) >= DISTINCT) & value.rlike("[0-9]")})
    wide = (F.col("n_owners") >= WIDE) | (F.col("n_repositories") >= SPREAD)
    judged = hit.join(ownership(hit), "value_hash").withColumns({"wide": wide, "live": ~wide & F.col("generated")})
    place = F.struct(F.col("hit.value_start").alias("start"), (F.col("hit.value_start") + F.length(value)).alias("end"))
    each = judged.groupBy("row", "content", "hit.start", "hit.kind").agg(F.max(F.when(F.col("live"), place)).alias("place"), F.max("wide").alias("wide"))
    per = each.groupBy("row", "content").agg(F.array_sort(F.collect_set("place")).alias("live"), F.count_if("wide").alias("n_examples"))
    none = base.filter(F.size("hits") == 0).select("doc_id", "row", "content", "hits", F.array().cast("array<struct<start:int,end:int>>").alias("live"), F.lit(0).cast("long").alias("n_examples"))
    return base.filter(F.size("hits") > 0).join(per, ["row", "content"], "left").select("doc_id", "row", "content", "hits", "live", "n_examples").unionByName(none)


def _joined(spans: Column, names: tuple[str, ...]) -> Column:
    kinds = F.array(*(F.lit(n) for n in names))
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kinds, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))))


def redact(text: Column, places: Column, mark: str = "<secret>") -> Column:
    """The text with the given places, in order, replaced; a place inside an earlier one is covered by it."""
    def step(acc: Column, x: Column) -> Column:
        start = F.greatest(acc["at"], x["start"])
        gap = F.substring(text, acc["at"] + 1, start - acc["at"])
        fresh = x["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.when(fresh, F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(places, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    return F.when(F.size(places) > 0, F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))).otherwise(text)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    names = (*(k[0] for k in KINDS), LIVE)
    base = F.transform("hits", lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    live = F.transform("live", lambda x: F.struct(x["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), x["end"].alias("end")))
    of_kind = [F.expr(f"size(filter(hits, x -> x.kind = {i}))") for i in range(len(KINDS))]
    counts = [n.cast("long").alias(f"n_{k[0]}") for n, k in zip(of_kind, KINDS, strict=True)]
    return found.select("doc_id", *counts, F.sha2(_joined(base, names), 256).alias("base_sha256"), _joined(F.array_sort(F.concat(base, live)), names).alias("spans"))


QUERIES = {"op10_secret_scan": op10_secret_scan}


def _hits_sql(number: int, pattern: str, group: int, least: int) -> str:
    """Matches of one kind: what stands between matches gives their places."""
    quoted = pattern.replace("'", "''")
    return f"""SELECT row, {number} AS kind, begins + length(match) AS stop, begins AS start, value FROM (
    SELECT row, match, value, (sum(length(gap)) OVER w + coalesce(sum(length(match)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS begins
    FROM (SELECT row, unnest(regexp_extract_all(body, '{quoted}')) AS match, unnest(regexp_extract_all(body, '{quoted}', {group})) AS value,
                 unnest(string_split_regex(body, '{quoted}')) AS gap, generate_subscripts(string_split_regex(body, '{quoted}'), 1) AS nth
          FROM d WHERE regexp_matches(body, '{quoted}'))
    WINDOW w AS (PARTITION BY row ORDER BY nth)) WHERE length(value) >= {least}"""


SQL = {
    "op10_secret_scan": f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS body FROM documents),
hits AS ({" UNION ALL ".join(_hits_sql(i, p, g, n) for i, (_, p, g, n) in enumerate(KINDS))}),
spread AS (
  SELECT value, count(DISTINCT coalesce('=' || source, '')) AS owners, count(DISTINCT coalesce('=' || source, '') || chr(1) || body) AS repositories
  FROM hits JOIN d USING (row) GROUP BY value),
live AS (
  SELECT row, {len(KINDS)} AS kind, stop, stop - length(value) AS start FROM hits JOIN spread USING (value)
  WHERE owners < {WIDE} AND repositories < {SPREAD} AND len(list_distinct(string_split(value, ''))) >= {DISTINCT} AND regexp_matches(value, '[0-9]')),
spans AS (
  SELECT row, kind, start, stop, {"CASE kind " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate((*(k[0] for k in KINDS), LIVE))) + " END"} || ':' || start || ':' || stop AS span
  FROM (SELECT row, kind, start, stop FROM hits UNION SELECT row, kind, start, stop FROM live)),
per AS (
  SELECT row, {", ".join(f"count(*) FILTER (kind = {i}) AS n_{k[0]}" for i, k in enumerate(KINDS))},
         string_agg(span, ',' ORDER BY start, kind) FILTER (kind < {len(KINDS)}) AS base, string_agg(span, ',' ORDER BY start, kind, stop) AS spans
  FROM spans GROUP BY row)
SELECT doc_id, {", ".join(f"coalesce(n_{k[0]}, 0)::BIGINT AS n_{k[0]}" for k in KINDS)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (row)
"""
}
