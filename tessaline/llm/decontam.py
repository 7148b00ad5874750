"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

The sets are the word shingles of benchmark windows and of documents. A document is read once: its shingles, exploded with
their positions, meet the benchmark's shingles, and only those that match (exact strings, not hashes) are written, with one
head row for each document. All later steps work on these. Shingles are ordered by rarity, counted over all documents; a
window needs all of its shingles, so the prefix that must be joined is its single rarest. Each match of it proposes one
window at one place, which must fit into the document (length and positional bounds), and is verified by the shingles at
the offsets that cover the whole window.

The benchmark's shingles are broadcast if there are at most `broadcast_limit`, and shuffled beyond.

Defined results: null and empty texts have no words and are never hit; an item without words has no window, one of fewer
than `window` words is one window; an item that stands in the benchmark twice counts once; repeated documents get a row
each; extra columns are ignored; an empty benchmark hits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, lower_ascii

#: Fixed value: runs of digits, a-z and anything beyond ASCII.
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), F.lit(ITEM_WORD), F.lit(0))


def _shingles(words: Column, n: Column, size: int) -> Column:
    """Space-joined runs of size words; none if there are fewer words."""
    heads = F.slice(words, F.lit(1), F.greatest(n - (size - 1), F.lit(0)))
    if size == 1:
        return heads
    return F.transform(heads, lambda w, i: F.concat_ws(" ", w, *[F.get(words, i + k) for k in range(1, size)]))


def windows_of(benchmark: DataFrame, id_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """(item, win, n, t, needs): each distinct window of each item, its words, shingle size and (offset, shingle) cover."""
    words = benchmark.select(F.col(id_col).cast("string").alias("item"), _words(F.col(text_col)).alias("words")).withColumn("total", F.size("words")).filter("total > 0")
    words = words.withColumn("n", F.least(F.lit(window), F.col("total")))
    starts = F.sequence(F.lit(0), F.col("total") - F.col("n"))
    wins = words.select("item", "n", F.explode(F.transform(starts, lambda s: F.slice(F.col("words"), s + 1, F.col("n")))).alias("w"))
    return wins.select("item", "n", F.array_join("w", " ").alias("win"), "w", F.least(F.lit(shingle), F.col("n")).alias("t")).dropDuplicates(["item", "win"])


def matches(docs: DataFrame, tokens: DataFrame, sizes: list[int], id_col: str, text_col: str, broadcast: bool) -> DataFrame:
    """(uid, doc_id, n_words, pos, t, token): a head row (pos -1, token '\\0' and the text's SHA-256) and each matching shingle."""
    base = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("doc_id"), F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"), 256).alias("key"), _words(F.col(text_col)).alias("words"))
    base = base.withColumn("n_words", F.size("words"))
    runs = [F.array(F.concat(F.lit("\0"), F.col("key"))), *[_shingles(F.col("words"), F.col("n_words"), t) for t in sizes]]
    rows = base.select("uid", "doc_id", "n_words", F.posexplode(F.concat(*runs)).alias("at", "token"))
    small = F.broadcast(tokens) if broadcast else tokens
    rows = rows.join(small.withColumnRenamed("token", "known"), rows["token"] == F.col("known"), "left").filter("known IS NOT NULL OR at = 0")
    # Where the shingles of each size begin in the exploded list, to get the word position back.
    pos, size, begin = F.lit(-1), F.lit(0), F.lit(1)
    for t in sizes:
        inside = F.col("at") >= begin
        pos, size = F.when(inside, F.col("at") - begin).otherwise(pos), F.when(inside, F.lit(t)).otherwise(size)
        begin = begin + F.greatest(F.col("n_words") - (t - 1), F.lit(0))
    return rows.select("uid", "doc_id", "n_words", pos.alias("pos"), size.alias("t"), "token")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = 13, shingle: int = 3, percent: int = 5, broadcast_limit: int = 64 << 20,
) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, n_items, items, contaminated) of each row of docs; text_key is the text's SHA-256."""
    wins = cut(windows_of(benchmark, item_col, item_text_col, window, shingle), "decontam-windows")
    distinct = wins.select("win", "n", "t", "w").dropDuplicates(["win"])
    parts = F.transform(F.sequence(F.lit(0), F.col("n") - F.col("t")), lambda s: F.struct(s.alias("offset"), F.array_join(F.slice(F.col("w"), s + 1, F.col("t")), " ").alias("token")))
    needs = cut(distinct.select("win", "n", "t", F.explode(parts).alias("p")).select("win", "n", "t", "p.offset", "p.token"), "decontam-needs")
    tokens = needs.select("token").distinct()
    sizes = sorted(r[0] for r in needs.select("t").distinct().collect())  # at most `shingle` values
    few = (tokens.agg(F.sum(F.octet_length("token") + 64)).first()[0] or 0) <= broadcast_limit  # bytes, with what a row of a hash table has besides
    found = cut(matches(docs, tokens, sizes, id_col, text_col, few), "decontam-matches")
    heads = found.filter("pos < 0").select("uid", "doc_id", "n_words", F.substring("token", 2, 64).alias("text_key"))
    hits = found.filter("pos >= 0").select("uid", "n_words", "pos", "t", "token")

    # The rarest shingle of each window; one that no document has rules its windows out.
    rarity = hits.groupBy("token", "t").agg(F.count("*").alias("seen"))
    ranked = needs.join(rarity, ["token", "t"], "left").groupBy("win", "n", "t").agg(F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), F.col("token"), F.col("offset"))).alias("first"))
    prefix = ranked.filter("first.seen > 0").select("win", "n", "t", F.col("first.token").alias("token"), F.col("first.offset").alias("offset"))
    proposed = hits.join(prefix, ["token", "t"]).select("uid", "win", "n", "t", (F.col("pos") - F.col("offset")).alias("start"), "n_words")
    proposed = proposed.filter("start >= 0 AND start + n <= n_words").select("uid", "win", "n", "t", "start")
    # Offsets 0, t, 2t ... and the last cover every word of the window.
    cover = needs.filter("offset % t = 0 OR offset = n - t").select("win", "offset", F.col("token").alias("need"))
    size = cover.groupBy("win").agg(F.count("*").alias("wanted"))
    asked = proposed.join(cover, "win").select("uid", "win", "n", "start", (F.col("start") + F.col("offset")).alias("pos"), "t", F.col("need").alias("token"))
    held = asked.join(hits.drop("n_words"), ["uid", "pos", "t", "token"]).groupBy("uid", "win", "n", "start").agg(F.count("*").alias("got"))
    occurs = cut(held.join(size, "win").filter("got = wanted").select("uid", "win", "n", "start"), "decontam-occurrences")

    # Covered words: intervals by start, each counted from where those before it end.
    order = W.partitionBy("uid").orderBy("start", "n")
    spans = occurs.select("uid", "start", (F.col("start") + F.col("n")).alias("stop")).distinct().withColumn("n", F.col("stop") - F.col("start"))
    reached = F.coalesce(F.max("stop").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    covered = spans.withColumn("reached", reached).groupBy("uid").agg(F.sum(F.greatest(F.lit(0), F.col("stop") - F.greatest("start", "reached"))).alias("n_hit"))
    items = occurs.select("uid", "win").distinct().join(wins.select("win", "item"), "win").groupBy("uid").agg(F.array_sort(F.collect_set(F.coalesce("item", F.lit("")))).alias("items"))
    out = heads.join(covered, "uid", "left").join(items, "uid", "left")
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("bigint")
    listed = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    return out.select("doc_id", "text_key", F.col("n_words").cast("bigint").alias("n_words"), n_hit.alias("n_hit"), F.size(listed).cast("bigint").alias("n_items"), listed.alias("items"), ((n_hit > 0) & (n_hit * 100 >= F.col("n_words") * percent)).alias("contaminated"))


#: The contract's result in SQL. Windows are compared as space-joined words.
ORACLE = r"""
WITH dw AS (SELECT doc_id, row_number() OVER () AS uid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bx AS (SELECT item_id, least(13, len(w)) AS n, unnest([array_to_string(w[s:s + least(13, len(w)) - 1], ' ') for s in range(1, len(w) - least(13, len(w)) + 2)]) AS win FROM bw WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bx),
dx AS (SELECT uid, n, s, array_to_string(w[s:s + n - 1], ' ') AS win FROM (SELECT uid, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM dw, sizes WHERE len(w) >= n)),
hit AS (SELECT dx.uid, dx.n, dx.s, bx.item_id FROM dx JOIN bx ON dx.win = bx.win AND dx.n = bx.n),
pos AS (SELECT uid, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT uid, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT uid, n, s FROM hit)) GROUP BY uid),
it AS (SELECT uid, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (SELECT DISTINCT uid, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY uid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN pos USING (uid) LEFT JOIN it USING (uid)
"""
