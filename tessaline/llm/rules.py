"""Quality rules by distribution divergence, in DataFrame operations only.

Each text is reduced to two histograms: of character classes, and of its language's common words. Each is compared with
the language's reference by Jensen-Shannon distance (base 2, 0 to 1). References are sums over all documents of a
language, made by partial aggregation: shares of the character classes, and shares of the `top_words` most frequent words.
A distance is too large beyond a constant plus a term that falls with the square root of the words, as the distance made
by chance does. Texts shorter than `min_words` words (for common words: with fewer than `min_common` of them expected) are
not judged by distance, as a short histogram is noise. Base rules come first: too few words, or too large a share of words inside
five-word windows that occur again.

Defined results: null and empty texts have zero counts and fail the base rules; a null language is a language of its own;
a language whose texts have no words judges none; repeated rows get a row each; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, cut

#: The character classes in the order in which they are stripped from a text, as patterns.
CLASSES = {
    "lower": "[a-z]+", "space": r"[\x20\x09-\x0D]+", "beyond": r"[^\x00-\x7F]+", "upper": "[A-Z]+", "symbol": "[#*$%&|<>]+", "digit": "[0-9]+",
}
NAMES = (*CLASSES, "other")


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def class_counts(df: DataFrame) -> DataFrame:
    """Add n_<class> (code points) to rows with text: each class is stripped from what those before it left."""
    rest = F.col("text")
    df = df.withColumn("left_0", F.char_length(rest)).withColumn("rest", rest)
    for i, (name, pattern) in enumerate(CLASSES.items()):
        df = df.withColumn("rest", F.regexp_replace("rest", pattern, "")).withColumn(f"left_{i + 1}", F.char_length("rest"))
        df = df.withColumn(f"n_{name}", (F.col(f"left_{i}") - F.col(f"left_{i + 1}")).cast("bigint"))
    last = f"left_{len(CLASSES)}"
    return df.withColumn("n_other", F.col(last).cast("bigint")).drop("rest", *[f"left_{i}" for i in range(len(CLASSES) + 1)])


def with_window_hashes(df: DataFrame, words: str, n: str, out: str, width: int = 5) -> DataFrame:
    """Add out: hashes of all windows of width words. Windows double and grow by zipping an array with itself, shifted."""
    pair = lambda x, y: F.xxhash64(x, y)
    df = df.withColumn("__one", F.transform(words, lambda w: F.xxhash64(w))).withColumn(out, F.col("__one"))
    size = 1
    for bit in bin(width)[3:]:
        df = df.withColumn(out, F.zip_with(out, F.slice(out, F.lit(size + 1), F.greatest(F.col(n), F.lit(0))), pair))
        size *= 2
        if bit == "1":
            df = df.withColumn(out, F.zip_with(out, F.slice("__one", F.lit(size + 1), F.greatest(F.col(n), F.lit(0))), pair))
            size += 1
    # What was zipped with nothing at the end is no window.
    return df.withColumn(out, F.slice(out, F.lit(1), F.greatest(F.col(n) - (width - 1), F.lit(0)))).drop("__one")


def covered_by_repeats(hashes: Column, width: int = 5) -> Column:
    """Sort (hash, place); those with an equal neighbour repeat; count the words their windows cover."""
    ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def marked(pairs: Column) -> Column:
        places = F.array_sort(F.transform(F.filter(pairs, lambda e, i: F.coalesce(F.when(i > 0, e["h"] == F.get(pairs, i - 1)["h"]), F.lit(False)) | F.coalesce(e["h"] == F.get(pairs, i + 1)["h"], F.lit(False))), lambda e: e["i"]))
        start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("end"))
        return F.aggregate(places, start, lambda a, p: F.struct((a["total"] + p + width - F.greatest(p, a["end"])).alias("total"), (p + width).alias("end")), lambda a: a["total"])

    # transform over a one-element array binds the sorted array once.
    once = F.get(F.transform(F.array(ordered), marked), F.lit(0))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), once).otherwise(F.lit(0)).cast("bigint")


def common_words(docs: DataFrame, top_words: int) -> DataFrame:
    """(lang, ref_words, ref_shares, common_share): one row for each language with words, from all of docs (lang, text)."""
    counted = cut(docs.select("lang", F.explode(_words(F.col("text"))).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n")), "rules-words")
    all_words = counted.groupBy("lang").agg(F.sum("n").alias("all_words"))
    # The most frequent of each language without ordering all of its words in one task: first within spread parts.
    spread = W.partitionBy("lang", "part").orderBy(F.desc("n"), "word")
    some = counted.withColumn("part", F.pmod(F.xxhash64("word"), F.lit(64))).withColumn("r", F.row_number().over(spread)).filter(F.col("r") <= top_words)
    best = some.withColumn("r", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "word"))).filter(F.col("r") <= top_words)
    listed = best.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("r", "word", "n"))).alias("top"), F.sum("n").alias("common"))
    words = listed.join(all_words, listed["lang"].eqNullSafe(all_words["lang"])).select(
        listed["lang"].alias("lang"), F.transform("top", lambda e: e["word"]).alias("ref_words"),
        F.transform("top", lambda e: e["n"] / F.col("common")).alias("ref_shares"), (F.col("common") / F.col("all_words")).alias("common_share"))
    return cut(words, "rules-common")


def class_shares(counted: DataFrame) -> DataFrame:
    """(lang, ref_classes): each language's shares of the character classes, from the counts of all its documents."""
    classes = counted.groupBy("lang").agg(*[F.sum(f"n_{n}").alias(n) for n in NAMES])
    total = sum((F.col(n) for n in NAMES[1:]), F.col(NAMES[0]))
    return cut(classes.select("lang", F.array(*[F.coalesce(F.try_divide(F.col(n).cast("double"), total.cast("double")), F.lit(0.0)) for n in NAMES]).alias("ref_classes")), "rules-classes")


def distance(p: list[Column], q: list[Column]) -> Column:
    """Jensen-Shannon distance of two histograms that sum to 1."""
    term = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    halves = [term(a, (a + b) / 2) + term(b, (a + b) / 2) for a, b in zip(p, q, strict=True)]
    total = halves[0]
    for h in halves[1:]:
        total = total + h
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", top_words: int = 16, min_words: int = 50, min_common: int = 20,
    max_class_distance: float = 0.16, max_word_distance: float = 0.25, class_noise: float = 1.0, word_noise: float = 0.6, broadcast_limit: int = 10_000,
) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, class_distance, word_distance, kept)."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    small = lambda refs: F.broadcast(refs) if refs.count() <= broadcast_limit else refs
    words = small(common_words(base.select("lang", "text"), top_words))
    rows = class_counts(base).withColumn("words", _words(F.col("text"))).withColumn("n_words", F.size("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    rows = with_window_hashes(rows.withColumn("lines", lines), "words", "n_words", "hashes")
    rows = rows.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint")).withColumn("n_repeat_words", covered_by_repeats(F.col("hashes")))
    own = words.select(F.col("lang").alias("ref_lang"), "ref_words")
    rows = rows.join(own, F.col("lang").eqNullSafe(F.col("ref_lang")), "left")
    rows = rows.withColumn("common", F.filter("words", lambda w: F.array_contains(F.col("ref_words"), w)))
    rows = rows.withColumn("counts", F.transform("ref_words", lambda r: F.size(F.filter(F.col("common"), lambda w: w == r))))
    n_chars = sum((F.col(f"n_{n}") for n in NAMES[1:]), F.col(f"n_{NAMES[0]}"))
    # Texts are read here once; what follows works on these narrow rows.
    slim = cut(rows.select("doc_id", "lang", "n_words", n_chars.alias("n_chars"), *[F.col(f"n_{n}") for n in NAMES], "n_dup_lines", "n_repeat_words", "counts", F.coalesce(F.size("common"), F.lit(0)).alias("n_common")), "rules-counts")
    classes = small(class_shares(slim))
    slim = slim.join(classes.select(F.col("lang").alias("class_lang"), "ref_classes"), F.col("lang").eqNullSafe(F.col("class_lang")), "left")
    slim = slim.join(words.select(F.col("lang").alias("word_lang"), "ref_shares", "common_share"), F.col("lang").eqNullSafe(F.col("word_lang")), "left")
    share = lambda c, n: F.coalesce(F.try_divide(c.cast("double"), n.cast("double")), F.lit(0.0))
    by_class = distance([share(F.col(f"n_{n}"), F.col("n_chars")) for n in NAMES], [F.get("ref_classes", F.lit(i)) for i in range(len(NAMES))])
    # A histogram of common words, and of how much of the text they are, against the reference's.
    rate = share(F.col("n_common"), F.col("n_words"))
    p = [F.coalesce(share(F.get("counts", F.lit(i)), F.col("n_words")), F.lit(0.0)) for i in range(top_words)] + [1 - rate]
    q = [F.coalesce(F.get("ref_shares", F.lit(i)), F.lit(0.0)) * F.col("common_share") for i in range(top_words)] + [1 - F.col("common_share")]
    slim = slim.withColumn("class_distance", by_class).withColumn("word_distance", distance(p, q))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    # The distance that chance alone makes falls with the square root of the length.
    noise = 1 / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)).cast("double"))
    far_classes = F.col("class_distance") > max_class_distance + class_noise * noise
    far_words = (F.col("n_words") * F.col("common_share") >= min_common) & (F.col("word_distance") > max_word_distance + word_noise * noise)
    odd = (F.col("n_words") >= min_words) & (far_classes | far_words)
    return slim.select(
        "doc_id", F.col("n_words").cast("bigint").alias("n_words"), (F.col("n_chars") - F.col("n_space")).alias("word_chars"), F.col("n_symbol").alias("n_symbols"), "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), "class_distance", "word_distance", (~failed & ~F.coalesce(odd, F.lit(False))).alias("kept"))


#: The contract's columns in SQL, for the default parameters.
ORACLE = r"""
WITH w AS (SELECT row_number() OVER () AS uid, doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
a AS (SELECT uid, doc_id, lang, t, ws, len(ws) AS n_words, length(t) AS n, length(regexp_replace(t, '[^a-z]', '', 'g')) AS c1, length(regexp_replace(t, '[^\x20\x09-\x0D]', '', 'g')) AS c2,
  length(regexp_replace(t, '[\x00-\x7F]', '', 'g')) AS c3, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS c4, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS c5, length(regexp_replace(t, '[^0-9]', '', 'g')) AS c6 FROM w),
b AS (SELECT *, n - c1 - c2 - c3 - c4 - c5 - c6 AS c7 FROM a),
r AS (SELECT lang, [sum(c1), sum(c2), sum(c3), sum(c4), sum(c5), sum(c6), sum(c7)] AS c, CAST(sum(n) AS DOUBLE) AS n FROM b GROUP BY lang),
k AS (SELECT b.uid, CASE WHEN b.n > 0 THEN [b.c1, b.c2, b.c3, b.c4, b.c5, b.c6, b.c7][i] / CAST(b.n AS DOUBLE) ELSE 0 END AS p, CASE WHEN r.n > 0 THEN r.c[i] / r.n ELSE 0 END AS q
  FROM b JOIN r ON b.lang IS NOT DISTINCT FROM r.lang, range(1, 8) AS g(i)),
kd AS (SELECT uid, sqrt(greatest(sum((CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END) + (CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END)) / 2, 0)) AS dist FROM k GROUP BY uid),
tok AS (SELECT uid, lang, unnest(ws) AS word FROM w),
cnt AS (SELECT lang, word, count(*) AS m FROM tok GROUP BY lang, word),
top AS (SELECT lang, word, m, CAST(total AS DOUBLE) AS total FROM (SELECT *, sum(m) OVER (PARTITION BY lang) AS total, row_number() OVER (PARTITION BY lang ORDER BY m DESC, word) AS rn FROM cnt) WHERE rn <= 16),
own AS (SELECT uid, word, count(*) AS m FROM tok GROUP BY uid, word),
pq AS (SELECT b.uid, CASE WHEN b.n_words > 0 THEN coalesce(own.m, 0) / CAST(b.n_words AS DOUBLE) ELSE 0 END AS p, top.m / top.total AS q FROM b JOIN top ON b.lang IS NOT DISTINCT FROM top.lang LEFT JOIN own ON own.uid = b.uid AND own.word = top.word),
pr AS (SELECT uid, p, q FROM pq UNION ALL SELECT uid, 1 - sum(p), 1 - sum(q) FROM pq GROUP BY uid),
wd AS (SELECT uid, sqrt(greatest(sum((CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END) + (CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END)) / 2, 0)) AS dist FROM pr GROUP BY uid),
cs AS (SELECT uid, sum(q) AS common_share FROM pq GROUP BY uid),
win AS (SELECT uid, i, array_to_string(ws[i:i + 4], chr(1)) AS x FROM (SELECT uid, ws, unnest(range(1, n_words - 3)) AS i FROM b WHERE n_words >= 5)),
rep AS (SELECT uid, count(DISTINCT p) AS n_repeat FROM (SELECT uid, unnest(range(i, i + 5)) AS p FROM (SELECT *, count(*) OVER (PARTITION BY uid, x) AS times FROM win) WHERE times > 1) GROUP BY uid),
ln AS (SELECT uid, count(*) - count(DISTINCT line) AS n_dup FROM (SELECT uid, unnest(string_split(t, chr(10))) AS line FROM b) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY uid),
f AS (SELECT b.*, coalesce(rep.n_repeat, 0) AS n_repeat, coalesce(ln.n_dup, 0) AS n_dup, kd.dist AS class_distance, wd.dist AS word_distance, cs.common_share, b.n_words < 10 OR 100 * coalesce(rep.n_repeat, 0) > 20 * b.n_words AS failed
  FROM b LEFT JOIN rep USING (uid) LEFT JOIN ln USING (uid) LEFT JOIN kd USING (uid) LEFT JOIN wd USING (uid) LEFT JOIN cs USING (uid))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n - c2 AS BIGINT) AS word_chars, CAST(c5 AS BIGINT) AS n_symbols, CAST(n_dup AS BIGINT) AS n_dup_lines, CAST(n_repeat AS BIGINT) AS n_repeat_words, failed AS base_failed,
  NOT failed AND NOT coalesce(n_words >= 50 AND (class_distance > 0.16 + 1.0 / sqrt(n_words) OR (n_words * common_share >= 20 AND word_distance > 0.25 + 0.6 / sqrt(n_words))), false) AS kept
FROM f
"""
