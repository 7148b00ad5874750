"""Keyed de-duplication, unions with priority, running groups, batches and other building blocks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.store import cut_here


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in order. Minima of structs: one partial aggregate, no sort of a group."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*order, *rest), F.struct(*order)).alias("__best"))
    return best.select(*[f"__best.{c}" if c not in keys else c for c in df.columns])


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*order, *rest), F.struct(*order)).alias("__best"))
    return best.select(*[f"__best.{c}" if c not in keys else c for c in df.columns])


def best_of(df: DataFrame, keys: Sequence[str], value: str, tie: str) -> DataFrame:
    """The row with the largest value of each key; of equal ones that with the smallest tie."""
    rest = [c for c in df.columns if c not in keys and c not in (value, tie)]
    # Smallest tie among the largest values: the order of (value, tie) with the tie turned round by two partial aggregates.
    top = df.groupBy(*keys).agg(F.max(value).alias("__top")).select(*[F.col(k).alias(f"__{k}") for k in keys], "__top")
    on = F.col(value).eqNullSafe(F.col("__top"))
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    held = df.join(top, on).select(*keys, value, tie, *rest)
    return first_wins(held, keys, [tie]).select(*df.columns)


def union_distinct(key: str, *frames: DataFrame) -> DataFrame:
    """Rows of all frames, one for each key: of the earliest frame that has it."""
    return ordered_union(key, None, *frames).drop("prio")


def ordered_union(key: str, order: str | None, *frames: DataFrame) -> DataFrame:
    """Like union_distinct, with prio, the number of the frame; within a frame the first by order."""
    out = None
    for n, frame in enumerate(frames):
        part = frame.withColumn("prio", F.lit(n))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return first_wins(out, [key], ["prio", *([order] if order else [c for c in out.columns if c not in (key, "prio")])])


def difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.join(b.select(F.col(key).alias("__b")).distinct(), F.col(key) == F.col("__b"), "left_anti")


def intersection(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.join(b.select(F.col(key).alias("__b")).distinct(), F.col(key) == F.col("__b"), "left_semi")


def lines_of(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, ord, line): one row for each line."""
    return df.select(key, F.posexplode(F.split(text, "\n")).alias("ord", "line"))


def running_value(df: DataFrame, key: str, order: str, value: Column, name: str) -> DataFrame:
    """The last value that is not null up to each row, within key."""
    return df.withColumn(name, F.last(value, ignorenulls=True).over(W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, 0)))


def section_numbers(df: DataFrame, key: str, order: str, starts: Column) -> DataFrame:
    """section: how many rows up to each one start a section (0: before the first)."""
    return df.withColumn("section", F.sum(F.when(starts, 1).otherwise(0)).over(W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, 0)))


def pending_value(df: DataFrame, key: str, order: str, value: Column, name: str) -> DataFrame:
    """The next value that is not null from each row on: labels attach to the heading that follows."""
    return df.withColumn(name, F.first(value, ignorenulls=True).over(W.partitionBy(key).orderBy(order).rowsBetween(0, W.unboundedFollowing)))


def paired(df: DataFrame, key: str, order: str, is_term: Column, value: str) -> DataFrame:
    """Terms with the row that follows them, if that is no term."""
    w = W.partitionBy(key).orderBy(order)
    return df.withColumn("__term", is_term).withColumn("definition", F.when(~F.lead("__term", 1, True).over(w), F.lead(value).over(w))).filter("__term").drop("__term")


def toggled(df: DataFrame, key: str, order: str, is_mark: Column, name: str = "inside") -> DataFrame:
    """Whether an odd number of marks stands up to each row (fences)."""
    return df.withColumn(name, F.sum(F.when(is_mark, 1).otherwise(0)).over(W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, 0)) % 2 == 1)


def without_repeated(df: DataFrame, key: str, order: str, blank: Column) -> DataFrame:
    """Of runs of rows that are blank, the first."""
    w = W.partitionBy(key).orderBy(order)
    return df.withColumn("__blank", blank).withColumn("__before", F.lag("__blank", 1, False).over(w)).filter("NOT (__blank AND __before)").drop("__blank", "__before")


def levels_by_appearance(df: DataFrame, key: str, order: str, mark: str) -> DataFrame:
    """level: the rank of each mark by where it first appears."""
    first = df.groupBy(key, mark).agg(F.min(order).alias("__first"))
    ranked = first.withColumn("level", F.row_number().over(W.partitionBy(key).orderBy("__first"))).select(F.col(key).alias("__k"), F.col(mark).alias("__m"), "level")
    return df.join(ranked, (F.col(key) == F.col("__k")) & F.col(mark).eqNullSafe(F.col("__m"))).drop("__k", "__m")


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], value: Column, out: str) -> DataFrame:
    """out: the sum of value over the rows of the same keys up to each one in order, for groups of any size.

    Rows are dealt by ranges of (keys, order), so a large group lies in many partitions. Each sums up its own rows, and to that
    comes what the partitions before have of the group: a row for each partition and group that it holds. Rows that are equal
    in keys and order come in any order, always the same within a run.
    """
    rest = [F.col(c).asc_nulls_first() for c in keys] + [F.col(c) if isinstance(c, str) else c for c in order] + [F.col("__spread")]
    dealt = df.withColumn("__value", value).withColumn("__spread", F.monotonically_increasing_id()).repartitionByRange(*rest)
    rows = cut_here(dealt.withColumn("__part", F.spark_partition_id()))
    inside = rows.withColumn("__inside", F.sum("__value").over(W.partitionBy("__part", *keys).orderBy(*rest[len(keys) :]).rowsBetween(W.unboundedPreceding, 0)))
    parts = rows.groupBy("__part", *keys).agg(F.sum("__value").alias("__sum"))
    before = F.sum("__sum").over((W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))).orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    parts = parts.select(F.col("__part").alias("__at"), *[F.col(k).alias(f"__k{n}") for n, k in enumerate(keys)], F.coalesce(before, F.lit(0)).alias("__before"))
    same = F.col("__part") == F.col("__at")
    for n, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{n}"))
    return inside.join(parts, same).withColumn(out, F.col("__before") + F.col("__inside")).select(*[c for c in df.columns if c != out], out)


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], out: str = "number") -> DataFrame:
    """out: the place of each row among those of the same keys in order, from 1, for groups of any size."""
    return running_total(df, keys, order, F.lit(1).cast("bigint"), out)


def batches(df: DataFrame, key: str | None, order: str, size: int) -> DataFrame:
    """batch: rows in runs of size within key (within all, if it is None)."""
    return numbered(df, [key] if key else [], [F.col(order).asc_nulls_first()], "batch").withColumn("batch", F.floor((F.col("batch") - 1) / size).cast("bigint"))


def decollided(df: DataFrame, group: str, name: str, order: str, out: str = "unique_name") -> DataFrame:
    """Names made unique within group: the first keeps its name, further ones get -2, -3 and so on.

    A made name may be somebody's own; numbers that are taken so are passed over, however many they are. Groups of any size.
    """
    now = numbered(df, [group, name], [F.col(order).asc_nulls_first()], "__try")
    # Numbers taken of each base; a null base makes names of a number alone.
    number = r"[1-9][0-9]{0,17}"
    own, plain = rf"(?s)\A(.*)-({number})\z", rf"\A({number})\z"
    base = F.when(F.rlike(name, F.lit(own)), F.regexp_extract(name, own, 1))
    value = F.when(F.rlike(name, F.lit(own)), F.regexp_extract(name, own, 2)).when(F.rlike(name, F.lit(plain)), F.col(name)).cast("bigint")
    taken = df.select(group, base.alias(name), value.alias("__taken_number")).filter("__taken_number >= 2").distinct()
    # Free numbers below each taken one, and before each row's: the rows that follow a taken number go one further for it.
    taken = numbered(taken, [group, name], ["__taken_number"], "__k")
    both = now.withColumn("__free", (F.col("__try") - 2).cast("bigint")).withColumn("__taken", F.lit(0).cast("bigint")).unionByName(
        taken.select(group, name, (F.col("__taken_number") - 1 - F.col("__k")).alias("__free"), F.lit(1).cast("bigint").alias("__taken")), allowMissingColumns=True)
    passed = running_total(both, [group, name], ["__free", F.desc("__taken")], F.col("__taken"), "__passed")
    made = F.when(F.col("__try") == 1, F.col(name)).otherwise(F.concat_ws("-", name, (F.col("__try") + F.col("__passed")).cast("string")))
    return passed.filter("__taken = 0").withColumn(out, made).select(*df.columns, out)


def ranked_by(value: Column | str, ranking: Sequence[str]) -> Column:
    """Place of value in ranking from 1; all others after it."""
    c = F.col(value) if isinstance(value, str) else value
    place = F.array_position(F.array(*[F.lit(r) for r in ranking]), c)
    return F.when(place > 0, place).otherwise(F.lit(len(ranking) + 1))


def folded_order(*columns: str) -> list[Column]:
    """An order without regard to case; names that differ in case alone in their own order."""
    return [F.lower(c) for c in columns] + [F.col(c) for c in columns]


def limited(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """The first n rows in order: each task keeps n of its own, one task merges those."""
    return df.orderBy(*order).limit(n)


def seen_values(df: DataFrame, key: str, value: str, order: str, out: str = "values") -> DataFrame:
    """(key, out): the distinct values of each key in the order in which they first came. Repeats go before groups meet."""
    first = df.groupBy(key, value).agg(F.min(order).alias("__first"))
    return first.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("__first", value))), lambda e: e[value]).alias(out))


def search(df: DataFrame, column: str, query: str, order: Sequence[Column], limit: int = 20) -> DataFrame:
    """The first rows, in order, whose column contains query in any case."""
    return df.filter(F.contains(F.lower(column), F.lit(query.lower()))).orderBy(*order).limit(limit)


def shown(items: Column, n: int = 20) -> Column:
    """The first n of a list, and how many more there are."""
    return F.concat(F.slice(items, 1, n), F.when(F.size(items) > n, F.array(F.concat(F.lit("... and "), (F.size(items) - n).cast("string"), F.lit(" more")))).otherwise(F.array().cast("array<string>")))


def expand_ranges(df: DataFrame, token: str, out: str = "number") -> DataFrame:
    """Tokens `3-7` or `4` as numbers; others give no row."""
    lo, hi = (F.nullif(F.regexp_extract(token, pattern, 1), F.lit("")).try_cast("bigint") for pattern in (r"^(\d+)(?:-\d+)?$", r"^\d+-(\d+)$"))
    ranged = df.withColumn("__lo", lo).withColumn("__hi", F.coalesce(hi, lo)).filter("__lo IS NOT NULL")
    ends = (F.least("__lo", "__hi"), F.greatest("__lo", "__hi"))
    return ranged.withColumn(out, F.explode(F.sequence(*ends))).drop("__lo", "__hi")


def full_coverage(a: DataFrame, b: DataFrame, key: str, value: str, default: Column | None = None) -> DataFrame:
    """(key, value, in_a, in_b) over the keys of either: b's value, else a's, else the default (the key)."""
    left = a.select(F.col(key).alias("__a"), F.col(value).alias("__va"))
    right = b.select(F.col(key).alias("__b"), F.col(value).alias("__vb"))
    k = F.coalesce("__a", "__b")
    return left.join(right, F.col("__a") == F.col("__b"), "full_outer").select(k.alias(key), F.coalesce("__vb", "__va", default if default is not None else k.cast("string")).alias(value), F.col("__a").isNotNull().alias("in_a"), F.col("__b").isNotNull().alias("in_b"))


def scoped_union(frames: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Independent domains as one: keys get their scope as prefix."""
    out = None
    for scope, frame in frames.items():
        part = frame.withColumn("scope", F.lit(scope)).withColumn(key, F.concat(F.lit(f"{scope}:"), F.col(key).cast("string")))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def remapped_aliases(index: DataFrame, pages: DataFrame, suffix: str = "/overview", key: str = "url") -> DataFrame:
    """Index rows whose url is no page but whose parent is: they move to the parent; others stay."""
    own = pages.select(F.col(key).alias("__own")).distinct()
    up = pages.select(F.col(key).alias("__up")).distinct()
    parent = F.when(F.col(key).endswith(suffix), F.regexp_replace(F.col(key), F.lit(rf"\Q{suffix}\E$"), F.lit("")))
    joined = index.withColumn("__parent", parent).join(own, F.col(key) == F.col("__own"), "left").join(up, F.col("__parent") == F.col("__up"), "left")
    return joined.withColumn(key, F.when(F.col("__own").isNull() & F.col("__up").isNotNull(), F.col("__up")).otherwise(F.col(key))).drop("__parent", "__own", "__up")


def prefix_join(rows: DataFrame, prefixes: DataFrame, path: str = "path", prefix: str = "prefix") -> DataFrame:
    """rows with the columns of the longest prefix (whole segments) of their path; rows without one go, repeated rows stay.

    A path has few ancestors: they are rows of an equi-join, so no path is compared with every prefix. Only distinct paths
    go through it; rows then meet their path's prefix. Of a prefix that stands there twice the smallest row counts.
    """
    parts = F.split("__path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    known = prefixes.groupBy(F.col(prefix).alias("__prefix")).agg(F.min(F.struct(*prefixes.columns)).alias("__named"))
    named = rows.filter(F.col(path).isNotNull()).select(F.col(path).alias("__path")).distinct().select("__path", F.explode(above).alias("__above"))
    best = named.join(known, F.col("__above") == F.col("__prefix")).groupBy("__path").agg(F.max_by("__named", F.char_length("__prefix")).alias("__best"))
    return rows.join(best, F.col(path) == F.col("__path")).select(*rows.columns, "__best.*")


def looked_up_content(index: DataFrame, pages: DataFrame, key: str = "url", content: str = "content", default: str | None = None) -> DataFrame:
    """index with the content that pages (key, content) has for its key, the default where there is none; of a repeated key one row's."""
    known = pages.groupBy(F.col(key).alias("__key")).agg(F.min(content).alias("__content"))
    joined = index.join(known, F.col(key) == F.col("__key"), "left")
    return joined.withColumn(content, F.coalesce("__content", F.lit(default))).drop("__key", "__content")


def duplicate_outputs(df: DataFrame, path: str = "out_path") -> DataFrame:
    """(path, n) of outputs that more than one row would write."""
    return df.groupBy(path).agg(F.count("*").alias("n")).filter("n > 1")
