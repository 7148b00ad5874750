"""Requests that follow from replies: pages that a first reply counts, requests that another names, many keys in one reply.

Requests are rows with a url and whatever they are for; replies are the same rows with status and body. Equal URLs are asked
for once. A reply that failed is a row as well, so that what depends on it is known to be unseen.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import catalogue as C
from ..plans.store import cut_here
from . import discover as D
from .crawl import Get


def ask(requests: DataFrame, get: Get, etag: str | None = None) -> DataFrame:
    """requests with status, body (null unless 200) and etag; each distinct url is asked for once, with the column etag if it is named."""
    known = F.min(etag) if etag else F.first(F.lit(None).cast("string"))
    asked = requests.filter("url IS NOT NULL").groupBy("url").agg(known.alias("etag"))
    replies = get(asked).select(F.col("url").alias("__u"), F.col("status").alias("__status"), F.col("body").alias("__body"), F.col("etag").alias("__etag"))
    rest = [c for c in requests.columns if c not in ("status", "body", "etag")]
    joined = requests.select(*rest).join(replies, F.col("url") == F.col("__u"), "left")
    return cut_here(joined.select(*rest, F.coalesce("__status", F.lit(0)).alias("status"), F.when(F.col("__status") == 200, F.col("__body").cast("string")).alias("body"), F.col("__etag").alias("etag")))


def follow(start: DataFrame, get: Get, *steps: Callable[[DataFrame], DataFrame]) -> list[DataFrame]:
    """Replies of start, then of the requests that each step makes of the successful replies before it."""
    out = [ask(start, get)]
    for step in steps:
        out.append(ask(step(out[-1].filter("status = 200")), get))
    return out


def all_pages(first: DataFrame, get: Get, total: Column, url: Callable[[Column, Column], Column]) -> DataFrame:
    """Replies, with page, of every page of each request: the first says in total how many there are; url makes a page's from the first's and its number."""
    one = ask(first, get).withColumn("page", F.lit(1))
    named = one.filter("status = 200").withColumn("__total", total.cast("int")).filter("__total > 1")
    more = named.withColumn("page", F.explode(F.sequence(F.lit(2), F.col("__total")))).withColumn("url", url(F.col("url"), F.col("page"))).drop("__total")
    return one.unionByName(ask(more, get))


def complete_by(replies: DataFrame, *keys: str) -> DataFrame:
    """(keys, complete): whether all requests of a key came."""
    return replies.groupBy(*keys).agg(F.bool_and(F.col("status") == 200).alias("complete"))


def in_batches(keys: DataFrame, get: Get, url: Callable[[Column], Column], more: Callable[[DataFrame], DataFrame], failed: Column | None = None, size: int = 50, key: str = "key") -> tuple[DataFrame, DataFrame]:
    """(replies, outcome of batches) of requests for size keys each.

    url makes a request's address from the array of its keys. more: successful replies (batch, url, body) to (batch, url) of
    continuations; a url that a batch has had is not asked for again. replies: (batch, part, url, status, body); batches:
    (batch, keys, requests, failed), failed where a request of the batch did not come, or failed says so of a body.
    """
    held = cut_here(D.batched(keys.select(key).distinct(), size, key).groupBy("batch").agg(F.array_sort(F.collect_list(key)).alias("keys")))  # size keys at most
    now, out = held.select("batch", url(F.col("keys")).alias("url")), None
    for part in count(1):
        got = ask(now, get).withColumn("part", F.lit(part))
        out = got if out is None else cut_here(out.unionByName(got))
        told = more(got.filter("status = 200").select("batch", "url", "body")).filter("url IS NOT NULL")
        now = cut_here(told.join(out.select(F.col("batch").alias("__b"), F.col("url").alias("__seen")), (F.col("batch") == F.col("__b")) & (F.col("url") == F.col("__seen")), "left_anti").select("batch", "url").distinct())
        if now.isEmpty():
            break
    bad = (F.col("status") != 200) | F.coalesce(failed if failed is not None else F.lit(False), F.lit(False))
    told = out.groupBy(F.col("batch").alias("__b")).agg(F.count("*").alias("requests"), F.bool_or(bad).alias("failed"))
    return out, held.join(told, F.col("batch") == F.col("__b")).select("batch", "keys", "requests", "failed")


def outcome_by_key(batches: DataFrame, found: DataFrame, key: str = "key") -> DataFrame:
    """(key, outcome) of every key that was asked for: 'found' if found has it, 'failed' if its batch failed, else 'missing'."""
    asked = batches.select(F.explode("keys").alias(key), "failed")
    there = found.select(F.col(key).alias("__f")).distinct()
    outcome = F.when(F.col("__f").isNotNull(), "found").when(F.col("failed"), "failed").otherwise("missing")
    return asked.join(there, F.col(key) == F.col("__f"), "left").select(key, outcome.alias("outcome"))


def wiki_url(api: str, **parameters: str) -> Callable[[Column], Column]:
    """A MediaWiki request for an array of titles."""
    fixed = "&".join(f"{k}={v}" for k, v in parameters.items())
    return lambda titles: F.concat(F.lit(f"{api}?{fixed}&titles="), F.array_join(F.transform(titles, F.url_encode), "%7C"))


_CONTINUE = "struct<continue:map<string,string>>"


def continued(replies: DataFrame, key: str = "batch") -> DataFrame:
    """(key, url) of the continuation that a reply names: its url with those parameters in place of earlier ones of that name."""
    told = replies.select(key, "url", F.from_json("body", _CONTINUE)["continue"].alias("c")).filter("c IS NOT NULL")
    pairs = F.array_sort(F.filter(F.map_entries("c"), lambda e: e["key"] != "continue"))
    bare = F.split("url", r"[?&]")
    kept = F.filter(F.slice(bare, F.lit(2), F.size(bare)), lambda p: ~F.array_contains(F.map_keys("c"), F.split(p, "=")[0]))
    added = F.transform(pairs, lambda e: F.concat(e["key"], F.lit("="), F.url_encode(e["value"])))
    return told.filter(F.size(pairs) > 0).select(key, F.concat(bare[0], F.lit("?"), F.array_join(F.concat(kept, added), "&")).alias("url"))


def bundle_chain(page: DataFrame, get: Get, origin: str) -> tuple[DataFrame, DataFrame]:
    """((source, route, module, made_from, url, status, body), (source, complete)): from a page (source, url, text) to the bodies of its routes.

    The page names a bundler's main script and its runtime; these are fetched and say, together, in which chunk each route's
    content lies; chunks are fetched, each once. complete: whether both scripts came and gave routes.
    """
    absolute = lambda u: F.when(F.rlike(u, F.lit("^https?://")), F.col(u)).otherwise(F.concat(F.lit(origin.rstrip("/") + "/"), F.regexp_replace(u, "^/+", "")))
    scripts = D.script_urls(page, "source", "text").withColumn("url", absolute("url"))
    runtime = F.rlike("url", F.lit(r"/runtime[^/]*\.js$"))
    kinds = scripts.withColumn("kind", F.when(runtime, "runtime").when(F.rlike("url", F.lit(r"/main[^/]*\.js$")), "main")).filter("kind IS NOT NULL")
    got = ask(kinds.select("source", "kind", "url"), get)
    held = got.filter("status = 200").select("source", "kind", F.col("body").alias("script"))
    routes = D.route_contents(held.filter("kind = 'main'"), held.filter("kind = 'runtime'"))
    chunks = ask(routes.withColumn("url", absolute("file")).drop("file"), get)
    whole = got.groupBy("source").agg((F.bool_and(F.col("status") == 200) & (F.count_distinct("kind") == 2)).alias("complete"))
    some = chunks.groupBy(F.col("source").alias("__s")).agg(F.count("*").alias("__n"))
    told = page.select("source").distinct().join(whole, "source", "left").join(some, F.col("source") == F.col("__s"), "left")
    return chunks, told.select("source", (F.coalesce("complete", F.lit(False)) & (F.coalesce("__n", F.lit(0)) > 0)).alias("complete"))


def registry_documents(providers: DataFrame, get: Get, root: str, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, providers) of a registry whose replies depend on each other: provider -> newest version -> its documents.

    providers: (provider). documents: (provider, id, category, slug, title, url), of providers that are not current;
    providers: (provider, version, fingerprint, complete, current). The fingerprint is of the immutable document ids and what
    shows of them. known: (provider, version, fingerprint) of runs that succeeded in full: a provider with the same is
    current, and none of its documents is asked for.
    """
    ask_first = providers.select("provider", F.concat(F.lit(root.rstrip("/") + "/"), "provider").alias("url"))
    version = F.get_json_object("body", "$.version")
    first, second = follow(ask_first, get, lambda r: r.withColumn("version", version).filter("version IS NOT NULL").select("provider", "version", F.concat_ws("/", "url", "version").alias("url")))
    listed = second.filter("status = 200").select("provider", "version", F.explode(F.from_json("body", "struct<docs:array<struct<id:string,category:string,slug:string,title:string>>>")["docs"]).alias("doc")).select("provider", "version", "doc.*")
    listed = cut_here(listed.fillna("", ["id", "slug", "title"]).fillna("other", ["category"]))
    prints = C.fingerprint(listed, ["provider"], ["category", "slug", "id", "title"]).select("provider", "fingerprint")
    told = first.select("provider").join(second.select("provider", "version", (F.col("status") == 200).alias("__ok")), "provider", "left").join(prints, "provider", "left")
    told = told.withColumn("complete", F.coalesce("__ok", F.lit(False)) & F.col("fingerprint").isNotNull()).drop("__ok")
    if known is not None:
        old = known.select(F.col("provider").alias("__p"), F.col("version").alias("__v"), F.col("fingerprint").alias("__f"))
        told = told.join(old, F.col("provider") == F.col("__p"), "left").withColumn("current", F.col("complete") & F.col("version").eqNullSafe(F.col("__v")) & F.col("fingerprint").eqNullSafe(F.col("__f"))).drop("__p", "__v", "__f")
    else:
        told = told.withColumn("current", F.lit(False))
    told = cut_here(told)
    due = told.filter("complete AND NOT current").select(F.col("provider").alias("__due"))
    docs = listed.join(due, F.col("provider") == F.col("__due"), "left_semi")
    return docs, told


