"""The command line of a run: sources by name, prefix, number or range, options for all of them, and options of their own after `--`.

    python -m tessaline.plans.cli --state s3a://corpus/state anthropic cloud 3-5 --dry-run -- --scope docs/api

Exit status: 0, if all sources ran; 1, if one failed (the others still run); 2, if the command can't be understood.
"""

from __future__ import annotations

import argparse
import re
import sys
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..sources.registry import SOURCES, SourceSpec, listing, select_sources
from ..sources.transport import Transport, cookie_header, standard_transport, verify_access
from . import run as runner
from .store import SnapshotStore
from .sync import Options, run_sources


@dataclass(frozen=True)
class Command:
    specs: tuple[SourceSpec, ...]
    options: Options
    headers: dict[str, str]
    state: str
    list_only: bool
    verbose: bool
    rest: tuple[str, ...]
    providers: tuple[str, ...] = ()
    raw: str | None = None
    manifests: str | None = None
    hours: float = 24.0
    commits: int = 0
    index: bool = False


def _own() -> argparse.ArgumentParser:
    """Options of sources, which may follow `--`."""
    p = argparse.ArgumentParser(prog="--", add_help=False, allow_abbrev=False)
    p.add_argument("--scope", action="append", default=[], help="only keys below this prefix; may be repeated")
    p.add_argument("--provider", action="append", default=[], help="only these providers of a registry, namespace/name")
    p.add_argument("--include", action="append", default=[], help="only paths that this pattern is found in; may be repeated")
    p.add_argument("--exclude", action="append", default=[], help="no paths that this pattern is found in; may be repeated")
    p.add_argument("--manifest-cache", help="where discovered addresses are kept, to be used again for --manifest-hours")
    p.add_argument("--manifest-hours", type=float)
    p.add_argument("--raw", help="where descriptions are kept as they came")
    p.add_argument("--commits", type=int, help="in how many parts a long run commits")
    p.add_argument("--spec-url", help="where the description is, in place of the source's own address")
    p.add_argument("--host", help="host in place of the address's")
    p.add_argument("--base-url", help="address in place of the source's")
    p.add_argument("--cookie")
    p.add_argument("--cookie-file")
    return p


def parse(arguments: Sequence[str], pick: Callable[[list[str]], list[str]] | None = None) -> Command:
    """The command, SystemExit(2) where it can't be understood. pick: asked for names if there are none, with all names."""
    given = list(arguments)
    cut = given.index("--") if "--" in given else len(given)
    before, after = given[:cut], given[cut + 1 :]
    p = argparse.ArgumentParser(prog="tessaline", allow_abbrev=False, parents=[_own()])
    p.add_argument("names", nargs="*")
    for flag in ("--all", "--list", "--dry-run", "--force", "--verbose", "--archive", "--index"):
        p.add_argument(flag, action="store_true")
    p.add_argument("--limit", type=int)
    p.add_argument("--state", default="state")
    a = p.parse_args(before)
    more, rest = _own().parse_known_args(after)
    for name, value in vars(more).items():
        setattr(a, name, [*getattr(a, name), *value] if isinstance(value, list) else value or getattr(a, name))
    if a.limit is not None and a.limit < 1:
        p.error("--limit has to be 1 or more")
    names = ["all"] if a.all else a.names or (pick(sorted(SOURCES)) if pick and not a.list else [])
    if not names and not a.list:
        p.error("name sources, or --all, or --list")
    try:
        specs = [SOURCES[n] for n in select_sources(names)]
    except ValueError as e:
        p.error(str(e))
    if a.all:  # those that need an address or a cookie are for runs by name
        specs = [s for s in specs if s.url]
    start = a.spec_url or a.base_url
    if (start or a.host) and len(specs) > 1:
        p.error("an address is for one source")
    if start:
        specs = [replace(s, url=start) for s in specs]
    elif a.host:
        specs = [replace(s, url="/".join([*s.url.split("/")[:2], a.host, *s.url.split("/")[3:]])) for s in specs]
    headers = cookie_header(a.cookie, a.cookie_file)
    for s in specs:
        if s.requires_auth and not headers:
            p.error(f"{s.name} needs --cookie or --cookie-file")
        if not s.url:
            p.error(f"{s.name} needs --base-url or --spec-url")
    for provider in a.provider:
        if not re.fullmatch(r"[\w.-]+/[\w.-]+", provider):
            p.error(f"{provider!r} is no namespace/name")
    if a.provider and any("registry_documents" not in s.discovery for s in specs):
        p.error("--provider is for registries")
    scope = None
    for one in [F.startswith("key", F.lit(prefix)) for prefix in a.scope] + [F.rlike("key", F.lit(pattern)) for pattern in a.include]:
        scope = one if scope is None else scope | one
    for pattern in a.exclude:
        none = ~F.rlike("key", F.lit(pattern))
        scope = none if scope is None else scope & none
    options = Options(force=a.force, dry_run=a.dry_run, limit=a.limit, scope=scope, archive=a.archive)
    return Command(tuple(specs), options, headers, a.state, a.list, a.verbose, tuple(rest), tuple(a.provider), a.raw, a.manifest_cache, 24.0 if a.manifest_hours is None else a.manifest_hours, a.commits or 0, a.index)


#: Lines of a source that --verbose shows; of more it says how many there are.
SHOWN = 1000


def main(arguments: Sequence[str], spark: SparkSession | None = None, get: runner.Get | None = None, show: Callable[[str], None] = print, send: Transport = standard_transport) -> int:
    """Run the command; get replaces fetching, in tests and over landed pages; send is what access is verified with."""

    def asked(names: list[str]) -> list[str]:
        if not sys.stdin.isatty():
            return []
        for n, name in enumerate(names, 1):
            show(f"{n:3} {name}")
        return input("Which? ").replace(",", " ").split()

    try:
        command = parse(arguments, asked)
    except SystemExit as e:
        return int(e.code or 0)
    spark = spark or SparkSession.builder.getOrCreate()
    if command.list_only:
        for row in listing(spark).orderBy("name").collect():  # a row for each known source
            show(f"{row['name']}  {row['discovery']}  {row['url']}")
        return 0
    reasons: list[str] = []

    def of(spec: SourceSpec):
        def one():
            verify = None
            if spec.requires_auth:  # before anything is fetched
                verify = lambda: verify_access(spec.url, command.headers, send)
            store = SnapshotStore(spark, f"{command.state.rstrip('/')}/{spec.name}")
            out = runner.run_source(
                spark, spec, store, get or runner.online(spec.policy, command.headers), command.options, raw=command.raw, manifests=command.manifests, hours=command.hours, providers=command.providers, verify=verify, commits=command.commits, index_pages=command.index)
            if command.verbose:
                told = out.rows.filter("status <> 'unchanged'")
                lines = told.orderBy("key").limit(SHOWN).collect()
                reasons.extend(f"{spec.name}: {r['status']} {r['key']}" for r in lines)
                if len(lines) == SHOWN and (rest := told.count() - SHOWN):
                    reasons.append(f"{spec.name}: ... and {rest} more")
            return out

        return one

    told = run_sources(spark, {s.name: of(s) for s in command.specs}).collect()  # a row for each source
    for row in told:
        show(f"{row['source']}: " + (", ".join(f"{n} {k}" for k, n in sorted(row["counts"].items())) or "nothing" if row["ok"] else f"failed: {row['error']}"))
    for line in reasons:
        show(f"  {line}")
    return int(not all(row["ok"] for row in told))


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
