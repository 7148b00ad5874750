"""Prefix trie, whitening, fingerprints: against brute force, on odd inputs and hot groups."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest

from tessaline.llm import fingerprints as P
from tessaline.llm import queries, trie
from tessaline.llm import whitening as W

from ..conftest import SMALL, duck

TURNS = "conv_id long, turn long, role string, text string, n long, base string"


def rows_of(frame, columns):
    return sorted((tuple(None if pd.isna(v) else v for v in r) for r in frame[columns].astype(object).values.tolist()), key=repr)


# ---------------------------------------------------------------- prefix trie

def brute_trie(turns):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in turns:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(rows)] for c, rows in own.items()}
    built = {}
    for c, rows in own.items():
        base = c - int(np.fmod(c, 100))
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = [*own.get(base, [])[:h], *rows[h:]]
    nodes = {tuple(path[:d]) for path in built.values() for d in range(len(path) + 1)}
    members = {n: sorted(c for c, p in built.items() if tuple(p[: len(n)]) == n) for n in nodes}
    out = []
    for n in nodes:
        below = [m for m in nodes if m[: len(n)] == n]
        children = [m for m in below if len(m) == len(n) + 1]
        leaves = [m for m in below if not any(x[:-1] == m and x for x in nodes)]
        saved = sum((len(members[m]) - 1) * (len(m[-1][1]) if m else 0) for m in below)
        ends = ",".join(str(c) for c in members[n] if len(built[c]) == len(n))
        out.append((members[n][0], len(n), members[n[:-1]][0] if n else None, len(members[n]), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def same_trie(spark, turns):
    got = trie.prefix_trie(spark.createDataFrame(turns, TURNS))
    assert got.columns == TRIE and {t for c, t in got.dtypes if c != "ends_sha256"} == {"bigint"}
    assert rows_of(got.toPandas(), TRIE) == brute_trie(turns)


def random_turns(seed, n=60):
    rnd = random.Random(seed)
    pick = [None, "", "a", "é", "a\nb", "x" * 300]
    return [(rnd.choice([-250, -150, -3, 0, 1, 7, 99, 100, 104, 205, 206, 207, None]), rnd.choice([None, 0, 1, 1, 2, 3]), rnd.choice([None, "user", "assistant"]), rnd.choice(pick), 1, "b") for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_trie_is_brute_force(spark, seed):
    """Nulls in every column, ties, repeated rows, negative ids, absent bases, turnless conversations, clashing names."""
    same_trie(spark, random_turns(seed))


def test_trie_of_copies_and_chains(spark):
    """A third of all conversations are copies; others each go on where the one before ended; one is long."""
    copies = [(c, k, "user", f"t{k}", 0, "") for c in range(1000, 1040) for k in range(3)]
    chain = [(c * 100, k, "user", f"s{k}", 0, "") for c in range(20) for k in range(c + 1)]
    long = [(777_000, k, "assistant", str(k), 0, "") for k in range(120)]
    same_trie(spark, [*copies, *chain, *long])


def test_families_emit_in_parts(spark, monkeypatch):
    monkeypatch.setattr(trie, "FLUSH", 5)
    family, out = trie._Family(0), []
    for conv in (0, 1, 2):
        family.begin(conv, 2)
        for k in range(8):
            family.turn("user", str(k if conv < 2 else -k))
            if len(family.nodes) >= trie.FLUSH:
                out += family.rows()
        family.end()
    out += family.rows()
    totals = defaultdict(int)
    for name, _, depth, _, _, n, _, _ in out:
        totals[name, depth] += n
    assert totals[trie.ROOT, 0] == 3 and sum(n for (_, d), n in totals.items() if d == 2) == 3
    assert sorted(c for r in out for c in r[7]) == [0, 1, 2]


def test_trie_of_no_rows(spark):
    assert trie.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b", 1, "")], TURNS)).count() == 0
    same_trie(spark, [(5, None, None, None, 1, "")])


def test_trie_query_is_its_sql(spark):
    got = queries.QUERIES["op11_prefix_trie"](spark, SMALL).toPandas()
    assert rows_of(got, TRIE) == rows_of(duck(SMALL).execute(trie.ORACLE).df(), TRIE)


# ---------------------------------------------------------------- whitening

def exact_fit(vectors):
    """(n, sums, covariance) with fractions, of distinct vectors of whole numbers."""
    fit = sorted({tuple(int(np.floor(64 * float(c))) + 1_000_000 for c in v) for v in vectors})
    n, dim = len(fit), len(fit[0])
    sums = [sum(v[k] for v in fit) for k in range(dim)]
    d = [[n * v[k] - sums[k] for k in range(dim)] for v in fit]
    return n, sums, np.array([[float(Fraction(sum(r[i] * r[j] for r in d), n**3)) for j in range(dim)] for i in range(dim)])


def check_whitening(got, vectors, rows):
    n, sums, v = exact_fit(vectors)
    values, vecs = np.linalg.eigh(v)
    values, vecs = values[::-1], vecs[:, ::-1]
    assert (got.n == n).all() and got.identity_error.nunique() == 1 and got.identity_error.iloc[0] <= 1e-9
    k = got.component.max()
    assert np.allclose(got.groupby("component").explained.first(), values[:k] / np.trace(v), rtol=1e-9)
    for i, vec in rows:
        d = [n * (int(np.floor(64 * float(c))) + 1_000_000) - s for c, s in zip(vec, sums, strict=True)]
        own = got[got.vec_id == i].sort_values("component")
        assert (own.deviation == sum(x * x for x in d)).all() and own.component.tolist() == list(range(1, k + 1))
        assert np.allclose(np.abs(own.whitened), np.abs((np.array(d) / n) @ vecs[:, :k] / np.sqrt(values[:k])), atol=1e-8)


def test_whitening_is_exact(spark):
    rnd = np.random.default_rng(3)
    vectors = (rnd.normal(size=(150, 20)) * np.linspace(0.2, 3, 20)).astype(np.float32)
    vectors[50:100] = vectors[0]  # a third are copies
    rows = [(i, v.tolist(), 1, 2) for i, v in enumerate(vectors)]
    got = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>, n long, component int").repartition(5)).toPandas()
    check_whitening(got, vectors, enumerate(vectors))
    assert got.component.max() == 16 and len(got) == 150 * 16


def test_whitening_of_odd_rows(spark):
    bad = [(90, None), (91, [1.0, None]), (92, [float("nan"), 1.0]), (93, [float("inf"), 1.0]), (94, []), (95, [1.0, 2.0, 3.0]), (96, [-float("inf"), 0.0])]
    good = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [0.25, -3.0]), (3, [2.0, 2.0]), (4, [1.0, 7.5])]
    make = lambda rows: W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = make([*bad, *good]).toPandas()
    assert len(got) == 10 and sorted(got.vec_id.dropna().unique()) == [1, 3, 4]
    check_whitening(got, [v for _, v in good], good[3:])
    # One distinct vector, none, a direction without variance, an empty table.
    assert make([(1, [1.0, 2.0]), (2, [1.0, 2.0])]).count() == 0 == make(bad[:4]).count() == make([]).count()
    assert make([(1, [1.0, 2.0]), (2, [2.0, 2.0])]).count() == 2
    huge = make([(1, [1e300, 0.0]), (2, [0.0, 1.0]), (3, [-1e300, 5.0])]).toPandas()
    assert len(huge) and np.isfinite(huge.whitened).all() and huge.deviation.isna().tolist() == [i != 2 for i in huge.vec_id]


def test_error_free_parts():
    """Double-double sums and block products against fractions, for values a naive sum of squares would lose."""
    rnd = np.random.default_rng(5)
    hi = rnd.normal(size=(W.BLOCK, 4)) * np.array([1e-6, 1, 1e3, 1e6])
    lo = hi * rnd.normal(size=hi.shape) * 1e-17
    a, b = W.block_product(hi, lo)
    for i in range(4):
        for j in range(4):
            want = sum((Fraction(float(x)) + Fraction(float(e))) * (Fraction(float(y)) + Fraction(float(f))) for x, e, y, f in zip(hi[:, i], lo[:, i], hi[:, j], lo[:, j], strict=True))
            scale = sum(abs(Fraction(float(x)) * Fraction(float(y))) for x, y in zip(hi[:, i], hi[:, j], strict=True))
            assert abs(Fraction(float(a[i, j])) + Fraction(float(b[i, j])) - want) <= scale * Fraction(1, 1 << 58)
    s, e = W.two_sum(np.array([1e16]), np.array([1.0]))
    assert Fraction(float(s[0])) + Fraction(float(e[0])) == 10**16 + 1


def test_whitening_query_on_a_whole_table(spark):
    got = queries.QUERIES["op12_embedding_whitening"](spark, SMALL).toPandas()
    table = pd.read_parquet(f"{SMALL}/embeddings.parquet")
    assert len(got) == 16 * len(table) and got.identity_error.max() <= 1e-9
    n, _, v = exact_fit(np.stack(table.embedding))
    assert (got.n == n).all() and np.allclose(got.groupby("component").explained.first(), np.linalg.eigvalsh(v)[::-1][:16] / np.trace(v), rtol=1e-10)


# ---------------------------------------------------------------- fingerprints

def brute_print(text):
    """Votes term by term, with the module's hash of each word taken alone."""
    from tessaline.llm.common import mix64, words_of

    words = words_of([text.encode()])[0]
    counts = defaultdict(int)
    for w in words:
        counts[int(w)] += 1
    for a, b in zip(words, words[1:]):  # noqa: B905  neighbours
        counts[int(mix64(np.array([a * P._PAIR + b], np.uint64))[0])] += 1
    total = [0] * P.BITS
    for term, n in counts.items():
        wide = int(mix64(np.array([term], np.uint64))[0]) | int(mix64(np.array([term ^ int(P._SECOND)], np.uint64))[0]) << 64
        for k in range(P.BITS):
            total[k] += n.bit_length() * (1 if wide >> k & 1 else -1)
    return sum((t > 0) << k for k, t in enumerate(total)).to_bytes(16, "little")


def brute_rows(docs):
    keyed = sorted(((i is not None, i or 0, hashlib.sha256((t or "").encode()).hexdigest(), t or "", i) for i, t in docs), key=lambda r: r[:3])
    out = []
    for k, (_, _, _, text, i) in enumerate(keyed):
        following = keyed[(k + 1) % len(keyed)][3]
        half = len(text) // 2
        made = text[: len(text) - half] + following[:half]
        a, b, c = (int.from_bytes(brute_print(x), "little") for x in (text, made, following))
        out.append((i, len(text), hashlib.sha256(made.encode()).hexdigest(), brute_print(text).hex(), brute_print(made).hex(), 1 - (a ^ b).bit_count() / 128, 1 - (a ^ c).bit_count() / 128))
    return sorted(out, key=repr)


PRINTS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


@pytest.mark.parametrize("seed", range(2))
def test_fingerprints_are_brute_force(spark, seed):
    """Nulls, empty and long texts, ties, repeated rows, edges of partitions, clashing names."""
    rnd = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "été", "𝒳y", "d", "\t", "\n"]
    docs = [(rnd.choice([None, 1, 1, *range(2, 30)]), rnd.choice([None, "", " ", "one", " ".join(rnd.choices(words, k=rnd.randint(1, 60)))])) for _ in range(50)]
    docs += [(7, "same text here")] * 30 + [(100, "long " * 20_000 + "end")]
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, fingerprint string, n_near long").repartition(6)
    got = P.document_fingerprints(frame)
    assert got.columns == [*PRINTS, "n_near"]
    assert rows_of(got.toPandas(), PRINTS) == brute_rows(docs)


def test_few_rows(spark):
    schema = "doc_id long, text string"
    assert P.document_fingerprints(spark.createDataFrame([], schema)).count() == 0
    one = P.document_fingerprints(spark.createDataFrame([(1, "abcd efgh")], schema)).toPandas()
    assert rows_of(one, PRINTS) == brute_rows([(1, "abcd efgh")]) and one.near_next[0] == 1.0


@pytest.mark.parametrize("radius", [0, 1, 4, 9])
def test_tables_find_all_within_the_radius(spark, radius):
    """Every pair of fingerprints within the radius, each once, and none beyond; many around one centre."""
    rnd = random.Random(radius)
    prints = {rnd.getrandbits(128) for _ in range(40)} | {0, (1 << 128) - 1}
    for p in list(prints)[:12]:
        for k in range(0, radius + 3):
            prints.add(p ^ sum(1 << b for b in rnd.sample(range(128), k)))
    raw = sorted(prints)
    frame = spark.createDataFrame([(p.to_bytes(16, "big"), 1) for p in raw + raw[:5]], "fingerprint binary, distance int")
    got = P.within(frame.limit(20), frame, radius).toPandas()
    asked = {int.from_bytes(bytes(r.fingerprint), "big") for r in frame.limit(20).collect()}
    want = sorted((a, b, (a ^ b).bit_count()) for a in asked for b in raw if (a ^ b).bit_count() <= radius)
    assert sorted((int.from_bytes(q, "big"), int.from_bytes(f, "big"), d) for q, f, d in got[["query", "fingerprint", "distance"]].values.tolist()) == want


def test_fingerprint_query_tells_edited_from_unrelated(spark):
    got = queries.QUERIES["op13_document_fingerprints"](spark, SMALL).toPandas()
    docs = pd.read_parquet(f"{SMALL}/documents.parquet")
    assert sorted(got.doc_id) == sorted(docs.doc_id) and got.merge(docs, on="doc_id", suffixes=("", "_d")).groupby("text").fingerprint.nunique().max() == 1
    assert (got.near_edited > got.near_next).mean() > 0.97
    asked = got[got.doc_id % 20 == 0]
    whole = [int(x, 16) for x in got.fingerprint]
    assert asked.n_near.tolist() == [sum((int(a, 16) ^ b).bit_count() <= P.RADIUS for b in whole) - 1 for a in asked.fingerprint] and got[got.doc_id % 20 > 0].n_near.isna().all()
