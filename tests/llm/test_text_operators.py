"""SimHash, repeats, decontamination, rules, mixing: brute force on small cases, and every odd input."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash

from tessaline.llm import components, decontam, mixing, queries, rules, simhash, suffix

from ..conftest import SMALL, compare, duck

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, uid string, key string, fp string, spans string, n_bytes string, words int"


def frame(spark, texts, langs=None, sources=None):
    """Documents with columns whose names operators use themselves."""
    rows = [(i, t, (langs or ["en"])[i % len(langs or [1])], (sources or ["s"])[i % len(sources or [1])], "u", "k", "f", "x", "n", 3) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


ODD = [None, "", " \n\t", "one", "one two", "Ünïcode wörds hère and ßome möre", "a b c d e f g h", "a b c d e f g h", "long " * 30_000, "😀 " * 50, "x" * 5000]


# ---------------------------------------------------------------- simhash

def brute_fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def brute_components(prints):
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(prints))]


def test_simhash_against_brute_force(spark):
    rnd = random.Random(3)
    base = [" ".join(rnd.choice("ab cd ef gh ij kl mn op".split()) for _ in range(60)) for _ in range(15)]
    texts = [*ODD, *base]
    for b in base:
        for _ in range(3):
            w = b.split()
            w[rnd.randrange(60)] = "zz"
            texts.append(" ".join(w))
    got = {r["doc_id"]: r for r in simhash.near_duplicates(frame(spark, texts)).collect()}
    prints = [brute_fingerprint(t) for t in texts]
    assert [got[i]["fingerprint"] for i in range(len(texts))] == [f"{p:016x}" for p in prints]
    assert [got[i]["component_id"] for i in range(len(texts))] == brute_components(prints)


def test_ball_links_find_every_pair_at_two_bits(spark):
    rnd = random.Random(1)
    values = {rnd.getrandbits(64) for _ in range(40)}
    values |= {v ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for v in list(values)} | {v ^ 7 for v in list(values)[:10]} | {0, 1 << 63, (1 << 64) - 1}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    for radius in (0, 1, 2):
        links = simhash.ball_links(spark.createDataFrame([(v,) for v in signed], "fp long"), radius)
        roots = {r["node"]: r["root"] for r in components.components(links).collect()}
        # Same partition as by all pairs.
        want: dict = {v: v for v in signed}
        changed = True
        while changed:
            changed = False
            for a in signed:
                for b in signed:
                    if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= radius and want[a] != want[b]:
                        want[a] = want[b] = min(want[a], want[b])
                        changed = True
        assert {v: roots.get(v, v) for v in signed} == want


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(100, i) for i in range(101, 160)]
    edges = spark.createDataFrame([*chain, *star, (200, 200), (7, 8), (8, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert all(got[i] == 0 for i in range(1, 61)) and all(got[i] == 100 for i in range(101, 160)) and 200 not in got


def test_one_of_each_class_stays(spark):
    df = spark.createDataFrame([(5, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (None, "q r s t u v w"), (9, "zz yy xx ww vv")], "doc_id long, text string")
    kept = simhash.one_of_each(df)
    assert sorted((r["doc_id"] or -1, r["text"]) for r in kept.collect()) == [(-1, "q r s t u v w"), (3, "a b c d e f"), (9, "zz yy xx ww vv")]
    assert kept.columns == df.columns and simhash.one_of_each(df.limit(0)).count() == 0


# ---------------------------------------------------------------- repeats

def brute_repeats(texts, threshold):
    seen = defaultdict(list)
    for i, t in enumerate(texts):
        for p in range(len(t) - threshold + 1):
            seen[t[p : p + threshold]].append((i, p))
    covered = [bytearray(len(t)) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                covered[i][p : p + threshold] = b"\1" * threshold
    return covered


@pytest.mark.parametrize("threshold", [3, 40, 41])
def test_repeats_against_brute_force(spark, threshold):
    rnd = random.Random(threshold)
    blocks = ["".join(rnd.choice("abcdé ") for _ in range(rnd.randint(5, 200))) for _ in range(5)]
    texts = [None, "", "é" * 30, "a" * 100, "ab" * 60, "x" * (threshold - 1), "y" * threshold]
    for _ in range(40):
        parts = []
        for _ in range(rnd.randint(0, 4)):
            b = rnd.choice(blocks)
            a = rnd.randrange(len(b))
            parts.append(b[a : a + rnd.randint(1, 120)] if rnd.random() < 0.6 else "".join(rnd.choice("qrstuv") for _ in range(rnd.randint(0, 50))))
        texts.append("".join(parts))
    texts += [texts[10], texts[10]]
    data = [(t or "").encode() for t in texts]
    got = {r["doc_id"]: r for r in suffix.remove_repeats(frame(spark, texts), threshold=threshold).collect()}
    for i, (t, c) in enumerate(zip(data, brute_repeats(data, threshold), strict=True)):
        runs = sum(1 for j in range(len(t)) if c[j] and (j == 0 or not c[j - 1]))
        kept = bytes(b for b, on in zip(t, c, strict=True) if not on)
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], got[i]["kept_sha256"]) == (len(t), sum(c), runs, hashlib.sha256(kept).hexdigest()), i
        assert got[i]["key"] == "k" and got[i]["spans"] == "x"


def test_repeats_of_odd_inputs(spark):
    got = {r["doc_id"]: r for r in suffix.remove_repeats(frame(spark, ODD)).collect()}
    assert (got[0]["n_bytes"], got[0]["kept_sha256"]) == (0, hashlib.sha256(b"").hexdigest()) and got[8]["n_removed"] == 150_000 and got[10]["n_removed"] == 5000 and got[6]["n_removed"] == 0
    assert suffix.remove_repeats(frame(spark, []).limit(0)).count() == 0
    cut = spark.createDataFrame([("aé".encode()[:-1],)], "b binary").select(suffix.decoded("b")).first()[0]
    assert cut == "a"


def brute_passages(texts, threshold):
    """Bytes from the first to the last word of each run of words that is covered by passages of that many words that recur."""
    words = [[(m.group().translate(LOWER), len(t[: m.start()].encode()), len(t[: m.end()].encode())) for m in WORD.finditer(t)] for t in texts]
    seen = defaultdict(list)
    for i, w in enumerate(words):
        for j in range(len(w) - threshold + 1):
            seen[tuple(x[0] for x in w[j : j + threshold])].append((i, j))
    on = [[False] * (len(w) + 1) for w in words]
    for found in seen.values():
        for i, j in found if len(found) > 1 else ():
            on[i][j : j + threshold] = [True] * threshold
    for t, w, o in zip(texts, words, on, strict=True):
        kept, at = t.encode(), 0
        parts, start = [], None
        for j, hit in enumerate(o):
            if hit and start is None:
                start = j
            if not hit and start is not None:
                parts.append(kept[at : w[start][1]])
                at, start = w[j - 1][2], None
        yield b"".join([*parts, kept[at:]])


def test_passages_of_words_against_brute_force(spark):
    rnd = random.Random(3)
    blocks = [[rnd.choice(["Éa", "b", "cc", "d-d", "😀"]) + str(rnd.randint(0, 9)) for _ in range(30)] for _ in range(4)]
    texts = ["", "one", "a " * 40, " ".join(blocks[0]), "\n".join(blocks[0]).upper()]
    for _ in range(30):
        parts = []
        for _ in range(rnd.randint(0, 4)):
            b, a = rnd.choice(blocks), rnd.randrange(30)
            parts += b[a : a + rnd.randint(1, 20)] if rnd.random() < 0.6 else [f"u{rnd.random()}" for _ in range(rnd.randint(0, 9))]
        texts.append(rnd.choice([" ", "\n", " \t"]).join(parts))
    got = {r["doc_id"]: bytes(r["kept_bytes"]) for r in suffix.remove_repeats(frame(spark, texts), threshold=7, words=True).collect()}
    beside = {r["doc_id"]: r["n_passage_bytes"] for r in suffix.remove_repeats(frame(spark, texts), passages=7).collect()}
    for i, want in enumerate(brute_passages(texts, 7)):
        assert (got[i], beside[i]) == (want, len(texts[i].encode()) - len(want)), i


def test_repeats_of_a_whole_table_against_brute_force(spark):
    folder = SMALL.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in queries.op3_suffix_array_dedup(spark, folder).collect()}
    rows = docs.select("doc_id", "text").collect()
    data = [(r["text"] or "").encode() for r in rows]
    for r, t, c in zip(rows, data, brute_repeats(data, 400), strict=True):
        assert got[r["doc_id"]] == (sum(c), sum(1 for j in range(len(t)) if c[j] and (j == 0 or not c[j - 1]))), r["doc_id"]


def test_long_texts_are_ranked_in_segments(monkeypatch):
    rnd = random.Random(1)
    texts = [bytes(rnd.randrange(256) for _ in range(n)) for n in (5, 40, 400, 39, 1000)]
    units, bounds = suffix.units_of(texts, False)
    monkeypatch.setattr(suffix, "SEGMENT", 70)
    windows = set()
    for part, own, i, a in suffix._segments(units, bounds, 40):
        assert len(part) <= 70 + 39
        for t, _, _, at, lo, hi in zip(*suffix.anchors(part, own, 40), strict=True):
            windows |= {(int(t + i), int(a + at - o)) for o in range(lo, hi + 1)}
    assert windows == {(i, j) for i, t in enumerate(texts) for j in range(len(t) - 39)}


# ---------------------------------------------------------------- decontamination

ITEM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_contamination(texts, items):
    tokens = lambda t: ITEM.findall((t or "").translate(LOWER))
    windows = defaultdict(set)
    for k, t in items:
        w = tokens(t)
        n = min(13, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[s : s + n])].add(str(k))
    sizes = {len(w) for w in windows}
    for t in texts:
        w = tokens(t)
        hit, found = [False] * len(w), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[s : s + n]))) is not None:
                    hit[s : s + n] = [True] * n
                    found |= own
        yield len(w), sum(hit), sorted(found), sum(hit) > 0 and 20 * sum(hit) >= len(w)


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_decontamination_against_brute_force(spark, limit):
    rnd = random.Random(8)
    vocabulary = [f"w{i}" for i in range(30)] + ["Été", "naïve"]
    phrase = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(phrase(rnd.choice((1, 2, 5, 13, 20, 40))))) for i in range(12)] + [(90, None), (91, "--"), (3, "Twice A b"), (4, "twice, a B!")]
    texts = list(ODD)
    for _ in range(40):
        w = phrase(rnd.randint(0, 60))
        if rnd.random() < 0.6:
            own = (rnd.choice(items)[1] or "").split()
            a = rnd.randrange(len(own)) if own else 0
            w[len(w) // 2 : len(w) // 2] = own[a : a + rnd.randint(1, 30)]
        texts.append("; ".join(w).upper() if rnd.random() < 0.3 else " ".join(w))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r for r in decontam.decontaminate(frame(spark, texts), benchmark, broadcast_limit=limit).collect()}
    for i, want in enumerate(brute_contamination(texts, items)):
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["items"], got[i]["contaminated"]) == want, i


def test_decontamination_of_empty_tables(spark):
    docs, items = frame(spark, ["a b c"]), spark.createDataFrame([], "item_id long, text string")
    assert [(r["n_words"], r["n_hit"], r["contaminated"]) for r in decontam.decontaminate(docs, items).collect()] == [(3, 0, False)]
    assert decontam.decontaminate(docs.limit(0), spark.createDataFrame([(1, "a")], "item_id long, text string")).count() == 0
    twice = decontam.decontaminate(docs.union(docs), spark.createDataFrame([(1, "b")], "item_id long, text string")).collect()
    assert [(r["n_hit"], r["items"]) for r in twice] == [(1, ["1"])] * 2


# ---------------------------------------------------------------- rules

def brute_base(text):
    t = text or ""
    w = WORD.findall(t)
    wins = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    inside = set()
    for i in range(len(w) - 4):
        if wins[tuple(w[i : i + 5])] > 1:
            inside |= set(range(i, i + 5))
    lines, seen, again = t.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), again, len(inside), len(w) < 10 or 100 * len(inside) > 20 * len(w)


def test_base_rules_against_brute_force(spark):
    texts = [*ODD, "a b c d e a b c d e", "x\nx\n \n \ny\nx", "#*$ %&|<> a\x0bb\x1cc", *("the cat sat on the mat and ran " * k + "end\nend" for k in range(1, 6)), *duck(SMALL).sql("SELECT text FROM documents").df()["text"].tolist()[:60]]
    got = {r["doc_id"]: r for r in rules.judge(frame(spark, texts, ["en", None, "fr"])).collect()}
    for i, t in enumerate(texts):
        assert tuple(got[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == brute_base(t), i
        assert not (got[i]["kept"] and got[i]["base_failed"])


def brute_distance(p, q):
    term = lambda a, m: a * math.log2(a / m) if a > 0 else 0
    return math.sqrt(max(0, sum(term(a, (a + b) / 2) + term(b, (a + b) / 2) for a, b in zip(p, q, strict=True)) / 2))


def test_divergences_against_brute_force(spark):
    rnd = random.Random(4)
    normal = lambda: " ".join(rnd.choice(["the", "of", "and", "to", *[f"word{chr(97 + k)}" for k in range(20)]]) for _ in range(rnd.randint(60, 200))) + "."
    texts = [normal() for _ in range(30)] + ["$$$ ### " * 40 + " ".join(f"Q{k}" for k in range(40))]
    got = {r["doc_id"]: r for r in rules.judge(frame(spark, texts)).collect()}
    classes = lambda t: [len(re.findall(p, t)) for p in ("[a-z]", r"[\x20\x09-\x0D]", r"[^\x00-\x7F]", "[A-Z]", r"[#*$%&|<>]", "[0-9]")]
    full = lambda t: [*classes(t), len(t) - sum(classes(t))]
    total = [sum(x) for x in zip(*map(full, texts), strict=True)]
    words = Counter(w for t in texts for w in t.split())
    top = [w for w, _ in sorted(words.items(), key=lambda e: (-e[1], e[0]))[:16]]
    n_all = sum(words.values())
    for i, t in enumerate(texts):
        assert got[i]["class_distance"] == pytest.approx(brute_distance([x / len(t) for x in full(t)], [x / sum(total) for x in total]), abs=1e-9)
        own = Counter(t.split())
        n = sum(own.values())
        p, q = [own[w] / n for w in top], [words[w] / n_all for w in top]
        assert got[i]["word_distance"] == pytest.approx(brute_distance([*p, 1 - sum(p)], [*q, 1 - sum(q)]), abs=1e-9)
    assert not got[30]["kept"] and all(got[i]["kept"] for i in range(30))
    assert rules.judge(frame(spark, []).limit(0)).count() == 0


# ---------------------------------------------------------------- mixing

def brute_targets(sizes, weights, share=1.5, epochs=2):
    target = dict.fromkeys(sizes, 0.0)
    clamped: set = set()
    total = share * sum(sizes.values())
    while True:
        rest = {s: weights[s] for s in sizes if s not in clamped}
        left = total - sum(epochs * sizes[s] for s in clamped)
        target = {s: epochs * sizes[s] if s in clamped else left * weights[s] / sum(rest.values()) for s in sizes}
        over = {s for s in rest if target[s] > epochs * sizes[s]}
        if not over:
            return target
        clamped |= over


def test_mixing_against_brute_force(spark):
    rnd = random.Random(2)
    texts = ["w " * rnd.randint(0, 400) for _ in range(300)] + [None, "", "only"]
    names = [f"s{k}" for k in (1, 10, 2, 3, 30)] + [None, "é", "Z"]
    docs = frame(spark, texts, None, names)
    got = mixing.mix(docs).collect()
    sizes: dict = defaultdict(int)
    for i, t in enumerate(texts):
        sizes[names[i % len(names)]] += len(WORD.findall(t or ""))
    order = sorted((n for n in sizes if n is not None), key=lambda n: [ord(c) for c in n]) + [None]
    want = brute_targets(sizes, {n: (5, 2, 1)[k % 3] for k, n in enumerate(order)})
    taken: dict = defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]], rel=1e-12) and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    largest = max(len(WORD.findall(t or "")) for t in texts)
    assert all(abs(taken[s] - want[s]) <= largest for s in sizes) and len(got) == len(texts)
    again = mixing.mix(docs.repartition(7), bucket_digits=1).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in got)


def test_mixing_of_odd_inputs(spark):
    assert mixing.mix(frame(spark, []).limit(0)).count() == 0
    assert [(r["size"], r["target"], r["taken"]) for r in mixing.mix(frame(spark, [None, ""])).collect()] == [(0, 0.0, 0)] * 2
    one = mixing.mix(frame(spark, ["a b", "c d", "e f", "g h"])).collect()
    assert sum(r["taken"] for r in one) == 12


@pytest.mark.parametrize("name", ["op5_mix_sources", "op7_decontaminate", "op10_quality_rules"])
def test_against_sql(spark, name):
    compare(queries.QUERIES[name](spark, SMALL).toPandas(), duck(SMALL).sql(queries.ORACLES[name]).df())


@pytest.mark.parametrize("name", ["op5_mix_sources", "op7_decontaminate", "op10_quality_rules"])
def test_native_plans_have_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
