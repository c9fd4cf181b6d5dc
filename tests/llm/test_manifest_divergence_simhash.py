"""SimHash links, the Merkle manifest and the divergence audit against restatements in
plain Python on small tables, with nulls, ties, repeats, hot groups and empty tables."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import pytest
import xxhash
from compare import connect, difference
from pyspark.sql import functions as F

from outreach.llm import divergence, merkle, simhash
from outreach.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, place string, tree int, fp double"


def table(spark, rows):
    """Documents with columns named like the operators' own ones."""
    return spark.createDataFrame([(*r, "x", 1, 2.0) for r in rows], SCHEMA)


def documents(n, rng, sources=3):
    vocabulary = [f"w{i}" for i in range(40)] + ["Ärger", "straße", "ΩMEGA", "co2"]
    rows = []
    for i in range(n):
        text = " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))
        source = "hot" if i % 3 == 0 else f"s{rng.randint(0, sources)}"
        rows.append((i * 7, text, rng.choice(["en", "de"]), source, len(text)))
    return rows


# SimHash ----------------------------------------------------------------------------


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(ids, linked):
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in linked:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


@pytest.mark.parametrize("text", [
    None, "", " \t\n", "one", "One TWO three", "a b c d", "a a a a a a", "Ä b\x0bc d e f", "x " * 40_000 + "y z", "naïve café ÀÉ \x85 end now",
])
def test_fingerprint_follows_its_definition(text):
    assert simhash.fingerprint(None if text is None else text.encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("bits,segments", [(4, 3), (4, 2), (3, 4), (5, 4), (0, 3)])
def test_every_near_pair_meets_in_a_cell(spark, bits, segments):
    rng = random.Random(bits * 10 + segments)
    values = [rng.getrandbits(64) for _ in range(30)]
    near = [v ^ sum(1 << b for b in rng.sample(range(64), bits)) for v in values]
    signed = [v - (1 << 64) if v >> 63 else v for v in values + near]
    nodes = spark.createDataFrame([(v,) for v in dict.fromkeys(signed)], "fp long")
    cells = defaultdict(list)
    for r in simhash.entries(nodes, bits, segments).collect():
        cells[r.cell].append((r.fp, r.own))
    met = {frozenset((a, b)) for c in cells.values() for a, x in c for b, y in c if x or y}
    assert all(frozenset(p) in met for p in zip(signed[:30], signed[30:]))


def fingerprint_rows(rng):
    """Families around a few centres, chains that drift, and lone ones."""
    out = []
    for _ in range(6):
        v = rng.getrandbits(64)
        for _ in range(40):
            out.append(v)
            v ^= sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6)))
    return out + [rng.getrandbits(64) for _ in range(200)]


@pytest.mark.parametrize("most", [simhash.CELL, 16])
def test_links_join_what_all_pairs_join(spark, most):
    values = list(dict.fromkeys(fingerprint_rows(random.Random(5))))
    want = components_of(values, [(a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= 4])
    sign = lambda v: v - (1 << 64) if v >> 63 else v
    nodes = spark.createDataFrame([(sign(v),) for v in values], "fp long")
    found = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(nodes, 4, 3, most).collect()]
    assert components_of(values, found) == want


def test_a_family_leaves_as_a_tree(spark):
    """2000 fingerprints around one: pairs are not made, and no node gets all links."""
    centre = 0x0F0F0F0F0F0F0F0F
    values = list(dict.fromkeys(centre ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(64)))[:2000]
    nodes = spark.createDataFrame([(v if v < 1 << 63 else v - (1 << 64),) for v in values], "fp long")
    found = simhash.links(nodes).collect()
    assert len(found) <= 24 * len(values)
    in_cell = simhash.tree(simhash.np.arange(2000))
    assert max(Counter(in_cell[1].tolist()).values()) <= 16 and len(in_cell[0]) == 1999
    assert len(set(components_of([n.fp for n in nodes.collect()], [tuple(r) for r in found]).values())) == 1


def test_simhash_components(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choices([f"v{i}" for i in range(300)], k=250)) for _ in range(8)]
    rows = []
    for i in range(120):
        words = rng.choice(base).split()
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = "changed"
        rows.append((1000 - i, " ".join(words), "en", "s", 1))
    rows += [(7, None, "en", "s", 1), (5, "", "en", "s", 1), (5, base[0], "en", "s", 1), (5, base[0], "en", "s", 1)]
    got = simhash.near_duplicates(table(spark, rows + [(None, base[0], None, None, None), (None, None, None, None, None)])).collect()
    prints = [(r[0], plain_fingerprint(r[1])) for r in rows]
    of = components_of(range(len(rows)), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i][1] ^ prints[j][1]).bit_count() <= 4])
    least = {}
    for i, part in of.items():
        least[part] = min(least.get(part, prints[i][0]), prints[i][0])
    want = sorted((d, f"{fp:016x}", least[of[i]]) for i, (d, fp) in enumerate(prints))
    assert sorted(tuple(r) for r in got if r.doc_id is not None) == want
    assert sorted((r.fingerprint, r.component_id) for r in got if r.doc_id is None) == sorted([("0" * 16, None), (f"{plain_fingerprint(base[0]):016x}", None)])


def test_simhash_of_nothing(spark):
    assert simhash.near_duplicates(table(spark, [])).collect() == []


def test_simhash_query_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    ids = sorted(prints)
    want = components_of(ids, [(a, b) for i, a in enumerate(ids) for b in ids[:i] if (prints[a] ^ prints[b]).bit_count() <= 4])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op11_simhash"](spark, sf_dir).collect()}
    assert got == {i: (f"{prints[i]:016x}", want[i]) for i in ids}


# Merkle manifest --------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def lower(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def climb(nodes, at):
    """Root of the nodes and the (left, right) of each level above node `at`."""
    path = []
    while len(nodes) > 1:
        start = at // 16 * 16
        path.append(("".join(nodes[start:at]), "".join(nodes[at + 1 : start + 16])))
        nodes = [sha(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
        at //= 16
    return nodes[0], path


def plain_manifest(rows):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[3]].append((r[0] is not None, r[0], plain_leaf(r, r[1]), r))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        by_source[s].sort(key=lambda x: (x[0], x[1] or 0, x[2]))
    subroots = [climb([x[2] for x in by_source[s]], 0)[0] for s in order]
    out = []
    for k, s in enumerate(order):
        nodes = [x[2] for x in by_source[s]]
        root, above = climb(subroots, k)
        for i, (_, doc_id, own, r) in enumerate(by_source[s]):
            path = climb(nodes, i)[1] + above
            touched = doc_id is not None and crc32(str(doc_id).encode()) % 5 == 0
            h = plain_leaf(r, lower(r[1])) if touched else own
            for a, b in path:
                h = sha(a, h, b)
            out.append((doc_id, own, subroots[k], root, sha(*[a + b for a, b in path]), h, h == root))
    return sorted(out, key=str)


def got_manifest(spark, rows):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in merkle.manifest(table(spark, rows), tampered).select(*columns).collect()), key=str)


@pytest.mark.parametrize("sizes", [[1], [2], [16], [17], [256], [257, 1, 16], [700, 3]])
def test_manifest_at_the_edges_of_runs_and_blocks(spark, sizes):
    rows = [(i * 3 + 1000 * k, f"Text {i}", "en", f"s{k}", i) for k, n in enumerate(sizes) for i in range(n)]
    random.Random(1).shuffle(rows)
    assert got_manifest(spark, rows) == plain_manifest(rows)


def test_manifest_of_many_sources_nulls_and_repeats(spark):
    rng = random.Random(2)
    rows = documents(300, rng) + [(i, "A b", None, f"own{i}", None) for i in range(300)]
    rows += [(None, None, None, None, None)] * 3 + [(None, "X", "en", None, 1), (21, "Twice", "en", "hot", 5), (21, "Twice", "en", "hot", 5), (21, None, "en", "hot", 5)]
    rows += [(9, "", "", "", 0), (-4, "Long " * 50_000, "é", "É", -1)]
    assert got_manifest(spark, rows) == plain_manifest(rows)


def test_manifest_of_nothing(spark):
    assert merkle.manifest(table(spark, []), F.lit(True)).collect() == []


def test_a_changed_row_is_told_from_an_unchanged_one(spark):
    rows = [(i, "No capitals" if i % 2 else "none", "en", f"s{i % 3}", 1) for i in range(50)]
    out = merkle.manifest(table(spark, rows), F.lit(True)).collect()
    assert {r.doc_id for r in out if not r.verified} == {i for i in range(50) if i % 2}


# Divergence audit -------------------------------------------------------------------


def plain_audit(rows, top):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text or ""))
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= 3]
        own = [s for g, s in groups if g == lang]
        whole = Counter()
        for s in own:
            whole.update({t: counts[lang, s][t] for t in kept})

        def prices(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: prices(counts[lang, s]) for s in own}
        q = prices(whole)
        f = lambda a, b: (a - b) ** 2 // b
        for s in own:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in own if o != s]
            words = [(t, f(p[s][t], q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", words, top)):
                for rank, (item, value) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most], 1):
                    out.append((lang, s, part, item, value, rank))
    return sorted(out)


def got_audit(spark, rows, **options):
    return sorted(tuple(r) for r in divergence.audit(table(spark, rows), **options).select("lang", "source", "part", "item", "value", "rank").collect())


def test_audit_equals_the_sum_over_terms(spark):
    rng = random.Random(4)
    rows = documents(200, rng, sources=6)
    rows += [(1, None, "fr", "only", 0), (2, "", None, None, 0), (3, "a B a1b", None, "x", 0), (4, "rare words", "fr", "s1", 0)]
    rows += [(5, "Zz " * 3000, "en", "s1", 0), rows[3], rows[3]]
    assert got_audit(spark, rows, top=10) == plain_audit(rows, 10)


def test_audit_in_small_blocks(spark, monkeypatch):
    rows = documents(150, random.Random(6), sources=9)
    for name, value in (("ROWS", 3), ("COLUMNS", 20), ("PIECE", 7), ("ENTRIES", 50), ("_CHUNK", 10)):
        monkeypatch.setattr(divergence, name, value)
    assert got_audit(spark, rows) == plain_audit(rows, 200)


def test_joint_values_in_pieces(monkeypatch):
    """One block against the definition, with pieces of three columns."""
    monkeypatch.setattr(divergence, "PIECE", 3)
    rng = random.Random(8)
    level = [[rng.randint(0, 3) for _ in range(5)] for _ in range(30)]
    columns, rows, own = {}, [], []
    for t, counts in enumerate(level):
        for g, c in enumerate(counts):
            if c:
                rows.append(t)
                own.append(columns.setdefault((g, 10 + c), len(columns)))
    group, p = (divergence.np.array(v, dtype="int64") for v in zip(*columns))
    got = Counter()
    for a, b, v in divergence.joint_value(divergence.np.array(own), divergence.np.array(rows), group, p, divergence.np.full(len(p), 10), 30):
        got[a, b] += v
    f = lambda s, t: (s - t) ** 2 // t
    for a in range(5):
        for b in range(5):
            want = sum(f(10 + x[a], 10 + x[b]) - f(10 + x[a], 10) - f(10, 10 + x[b]) for x in level if x[a] and x[b] and a != b)
            assert got[a, b] == want


def test_audit_of_nothing(spark):
    assert divergence.audit(table(spark, [])).collect() == []
    assert got_audit(spark, [(1, None, None, None, None)]) == []


def test_prices_do_not_overflow(spark):
    rows = spark.createDataFrame([(4 * 10**18, 4 * 10**18, 10**6)], "c long, n long, v long")
    got = rows.select(divergence.price(F.col("c"), F.col("n"), F.col("v"))).first()[0]
    assert got == 1 + 10**9 * (4 * 10**18 + 1) // (4 * 10**18 + 10**6)


@pytest.mark.parametrize("name", ["op12_merkle_manifest", "op13_divergence"])
def test_query_equals_its_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None
