"""The training-data operators against plain versions, on small tables with awkward rows."""

import hashlib
import math
import pickle
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pytest

from portico.llm import embedding_join, exact_dedup, jaccard_join, licenses, mixing, packing, quality, suffix_dedup, toxicity, url_rules
from portico.llm.common import components, lean, local_components
from portico.llm.hashing import text_buffer
from portico.llm.tokens import style_grams

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, count long, key string"


def docs_of(spark, rows):
    """Rows of (doc_id, text, source) as documents with extra columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 7, "k") for i, t, s in rows], DOCS)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def corpus(seed=0, n=60):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeé") for _ in range(r.randint(2, 7))) for _ in range(300)]
    text = lambda k: " ".join(r.choice(vocabulary) for _ in range(k))
    shared, base = text(40), text(60)
    rows = [(i, text(r.randint(1, 80)), f"s{i % 3}") for i in range(n)]
    rows += [(100 + i, f"{text(12)} {shared} {text(9)}", "s0") for i in range(12)]
    for i in range(15):
        w = base.split()
        w[r.randrange(len(w))] = r.choice(vocabulary)
        rows.append((200 + i, " ".join(w), "s1"))
    rows += [(300, base, "s1"), (301, base.upper(), None), (302, None, None), (303, "", "s2"), (304, " \t\n ", "s2"), (305, "one", "s2"), (306, "a b c", "s2"), (307, "A b  c", "s2")]
    rows += [(308, "x" * 400, "s2"), (309, "y " * 300, "s2"), (310, text(3000), "s0"), (311, "é" * 120, "s0"), (312, "é" * 120, "s0"), (313, text(25) + "\x00\U0001F600 end", "s1")]
    return rows


def rows_of(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def brute_repeats(rows, width):
    seen, out = set(), {}
    for i, t, _ in sorted(rows):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - width + 1):
            w = b[k : k + width]
            if w in seen:
                gone[k : k + width] = True
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        out[i] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_dedup(spark):
    rows = corpus(1)
    df = docs_of(spark, rows).repartition(5)
    found = rows_of(suffix_dedup.suffix_dedup(df))
    want = brute_repeats(rows, 100)
    assert {i: tuple(r)[1:5] for i, r in found.items()} == want
    assert sum(w[1] for w in want.values()) > 1000
    r = found[312]
    assert [(s["start"], s["end"]) for s in r["spans"]] == [(0, 240)]


def test_suffix_dedup_odd_tables(spark):
    assert suffix_dedup.suffix_dedup(docs_of(spark, [])).count() == 0
    got = [tuple(r)[:4] for r in suffix_dedup.suffix_dedup(docs_of(spark, [(None, "a" * 150, None), (1, "b" * 99, None), (1, "b" * 99, None), (2, None, None)])).collect()]
    assert sorted(got, key=str) == [(1, 99, 0, 0), (1, 99, 0, 0), (2, 0, 0, 0), (None, 150, 0, 0)]


def test_suffix_dedup_repeated_ids(spark):
    """Rows that share an id are documents of their own, in order of their texts' hashes."""
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdef") for _ in range(6))
    a, b, c = (" ".join(word() for _ in range(40)) for _ in range(3))
    rows = [(5, f"{a} {b}", None), (5, f"{b} {c}", None), (5, f"{b} {c}", None), (3, f"{c} x", None), (7, f"y {a}", None), (7, None, None), (None, a, None)]
    found = sorted((str(x["doc_id"]), x["kept_sha256"], x["n_removed"]) for x in suffix_dedup.suffix_dedup(docs_of(spark, rows).repartition(3)).collect())
    own = sorted({(i, t or "") for i, t, _ in rows if i is not None}, key=lambda x: (x[0], hashlib.sha256(x[1].encode()).hexdigest()))
    want = brute_repeats([(k, t, None) for k, (_, t) in enumerate(own)], 100)
    at = {x: k for k, x in enumerate(own)}
    expect = [(str(i), want[at[i, t or ""]][3], want[at[i, t or ""]][1]) for i, t, _ in rows if i is not None] + [("None", hashlib.sha256(a.encode()).hexdigest(), 0)]
    assert found == sorted(expect)
    assert sum(x[2] for x in found) > 400


def test_suffix_dedup_deals_phrases_evenly():
    """No bucket of packed phrases holds much more than its share."""
    r = np.random.default_rng(0)
    batch = pa.record_batch([pa.array(range(60), pa.int64()), pa.array(["".join(map(chr, r.integers(97, 123, 5000))) for _ in range(60)])], names=["doc_id", "text"])
    size = Counter()
    for out in suffix_dedup._phrase_blobs(100, 32, 64)(iter([batch])):
        for kind, bucket, blob in zip(out["kind"].to_pylist(), out["bucket"].to_pylist(), out["blob"].to_pylist(), strict=True):
            size[bucket] += len(blob) if kind == 1 else 0
    assert max(size.values()) < 1.5 * sum(size.values()) / 64


def test_exact_dedup(spark):
    rows = corpus(2) + [(401, "Same TEXT", "s"), (402, "same text", "s"), (403, "SAME text", None), (404, "É", "s"), (405, "é", "s")]
    found = rows_of(exact_dedup.exact_dedup(docs_of(spark, rows)))
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[lower(t)].append(i)
    for norm, ids in groups.items():
        for i in ids:
            assert tuple(found[i]) == (i, max(ids), len(ids), i == max(ids), hashlib.sha256(norm.encode()).hexdigest())
    assert exact_dedup.exact_dedup(docs_of(spark, [])).count() == 0
    odd = exact_dedup.exact_dedup(docs_of(spark, [(None, "a", None), (None, "b", None), (3, "b", None)])).collect()
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"]) for r in odd) == [("3", "3", 2, True), ("None", "3", 2, False), ("None", "None", 1, True)]


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    names = sorted([s for s in sizes if s is not None], key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    capped, left = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in capped]
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total >= most * sizes[s]]
        if not over:
            return capped | {s: left * weight[s] / total for s in open_}
        for s in over:
            capped[s] = float(most * sizes[s])
            left -= capped[s]


def test_mixing(spark):
    rows = corpus(3)
    df = docs_of(spark, rows)
    found = rows_of(mixing.mix_sources(df))
    size = {i: len(WORD.findall(t or "")) for i, t, _ in rows}
    by_source, taken = Counter(), Counter()
    for i, _, s in rows:
        by_source[s] += size[i]
        taken[s] += found[i]["taken"]
        assert found[i]["size"] == size[i]
        assert found[i]["taken"] == found[i]["copies"] * size[i] <= 2 * size[i]
    targets = brute_targets(dict(by_source))
    for i, _, s in rows:
        assert found[i]["source_size"] == by_source[s]
        assert found[i]["target"] == pytest.approx(targets[s])
    for s, t in targets.items():
        assert abs(taken[s] - t) <= max(size[i] for i, _, x in rows if x == s)
    again = rows_of(mixing.mix_sources(df.repartition(3)))
    assert {i: tuple(r) for i, r in again.items()} == {i: tuple(r) for i, r in found.items()}
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter({i: r["copies"] for i, r in found.items() if r["copies"]})
    assert mixing.mix_sources(docs_of(spark, [])).count() == 0
    assert mixing.mix_sources(docs_of(spark, [(None, None, None), (1, "", "a")])).agg({"taken": "sum"}).first()[0] == 0


def test_mixed_documents_by_source(spark):
    """Rows that share an id, or have none, are taken as often as their own source says."""
    rows = [(None, f"a b c {k}", s) for k, s in enumerate("xyz")] + [(7, "one two", "x"), (7, "three", "y"), (7, "four five six", None)]
    rows += [(100 + i, "w " * (5 + i), "xyz"[i % 3]) for i in range(30)]
    df = docs_of(spark, rows)
    want = Counter()
    for r in mixing.mix_sources(df).collect():
        want[r["doc_id"], r["source"]] += r["copies"]
    assert len({want[None, s] for s in "xyz"}) > 1
    assert Counter((r["doc_id"], r["source"]) for r in mixing.mixed_documents(df).collect()) == +want


def brute_sets(rows, n=5):
    out = {}
    for i, t, _ in rows:
        w = WORD.findall(lower(t))
        out[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    return out


def brute_components(sets):
    ids = sorted(sets)
    at = {i: k for k, i in enumerate(ids)}
    a, b = [], []
    for x in ids:
        for y in ids:
            if x < y and sets[x] and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                a.append(at[x])
                b.append(at[y])
    return {i: ids[k] for i, k in zip(ids, local_components(len(ids), np.array(a, int), np.array(b, int)), strict=True)}


@pytest.mark.parametrize("seed", [4, 5])
def test_jaccard_join(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LIST_BLOCK", 3)
    monkeypatch.setattr(jaccard_join, "TIERS", (4, 8, 64))
    monkeypatch.setattr(jaccard_join, "SIGNED", 3)
    rows = corpus(seed)
    found = rows_of(jaccard_join.jaccard_components(docs_of(spark, rows).repartition(3)))
    sets = brute_sets(rows)
    want = brute_components(sets)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in found.items()} == {i: (len(sets[i]), want[i]) for i in sets}
    assert len(set(want.values())) < len(want) - 10
    odd = jaccard_join.jaccard_components(docs_of(spark, [(None, "a b c d e f", None), (2, "a b c d e f", None), (2, "a b c d e f", None), (3, None, None)])).collect()
    assert sorted((str(r[0]), r[1], str(r[2])) for r in odd) == [("2", 2, "2"), ("2", 2, "2"), ("3", 0, "3"), ("None", 2, "None")]
    kept = jaccard_join.first_of_each(docs_of(spark, rows))
    assert kept.columns == docs_of(spark, []).columns
    assert {r["doc_id"] for r in kept.collect()} == set(want.values())


@pytest.mark.parametrize("signed", [2, 1 << 30])
def test_jaccard_list_pairs(spark, signed, monkeypatch):
    """The last round alone, without leaders, finds all links with and without signatures."""
    monkeypatch.setattr(jaccard_join, "SIGNED", signed)
    rows = corpus(5)
    found = rows_of(jaccard_join.jaccard_components(docs_of(spark, rows).repartition(3)))
    assert {i: r["component_id"] for i, r in found.items()} == brute_components(brute_sets(rows))


def test_jaccard_repeated_ids(spark):
    """Texts that share an id are judged each by its own set."""
    a, b = "a b c d e f g h i j k l m n o p q r s t u v", "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 21 22"
    rows = [(5, a, None), (5, b, None), (1, a + " w", None), (2, b + " 23", None)]
    found = jaccard_join.jaccard_components(docs_of(spark, rows).repartition(2)).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in found) == [(1, 1), (2, 2), (5, 1), (5, 2)]


def test_signatures():
    r = np.random.default_rng(3)
    for _ in range(50):
        x, y = (np.unique(r.integers(0, 4000, r.integers(1, 3000)).astype(np.uint64)) for _ in range(2))
        apart = len(np.setxor1d(x, y))
        signs = np.stack([jaccard_join.signature(x), jaccard_join.signature(y)])
        differ = int(np.bitwise_count(signs[0] ^ signs[1]).sum())
        assert differ <= apart
        assert jaccard_join.differing(signs, np.array([0]), np.array([1])).tolist() == [differ]


def test_jaccard_join_empty(spark):
    assert jaccard_join.jaccard_components(docs_of(spark, [])).count() == 0


def test_components(spark):
    r = random.Random(6)
    edges = [(r.randrange(300) - 50, r.randrange(300) - 50) for _ in range(200)] + [(1000 + k, 1001 + k) for k in range(70)] + [(5, 5)]
    found = {x["vertex"]: x["component"] for x in components(spark.createDataFrame(edges, "a long, b long").repartition(7), "a", "b").collect()}
    names = sorted({x for e in edges if e[0] != e[1] for x in e})
    at = {x: k for k, x in enumerate(names)}
    label = local_components(len(names), np.array([at[a] for a, b in edges if a != b]), np.array([at[b] for a, b in edges if a != b]))
    assert found == {x: names[k] for x, k in zip(names, label, strict=True)}
    assert min(found[1000 + k] for k in range(71)) == max(found[1000 + k] for k in range(71)) == 1000


def test_embedding_links(spark, monkeypatch):
    r = np.random.default_rng(7)
    x = r.normal(size=(120, 16))
    x[40:80] = x[:40] + r.normal(size=(40, 16)) * r.uniform(0.02, 0.3, size=(40, 1))
    rows = [(i, [float(v) for v in np.float32(x[i])], int(i % 2)) for i in range(120)]
    rows += [(200 + k, rows[3][1], 1) for k in range(4)] + [(210, [0.0] * 16, 1), (211, None, 1), (212, rows[3][1], None), (213, [1.0, None] + [0.0] * 14, 1), (214, [float("nan")] * 16, 1), (215, [float("inf")] + [0.0] * 15, 1), (216, [], 1), (217, [2.0], 1), (218, [3.0], 1), (219, [1e300 / 1e262] * 16, 0), (220, [1.0] * 16, 0)]
    df = spark.createDataFrame([(*row, "x", 1) for row in rows], "vec_id long, embedding array<float>, label int, key string, links long")
    found = rows_of(embedding_join.embedding_links(df, tile=16), "vec_id")
    ids = [row[0] for row in rows]
    links, a, b = Counter(), [], []
    for p, (i, u, l) in enumerate(rows):
        for q, (j, v, m) in enumerate(rows):
            if i >= j or l != m or l is None or not u or not v or len(u) != len(v) or None in u or None in v:
                continue
            s, t = np.array(np.float32(u), float), np.array(np.float32(v), float)
            if not (np.isfinite(s).all() and np.isfinite(t).all() and s.any() and t.any()):
                continue
            if (s / np.linalg.norm(s)) @ (t / np.linalg.norm(t)) >= 0.98:
                links[i] += 1
                links[j] += 1
                a.append(p)
                b.append(q)
    low = local_components(len(ids), np.array(a), np.array(b))
    assert sum(links.values()) > 60
    for k, i in enumerate(ids):
        assert tuple(found[i]) == (i, links[i], ids[low[k]], ids[low[k]] == i)
    assert embedding_join.embedding_links(df.limit(0)).count() == 0


def test_embedding_links_of_repeated_ids(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.01], 0), (2, [0.0, 1.0], 0), (2, [0.0, 1.0], 0), (2, [5.0, 0.0], 1), (None, [1.0, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in embedding_join.embedding_links(df).collect())
    assert found == [("1", 1, "1", True), ("1", 1, "1", True), ("2", 0, "2", True), ("2", 1, "2", True), ("2", 1, "2", True), ("None", 0, "None", False)]


def test_quantisation_bound():
    r = np.random.default_rng(8)
    x = r.normal(size=(300, 64)) * r.uniform(0.1, 3, size=(1, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    i, j = embedding_join.possible(embedding_join.quantise(x), embedding_join.quantise(x), 0.5)
    assert set(zip(*np.nonzero(x @ x.T >= 0.5), strict=True)) <= set(zip(i, j, strict=True))
    assert len(i) < 3 * (x @ x.T >= 0.5).sum() + 300


def test_url_filter(spark):
    urls = ["http://Example.ORG/en/12?x#y", "https://a.b.example.org/es/1", "https://example.org/es", "http://org", "http://xorg/", "http://notexample.org/es/", "ftp://shop.com/fr/x?de", "http://shop.com/de/", "http://shop.com?/de/", None, "no scheme", "http://", "://com/de/x://org/", "http://com/fr/", "http://..com/de/a\nb", "http://é.com/de/é"] * 2
    df = spark.createDataFrame([(k if k else None, u, "h", "r") for k, u in enumerate(urls)], "page_id long, url string, html string, rule string")
    for rules in (url_rules.RULES, [("com", "/", "allow"), ("com", "/d", "block"), ("com", "/de", "allow"), ("com", "/de/", "block"), ("com", "/de/", "allow"), ("com", "/f", "block"), ("shop.com", "/de/", "allow"), ("b.example.org", "/", "block")]):
        found = url_rules.filter_urls(df, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
        want = []
        for k, u in enumerate(urls):
            rest = (u or "").partition("://")[2]
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host) :])[0]
            host = lower(host)
            fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
            best = max(fits, default=None)
            want.append((str(k or None), host, path, str(best and best[2]), best[3] if best else "allow"))
        assert sorted((str(r[0]), r[1], r[2], str(r[3]), r[4]) for r in found) == sorted(want)
    assert url_rules.query(spark, df.limit(0)).count() == 0
    assert [tuple(r) for r in url_rules.rule_table(spark, url_rules.RULES).collect()] == url_rules.RULES


def test_license_scan(spark):
    mit = "Released under the MIT license!"
    rows = [(1, f"words before\n{mit}\nafter", "s"), (2, mit, "s"), (3, "nothing of the kind", "s"), (4, None, "s"), (5, "", None), (6, "This program is free software", "s"), (7, dict(licenses.TEMPLATES)["ISC"].replace("any purpose", "some purpose"), "s"), (None, mit, "s"), (8, "a " * 5000 + "\nLicensed under the Apache License, Version 2.0.", "s")]
    found = {r["doc_id"]: r for r in licenses.license_scan(docs_of(spark, rows)).collect()}

    def dice(a, b):
        a, b = set(licenses.template_bigrams(a)), set(licenses.template_bigrams(b))
        return 2 * len(a & b) / (len(a) + len(b)) if a and b else 0

    for i, t, _ in rows:
        units = [t or "", *((t or "").split("\n") if "\n" in (t or "") else [])]
        best = [min(((-dice(u, b), n) for n, b in licenses.TEMPLATES), default=None) for u in units]
        hits = [b for b in best if -b[0] >= 0.8]
        assert (found[i]["n_units"], found[i]["n_matches"], found[i]["license"]) == (len(units), len(hits), min(hits)[1] if hits else None)
    assert licenses.license_scan(docs_of(spark, [])).count() == 0


def test_license_passages(spark):
    """Wrapped, full and inline notices are found; each row against all windows tried in Python."""
    import textwrap

    body, short = dict(licenses.BODIES), dict(licenses.TEMPLATES)
    wrapped = "\n".join(" * " + line for line in textwrap.wrap(body["MIT"], 60))
    gpl = "\n# ".join(textwrap.wrap(dict(licenses.BODIES)["GPL-3.0"], 50))
    prose = " ".join(f"word{k}" for k in range(200))
    rows = [(1, f"Copyright 2020\n\n{wrapped}\n\n{prose}", "s"), (2, f"{prose} # {gpl}", "s"), (3, f"{prose}\n{textwrap.fill(body['BSD-3-Clause'], 70)}", "s"), (4, f"The code is Released under the MIT License. {prose}", "s"), (5, textwrap.fill(short["ISC"], 40) + prose, "s")]
    rows += [(6, prose, "s"), (7, None, None), (8, "", None), (9, "license", None), (10, "This program is free software and the License of it", "s"), (None, "a " * 5000 + "\nLicensed under CC BY-NC 4.0.", "s")]
    found = {r["doc_id"]: r for r in licenses.license_passages(docs_of(spark, rows)).collect()}
    for i, text, _ in rows:
        w = re.sub(licenses.BREAK, " ", lower(text)).split()
        pairs = [f"{x} {y}" for x, y in zip(w, w[1:], strict=False)]
        best = []
        for name, t in licenses.TEMPLATES + licenses.BODIES:
            b = set(licenses.template_bigrams(t))
            dice = [2 * len(b & set(g)) / (len(set(g)) + len(b)) for g in (pairs[k : k + len(b)] for k in range(len(pairs)) if pairs[k] in b)]
            best += [(-max(dice), name)] if dice and max(dice) >= 0.8 else []
        assert (found[i]["n_licenses"], found[i]["license"], found[i]["dice"]) == (len({n for _, n in best}), min(best)[1] if best else None, round(-min(best)[0], 9) if best else None)
    assert [found[k]["license"] for k in (1, 2, 3, 4, 5, None)] == ["MIT", "GPL-3.0", "BSD-3-Clause", "MIT", "ISC", "CC-BY-NC-4.0"]
    missed = {r["doc_id"] for r in licenses.license_scan(docs_of(spark, rows)).where("license is null").collect()}
    assert {1, 2, 3, 4} <= missed
    assert licenses.license_passages(docs_of(spark, [])).count() == 0


def test_packing(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    rows = corpus(9) + [(400, "a<|endoftext|>b don't\r\n\u3000 \u00a0 12³½ ǅ\u200b", "s"), (401, "word " * 3000, "s")]
    pieces = packing.pack(docs_of(spark, rows).repartition(2)).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append((p["start"], np.frombuffer(p["ids"], "<u4"), p))
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    for i, t, _ in rows:
        want = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        mine = sorted(by_doc[i], key=lambda x: x[0])
        assert np.concatenate([m[1] for m in mine]).tolist() == want
        at = 0
        for start, ids, p in mine:
            assert (start, p["length"], p["doc_tokens"]) == (at, len(ids), len(want))
            at += len(ids)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(p["length"] for p in pieces)
    assert len(by_sequence) <= total / 1024 * 1.05 + 4
    digest = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in packing.digest(packing.pack(docs_of(spark, rows))).collect()}
    for p in packing.pack(docs_of(spark, rows)).collect():
        assert digest[p["doc_id"], p["start"]] == zlib.crc32(p["ids"])
    assert packing.pack(docs_of(spark, [])).count() == 0
    assert [r["length"] for r in packing.pack(docs_of(spark, [(None, None, None)])).collect()] == [1]


def test_differencing():
    r = random.Random(10)
    for _ in range(60):
        sizes = [r.randint(1, 384) for _ in range(r.randint(1, 300))]
        windows = packing.balanced(sizes, 1024)
        assert sorted(k for w in windows for k in w) == list(range(len(sizes)))
        loads = [sum(sizes[k] for k in w) for w in windows]
        assert max(loads) <= 1024
        assert len(windows) <= sum(sizes) / 1024 * 1.03 + 2


def labelled(spark, n=400):
    r = random.Random(11)
    words = ["".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(200)]
    rows, labels = [], []
    for i in range(n):
        text = [r.choice(words) for _ in range(r.randint(5, 60))]
        bad, toxic = i % 6 == 0, i % 5 == 0
        if toxic:
            text[:: 4] = [r.choice(["vile", "nasty", "awful"]) for _ in text[::4]]
        if bad:
            text = [w.upper() + "!!" for w in text] if i % 2 else [w for w in text[:4] for _ in range(9)]
        rows.append((i, " ".join(text), "s"))
        if i % 2 == 0 or i % 3 == 0:
            labels.append((i, int(not bad), int(toxic)))
    return docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality(spark):
    df, labels = labelled(spark)
    found = rows_of(quality.quality_scores(df, labels))
    wrong = sum(r["kept"] != (i % 6 != 0) for i, r in found.items())
    assert len(found) == 400
    assert wrong <= 12
    odd = docs_of(spark, [(1, None, None), (2, "", None), (None, "word", None), (3, "a b", None), (3, "a b", None)])
    assert quality.quality_scores(odd, labels.limit(0)).where("kept").count() == 5
    assert quality.quality_scores(odd.limit(0), labels).count() == 0
    good = quality.good_documents(df, labels)
    assert good.columns == df.columns
    assert good.count() == sum(r["kept"] for r in found.values())


def test_quality_sample_is_the_top_k(spark):
    df, labels = labelled(spark, 200)
    rows = quality.quality_scores(df, labels, length=0.05).collect()
    k = sum(r["kept"] for r in rows)
    assert 100 < k < 200
    assert min(r["log_ratio"] for r in rows if r["kept"]) < max(r["log_ratio"] for r in rows if not r["kept"])


def test_quality_keeps_ties_at_the_end(spark):
    """Rows that repeat an id and its text stay or go together, and at least k stay."""
    df, labels = labelled(spark, 120)
    rows = [(r["doc_id"], r["text"], "s") for r in df.collect() for _ in range(7 if r["doc_id"] % 6 else 1)]
    many = docs_of(spark, rows).repartition(3)
    k = quality.quality_scores(many, labels, length=float("inf")).where("kept").count()
    kept = Counter(r["doc_id"] for r in quality.quality_scores(many, labels, length=0.05).where("kept").collect())
    assert k <= sum(kept.values()) < k + 7
    assert all(n == (7 if i % 6 else 1) for i, n in kept.items())


def test_quality_against_a_plain_version(spark):
    """Ratios, noise and the k kept, from counts and a sort in plain Python."""
    df, labels = labelled(spark, 150)
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    told = {r["doc_id"]: r["quality"] for r in labels.collect()}
    half = quality.BUCKETS // 2
    grams = {i: style_grams(*text_buffer(pa.array([t])), quality.BUCKETS)[0].tolist() for i, t in texts.items()}
    raw, target = [1] * quality.BUCKETS, [1] * quality.BUCKETS
    for i, own in grams.items():
        for g in own:
            raw[g] += 1
            target[g] += told.get(i) == 1
    sums = [(sum(target[s]), sum(raw[s])) for s in (slice(0, half), slice(half, None))]
    ratio = [math.log(target[g] / sums[g >= half][0]) - math.log(raw[g] / sums[g >= half][1]) for g in range(quality.BUCKETS)]
    score = {i: sum(ratio[g] for g in own) / len(own) for i, own in grams.items()}
    ids = sorted(told)
    cut = quality.best_cut(np.array([score[i] for i in ids]), np.array([told[i] == 1 for i in ids]))
    k = sum(s >= cut for s in score.values())
    for length in (quality.LENGTH, 2.0):
        uniform = {i: (int(hashlib.md5(f"gumbel{i}".encode()).hexdigest()[:15], 16) + 0.5) / 2**60 for i in texts}  # the rank's MD5 of the noise's name
        key = {i: length * score[i] - math.log(-math.log(uniform[i])) for i in texts}
        best = set(sorted(key, key=key.get, reverse=True)[:k])
        found = rows_of(quality.quality_scores(df, labels, length=length))
        assert {i for i, r in found.items() if r["kept"]} == best
        assert all(r["score"] == pytest.approx(score[i], abs=1e-9) and r["n_grams"] == len(grams[i]) for i, r in found.items())


def test_best_cut():
    assert quality.best_cut(np.array([1.0, 2, 3, 4]), np.array([False, False, True, True])) == 2.5
    assert quality.best_cut(np.array([1.0, 2]), np.array([True, True])) == float("-inf")


def test_toxicity(spark):
    df, labels = labelled(spark)
    found = rows_of(toxicity.toxicity(df, labels))
    for i, r in found.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
        assert r["predicted"] == (r["score"] >= 0.5)
    assert sum(r["predicted"] != (i % 5 == 0) for i, r in found.items() if i % 6) <= 12
    odd = docs_of(spark, [(1, None, None), (2, "", None), (None, "nasty", None), (3, "vile", None), (3, "vile", None)])
    assert toxicity.toxicity(odd, labels).count() == 5
    assert {r["score"] for r in toxicity.toxicity(odd, labels.limit(0)).collect()} == {0.0}
    assert toxicity.toxicity(odd.limit(0), labels).count() == 0


def test_block_max_search_is_exact():
    r = np.random.default_rng(12)
    x = r.random((500, 40)) * (r.random((500, 40)) < 0.1)
    x = x[x.sum(axis=1) > 0]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    example, term = np.nonzero(x)
    index = toxicity.Index(40, np.arange(len(x)), np.zeros(len(x)), example, term, x[example, term])
    for q in x[:100]:
        at = np.flatnonzero(q)
        hit, cos = index.nearest(at, q[at], 7)
        all_ = x @ q
        want = sorted(((-round(c, 12), i) for i, c in enumerate(all_) if c > 0))[:7]
        assert [int(index.ids[h]) for h in hit] == [i for _, i in want]
        assert np.allclose(cos, [-c for c, _ in want])


def plain_toxicity(texts, told, chance=0.001, k=16):
    """Scores from dictionaries and full sorts, by the rules that `toxicity` states."""
    bags = {i: Counter(re.findall(r"[0-9a-z\u0080-\U0010ffff]+", lower(t))) for i, t in texts.items()}
    df = Counter(w for b in bags.values() for w in b)
    idf = {w: math.log((len(texts) + 1) / d) for w, d in df.items()}
    known = {i: y for i, y in told.items() if i in texts and zlib.crc32(str(i).encode()) % 5}
    n, pos = len(known), sum(known.values())
    here, toxic = Counter(w for i in known for w in bags[i]), Counter(w for i, y in known.items() if y for w in bags[i])
    z = NormalDist().inv_cdf(min(chance / len(here), 1) / 2)

    def g(w):
        c, a, p = here[w], toxic[w], pos / n
        cells = [(a, c * p), (c - a, c * (1 - p)), (pos - a, (n - c) * p), (n - c - pos + a, (n - c) * (1 - p))]
        return 2 * sum(o * math.log(o / e) for o, e in cells if o > 0)

    kept = {w for w in here if g(w) > z * z}

    def vector(i):
        v = {w: (1 + math.log(m)) * idf[w] for w, m in bags[i].items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items() if w in kept} if norm else {}

    unit = {i: vector(i) for i in texts}

    def vote(i, without=None):
        near = [(sum(x * unit[j].get(w, 0) for w, x in unit[i].items()), j) for j in known if j != without]
        near = sorted(((-round(c, 12), j) for c, j in near if c > 0))[:k]
        weights = [1 / max(1 + c, 0.05) - 1 for c, _ in near]
        return (sum(w * known[j] for w, (_, j) in zip(weights, near, strict=True)) + 0.01 * pos / n) / (sum(weights) + 0.01) if near else None

    asked = {i: vote(i, i) for i in known}
    alone = [known[i] for i, v in asked.items() if v is None]
    x, y = toxicity.calibration(np.array([v for v in asked.values() if v is not None]), np.array([float(known[i]) for i, v in asked.items() if v is not None]))

    def score(i):
        v = vote(i)
        if v is None:
            return sum(alone) / len(alone) if alone else pos / n
        return float(y[max(int(np.searchsorted(x, v + 1e-9, side="right")) - 1, 0)])

    return kept, {i: score(i) for i in texts}


def test_toxicity_against_a_plain_version(spark):
    df, labels = labelled(spark, 200)
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    told = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    kept, want = plain_toxicity(texts, told)
    found = {r["doc_id"]: r["score"] for r in toxicity.toxicity(df.repartition(5), labels).collect()}
    assert {"vile", "nasty", "awful"} <= kept
    assert set(found) == set(want)
    off = [i for i in want if abs(want[i] - found[i]) > 1e-6]
    assert not off, [(i, want[i], found[i]) for i in off[:5]]


def test_toxicity_indexes_every_telling_word(spark):
    """A lexicon of 700 words is found as a whole: no bound on the number of terms."""
    r = random.Random(3)
    plain, rude = [f"w{i}" for i in range(400)], [f"rude{i}" for i in range(700)]
    rows, labels = [], []
    for i in range(1500):
        words = [r.choice(plain) for _ in range(30)]
        if i % 3 == 0:
            words += r.sample(rude, 40)
        rows.append((i, " ".join(words), "s"))
        labels.append((i, 0, int(i % 3 == 0)))
    model = toxicity.fit(docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert len(model.words.names) >= 690
    few = np.array([toxicity.word_hashes(*text_buffer(pa.array([" ".join(plain[:300] + ["rude699"])])))[0]][0])
    term, n = np.unique(few, return_counts=True)
    at, w = model.words.weigh(term, n)
    assert (w * w).sum() < 0.2


def plain_scores(texts, told, k=16):
    """Scores over all words, each weighed by 1 + G, from dictionaries and full sorts; also the examples' words."""
    bags = {i: Counter(re.findall(r"[0-9a-z\u0080-\U0010ffff]+", lower(t))) for i, t in texts.items()}
    df = Counter(w for b in bags.values() for w in b)
    known = {i: y for i, y in told.items() if i in texts and zlib.crc32(str(i).encode()) % 5}
    n, pos = len(known), sum(known.values())
    here, toxic = Counter(w for i in known for w in bags[i]), Counter(w for i, y in known.items() if y for w in bags[i])

    def weight(w):
        c, a, p = here[w], toxic[w], pos / n
        cells = [(a, c * p), (c - a, c * (1 - p)), (pos - a, (n - c) * p), (n - c - pos + a, (n - c) * (1 - p))] if c else []
        return math.log((len(texts) + 1) / df[w]) * (1 + 2 * sum(o * math.log(o / e) for o, e in cells if o > 0))

    def vector(i):
        v = {w: (1 + math.log(m)) * weight(w) for w, m in bags[i].items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    unit = {i: vector(i) for i in texts}

    def vote(i, without=None):
        near = [(sum(x * unit[j].get(w, 0) for w, x in unit[i].items()), j) for j in known if j != without]
        near = sorted(((-round(c, 12), j) for c, j in near if c > 0))[:k]
        weights = [1 / max(1 + c, 0.05) - 1 for c, _ in near]
        return (sum(w * known[j] for w, (_, j) in zip(weights, near, strict=True)) + 0.01 * pos / n) / (sum(weights) + 0.01)

    x, y = toxicity.calibration(np.array([vote(i, i) for i in known]), np.array([float(v) for v in known.values()]))
    return set(here), {i: float(y[max(int(np.searchsorted(x, vote(i) + 1e-9, side="right")) - 1, 0)]) for i in texts}


def test_toxicity_query_compares_whole_texts(spark, tmp_path):
    """The query's scores are those of a plain search in which no word is left out."""
    from portico.llm import queries

    df, labels = labelled(spark, 200)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    words, want = plain_scores(texts, {r["doc_id"]: r["toxic"] for r in labels.collect()})
    found = {r["doc_id"]: r["score"] for r in queries.op6_toxicity(spark, str(tmp_path)).collect()}
    off = [i for i in want if abs(want[i] - found[i]) > 1e-6]
    assert set(found) == set(want)
    assert not off, [(i, want[i], found[i]) for i in off[:5]]
    model = toxicity.fit(df, labels.where(~toxicity.held_out(labels.doc_id)), chance=None)
    assert len(model.words.names) == len(words)
    one = labels.selectExpr("doc_id", "quality", "1 as toxic")
    assert {r["score"] for r in toxicity.toxicity(df, one, chance=None).collect()} == {1.0}


def test_toxicity_odd_tables(spark):
    """One label alone, ids that repeat with other texts, labels of documents that are not there, a very long text."""
    df, labels = labelled(spark, 60)
    one = labels.selectExpr("doc_id", "quality", "1 as toxic")
    assert {r["score"] for r in toxicity.toxicity(df, one).collect()} == {1.0}
    odd = docs_of(spark, [(7, "nasty " * 100_000, None), (7, "plain", None), (7, None, None), (None, None, None)])
    assert {r["score"] for r in toxicity.toxicity(odd, spark.createDataFrame([(7, 0, 1), (999, 0, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")).collect()} == {1.0}


def test_block_max_search_of_frequent_terms_is_exact():
    """Terms that most examples hold leave most blocks in question; then their lists are read as a whole."""
    r = np.random.default_rng(5)
    x = r.random((1000, 30)) * (r.random((1000, 30)) < np.linspace(0.05, 0.9, 30))
    x = x[x.sum(axis=1) > 0]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    example, term = np.nonzero(x)
    index = toxicity.Index(30, np.arange(len(x)), np.zeros(len(x)), example, term, x[example, term])
    for own, q in enumerate(x[:100]):
        at = np.flatnonzero(q)
        hit, _ = index.nearest(at, q[at], 7, leave=own)
        want = sorted((-round(c, 12), i) for i, c in enumerate(x @ q) if c > 0 and i != own)[:7]
        assert [int(index.ids[h]) for h in hit] == [i for _, i in want]
    assert index.rows


def test_block_max_search_bounds_wide_terms_without_their_runs(monkeypatch):
    """Terms of most blocks are bounded as whole rows; their runs are picked for the blocks that are read, not all listed."""
    r = np.random.default_rng(6)
    x = r.random((4000, 60)) * (r.random((4000, 60)) < np.linspace(0.001, 0.5, 60))
    x = x[x.sum(axis=1) > 0]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    example, term = np.nonzero(x)
    index = toxicity.Index(60, np.arange(len(x)), np.zeros(len(x)), example, term, x[example, term])
    index = pickle.loads(pickle.dumps(index))
    listed, ragged = [], toxicity.ragged
    monkeypatch.setattr(toxicity, "ragged", lambda first, last: listed.append(int((last - first).sum())) or ragged(first, last))
    for own, q in enumerate(x[:60]):
        at = np.flatnonzero(q)
        del listed[:]
        hit, cos = index.nearest(at, q[at], 7, leave=own)
        want = sorted((-round(c, 12), i) for i, c in enumerate(x @ q) if c > 0 and i != own)[:7]
        assert [int(index.ids[h]) for h in hit] == [i for _, i in want]
        assert np.allclose(cos, [-c for c, _ in want])
        runs = np.diff(index.term_run)[at]
        assert listed[0] == runs[4 * runs < index.n_blocks].sum()
    assert index.place.dtype == np.uint16


def test_jaccard_chunks_send_each_connected_set_once():
    """Pairs that sets connect are answered together: before, a set was sent again with each of its pairs."""
    name = lambda k: pa.array(k, pa.int64())
    # a clique of 30 sets, one star that is larger than a chunk, and a pair of very large sets
    clique = [(i, j, 1000, 1000) for i in range(30) for j in range(i + 1, 30)]
    star = [(100, 101 + i, 40_000, 40_000) for i in range(200)]
    pairs = [*clique, *star, (900, 901, 5_000_000, 5_000_000)]
    random.Random(3).shuffle(pairs)
    batches = [pa.record_batch([name(list(x)) for x in zip(*part, strict=True)], names=["a", "b", "na", "nb"]) for part in (pairs[:250], pairs[250:])]
    told = [r for out in jaccard_join._chunks(iter(batches)) for r in out.to_pylist()]
    assert sorted((r["a"], r["b"]) for r in told) == sorted(p[:2] for p in pairs)
    chunks = defaultdict(set)
    for r in told:
        chunks[r["chunk"]] |= {r["a"], r["b"]}
    assert Counter(n for held in chunks.values() for n in held if n < 100) == Counter(range(30))
    assert {900, 901} in chunks.values()
    size = {n: s for a, b, x, y in pairs for n, s in ((a, x), (b, y))}
    assert all(8 * sum(size[n] for n in held) <= jaccard_join.CHUNK_BYTES for held in chunks.values() if 900 not in held)
    assert sum(100 in held for held in chunks.values()) == math.ceil(200 / (jaccard_join.CHUNK_BYTES // 320_000 - 1))
    assert list(jaccard_join._chunks(iter([]))) == []


@pytest.mark.parametrize("seed", [4, 6])
def test_jaccard_long_sets_are_ruled_out_by_wide_signatures(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LONG", 6)
    seen = []
    was = jaccard_join.JaccardJoin.not_far

    def not_far(self, near, count):
        out = was(self, near, count)
        seen.append((count, out[1], out[0].count()))
        return out

    monkeypatch.setattr(jaccard_join.JaccardJoin, "not_far", not_far)
    rows = corpus(seed)
    found = rows_of(jaccard_join.jaccard_components(docs_of(spark, rows).repartition(3)))
    assert {i: r["component_id"] for i, r in found.items()} == brute_components(brute_sets(rows))
    assert seen and all(left == there <= count for count, left, there in seen)


def test_wide_signatures_tell_long_sets_apart():
    """Before, unlike sets of some thousand shingles were sent as a whole: in signatures of 2,048 bits they cannot differ enough."""
    r = np.random.default_rng(5)
    base = r.integers(0, 1 << 62, 6000).astype(np.uint64)
    other = lambda same: np.unique(np.concatenate([base[:same], r.integers(0, 1 << 62, 6000 - same).astype(np.uint64)]))
    sets = {1: np.unique(base), 2: other(1000), 3: other(4500), 4: other(5300), 5: other(5900)}
    signs = {k: jaccard_join.signature(s) for k, s in sets.items()}
    pairs = [(1, k, 6000, 6000) for k in (2, 3, 4, 5)]
    limit = 12_000 - 2 * jaccard_join.needed(6000, 6000, 75)
    assert all(np.bitwise_count(signs[1] ^ signs[k]).sum() <= limit for k in sets)
    none = [None] * 5
    rows = [*zip([7] * 5, sets, none, none, none, [jaccard_join.signature(s, jaccard_join.WIDE_BITS).tobytes() for s in sets.values()], strict=True), *[(7, *p, None) for p in pairs]]
    kinds = [pa.int64()] * 5 + [pa.binary()]
    batches = [pa.record_batch([pa.array(c, t) for c, t in zip(zip(*part, strict=True), kinds, strict=True)], names=["chunk", "a", "b", "na", "nb", "sign"]) for part in (rows[:7], rows[7:])]
    far = {t["b"]: t["far"] for out in jaccard_join._far(75)(iter(batches)) for t in out.to_pylist()}
    assert far == {2: True, 3: True, 4: False, 5: False}


def test_workers_keep_no_freed_memory():
    """Before, a worker that waited beside others kept what its last task had freed."""
    mb = lambda: int(next(x for x in open("/proc/self/status") if x.startswith("VmRSS")).split()[1]) / 1024
    kept = []

    def run(batches):
        held = [np.ones(1000) for _ in range(25_000)]  # 200 MB in pieces that lie in the heap, with one at its end that stays
        kept.append(np.ones(1000))
        yield from batches
        del held

    before = mb()
    task = lean(run)(iter([1]))
    assert next(task) == 1 and mb() > before + 150
    assert list(task) == []
    assert mb() < before + 60


def test_quality_writes_scores_alone(spark):
    """Before, the rows with their texts were written beside the scores, and stayed while later stages ran."""
    r = random.Random(8)
    good, labels = labelled(spark, 60)
    long = docs_of(spark, [(5000 + i, " ".join(f"{r.getrandbits(60):x}" for _ in range(4000)), "s") for i in range(40)])
    docs = good.unionByName(long).repartition(3)
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    size = lambda: sum(p.stat().st_size for p in folder.rglob("*") if p.is_file())
    before = size()
    kept = quality.good_documents(docs, labels)
    rows = kept.select("doc_id", "text").collect()
    assert 10 * (size() - before) < sum(len(x["text"] or "") for x in docs.collect())
    verdict = [x["doc_id"] for x in quality.quality_scores(docs, labels).where("kept").collect()]
    assert sorted(x[0] for x in rows) == sorted(verdict) and len(verdict) < docs.count()
