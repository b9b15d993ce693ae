"""The pipeline on small tables, each stage against a plain version of it on its own input."""

from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from portico.llm import exact_dedup, jaccard_join, mixing, packing, quality

from .test_operators import WORD, brute_components, brute_sets, brute_targets, corpus, docs_of, labelled, lower


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    good, labels = labelled(spark, 120)
    extra = docs_of(spark, [(1000 + i, t, s) for i, t, s in corpus(21, 20)])
    good.unionByName(extra).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "jaccard_join", "mixing", "packing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").persist()
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    rows = lambda df: [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]

    kept = stages["quality"](spark, docs, folder).persist()
    verdict = {r["doc_id"] for r in quality.quality_scores(docs, spark.read.parquet(f"{folder}/labels.parquet")).where("kept").collect()}
    assert kept.columns == columns
    assert {r[0] for r in rows(kept)} == verdict
    assert 60 < len(verdict) < docs.count()

    unique = stages["exact_dedup"](spark, kept, folder).persist()
    groups = defaultdict(list)
    for i, t, _ in rows(kept):
        groups[lower(t)].append(i)
    assert unique.columns == columns
    assert sorted(r[0] for r in rows(unique)) == sorted(max(g) for g in groups.values())

    apart = stages["jaccard_join"](spark, unique, folder).persist()
    assert apart.columns == columns
    assert {r[0] for r in rows(apart)} == set(brute_components(brute_sets(rows(unique))).values())

    mixed = stages["mixing"](spark, apart, folder).persist()
    size = {i: len(WORD.findall(t or "")) for i, t, _ in rows(apart)}
    by_source, taken = Counter(), Counter()
    for i, _, s in rows(apart):
        by_source[s] += size[i]
    for i, _, s in rows(mixed):
        taken[s] += size[i]
    assert mixed.columns == columns
    assert max(Counter(r[0] for r in rows(mixed)).values()) <= 2
    for s, t in brute_targets(dict(by_source), mixing.WEIGHTS, mixing.SHARE, mixing.MOST).items():
        assert abs(taken[s] - t) <= max(size[i] for i, _, x in rows(apart) if x == s)

    pieces = stages["packing"](spark, mixed, folder).collect()
    encode = packing.encoder(packing.tokenizer_path())
    want = Counter()
    for i, t, _ in rows(mixed):
        want[i] += len(encode(t or "")) + 1
    got = Counter()
    for p in pieces:
        got[p["doc_id"]] += p["length"]
    assert got == want
    loads = Counter()
    for p in pieces:
        loads[p["sequence_id"]] += p["length"]
    assert max(loads.values()) <= 1024


def test_rows_follow_their_own_verdicts(spark):
    """Repeated and null ids, and extra columns named as the operators name theirs."""
    names = ["doc_id", "text", "source", "row", "maybe", "own", "key", "component", "name", "_dropped", "_copies", "_id", "slots", "norm", "rank"]
    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    rows = [(9, "Same", "s"), (5, "same", "s"), (5, "unique text", "t"), (5, "unique text", "t"), (7, a, "s"), (7, b, "t"), (3, a + " more", "s"), (8, b + " z", None), (4, c, "t"), (None, a, "s"), (None, None, None), (6, None, "s"), (1, "", "s"), (11, " \n", "s"), (12, a.upper(), "s")]
    docs = spark.createDataFrame([(*r, *[k] * (len(names) - 3)) for k, r in enumerate(rows)], ", ".join(f"{n} {t}" for n, t in zip(names, ["long", "string", "string"] + ["long"] * 12, strict=True))).repartition(3)
    of = lambda df: sorted(((r["doc_id"], r["text"], r["source"]) for r in df.collect()), key=str)

    unique = exact_dedup.kept_documents(docs)
    best = {}
    for r in rows:
        order = (r[0] is not None, r[0] or 0, r[1] or "")
        best[lower(r[1])] = max(best.get(lower(r[1]), (order, r)), (order, r), key=lambda x: x[0])
    assert unique.columns == names
    assert of(unique) == sorted((r for _, r in best.values()), key=str)

    apart = jaccard_join.first_of_each(docs)
    assert apart.columns == names
    want = [r for r in rows if r[0] is None or not WORD.findall(r[1] or "")]
    real = sorted({r for r in rows if r[0] is not None and WORD.findall(r[1] or "")}, key=lambda r: (r[0], r[1]))
    component = brute_components(brute_sets([(k, *r[1:]) for k, r in enumerate(real)]))
    assert of(apart) == sorted(want + [real[k] for k in sorted(set(component.values()))], key=str)

    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == names
    assert max(Counter(of(mixed)).values()) <= 2 * max(Counter(rows).values())
    taken = Counter()
    for r in mixing.mix_sources(docs).collect():
        taken[r["doc_id"], r["source"]] += r["copies"]
    assert Counter((i, s) for i, _, s in of(mixed)) == +taken

    labels = spark.createDataFrame([(4, 1), (7, 0)], "doc_id long, quality int")
    good = quality.good_documents(docs, labels)
    assert good.columns == names
    kept = sorted((str(r["doc_id"]), r["score"]) for r in quality.quality_scores(docs, labels).where("kept").collect())
    assert sorted(str(r[0]) for r in of(good)) == [i for i, _ in kept]
    for stage in (exact_dedup.kept_documents, jaccard_join.first_of_each, mixing.mixed_documents, lambda d: quality.good_documents(d, labels)):
        assert stage(docs.limit(0)).count() == 0


def test_run_applies_all_stages(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    key = lambda df: Counter((r["doc_id"], r["doc_tokens"]) for r in df.where("start = 0").collect())
    assert key(out) == key(docs)


def test_empty_documents(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_encodings_agree(spark):
    """The fast path's ids are those of the tokenizers library on all kinds of text."""
    from hypothesis import given, settings
    from hypothesis import strategies as st
    from tokenizers import Tokenizer

    slow, fast = Tokenizer.from_file(packing.tokenizer_path()), packing.encoder(packing.tokenizer_path())

    @settings(max_examples=300, deadline=None)
    @given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60))
    def check(text):
        assert np.array_equal(fast(text), slow.encode(text, add_special_tokens=False).ids)

    check()
