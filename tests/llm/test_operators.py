"""The operators on Spark: edge rows, empty tables, clashing columns, and brute force."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from contrail.llm import (
    embedding_dedup, html_text, lm_scoring, mixing, near_dedup, packing, pii, quality_classifier,
    quality_rules, toxicity,
)
from contrail.llm.common import held_out, words
from contrail.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, quality string, "
    "mixing int, node int, n_tokens string, tokens int, label string, graded int"
)
RNG = np.random.default_rng(17)
LONG = " ".join(f"w{k % 5000}x{k // 7}" for k in range(30_000))
ROWS = [
    (1, "", "en", "a", 0), (2, None, "en", None, None), (3, "Only two", None, "a", 8),
    (4, LONG, "en", "b", len(LONG)), (5, LONG + " end", "en", "b", 1),
    (6, "mail a.b@c.org or +1 212 555 0100 now", "de", "a", 5), (7, " \n\t ", "en", "a", 4),
    (8, "the same words again here today", "en", "a", 1),
    (8, "the same words again here today", "en", "a", 1), (None, "no id " * 30, "en", "a", 9),
    (9, "the same words again here today", "fr", "c", 1), (-1, "é ü ñ 漢字 😀", "fr", "c", 2),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "clash", 1, 2, "x", 3, "y", 4) for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def brute_components(docs):
    """Shingle count and least reachable id by id, from all pairs of ids that share a shingle."""
    sets = {}
    for r in docs:
        w = words(r["text"])
        runs = [tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1)))]
        sets[r["doc_id"]] = frozenset(runs)
    holders, shared = defaultdict(list), Counter()
    for d, found in sets.items():
        for s in found:
            holders[s].append(d)
    for own in holders.values():
        own.sort()
        shared.update((a, b) for k, b in enumerate(own) for a in own[:k])
    root = {d: d for d in sets}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((top(a), top(b)))
            root[b] = a
    return {d: (len(sets[d]), top(d)) for d in sets}


def test_lm_base_is_exact_and_the_model_is_better(spark, docs, real):
    for table in (docs, real):
        scored = lm_scoring.lm_score(table, held_out(F.col("doc_id"), 7, 2)).collect()
        rows = table.select("doc_id", "text").collect()
        assert len(scored) == len(rows)
        counts = Counter()
        for r in rows:
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2:
                counts.update([*words(r["text"]), b""])
        n, v = sum(counts.values()), len(counts)
        expected = Counter()
        for r in rows:
            found = [*words(r["text"]), b""]
            base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in found)
            expected[r["doc_id"], len(found), sum(counts[w] > 0 for w in found), round(base, 6)] += 1
        assert expected == Counter(
            (s["doc_id"], s["n_tokens"], s["n_known"], round(s["base_score"], 6)) for s in scored
        )
        assert {s["train_tokens"] for s in scored} == {n}
        assert all(math.isfinite(s["score"]) and s["score"] < 0 for s in scored)
    out = [s for s in scored if s["held_out"]]
    assert sum(s["score"] for s in out) > sum(s["base_score"] for s in out)


def test_mixture_meets_its_targets(docs, real):
    settings = mixing.Settings()
    mixed = mixing.mix(real, settings).select("lang", "source", F.col("mixing.*")).toPandas()
    mixed.columns = ["doc_lang", "doc_source", *mixed.columns[2:]]
    total = mixed.tokens.sum()
    for margin, power in settings.powers.items():
        have = mixed.groupby(margin).tokens.sum() ** power
        got = (mixed.tokens * mixed.weight).groupby(mixed[margin]).sum()
        assert np.allclose(got, have / have.sum() * total, rtol=1e-8)
    expected = (mixed.tokens * mixed.probability).sum()
    assert expected == pytest.approx(settings.keep * total, rel=1e-6)
    edge = mixing.mix(docs)
    assert edge.columns == [*docs.columns, "mixing_"]
    assert edge.count() == len(ROWS)


def test_near_duplicates(docs, real):
    found = {r["doc_id"]: r for r in near_dedup.near_duplicates(real).collect()}
    for d, (n, root) in brute_components(real.collect()).items():
        r = found[d]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (n, root, d == root)
    edge = sorted_rows(near_dedup.near_duplicates(docs).drop("n_shingles"))
    expected = [
        (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 4, False), (6, 6, True),
        (7, 7, True), (8, 8, True), (8, 8, True), (9, 8, False), (-1, -1, True), (None, None, True),
    ]
    assert edge == sorted(expected, key=repr)


def edited(found, places):
    return [f"edit{RNG.integers(10**9)}" if k in places else w for k, w in enumerate(found)]


def test_large_near_duplicate_groups_are_whole(spark):
    """A star, whose copies are near the original alone, and a passage in texts that are near one
    other text at most."""
    centre, passage = ([f"{p}{k}" for k in range(100)] for p in "cp")
    texts = [edited(centre, RNG.choice(100, 2, False)) for _ in range(4000)] + [centre]
    for k in range(1500):
        texts.append(edited(passage, range(62, 100)))
        texts.append(edited(texts[-1], [RNG.integers(62, 100)]))
    order = RNG.permutation(len(texts))
    texts = [texts[k] for k in order]
    sets = [{tuple(t[i : i + 5]) for i in range(96)} for t in texts]
    held = Counter(s for own in sets for s in own)
    code = {s: k for k, s in enumerate(s for s, n in held.items() if n > 1)}
    has = np.zeros((len(sets), len(code)), np.float32)
    for k, own in enumerate(sets):
        has[k, [code[s] for s in own if s in code]] = 1
    sizes, root = np.array([len(s) for s in sets]), np.arange(len(sets))
    both = has @ has.T
    near = 100 * both >= 75 * (sizes[:, None] + sizes - both)
    while (least := np.where(near, root, len(root)).min(1)).tolist() != root.tolist():
        root = least
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    # Blocks of about 1000 rows, so that regions are compared block by block.
    settings = near_dedup.Settings(block_shingles=100_000)
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(table, settings).collect()}
    assert [found[k] for k in range(len(root))] == root.tolist()


def test_quality_rules(docs, real):
    edge = quality_rules.quality_rules(docs)
    assert edge.columns == [*docs.columns, "quality_"]
    verdicts = Counter((r["doc_id"], r["quality_"]["kept"]) for r in edge.collect())
    assert verdicts[4, True] == 1 and verdicts[1, False] == 1 and verdicts[8, False] == 2


def test_visible_text(spark, empty):
    pages = spark.createDataFrame(
        [(1, "u", "<p>a"), (2, None, None), (2, None, None)], "page_id long, visible string, html string"
    )
    assert sorted_rows(html_text.extract(pages).select("page_id", "visible_")) == [(1, "a"), (2, ""), (2, "")]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_pii(docs, real):
    for table in (docs, real):
        model = pii.train(table)
        found = pii.detect(table, model)
        assert found.count() == table.count()
    r = pii.detect(docs, model).filter("doc_id = 6").first()["pii"]
    assert r["n_email"] == r["n_phone"] == 1
    assert r["spans"].startswith("email:5:14,phone:18:33")
    cleaned = {r["doc_id"]: r["text"] for r in pii.redact(docs, model).collect()}
    assert cleaned[6] == "mail <EMAIL> or <PHONE> now" and cleaned[2] is None and cleaned[1] == ""
    assert cleaned[4] == LONG


def test_packing(docs, real):
    for table in (docs, real):
        packed = packing.pack(table, max_tokens=512, batch_tokens=4096, shard_rows=50).toPandas()
        counts = Counter()
        for r in table.select("doc_id", "text").collect():
            counts[r["doc_id"]] += len(words(r["text"])) + 1
        got = packed.groupby("doc_id", dropna=False).n_tokens.sum()
        assert {None if k != k else int(k): v for k, v in got.items()} == counts
        assert (packed.n_tokens <= packed.padded_to).all()
        batches = packed.groupby(["bucket", "shard", "batch"])
        assert (batches.padded_to.sum() <= 4096).all()
        assert (batches.slot.nunique() == batches.size()).all()
    lengths = packed.n_tokens.value_counts().sort_index()
    ends = packing.best_boundaries(lengths.index.to_numpy(), lengths.to_numpy(), 16)
    assert sorted(packed.padded_to.unique()) == ends


def test_classifiers_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    toxic = QUERIES["op8_toxicity"](spark, sf).join(labels, "doc_id")
    right = toxic.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("double"))).first()[0]
    assert right > 0.9
    graded = QUERIES["op10_graded_quality"](spark, sf).join(labels, "doc_id")
    right = graded.filter("held_out").agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("double")))
    assert right.first()[0] > 0.85


def test_classifiers_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, grade int")
    model = toxicity.train(docs, none)
    scored = toxicity.classify(docs, model)
    assert {r["toxicity"]["score"] for r in scored.collect()} == {0.5}
    model = quality_classifier.train(docs, none)
    graded = quality_classifier.classify(docs, model)
    assert graded.columns[-1] == "graded_" and graded.count() == len(ROWS)
    one = spark.createDataFrame([(4, 1), (4, None), (None, 1)], "doc_id long, grade int")
    assert toxicity.classify(docs, toxicity.train(docs, one)).count() == len(ROWS)
    assert quality_classifier.classify(docs, quality_classifier.train(docs, one)).count() == len(ROWS)


def test_embeddings(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label")
    near = [float(x) for x in np.eye(64)[0]]
    nan = [float("nan"), *near[1:]]
    extra = [
        (1001, near, None), (1002, None, 1), (1003, nan, 1), (1004, [0.0] * 64, 1), (1005, [], 1),
        (1006, [1.0, 2.0], 1), (1007, [2.0, 4.0], 1), (1008, [1.0, 2.0], 2), (None, [1.0, 2.0], 1),
        (1009, [2.0, 4.0], 1), (1010, [1.0, None], 1), (1011, [float("inf"), 1.0], 1),
    ]
    hot = [(2000 + k, [float(x) for x in np.eye(64)[1] + 0.01 * v], 3) for k, v in enumerate(np.random.default_rng(1).normal(size=(700, 64)))]
    table = rows.union(spark.createDataFrame(extra + hot, rows.schema)).withColumn("node", F.lit("x"))
    settings = embedding_dedup.Settings(block=128)
    found = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(table, settings).collect()}
    assert len(found) == 500 + len(extra) + len(hot)
    for k in (1001, 1002, 1003, 1004, 1005, 1008, 1010, 1011, None):
        assert tuple(found[k])[1:] == (0, k, True)
    for k in (1006, 1007, 1009):
        assert tuple(found[k])[1:] == (2, 1006, k == 1006)
    groups = defaultdict(list)
    for r in [*rows.collect(), *spark.createDataFrame(hot, rows.schema).collect()]:
        groups[r["label"]].append(r)
    links = missed = 0
    for own in groups.values():
        x = np.array([np.array(r["embedding"], float) for r in own])
        x /= np.sqrt((x * x).sum(1, keepdims=True))
        near = (x @ x.T >= 0.93).sum(1) - 1
        for r, n in zip(own, near):
            assert found[r["vec_id"]]["n_links"] <= n
            links, missed = links + n, missed + n - found[r["vec_id"]]["n_links"]
    assert missed <= 0.001 * links


def test_empty_tables(spark, empty):
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(vectors).count() == 0
    assert near_dedup.near_duplicates(empty).count() == 0
    assert mixing.mix(empty).count() == 0
    assert packing.pack(empty).count() == 0
    assert quality_rules.quality_rules(empty).count() == 0
    assert pii.detect(empty, pii.train(empty)).count() == 0
    assert lm_scoring.lm_score(empty, held_out(F.col("doc_id"), 7, 2)).count() == 0
    none = spark.createDataFrame([], "doc_id long, grade int")
    assert toxicity.classify(empty, toxicity.train(empty, none)).count() == 0
    assert quality_classifier.classify(empty, quality_classifier.train(empty, none)).count() == 0


def test_pipeline_stages(spark, real):
    docs = real
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = spark.createDataFrame(
            (out := stage(spark, docs, SF)).collect(), out.schema
        )
        after = docs.collect()
        if name == "quality rules":
            assert sorted(after) == sorted(r for r in before if quality_rules.measure(r["text"])[-1])
        elif name == "near-dedup":
            found = brute_components(before)
            assert sorted(after) == sorted(r for r in before if found[r["doc_id"]][1] == r["doc_id"])
        elif name == "personal data":
            assert [r["doc_id"] for r in sorted(after)] == [r["doc_id"] for r in sorted(before)]
            assert not any(pii.base_spans(r["text"]) for r in after)
            texts = {r["doc_id"]: r["text"] for r in before}
            assert all(r["text"] == texts[r["doc_id"]] for r in after if "<" not in r["text"])
        elif name == "mixture":
            assert set(after) < set(before)
        else:
            counts = Counter()
            for r in after:
                counts[r["doc_id"]] += r["n_tokens"]
            assert counts == Counter({r["doc_id"]: len(words(r["text"])) + 1 for r in before})
        if name != "packing":
            assert docs.columns == real.columns
    assert set(ORACLES) <= set(QUERIES)


MADE_UP = (
    "kept_id cell mixing raked_cell raked_weight raked_probability probability quality pii before node "
    "group n row missing_id number digest component_id labels shard tokens tokens_ total topic"
).split()


def test_stages_with_every_column_name_that_they_make_up(spark, docs):
    """Also rows without an id, repeated rows, empty and null texts, and an empty table."""
    wide = docs.select("doc_id", "text", "lang", "source", "n_chars")
    wide = wide.withColumns({c: F.lit(7) for c in MADE_UP if c != "topic"})
    for start in (wide, wide.limit(0)):
        rows = start
        for name, stage in corpus_pipeline.STAGES:
            before = rows.count()
            rows = stage(spark, rows, SF)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert rows.columns == wide.columns
                assert rows.count() <= before
        assert rows.count() >= 0 and "batch" in rows.columns


def test_one_row_of_each_group_stays(spark):
    """Verdicts on rows: an id with two texts, rows without an id, repeated rows."""
    text = " ".join(f"w{k}" for k in range(100))
    near, other, third = f"{text} end", " ".join(f"o{k}" for k in range(60)), " ".join(f"t{k}" for k in range(60))
    rows = [
        (1, text), (5, near), (5, other), (None, other), (None, third), (None, third), (None, f"{third} end"),
        (7, None), (8, ""), (9, "few"), (9, "few"),
    ]
    table = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, number int, row string")
    kept = corpus_pipeline.one_of_each(spark, table, SF).select("doc_id", "text").collect()
    found = Counter(map(tuple, kept))
    of_third = [t for d, t in found.elements() if d is None]
    assert len(of_third) == 1 and of_third[0].startswith("t0")
    del found[None, of_third[0]]
    assert found == Counter([(1, text), (5, other), (7, None), (8, ""), (9, "few")])


def test_labelled_sample_is_bounded_in_rows(spark):
    """One labelled id holds nearly all rows."""
    from contrail.llm.labelled import labelled_sample

    rows = spark.range(50_000).select(F.lit(3).cast("long").alias("doc_id"), F.col("id").cast("string").alias("text"))
    rows = rows.union(spark.range(10, 300).select("id", F.lit("t")))
    grades = spark.range(300).select(F.col("id").alias("doc_id"), F.lit(1).alias("grade"))
    found = labelled_sample(rows, grades, 10**6).groupBy("doc_id").count().collect()
    assert len(found) == 291 and {r["count"] for r in found} == {1}
    assert labelled_sample(rows, grades, 100).count() < 200


def test_mixture_with_margins_that_contradict_each_other(spark, caplog):
    """Every source has a language of its own, so no weights meet both margins: it ends and says so."""
    rows = [(k, "w " * (5 + 20 * (k % 3)), f"s{k % 3}", f"l{k % 3}") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    mixed = mixing.mix(docs).select("mixing.*").toPandas()
    assert len(mixed) == 60 and np.isfinite(mixed.weight).all()
    assert "off by a factor" in caplog.text
    have = mixed.groupby("topic").tokens.sum() ** 0.8
    got = (mixed.tokens * mixed.weight).groupby(mixed.topic).sum()
    assert np.allclose(got, have / have.sum() * mixed.tokens.sum())


def test_a_run_leaves_only_its_result(spark, monkeypatch):
    """Tables written on the way are removed, also when a later stage fails."""
    import os

    from contrail.scratch import materialise, shared_folder

    def inner(spark, docs, sf_dir):
        return materialise(docs.filter("doc_id < 50"), "inner").filter("doc_id < 5")

    def failing(spark, docs, sf_dir):
        materialise(docs, "inner")
        raise OSError("lost")

    folder = shared_folder(spark)
    before = set(os.listdir(folder))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("first stage", inner), ("second", inner)])
    assert corpus_pipeline.run(spark, SF).count() == 5
    left = set(os.listdir(folder)) - before
    assert [name.split("-")[0] for name in left] == ["second"]
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("first stage", inner), ("second", failing)])
    with pytest.raises(OSError):
        corpus_pipeline.run(spark, SF)
    assert {name.split("-")[0] for name in set(os.listdir(folder)) - before - left} == {"first"}
