"""Operators over the whole corpus."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spendlens.llm import embeddings, graph, minhash, mixing, quality_classifier, registry, toxicity
from spendlens.llm.common import table
from tests.llm import brute

SF = "/root/testdata/sf0.1"


# ---------------------------------------------------------------- components

@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randint(0, 90), rng.randint(0, 90)) for _ in range(50)] + [(i, i + 1) for i in range(200, 240)]
    ids = {x for pair in links for x in pair}
    want = brute.components(ids, links)
    got = {r["id"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got.get(i, i) == want[i] for i in ids)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- near duplicates

def near(docs):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(docs).collect()}


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 400).astype(np.uint64)
    b = np.concatenate([a[:300], rng.integers(0, 2**63, 100).astype(np.uint64)])
    agree = [(minhash.sketch(a + np.uint64(k)) == minhash.sketch(b + np.uint64(k))).mean() for k in range(60)]
    assert abs(np.mean(agree) - 300 / 500) < 0.02 and np.std(agree) < 1.3 * math.sqrt(0.24 / minhash.SIZE)
    for n in (1, 2, 7):
        assert (minhash.sketch(a[:n]) != np.iinfo(np.uint64).max).all()


def test_near_duplicates_of_hostile_rows(hostile, empty, texts):
    got = near(hostile)
    want = brute.near_duplicates({i: t for i, t in texts if i is not None})
    assert {i: x for i, x in got.items() if i is not None} == want
    assert minhash.near_duplicates(hostile).count() == len(texts)
    assert minhash.near_duplicates(empty).count() == 0


def test_near_duplicates_of_the_tables(spark, folder):
    docs = {r["doc_id"]: r["text"] for r in table(spark, folder, "documents").collect()}
    found = registry.QUERIES["op5_minhash_near_dedup"](spark, folder).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute.near_duplicates(docs)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_groups_whose_first_text_is_far_from_most(spark, monkeypatch):
    """A large bucket in small blocks: near copies of a base that drift apart, so most
    are no link of the smallest id."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    docs = {}
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        docs[i] = " ".join(words)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert near(df) == brute.near_duplicates(docs)


@pytest.mark.parametrize("n,both", [(90, 80), (92, 84)])
def test_second_pass_keeps_pairs_that_it_alone_can_join(n, both):
    """Pairs at 0.80 and 0.84 in the blocks of every band that they share, without a first pass."""
    rng = random.Random(n)
    rows, want = [], 0
    for pair in range(4000):
        words = [f"w{rng.getrandbits(60)}" for _ in range(2 * n - both)]
        texts = [" ".join(words[:n]), " ".join(words[n - both:])]
        filled = [minhash.sketch(minhash.shingles(t, 1)) for t in texts]
        keys = [minhash.bands(f) for f in filled]
        shared = np.flatnonzero(keys[0] == keys[1])
        want += bool(len(shared))
        for band in shared:
            for k in (0, 1):
                rep = 2 * pair + k
                rows.append((int(keys[k][band]), int(band), 0, 0, rep, rep, n, minhash.mix(filled[k]).astype(np.uint8).tobytes(),
                             2, keys[k][:band], texts[k]))
    columns = [*minhash._MEMBER, "text"]
    batch = pa.RecordBatch.from_arrays([pa.array(c) if i != 9 else pa.array(list(c), pa.list_(pa.int64()))
                                        for i, c in enumerate(zip(*rows))], columns)
    near = {r for out in minhash._near_members(80)(iter([batch])) for r in out.column("rep").to_pylist()}
    links = [x for out in minhash._verify_members(1, 80)(iter([batch])) for x in zip(*[c.to_pylist() for c in out.columns])]
    assert len(near) == 2 * want and len(set(links)) == len(links) == want


# ---------------------------------------------------------------- embeddings

def links_of(rows, least=0.93):
    found = defaultdict(set)
    for i, v, l in rows:
        for j, w, m in rows:
            if i != j and l is not None and l == m and v and w and len(v) == len(w) and None not in v + w:
                a, b = np.array(v, float), np.array(w, float)
                if np.isfinite(a).all() and np.isfinite(b).all() and a.any() and b.any():
                    if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= least:
                        found[i].add(j)
    return found


@pytest.mark.parametrize("cell_rows,block", [(8192, 2048), (20, 7)])
def test_vectors(spark, cell_rows, block):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(6, 8))
    rows = [(i, (centers[i % 6] + rng.normal(size=8) * rng.choice([0.05, 0.4])).round(3).tolist(), int(i % 2)) for i in range(150)]
    rows += [(200, None, 1), (201, [], 1), (202, [0.0] * 8, 1), (203, [float("nan")] * 8, 1), (204, [None] + [1.0] * 7, 1),
             (205, rows[3][1], None), (206, rows[3][1], rows[3][2]), (207, [float("inf")] * 8, 1), (208, [1.0, 2.0], 1),
             (209, [2.0, 4.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("cell", F.lit("x"))
    found = links_of(rows)
    comp = brute.components([r[0] for r in rows], [(a, b) for a, bs in found.items() for b in bs])
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"])
           for r in embeddings.near_vectors(df, cell_rows=cell_rows, block=block).collect()}
    assert got == {r[0]: (len(found[r[0]]), comp[r[0]], comp[r[0]] == r[0]) for r in rows}
    assert embeddings.near_vectors(df.where("false")).count() == 0


def test_probed_cells_find_most_links(spark):
    vectors = table(spark, SF, "embeddings")
    exact = embeddings.near_vectors(vectors).agg(F.sum("n_links")).first()[0]
    probed = embeddings.near_vectors(vectors, cell_rows=50, probes=8).agg(F.sum("n_links")).first()[0]
    assert 0.9 * exact <= probed <= exact


# ---------------------------------------------------------------- classifiers

def held_out_accuracy(spark, name, label):
    found = registry.QUERIES[name](spark, SF).join(table(spark, SF, "labels"), "doc_id").where("held_out")
    assert found.where("score < 0 or score > 1 or score is null").count() == 0
    return found.agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0]


def test_quality_accuracy(spark):
    assert held_out_accuracy(spark, "op4_quality_classifier", "quality") > 0.95


def test_toxicity_accuracy(spark):
    assert held_out_accuracy(spark, "op8_toxicity", "toxic") > 0.95


@pytest.mark.parametrize("sf,majority,least", [
    ("0.001", False, 0.3), ("0.01", False, 0.7), ("0.1", False, 0.7), ("0.01", True, 0.7), ("0.1", True, 0.7)])
def test_both_classes_are_found_at_every_size(spark, sf, majority, least):
    """Recall of the rarer class among held-out rows; with ``majority`` labels are swapped, so toxic is the larger."""
    folder = f"/root/testdata/sf{sf}"
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    labels = table(spark, folder, "labels").select("doc_id", (1 - F.col("toxic") if majority else F.col("toxic")).alias("toxic"))
    found = toxicity.score(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").where(toxicity.held_out())
    rare = found.where(F.col("toxic") == int(not majority))
    right = (F.col("score") >= toxicity.THRESHOLD) == (F.col("toxic") == 1)
    assert rare.agg(F.avg(right.cast("int"))).first()[0] >= least
    assert found.agg(F.avg(right.cast("int"))).first()[0] > 0.8


def test_classifiers_take_any_rows(spark, hostile, empty):
    labels = spark.createDataFrame(
        [(4, 1, 0), (5, 1, 1), (6, 0, 0), (8, None, None), (None, 1, 1), (12, 1, 0), (13, 0, 0), (99, 1, 1)],
        "doc_id long, quality int, toxic int")
    docs = hostile.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    for each in (labels, labels.where("false")):
        good = quality_classifier.classify(hostile, each, steps=3)
        assert good.count() == docs.count() and good.where("score is null or isnan(score)").count() == 0
        toxic = toxicity.score(docs, toxicity.fit(docs, each))
        assert toxic.count() == docs.count() and toxic.where("score is null or isnan(score)").count() == 0
    assert quality_classifier.classify(empty, labels, steps=2).count() == 0
    none = docs.where("false")
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0


def test_block_max_search_is_exact():
    rng = random.Random(7)
    vocabulary = {f"t{i}": i for i in range(40)}
    index = toxicity.Index(vocabulary, np.array([1 + rng.random() for _ in vocabulary]))
    make = lambda: {rng.randrange(40): rng.randint(1, 4) for _ in range(rng.randint(1, 6))}
    examples = [(i, rng.randint(0, 1), make()) for i in range(700)]
    index.fill(examples)

    def dense(counts):
        out = np.zeros(40)
        terms, weights = index.vector(counts)
        out[terms] = weights
        return out

    matrix = np.array([dense(c) for _, _, c in examples])
    for _ in range(60):
        query = make()
        cosines = np.minimum(matrix @ dense(query), 1.0)
        order = [i for i in np.lexsort((np.arange(700), -np.round(cosines, 12))) if cosines[i] > 0][:15]
        rows, found = index.nearest(query, 15)
        assert list(rows) == order and np.allclose(found, cosines[order])


def test_quality_finds_the_prior(spark):
    """Unlabelled rows with a known share of positives."""
    rng = random.Random(2)
    good = lambda: " ".join(rng.choice(["the", "of", "river", "mountain", "people", "and"]) for _ in range(80)) + "."
    bad = lambda: " ".join(rng.choice(["$$$", "###", "WIN", "||"]) for _ in range(80))
    docs = [(i, good() if i % 10 < 7 else bad()) for i in range(2000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(1000) if i % 10 < 7], "doc_id long, quality int")
    out = quality_classifier.classify(df, labels, steps=15)
    wrong = out.where((F.col("predicted") == 1) != (F.col("doc_id") % 10 < 7)).count()
    assert wrong == 0


# ---------------------------------------------------------------- mixing

def poured(budget, children):
    """Water filling by bisection: children are (weight, capacity)."""
    budget = min(budget, sum(c for _, c in children))
    low, high = 0.0, 1e12
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if sum(min(c, middle * w) for w, c in children) < budget else (low, middle)
    return [min(c, high * w) for w, c in children]


def test_budgets(spark):
    rng = random.Random(9)
    leaves = [(f"d{d}", f"l{l}", f"s{s}", rng.choice([0, 5, 50, 1000, 40_000]), rng.choice([1.0, 2.0]), rng.choice([0.5, 1.5]),
               rng.choice([1.0, 3.0])) for d in range(3) for l in range(3) for s in range(4)]
    domain = {f"d{d}": float(d + 1) for d in range(3)}
    lang = {(f"d{d}", f"l{l}"): rng.choice([0.5, 1.5]) for d in range(3) for l in range(3)}
    leaves = [(d, l, s, t, domain[d], lang[d, l], w) for d, l, s, t, _, _, w in leaves]
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long, domain_weight double, "
                                       "lang_weight double, source_weight double")
    for share in (0.3, 0.9, 5.0):
        total = share * sum(x[3] for x in leaves)
        got = {(r["domain"], r["lang"], r["source"]): r["budget"] for r in mixing.leaf_budgets(
            df.select("domain", "lang", "source", "tokens"), df.drop("tokens"), F.lit(total), 2).collect()}
        cap = lambda *path: 2 * sum(x[3] for x in leaves if x[:len(path)] == path)
        ds = sorted(domain)
        for d, of_domain in zip(ds, poured(total, [(domain[d], cap(d)) for d in ds])):
            ls = sorted({x[1] for x in leaves if x[0] == d})
            for l, of_lang in zip(ls, poured(of_domain, [(lang[d, l], cap(d, l)) for l in ls])):
                ss = [x for x in leaves if x[:2] == (d, l)]
                for x, want in zip(ss, poured(of_lang, [(x[6], 2 * x[3]) for x in ss])):
                    assert got[x[:3]] == pytest.approx(want, rel=1e-6, abs=1e-3)


def test_prefixes(spark, folder):
    import hashlib
    rows = registry.QUERIES["op10_mixing"](spark, folder).collect()
    assert len(rows) == table(spark, folder, "documents").count()
    leaves = defaultdict(list)
    for r in rows:
        leaves[r["domain"], r["lang"], r["source"]].append(r)
    for members in leaves.values():
        supply, target = sum(r["n_tokens"] for r in members), members[0]["target"]
        assert supply == members[0]["supply"]
        epochs = target // supply if supply else 1
        rest, taken, open_ = target - epochs * supply, 0, True
        key = lambda r: hashlib.md5(f"{mixing.SEED}:{epochs}:{r['doc_id']}".encode()).hexdigest()
        for r in sorted(members, key=key):
            open_ = open_ and taken + r["n_tokens"] <= rest and rest > 0
            taken += r["n_tokens"]
            assert r["copies"] == epochs + open_


def test_mix_of_hostile_rows(hostile, empty):
    assert mixing.mix(hostile, share=1.0, max_epochs=1).columns == hostile.columns
    doubled = mixing.mix(hostile.where("doc_id = 12"), share=2.0, max_epochs=3)
    assert doubled.count() == 2
    assert mixing.mix(empty).count() == 0
    few = mixing.mix(hostile, share=0.5, max_epochs=1)
    assert few.select("doc_id").subtract(hostile.select("doc_id")).count() == 0


# ---------------------------------------------------------------- pipeline

def test_pipeline(spark, folder):
    import corpus_pipeline as p
    docs = table(spark, folder, "documents")
    out = p.run(spark, folder)
    assert out.where("not round_trip").count() == 0
    ids = Counter(r["doc_id"] for r in out.collect())
    assert max(ids.values()) == 1 and set(ids) <= {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in p.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == p.COLUMNS, name


def test_pipeline_stages_take_five_words_and_null_ids(spark):
    import corpus_pipeline as p
    words = [f"w{i}" for i in range(40)]
    other = " ".join(words[:20] + ["other"] + words[21:])  # 0.805 alike in four words, 0.756 in five
    rows = [(1, " ".join(words)), (2, other), (3, " ".join(words)), (None, "a text without an id"), (None, "another")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'en' as lang", "'s' as source", "cast(length(text) as long) as n_chars")
    kept = p.near_dedup(spark, docs, "")
    assert sorted(r["text"] for r in kept.collect()) == sorted([rows[0][1], other, rows[3][1], rows[4][1]])
    real = table(spark, "/root/testdata/sf0.001", "documents").select(*p.COLUMNS)
    nameless = real.withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")))
    good = p.quality(spark, nameless, "/root/testdata/sf0.001")
    n = good.where("doc_id is null").count()
    assert good.columns == p.COLUMNS and 0 < n < nameless.where("doc_id is null").count()


def test_pipeline_of_hostile_rows(spark, hostile, empty):
    """Every stage on nulls, empty and long texts, repeated rows, clashing names, and nothing."""
    import corpus_pipeline as p
    sf = "/root/testdata/sf0.001"
    extra = hostile.selectExpr("*", "1 as own_id", "'x' as same", "2 as chosen_id", "'k' as row_key")
    real = table(spark, sf, "documents").select(*p.COLUMNS).limit(30)
    for docs in (extra, extra.unionByName(real, allowMissingColumns=True), empty):
        for name, stage in p.STAGES:
            out = stage(spark, docs, sf)
            n, before = out.count(), docs.count()
            assert n <= before and (n == before or name not in ("secret scans", "byte-level bpe")), name
            if name != p.STAGES[-1][0]:
                assert out.columns == p.COLUMNS
                assert all(r["text"] for r in out.where("length(text) > 0 and text is not null").select("text").collect())
    through = real
    for name, stage in p.STAGES:
        through = stage(spark, through, sf)
    assert through.where("not round_trip").count() == 0


def test_near_dedup_stage_keeps_one_of_repeated_rows(spark):
    import corpus_pipeline as p
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(i, f"{text} {i} {' '.join(f'own{i}x{k}' for k in range(60))}", "en") for i in range(20)] * 2
    rows += [(None, "equal text of nobody at all", "en")] * 3 + [(50, "equal text of nobody at all", "de")]
    rows += [(60, "", "en"), (61, "", "en"), (62, None, "en"), (70, text, "fr"), (70, text, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'s' as source", "1L as n_chars")
    kept = Counter(map(tuple, p.near_dedup(spark, docs, "").select("doc_id", "lang").collect()))
    assert {i: n for (i, _), n in kept.items() if i is not None and i < 20} == dict.fromkeys(range(20), 1)
    assert sum(n for (i, _), n in kept.items() if i in (None, 50)) == 1
    assert kept[60, "en"] == kept[61, "en"] == kept[62, "en"] == 1 and kept[70, "en"] == 1 and (70, "fr") not in kept
