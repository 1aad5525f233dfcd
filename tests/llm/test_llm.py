"""Every corpus operator: brute force on small tables, and null, empty, long, repeated rows."""

import itertools
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as E
from tweetlake.session import scratch_path
from tweetlake.llm import (components, minhash_dedup, mixing, packing, projection_dedup, quality_net,
                           quality_rules, sharding, toxic_crf, url_filter, warc)

LONG = "lorem ipsum, Dolor! " * 30_000
DOCS = [(1, "The cat sat on the mat and then it sat on the hat again", "en", 7), (1, "The cat sat on the mat and then it sat on the hat again", "en", 7),
        (2, None, "en", None), (3, "", "de", 1), (4, " \t\n ", None, 2), (None, "a text without id but words", "en", 3),
        (5, "the CAT sat on the mat and then it sat on the hat again", "en", 9), (6, LONG, "fr", 1), (7, "x", None, 0)]
SCHEMA = "doc_id long, text string, lang string, n_words long"  # n_words clashes with a measurement


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, 1), (6, 0, 1), (None, 1, 1), (7, None, None)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _rows(df):
    return Counter(tuple(str(x) for x in r) for r in df.collect())


@pytest.mark.parametrize("key", ["op3_quality_rules", "op10_capture_index"])
def test_query_matches_sql(spark, sf_dir, key):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    got = E.queries()[key](spark, sf_dir)
    cur = con.execute(E.oracle_sql()[key])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(got.columns)
    assert _rows(got.select(names)) == Counter(tuple(str(x) for x in r) for r in cur.fetchall())


def test_rules_on_odd_rows(docs, none):
    got = {r["doc_id"]: r for r in quality_rules.ledger(docs).collect()}
    assert len(got) == 8 and quality_rules.ledger(docs).count() == len(DOCS)
    assert got[2]["n_words"] == got[3]["n_words"] == got[4]["n_words"] == 0 and got[2]["fail_bits"] & 1
    assert got[6]["n_words"] == 90_000 and got[6]["n_repeat_words"] == 90_000
    assert quality_rules.ledger(none).count() == 0 and quality_rules.keep(none).columns == none.columns
    assert quality_rules.keep(docs, "v1_base").count() == 0
    abl = {(r["policy"], r["rule"]): r for r in quality_rules.ablation(quality_rules.ledger(docs)).collect()}
    assert abl["v1_base", "few_words"]["n_failed"] == 8
    assert abl["v1_base", "few_words"]["n_kept_without"] == sum(
        not r["fail_bits"] & 2 for r in quality_rules.ledger(docs).collect())


def test_kept_rows_are_the_ledgers(table):
    d = table("documents")
    bits = {r["doc_id"]: r["fail_bits"] for r in quality_rules.ledger(d).collect()}
    assert {r["doc_id"] for r in quality_rules.keep(d).collect()} == {i for i, b in bits.items() if b == 0}


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    s, first = rng.normal(size=9), np.array([1, 0, 0, 0, 1, 1, 0, 0, 0], bool)
    trans, start = rng.normal(size=(2, 2)), 0.3
    p, joint = toxic_crf.marginals(s, first, trans, start, pairs=True)
    total, up, pairs = 0.0, np.zeros(9), np.zeros((2, 2))
    for y in itertools.product((0, 1), repeat=9):
        w = sum(s[i] * y[i] + (start * y[i] if first[i] else trans[y[i - 1], y[i]]) for i in range(9))
        total += np.exp(w)
        up += np.exp(w) * np.array(y)
        for i in range(9):
            if not first[i]:
                pairs[y[i - 1], y[i]] += np.exp(w)
    assert np.allclose(p, up / total) and np.allclose(joint, pairs / total)


@pytest.mark.parametrize("key,label", [("op1_toxic_spans", "toxic"), ("op7_quality_net", "quality")])
def test_held_out_scores(spark, key, label):
    sf = "/root/testdata/sf0.01"
    got = E.queries()[key](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    for r in got[["doc_id", "held_out"]].itertuples():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    out = got[got.held_out]
    assert (out.predicted == out[label]).mean() >= 0.9
    clean = out[out[label] == (0 if label == "toxic" else 1)]
    assert (clean.predicted == clean[label]).mean() >= 0.9
    assert got.score.between(0, 1).all()


def test_classifiers_on_odd_rows(docs, none, labels):
    for m, column in ((toxic_crf, "toxic"), (quality_net, "quality")):
        for d in (docs, none):
            model = m.fit(d, labels, column)
            got = m.score(d, model).collect()
            assert len(got) == d.count() and all(0 <= r["score"] <= 1 for r in got)
        unlabelled = m.fit(docs, labels.where("doc_id = 99"), column)
        assert m.score(docs, unlabelled).select("score").distinct().count() == 1
    assert quality_net.keep(docs, quality_net.fit(docs, labels)).columns == docs.columns


def test_word_vectors_equal_one_pass(spark):
    """Sums added over many tasks in two rounds are those of one pass over all texts."""
    texts = [" ".join(f"w{(i * j) % 31}" for j in range(i % 40)) for i in range(300)]
    total, counts = np.zeros((quality_net.ROWS, quality_net.DIM)), np.zeros(quality_net.ROWS, dtype=np.int64)
    quality_net.context_sums(texts, total, counts)
    centred = total - np.outer(counts, total.sum(0) / counts.sum())
    size = np.linalg.norm(centred, axis=1, keepdims=True)
    want = np.hstack([centred / np.where(size > 0, size, 1), (1e-3 / (1e-3 + counts / counts.sum()))[:, None]])
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(11)
    assert np.abs(quality_net.fit_vectors(docs) - want)[counts > 0].max() < 1e-6
    assert not quality_net.fit_vectors(docs.where("false")).any()


def test_a_long_text_does_not_end_the_sample(spark):
    """One labelled text beyond the budget, wherever the sampling order puts it."""
    rows = [(i, "huge " * 2000 if i in (4, 5) else f"some {'idiot' if i % 2 else 'kind'} words {i}") for i in range(60)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    lab = d.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    got = {r["doc_id"] for r in toxic_crf.labelled_sample(d, lab, "toxic", 6000, 8000).collect()}
    assert got == {i for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2 and i not in (4, 5)}
    model = toxic_crf.fit(d, lab, max_chars=8000)
    assert isinstance(model, toxic_crf.ToxicCrf) and toxic_crf.score(d, model).count() == 60


def test_admitted_rows():
    admitted = toxic_crf.admitted
    sizes, labels = np.array([9000, 3, 2, 500, 200, 4]), np.array([1, 0, 1, 0, 1, 0])
    assert admitted(sizes, labels, 1000).tolist() == [False, True, True, True, True, True]
    assert admitted(sizes, labels, 300).tolist() == [False, True, True, False, True, True]
    # All toxic texts long, the clean ones fill the room: each class has a half.
    sizes, labels = np.array([10] * 200 + [400] * 3), np.array([0] * 200 + [1] * 3)
    keep = admitted(sizes, labels, 1000)
    assert keep[200:].sum() == 1 and keep[:200].sum() > 0 and sizes[keep].sum() <= 1000
    assert not admitted(np.zeros(0, np.int64), np.zeros(0, np.int64), 10).any()


def test_offending_offsets():
    m = toxic_crf.ToxicCrf({"bias": -5.0, "w=idiot": 12.0}, np.zeros((2, 2)), 0.0, np.ones(3), 0.0)
    got = m.score(["You, Idiot!", "", "fine words"])
    assert got["span_starts"].tolist() == [[5], [], []] and got["span_ends"].tolist() == [[10], [], []]


def _components_of(sets, similar):
    at = {i: i for i in sets}
    def top(i):
        while at[i] != i:
            i = at[i]
        return i
    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and similar(sets[a], sets[b]):
            x, y = top(a), top(b)
            at[max(x, y)] = min(x, y)
    return {i: top(i) for i in at}


def test_minhash_equals_brute_force(table):
    d = table("documents")
    sets = {}
    for r in d.collect():
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"] or "")
        w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", w) if x]
        sets[r["doc_id"]] = {tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))} if w else set()
    want = _components_of(sets, lambda a, b: 100 * len(a & b) >= 80 * len(a | b))
    got = {r["doc_id"]: r for r in minhash_dedup.near_duplicates(d, 4, 80).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["n_shingles"] == len(sets[i]) and r["kept"] == (want[i] == i) for i, r in got.items())


def test_minhash_chain_of_edits(spark):
    """Copies of one text with ever more edits: groups, centres and single classes are all met."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(150)]
    rows, sets = [], {}
    for i in range(160):
        w = list(base)
        for k in rng.integers(0, 150, int(rng.integers(0, 12))):
            w[k] = f"e{rng.integers(10**6)}"
        rows.append((i, " ".join(w)))
        sets[i] = {tuple(w[j:j + 5]) for j in range(146)}
    want = _components_of(sets, lambda a, b: 100 * len(a & b) >= 80 * len(a | b))
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == want


def test_minhash_of_edits_without_originals(spark):
    """Copies near the threshold, their original removed: a class of the second step is all that joins another."""
    rng = np.random.default_rng(187)
    rows, sets = [], {}
    for i in range(60):
        w = [f"c0w{k}" for k in range(200)]
        for k in rng.integers(0, 200, int(rng.integers(3, 5))):
            w[k] = f"e{rng.integers(10**6)}"
        rows.append((i, " ".join(w)))
        sets[i] = {tuple(w[j:j + 5]) for j in range(196)}
    want = _components_of(sets, lambda a, b: 100 * len(a & b) >= 80 * len(a | b))
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_minhash_on_odd_rows(docs, none):
    got = minhash_dedup.near_duplicates(docs, 4, 80).collect()
    assert len(got) == len(DOCS) and minhash_dedup.near_duplicates(none).count() == 0
    of = {r["doc_id"]: r for r in got}
    assert of[5]["component_id"] == of[1]["component_id"] == 1 and not of[5]["kept"]
    assert of[2]["component_id"] == 2 and of[2]["n_shingles"] == 0 and of[None]["kept"]
    kept = minhash_dedup.keep(docs, 4, 80)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 2, 3, 4, 6, 7, None])


def test_minhash_ids_beyond_doubles_and_texts_under_one_id(spark):
    words = lambda k: " ".join(f"{k}{i}" for i in range(40))
    big = 2**53
    rows = [(big + 1, words("a")), (big + 3, words("b")), (None, words("c")), (9, words("d")), (9, words("e")), (9, words("d")),
            (10, words("e")), (11, ""), (11, None), (12, words("d") + " more")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in minhash_dedup.near_duplicates(df).collect())
    assert got == Counter({(big + 1, big + 1, True): 1, (big + 3, big + 3, True): 1, (None, None, True): 1, (9, 9, True): 3,
                           (10, 9, False): 1, (11, 11, True): 2, (12, 9, False): 1})
    kept = Counter(tuple(r) for r in minhash_dedup.keep(df).collect())
    assert kept == Counter([(big + 1, words("a")), (big + 3, words("b")), (None, words("c")), (9, words("d")), (9, words("e")), (11, ""), (11, None)])


def test_components_that_do_not_settle_are_an_error(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    with pytest.raises(RuntimeError):
        components.components(edges, max_rounds=2)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (100, 101), (None, 3)]
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["label"] for r in got} == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert len(got) == 101


def test_projection_equals_brute_force(spark, table):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 64))
    x = np.vstack([x, x[:20] + rng.normal(size=(20, 64)) * 0.3, x[:5], 3 * x[:3]])
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(200, None), (201, [0.0] * 64), (202, [float("nan")] * 64), (203, []), (204, [1.0, 2.0]), (None, rows[0][1])]
    schema = "vec_id long, embedding array<double>"
    got = {r["vec_id"]: r for r in projection_dedup.near_duplicates(spark.createDataFrame(rows, schema), block_rows=20).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    assert [got[i]["n_links"] for i in range(len(x))] == (near.sum(1) - 1).tolist()
    want = _components_of({i: {i} for i in range(len(x))}, lambda a, b: near[min(a), min(b)])
    assert {i: got[i]["component_id"] for i in range(len(x))} == want
    assert all(got[i]["kept"] and got[i]["n_links"] == 0 for i in (200, 201, 202, 203, 204))
    assert len(got) == len(x) + 6
    assert projection_dedup.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    assert projection_dedup.near_duplicates(table("embeddings")).count() == table("embeddings").count()


def test_projection_ids_beyond_doubles(spark):
    rows = [(2**53, [1.0, 0.0], 1), (2**53 + 1, [0.0, 1.0], 2), (None, [1.0, 1.0], 3), (None, [1.0, 0.0], 3), (7, [1.0, None], 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links int").coalesce(1)
    got = Counter(tuple(r) for r in projection_dedup.near_duplicates(df).collect())
    assert got == Counter({(2**53, 0, 2**53, True): 1, (2**53 + 1, 0, 2**53 + 1, True): 1, (None, 0, None, True): 2, (7, 0, 7, True): 1})


def test_rates_meet_targets(table, docs, none):
    d = table("documents")
    got = mixing.rates(d, d.select("doc_id", F.col("lang").alias("domain"))).toPandas()
    p = np.stack(got["p"].to_numpy())
    share = (got["tokens"] * got["rate"]).to_numpy() @ p / got["tokens"].sum()
    assert np.abs(share - [mixing.TARGETS[k] for k in sorted(mixing.TARGETS)]).max() < 2e-3
    assert (got["rate"] >= 0).all() and np.allclose(p.sum(1), 1)
    assert (got["unmet"] <= 1e-3 * max(mixing.TARGETS.values())).all()
    for x in (docs, none):
        lab = x.select("doc_id", F.col("lang").alias("domain"))
        assert mixing.rates(x, lab).count() == x.count()
        assert mixing.mix(x, lab).columns == x.columns


def test_rates_by_brute_force(spark):
    """The distributed steps against the same least squares solved in memory by another way."""
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.4, 0.3, 0.2], 300)
    tokens = rng.integers(1, 200, 300)
    targets = {"a": 0.2, "b": 0.5, "c": 0.3}
    members = spark.createDataFrame([(int(n), [float(v) for v in q]) for n, q in zip(tokens, p)], "tokens long, p array<double>")
    fitted = mixing.fit_rates(members, targets)
    rate = mixing.rate_of(p, fitted.steps, fitted.share)
    want = np.array([0.2, 0.5, 0.3])
    total = lambda r: (tokens * r) @ p / tokens.sum()
    assert np.abs(total(rate) - want).max() <= 1e-3 * 0.5 and fitted.unmet <= 1e-3 * 0.5
    # The nearest rates to 1 that meet the targets are max(0, 1 + p @ l): Newton steps on l.
    weight = 1 / (tokens @ p / tokens.sum())
    l = np.zeros(3)
    for _ in range(100):
        r = np.maximum(0, 1 + (p * weight) @ l)
        jac = ((p * (tokens * (r > 0))[:, None]).T @ (p * weight)) / tokens.sum()
        l -= np.linalg.lstsq(jac, total(r) - want, rcond=None)[0]
    assert np.abs(total(r) - want).max() < 1e-9 and np.abs(rate - r).max() < 0.05


def test_rates_report_targets_that_cannot_be_met(spark):
    members = spark.createDataFrame([(10, [0.5, 0.5])] * 4, "tokens long, p array<double>")
    fitted = mixing.fit_rates(members, {"a": 0.9, "b": 0.1})
    assert abs(fitted.unmet - 0.4) < 0.05


def _packed(df, texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.default_tokenizer())
    at: dict[int, list] = {}
    seen = Counter()
    for r in df.collect():
        ids = np.array(t.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids + [1], dtype="<u4")
        part = ids[r["start"]:r["start"] + 4096]
        assert r["start"] == 4096 * r["piece"] and len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"]
        at.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        seen[r["doc_id"]] += len(part)
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096
    return seen, at


def test_packing(table, docs, none):
    rows = table("documents").collect()
    seen, at = _packed(packing.pack(table("documents")), {r["doc_id"]: r["text"] for r in rows})
    assert set(seen) == {r["doc_id"] for r in rows}
    assert len(at) <= 1.02 * sum(seen.values()) / 4096 + 1
    seen, _ = _packed(packing.pack(docs), {d[0]: d[1] for d in DOCS})
    assert seen[2] == seen[3] == seen[4] == 1 and packing.pack(none).count() == 0


def test_packing_ids_beyond_doubles(spark):
    rows = [(2**53 + 1, "one two"), (2**53 + 3, "three"), (None, "four five")]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    assert {r["doc_id"] for r in got.collect()} == {2**53 + 1, 2**53 + 3, None}


def test_tokens_of_odd_texts():
    from tokenizers import Tokenizer
    path = packing.default_tokenizer()
    t = Tokenizer.from_file(path)
    texts = ["áb  c\x1cd\x85e <|endoftext|> x<|endoftext|>y It's don't ﬁ İstanbul ΣΑΣ 中文 ab 12 a.b é é", "", " x　y", "Thing. thing, !! |"]
    for text, raw in zip(texts, packing.token_bytes(texts, path), strict=True):
        assert raw == np.array(t.encode(text, add_special_tokens=False).ids + [1], dtype="<u4").tobytes()


def test_solve_keeps_the_histogram():
    rng = np.random.default_rng(2)
    h = Counter(int(x) for x in np.minimum(4096, rng.lognormal(5.5, 1, 4000)).astype(int) + 1 if x <= 4096)
    ways, got = packing.solve(dict(h)), Counter()
    for lengths, times in ways:
        assert sum(lengths) <= 4096
        for n in lengths:
            got[n] += times
    assert got == h
    assert sum(t for _, t in ways) <= 1.01 * sum(n * c for n, c in h.items()) / 4096 + 1


def test_shards(spark, docs, none):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"), F.lit(1).alias("shard"))
    got = sharding.shard(df, 40, block_rows=300).toPandas()
    sizes = got.groupby("shard")["slot"].agg(["count", "max", "nunique"])
    assert len(got) == 5000 and len(sizes) == 40 and (sizes["count"] == 125).all()
    assert (sizes["max"] == 124).all() and (sizes["nunique"] == 125).all()
    # Uniform: shards don't follow the ids.
    means = got.groupby("shard")["doc_id"].mean()
    assert abs(means - 2499.5).max() < 5 * 1443 / np.sqrt(125)
    odd = sharding.shard(docs, 4).collect()
    assert len(odd) == len(DOCS) and sorted(Counter(r["shard"] for r in odd).values()) == [2, 2, 2, 3]
    assert sharding.shard(none, 4).count() == 0


def test_communication_matrix():
    m = sharding.communication_matrix([5, 0, 17, 3], 4, seed=1)
    assert m.sum(1).tolist() == [5, 0, 17, 3] and sorted(m.sum(0).tolist()) == [6, 6, 6, 7]
    rng = np.random.default_rng(0)
    assert sharding._hypergeometric(rng, 3 * 10**9, 10**9, 4 * 10**9) == 3 * 10**9
    x = np.array([sharding._hypergeometric(rng, 3 * 10**9, 10**9, 10_000) for _ in range(2000)])
    assert abs(x.mean() - 7500) < 5 and abs(x.std() - np.sqrt(1875)) < 3


def test_matrix_follows_the_law():
    """Shares of all outcomes of a small matrix against the exact multivariate hypergeometric law."""
    from itertools import product
    from math import comb, prod
    rows, n = [2, 1, 3], 2  # two shards of three places each
    whole = comb(6, 3)
    law = {first: prod(comb(r, k) for r, k in zip(rows, first, strict=True)) / whole
           for first in product(*(range(r + 1) for r in rows)) if sum(first) == 3}
    seen = Counter(tuple(sharding.communication_matrix(rows, n, seed=s)[:, 0].tolist()) for s in range(4000))
    assert set(seen) == set(law)
    for first, p in law.items():
        assert abs(seen[first] / 4000 - p) < 4 * np.sqrt(p * (1 - p) / 4000)


def test_shards_against_a_plain_shuffle(spark, tmp_path):
    """Every row's shard and slot, worked out again from its place in the files, in any cut of the scan."""
    spark.range(900).select("id", F.lit("same").alias("text")).coalesce(1).write.parquet(f"{tmp_path}/t")
    spark.range(900, 1300).select("id", F.lit("same").alias("text")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/t")
    read = spark.read.parquet(f"{tmp_path}/t")
    got = {r["id"]: (r["shard"], r["slot"]) for r in sharding.shard(read, 5, seed=3, block_rows=100, stored=True).collect()}
    files = sorted({r[0] for r in read.select("_metadata.file_path").collect()})
    ids = [r["id"] for f in files for r in spark.read.parquet(f).collect()]
    m = sharding.Matrix(lambda b: min(1300, b * 100), 13, 5, 3)
    placed = [(int(s), int(k)) for b in range(13) for s, k in zip(*m.places(b), strict=True)]
    parts = -(-1300 // (5 * 100))
    want = {}
    for s in range(5):
        mine = sorted(((k >> 20) % parts, k, i) for i, (at, k) in zip(ids, placed, strict=True) if at == s)
        want.update({i: (s, slot) for slot, (_, _, i) in enumerate(mine)})
    assert got == want and Counter(s for s, _ in got.values()) == {s: 260 for s in range(5)}
    # Both permutations: neither shard nor slot follows the place.
    assert abs(np.corrcoef([got[i][1] for i in ids], range(1300))[0, 1]) < 0.15
    with pytest.raises(ValueError):
        sharding.shard(read.where("id % 2 = 0"), 5, stored=True)


def test_url_rules_and_models(spark):
    urls = ["http://A.example.org/es/1?x", "http://example.org/en/1", "http://example.org", "https://x.com/fr/", "https://x.com/de/",
            None, "", "no scheme", "http://notorg/x", "ftp://Org/#y", "a://b.com/fr/?q=http://c.org/z"] + [
            f"http://good{i}.com/fr/nice{i}" for i in range(40)] + [f"http://bad{i}.com/de/spam{i}" for i in range(40)] + [
            "http://q.net/fr/nice7", "http://q.net/de/spam7"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r["page_id"]: r for r in url_filter.judge(pages, url_filter.fit(pages)).collect()}
    assert [got[i]["rule"] for i in range(11)] == ["example.org/es/", "example.org/en/1", None, "com/fr/", "com/de/",
                                                   None, None, None, None, "org/", "com/fr/"]
    assert (got[0]["host"], got[0]["path"]) == ("a.example.org", "/es/1") and (got[5]["host"], got[7]["path"]) == ("", "")
    assert got[0]["verdict"] == "block" and got[3]["verdict"] == "allow"
    assert got[91]["verdict"] == "allow" and got[92]["verdict"] == "block"
    few = pages.where("page_id = 2")
    assert url_filter.judge(few, url_filter.fit(few)).first()["verdict"] == "allow"
    empty = pages.where("page_id < 0")
    assert url_filter.judge(empty, url_filter.fit(empty)).count() == 0


def test_url_scores_are_of_exact_contexts(spark, monkeypatch):
    """More contexts than any fixed number of hash rows: scores equal a plain Witten-Bell model."""
    rng = np.random.default_rng(4)
    signs = list("abcdefghijklmnopqrstuvwxyz0123456789-._~")
    urls = [f"http://a.com/{k}/" + "".join(rng.choice(signs, 30)) for k in ("fr", "de", "xx") for _ in range(400)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    apart = {r[0] for r in pages.where(F.pmod(F.xxhash64("url"), F.lit(5)) == 0).select("page_id").collect()}
    seen = {"/fr/": [{} for _ in range(5)], "/de/": [{} for _ in range(5)]}
    marked = lambda u: ["^"] * 4 + list(u) + ["$"]
    for i, u in enumerate(urls):
        for part, model in seen.items():
            if part in u and i not in apart:
                m = marked(u)
                for j in range(4, len(m)):
                    for k in range(5):
                        model[k].setdefault(tuple(m[j - k:j]), Counter())[m[j]] += 1
    assert len(seen["/fr/"][4]) > 4096

    def log_p(u, model):
        m, total = marked(u), 0.0
        for j in range(4, len(m)):
            p = 1 / 64
            for k in range(5):
                c = model[k].get(tuple(m[j - k:j]))
                if c:
                    p = (c[m[j]] + len(c) * p) / (c.total() + len(c))
            total += np.log(p)
        return total / (len(m) - 4)

    monkeypatch.setattr(url_filter, "BLOCK", 100, raising=False)
    got = {r["page_id"]: r["score"] for r in url_filter.judge(pages, url_filter.fit(pages)).collect()}
    assert len(got) == len(urls)
    assert max(abs(got[i] - log_p(u, seen["/fr/"]) + log_p(u, seen["/de/"])) for i, u in enumerate(urls)) < 1e-9


def test_warc_odd_pages(spark):
    rows = [(3, "http://a.org/x", "same"), (1, "http://b.org/ü\r\ny", "same"), (2, None, None), (4, "nothing", ""),
            (None, "http://a.org/x", "same"), (5, "http://a.org/x", "é" * 300_000), (1, "http://b.org/ü\r\ny", "same")]
    rows += [(10 + i, "http://hot.org/", f"<p>{i % 7}") for i in range(700)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = warc.round_trip(spark, pages).collect()
    assert len(got) == len(rows)
    of = {r["page_id"]: r for r in got}
    assert of[3]["refers_to"] == 1 and of[1]["record_type"] == "response" and of[None]["refers_to"] == 1
    assert of[4]["refers_to"] == 2 and of[2]["payload_bytes"] == 0 and of[5]["payload_bytes"] == 600_000
    assert of[2]["payload_digest"] == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
    assert all(of[10 + i]["refers_to"] == (None if i < 7 else 10 + i % 7) for i in range(700))
    assert warc.round_trip(spark, pages.where("page_id < 0")).count() == 0


def test_index_finds_what_was_written(spark):
    from tweetlake.session import scratch_path
    path = scratch_path(spark, "index")
    lines = spark.range(3000).select(F.concat(F.lit("k"), F.col("id") % 50).alias("key"), (F.col("id") % 300).alias("page_id"),
                                     F.lit("f").alias("file"), F.col("id").alias("offset"), F.lit(1).cast("long").alias("length"))
    top = warc.write_index(lines, path, block_lines=7)
    assert _rows(warc.find(lines, top)) == _rows(lines)
    assert warc.find(lines.select(F.concat("key", F.lit("x")).alias("key"), "page_id"), top).count() == 0


def test_pipeline(spark, sf_dir):
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "minhash_near_dedup",
                                                      "mixing_to_targets", "best_fit_packing"]
    got = corpus_pipeline.run(spark, sf_dir)
    ids = {r["doc_id"] for r in got.select("doc_id").distinct().collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bits = {r["doc_id"]: r["fail_bits"] for r in quality_rules.ledger(docs).collect()}
    assert ids and all(bits[i] == 0 for i in ids)
    assert isinstance(docs.schema["doc_id"].dataType, T.LongType) and got.where("length > 4096").count() == 0


ODD = ("doc_id long, text string, lang string, source string, n_chars long, _h string, _p double, _doc string, _copies int, rate double, "
       "f1 int, kept boolean, h string, t string")


def _odd_documents():
    """Nulls in every column, empty and very long texts, repeated rows, unlike texts under one id, large ids, near copies."""
    rng = np.random.default_rng(12)
    words = [f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(100)]
    text = lambda n: " ".join(rng.choice(words, n))
    first, second = text(120), text(150)
    rows = [(i, text(int(rng.integers(60, 200))), ["en", "fr", "de", "es", None][i % 5], "s") for i in range(40)]
    rows += [(100, first, "en", "s"), (101, first, "en", "s"), (101, first, "en", "s"), (102, first + " more", "en", "s"),
             (2**53 + 1, second, "fr", None), (2**53 + 3, second + " end", "fr", None), (None, text(80), "en", "s"), (103, None, "en", "s"),
             (104, "", None, None), (105, " \n\t", "de", "s"), (106, text(70), "en", "s"), (106, text(75), "en", "s"), (107, "too short", "en", "s"),
             (108, text(30_000), "en", "long"), (109, " ".join(["same words again"] * 60), "en", "s")]
    return [(*r, len(r[1] or ""), "h", 0.1, "d", 7, 9.0, 1, False, "x", "y") for r in rows]


def test_pipeline_stages_by_brute_force(spark):
    """Each stage on odd rows with clashing columns, against a plain version on the stage's own input."""
    import corpus_pipeline as cp
    folder = scratch_path(spark, "odd")
    rows = _odd_documents()
    spark.createDataFrame(rows, ODD).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i < 30 or i % 2), 0) for i in range(40)] + [(None, 1, 0), (3, None, None)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    stage = dict(cp.STAGES)
    names = ["quality_classifier", "quality_rules", "minhash_near_dedup", "mixing_to_targets", "best_fit_packing"]
    assert list(stage) == names
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plain = lambda df: Counter((r["doc_id"], r["text"]) for r in df.collect())

    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = quality_net.score(docs, quality_net.fit(docs, labels)).groupBy("doc_id").agg(F.max("score").alias("s"), F.min("score").alias("low")).collect()
    out = stage[names[0]](spark, docs, folder)
    assert out.columns == docs.columns
    sure = {r["doc_id"] for r in scored if r["low"] >= 0.7}
    never = {r["doc_id"] for r in scored if r["s"] < 0.7}
    got = {k[0] for k in plain(out)}
    assert sure <= got and not got & never

    def passes(text):
        ws = (text or "").split()
        grams = Counter(zip(ws, ws[1:], ws[2:]))
        again = {j for i, g in enumerate(zip(ws, ws[1:], ws[2:])) if grams[g] > 1 for j in (i, i + 1, i + 2)}
        return len(ws) >= 50 and 100 * len(again) <= 50 * len(ws)

    out = stage[names[1]](spark, docs, folder)
    assert out.columns == docs.columns and plain(out) == Counter((r[0], r[1]) for r in rows if passes(r[1]))

    docs = out
    out = stage[names[2]](spark, docs, folder)
    have = list(dict.fromkeys((r["doc_id"], r["text"]) for r in docs.collect()))
    sets = {}
    for i, (_, text) in enumerate(have):
        ws = text.lower().split()
        sets[i] = {tuple(ws[j:j + 5]) for j in range(max(1, len(ws) - 4))}
    at = _components_of({i: s for i, s in sets.items() if have[i][0] is not None}, lambda a, b: 100 * len(a & b) >= 80 * len(a | b))
    groups: dict[int, list] = {}
    for i, top in at.items():
        groups.setdefault(top, []).append(have[i])
    kept = plain(out)
    assert out.columns == docs.columns and len(kept) == len(groups) + 1 and set(kept.values()) == {1}
    for members in groups.values():
        assert min(m[0] for m in members) in {m[0] for m in members if m in kept} and sum(m in kept for m in members) == 1

    docs = out
    out = stage[names[3]](spark, docs, folder)
    rates = mixing.rates(docs, docs.select("doc_id", F.col("lang").alias("domain"))).collect()
    taken = Counter()
    for r in out.collect():
        taken[r["doc_id"]] += 1
    want = Counter()
    for r in rates:
        want[r["doc_id"]] += r["copies"]
    assert out.columns == docs.columns and taken == Counter({k: v for k, v in want.items() if v})

    once = out.dropDuplicates(["doc_id"])
    packed, at = _packed(stage[names[4]](spark, once, folder), {r["doc_id"]: r["text"] for r in once.collect()})
    assert set(packed) == {r["doc_id"] for r in once.collect()}
    assert stage[names[4]](spark, out, folder).where("piece = 0").count() == sum(taken.values())


def test_pipeline_runs_on_odd_and_empty_tables(spark):
    import corpus_pipeline as cp
    folder = scratch_path(spark, "odd-run")
    spark.createDataFrame(_odd_documents(), ODD).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    got = cp.run(spark, folder).collect()
    assert got and max(r["offset"] + r["length"] for r in got) <= 4096
    empty = scratch_path(spark, "empty-run")
    spark.createDataFrame([], ODD).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{empty}/labels.parquet")
    assert cp.run(spark, empty).count() == 0
