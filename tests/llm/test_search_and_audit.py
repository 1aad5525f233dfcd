"""Source divergence, ranked lexical search and learned partitions against plain versions."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tweetlake.llm import learned_partitions, lexical_scan, source_audit, transducer

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, term string, rank int, n long"


def _words(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 6))) for _ in range(n)]


# ---------------------------------------------------------------------------------------------
# Transducers and the source audit
# ---------------------------------------------------------------------------------------------

def test_transducer_gives_ordinals_and_is_minimal():
    terms = sorted({w.encode() for w in _words(400, 1)})
    made = transducer.Transducer.from_bytes(transducer.build(terms).to_bytes())
    asked = terms + [t + b"x" for t in terms[:50]] + [t[:-1] for t in terms[:50] if len(t) > 1]
    data = np.frombuffer(b" ".join(asked), np.uint8)
    lengths = np.array([len(t) for t in asked])
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    place = {t: i for i, t in enumerate(terms)}
    assert made.ordinals(data, starts, lengths).tolist() == [place.get(t, -1) for t in asked]
    # Minimal: as many states as there are unlike sets of endings.
    endings = defaultdict(set)
    for t in terms:
        for i in range(len(t) + 1):
            endings[t[:i]].add(t[i:])
    assert len(made.final) == len({frozenset(e) for e in endings.values()})
    assert transducer.heads(data, starts, lengths).tolist() == [transducer.head(t) for t in asked]


def test_transducer_wants_ascending_terms():
    with pytest.raises(ValueError):
        transducer.build([b"b", b"a"])


def _plain_audit(rows, least, best):
    found = [((r[2] or ""), (r[3] or ""), re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (r[1] or "").translate(UPPER))) for r in rows]
    df, counts = Counter(), Counter()
    for lang, source, terms in found:
        df.update((lang, t) for t in set(terms))
        counts.update((lang, source, t) for t in terms)
    groups = sorted({(lang, source) for lang, source, _ in found})
    kept = {lang: sorted(t for (x, t), n in df.items() if x == lang and n >= least) for lang in {g[0] for g in groups}}

    def shares(lang, count):
        n = sum(count(t) for t in kept[lang])
        return {t: 1 + 10**9 * (count(t) + 2) // (n + 2 * len(kept[lang])) for t in kept[lang]}

    p = {g: shares(g[0], lambda t: counts[g + (t,)]) for g in groups}
    q = {lang: shares(lang, lambda t: sum(counts[g + (t,)] for g in groups if g[0] == lang)) for lang in kept}
    out = set()
    for g in groups:
        f = lambda a, b: (a - b) ** 2 // (a + b)
        pairs = [(-sum(f(p[g][t], p[h][t]) for t in kept[g[0]]), h[1]) for h in groups if h[0] == g[0] and h != g]
        terms = [(-f(p[g][t], q[g[0]][t]), t) for t in kept[g[0]] if counts[g + (t,)] and p[g][t] > q[g[0]][t]]
        for part, items in (("pair", sorted(pairs, key=lambda x: (x[0], x[1].encode()))),
                            ("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[:best])):
            out |= {(*g, part, item, -v, i + 1) for i, (v, item) in enumerate(items)}
    return out


def _audit_rows():
    rng = random.Random(5)
    words = _words(60, 2)
    rows = [(i, " ".join(rng.choice(words[(i % 3) * 5:]) for _ in range(rng.randint(0, 30))).title(),
             rng.choice(["en", "fr", None]), rng.choice(["a", "b", "é", None]), "t", 1, 2) for i in range(150)]
    rows += [(None, None, "en", "null text", "", 0, 0), (None, "", "zz", "x", "", 0, 0), (7, "lone words", "zz", "y", "", 0, 0),
             (7, "lone words", "zz", "y", "", 0, 0), (8, "a" * 5000 + " " + " ".join(words) * 300, "en", "long", "", 0, 0)]
    return rows


@pytest.mark.parametrize("limit", [1 << 26, 1])
def test_audit_equals_plain_version(spark, monkeypatch, limit):
    """Also with small segments, blocks and buffer portions, and one transducer a scan."""
    if limit == 1:
        monkeypatch.setattr(source_audit, "BLOCK", 7)
        small = source_audit.transducers
        monkeypatch.setattr(source_audit, "transducers", lambda v: small(v, 25))
    rows = _audit_rows()
    got = source_audit.audit(spark.createDataFrame(rows, SCHEMA), least_docs=5, best=3, limit_bytes=limit)
    assert {tuple(r) for r in got.collect()} == _plain_audit(rows, 5, 3)
    assert got.count() == len(_plain_audit(rows, 5, 3))


def test_words_are_whole_across_buffer_portions(monkeypatch):
    monkeypatch.setattr(source_audit, "CHUNK", 5)
    texts = ["abc defgh", "ijklmnopqrstuvw", "", "x1y", "zz"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    begins = np.cumsum([0, *map(len, texts)])[:-1]
    got = [bytes(data[s:s + n]) for starts, lengths in source_audit._runs(data, begins) for s, n in zip(starts, lengths)]
    assert got == [b"abc", b"defgh", b"ijklmnopqrstuvw", b"x", b"y", b"zz"]


def test_audit_of_an_empty_table(spark):
    got = source_audit.audit(spark.createDataFrame([], SCHEMA))
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"] and got.count() == 0


# ---------------------------------------------------------------------------------------------
# Ranked lexical search
# ---------------------------------------------------------------------------------------------

def _plain_search(docs, items, best=10):
    find = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+").findall
    counts = [(d[0], Counter(find((d[1] or "").translate(UPPER)))) for d in docs]
    counts = [(i, c) for i, c in counts if c]
    total, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = set()
    for number, (item, text) in enumerate(dict.fromkeys((r[0], r[1] or "") for r in items)):
        scores = []
        for doc, c in counts:
            m = 10 + 90 * sum(c.values()) * total // length
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in set(find(text.translate(UPPER))) if t in c)
            if s > 0:
                scores.append((-s, doc is None, doc))
        out |= {(item, i + 1, doc, -s) for i, (s, _, doc) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:best])}
    return out


def _search_tables():
    rng = random.Random(9)
    words = _words(80, 3) + ["A1", "b2 c", "İx"]
    docs = [(i, rng.choice([" ", "-", "\n\n"]).join(rng.choice(words) for _ in range(rng.randint(0, 40))), "en", "s", "", 1, 2) for i in range(120)]
    docs += [docs[3], docs[3], (2**53 + 1, docs[4][1], None, None, "", 0, 0), (2**53 + 3, docs[4][1], None, None, "", 0, 0),
             (None, docs[4][1], None, None, "", 0, 0), (500, None, "", "", "", 0, 0), (501, "", "", "", "", 0, 0), (502, "!!", "", "", "", 0, 0),
             (503, " ".join(words) * 400, "", "", "", 0, 0)]
    items = [(i, " ".join(rng.choice(words) for _ in range(8)).upper(), 5) for i in range(25)]
    items += [(24, items[24][1], 6), (None, words[0], 1), (90, None, 1), (91, "unknownword", 1), (92, "", 1), (93, docs[4][1], 0)]
    return docs, items


@pytest.mark.parametrize("most", [(4096, 1 << 20), (4, 12)])
def test_search_equals_plain_version(spark, most):
    """Nulls, empty and long texts, ties, repeated rows, ids beyond 2^53, clashing columns; also in many blocks."""
    docs, items = _search_tables()
    got = lexical_scan.search(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string, doc_id int"),
                              most_items=most[0], most_postings=most[1]).collect()
    want = _plain_search(docs, items)
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_search_keeps_the_best_when_many_gather(spark, monkeypatch):
    monkeypatch.setattr(lexical_scan._Best, "settle", lexical_scan._Best.settle)
    best = lexical_scan._Best(2, 3)
    rng = np.random.default_rng(1)
    scores, ids = rng.integers(0, 9, (200_000, 2)), rng.permutation(200_000)
    for at in range(0, 200_000, 1000):
        best.add(scores[at:at + 1000], ids[at:at + 1000], np.ones(1000, bool))
    item, score, doc, _ = best.settle()
    for i in (0, 1):
        want = sorted(zip(-scores[:, i], ids))[:3]
        assert list(zip(-score[item == i], doc[item == i])) == want


def test_search_of_empty_tables(spark):
    docs, items = _search_tables()
    d, i = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string, doc_id int")
    assert lexical_scan.search(d.limit(0), i).count() == 0
    assert lexical_scan.search(d, i.limit(0)).count() == 0


# ---------------------------------------------------------------------------------------------
# Learned partitions
# ---------------------------------------------------------------------------------------------

def _plain_neighbours(rows, every=100, best=10):
    rows = list({(i, tuple(v)) for i, v in rows})
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], float)
    out = {}
    for at in np.flatnonzero(ids % every == 0):
        far = np.sqrt(((x - x[at]) ** 2).sum(1))
        found = {}
        for d, i in sorted((d, i) for d, i in zip(far, ids) if i != ids[at]):
            found.setdefault(i, d)
        out[int(ids[at])] = list(found.items())[:best]
    return out


def _check_recall(spark, rows, least, every=100):
    got = learned_partitions.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), every).collect()
    usable = [(r[0], np.array(r[1], np.float32)) for r in rows
              if r[0] is not None and r[1] and all(v is not None and math.isfinite(v) for v in r[1]) and any(r[1])]
    want = _plain_neighbours(usable, every)
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found[r.query_id].append((r.vec_id, r.score, r.rank))
    assert set(found) == set(want)
    hit = 0
    for q, rows_of in found.items():
        assert [r[2] for r in rows_of] == list(range(1, len(want[q]) + 1))
        assert [(s, v) for v, s, _ in rows_of] == sorted((s, v) for v, s, _ in rows_of)
        hit += len({v for v, _, _ in rows_of} & {v for v, _ in want[q]})
    assert hit >= least * sum(map(len, want.values()))
    return found, want


def test_neighbours_recall_on_clusters(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(30, 16))
    rows = [(i, (centre[i % 30] + 0.3 * rng.normal(size=16)).tolist(), i % 3) for i in range(3000)]
    _check_recall(spark, rows, 0.95, every=25)


def test_neighbours_of_odd_rows_are_exact_when_few(spark):
    """Nulls, zeros, non-finite components, other lengths, ties, repeated rows, ids beyond 2^53."""
    rng = np.random.default_rng(4)
    rows = [(i * 50, rng.normal(size=4).round(1).tolist(), 0) for i in range(30)]
    rows += [(100, rows[2][1], 1), (7, rows[2][1], 1), (5, rows[2][1], 1), (5, rows[2][1], 2), (2**53 + 1, rows[2][1], 1), (2**53 + 3, rows[2][1], 1),
             (None, rows[2][1], 0), (11, None, 0), (12, [0.0] * 4, 0), (13, [1.0, None, 0.0, 0.0], 0), (14, [float("nan")] * 4, 0),
             (15, [float("inf"), 0.0, 0.0, 1.0], 0)]
    found, want = _check_recall(spark, rows, 1.0)
    for q in want:
        assert [(v, s) for v, s, _ in found[q]] == want[q]
    assert {5, 7, 2**53 + 1, 2**53 + 3} <= {v for v, _, _ in found[100]}
    short = spark.createDataFrame(rows + [(200, [1.0, 2.0], 0)], "vec_id long, embedding array<float>, label int")
    assert learned_partitions.clean(short).where("size(vec) <> 4").count() == 0


def test_neighbours_when_a_third_of_all_rows_is_one_vector(spark, monkeypatch):
    monkeypatch.setattr(learned_partitions, "CELL_ROWS", 64)
    monkeypatch.setattr(learned_partitions, "CELL_QUERIES", 8)
    rng = np.random.default_rng(6)
    rows = [(i, [1.0] * 8 if i % 3 == 0 else rng.normal(size=8).tolist(), 0) for i in range(1500)]
    found, want = _check_recall(spark, rows, 0.9, every=20)
    assert [v for v, _, _ in found[0]] == [v for v, _ in want[0]] == list(range(3, 33, 3))


def test_parts_are_balanced_and_follow_the_graph():
    rng = np.random.default_rng(8)
    points = np.concatenate([rng.normal(c, 0.1, (100, 5)) for c in range(8)])
    near = learned_partitions.nearest(points, points, 10, np.arange(800))
    first = learned_partitions.halve(points, 8)
    part = learned_partitions.settle(first, near, 8)
    size = np.bincount(part, minlength=8)
    assert np.bincount(first).tolist() == [100] * 8 and size.min() >= 90 and size.max() <= 110
    assert (part[near] == part[:, None]).mean() >= (first[near] == first[:, None]).mean() > 0.9


def test_neighbours_of_an_empty_table(spark):
    got = learned_partitions.neighbours(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert got.columns == ["query_id", "rank", "vec_id", "score"] and got.count() == 0
