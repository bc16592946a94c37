"""Near-duplicate operators against all pairs."""

import random
import re
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicspark.llm import blocks, components, embeddings, queries, similar_texts, simhash

from . import brute

SF_DIR = "/root/testdata/sf0.001"
DOC = "doc_id long, text string"


def words(rng, n):
    return [rng.choice("abcdefgh") + str(rng.randrange(400)) for _ in range(n)]


def near_copies(seed=1, groups=12, copies=6, n=120):
    """Texts in groups whose copies have some words replaced."""
    rng, out = random.Random(seed), []
    for _ in range(groups):
        base = words(rng, n)
        for c in range(copies):
            text = list(base)
            for _ in range(c):
                text[rng.randrange(n)] = "x" + str(rng.randrange(99))
            out.append((len(out), " ".join(text)))
    rng.shuffle(out)
    return out


def expected_simhash(docs):
    ids = sorted(d for d, _ in docs)
    prints = [brute.simhash(dict(docs)[d]) for d in ids]
    roots = brute.groups(len(ids), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    return {d: ("%016x" % p, ids[r]) for d, p, r in zip(ids, prints, roots)}


@pytest.mark.parametrize("small", [0, 64])
def test_simhash_all_pairs(spark, small, monkeypatch):
    """Both ways through a cell give the components of all pairs."""
    monkeypatch.setattr(simhash, "SMALL_CELL", small)
    monkeypatch.setattr(simhash.links, "__defaults__", (simhash.RADIUS, small))
    docs = near_copies() + [(900, None), (901, ""), (902, "  \t\n"), (903, "One"), (904, "oNE  "), (905, "One two")]
    found = simhash.near_duplicates(spark.createDataFrame(docs, DOC)).collect()
    got = {r.doc_id: ("%016x" % (r.fingerprint % 2 ** 64), r.component_id) for r in found}
    assert got == expected_simhash(docs)
    assert got[901][1] == 900 and got[904][1] == 903


def test_simhash_query_is_the_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.QUERIES["op5_simhash_near_dedup"](spark, SF_DIR).collect()}
    assert got == expected_simhash(docs)


def test_simhash_odd_rows(spark):
    docs = spark.createDataFrame([(None, "a b c d", 1), (5, "a b c d", 2), (5, "a b c d", 3), (7, None, 4)],
                                 DOC + ", fp int").withColumn("node", F.lit("x"))
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=repr)
    assert got == [(5, 5), (5, 5), (7, 7), (None, 5)]
    assert simhash.near_duplicates(docs.where("false")).count() == 0


def test_manhattan_never_exceeds_hamming(spark):
    rng = random.Random(3)
    pairs = [(rng.getrandbits(64) - 2 ** 63, rng.getrandbits(64) - 2 ** 63) for _ in range(300)]
    found = spark.createDataFrame(pairs, "a long, b long").select(
        "a", "b", F.bit_count(simhash.unary_counts(F.col("a")).bitwiseXOR(simhash.unary_counts(F.col("b")))).alias("m")).collect()
    for r in found:
        a, b = r.a % 2 ** 64, r.b % 2 ** 64
        counts = sum(abs((a >> s & 3).bit_count() - (b >> s & 3).bit_count()) for s in range(0, 64, 2))
        assert r.m == counts <= (a ^ b).bit_count()


def test_components_of_chain_star_and_loops(spark):
    links = [(i, i + 1) for i in range(60)] + [(500, i) for i in range(501, 700)] + [(9000, 9000), (None, 3)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 500 for i in range(500, 700)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_labels_are_smallest_reachable():
    rng = np.random.default_rng(0)
    near = rng.random((80, 80)) < 0.015
    near |= near.T
    assert blocks.labels(near).tolist() == brute.groups(80, lambda i, j: near[i, j])


def vectors(seed=0):
    rng, out = np.random.default_rng(seed), []
    for _ in range(40):
        base = rng.normal(size=16)
        for k in range(int(rng.integers(1, 9))):
            out.append((base + k * 0.05 * rng.normal(size=16)).tolist())
    return [(i, v) for i, v in enumerate(out)]


def test_embeddings_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "block_pairs", lambda *a: blocks.block_pairs(*a, side=16))
    rows = vectors() + [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [1.0, None]), (904, [])]
    rows += [(905, rows[0][1]), (906, [2 * x for x in rows[0][1]]), (907, [1.0, 2.0]), (908, [1.0, 2.01]), (None, rows[0][1])]
    found = embeddings.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cell", F.lit(1)), cell_rows=30, visits=None)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found.collect()}
    fit = [(i, np.array(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]

    def near(i, j):
        a, b = fit[i][1], fit[j][1]
        return len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95

    roots = brute.groups(len(fit), near)
    want = {i: (0, i, True) for i, _ in rows} | {
        fit[i][0]: (sum(near(i, j) for j in range(len(fit)) if j != i), fit[roots[i]][0], roots[i] == i) for i in range(len(fit))}
    want[None] = (0, None, False)
    assert got == want


def planted(seed, n, dim, low=0.951, high=0.98):
    """Unit vectors without clusters; the second half holds a partner of each at a cosine of ``low`` to ``high``."""
    rng = np.random.default_rng(seed)
    one, other = rng.normal(size=(2, n, dim))
    one /= np.linalg.norm(one, axis=1)[:, None]
    other -= (one * other).sum(axis=1)[:, None] * one
    other /= np.linalg.norm(other, axis=1)[:, None]
    cosine = rng.uniform(low, high, n)[:, None]
    return np.concatenate([one, cosine * one + np.sqrt(1 - cosine ** 2) * other])


@pytest.mark.parametrize("cells", [400, 4096])
def test_planted_pairs_meet_in_a_cell(cells):
    unit, n = planted(13, 10_000, 64), 10_000
    centroids = embeddings.fit_centroids(unit, cells, rounds=5)
    assert len(centroids) == cells
    home, visited = embeddings.homes(unit, centroids, 0.95)
    assert visited.shape[1] == embeddings.VISITS + 1
    meet = (visited[:n] == home[n:, None]).any(axis=1) | (visited[n:] == home[:n, None]).any(axis=1)
    assert meet.mean() >= 0.99


@pytest.mark.parametrize("visits", [embeddings.VISITS, None])
def test_embedding_links_over_hundreds_of_cells(spark, visits):
    """Pairs in 400 cells fitted on five vectors each; no link is false, none counts twice, and all cells in reach lose none."""
    unit = planted(12, 1500, 24)
    near = unit @ unit.T >= 0.95
    want = near.sum(axis=1) - 1
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(unit)], "vec_id long, embedding array<double>")
    rows = embeddings.near_duplicates(frame, cell_rows=8, max_cells=400, sample_rows=2000, visits=visits).collect()
    got = np.array([r.n_links for r in sorted(rows)])
    assert (got <= want).all() and got.sum() >= 0.97 * want.sum() and want.sum() >= 3000
    if visits is None:
        assert (got == want).all()


def test_embedding_links_of_the_tables(spark):
    """All links of 10,000 vectors with groups of near copies, as floats."""
    rows = spark.read.parquet("/root/testdata/check_s/embeddings.parquet").select("vec_id", "embedding")
    unit = np.array([r[0] for r in rows.orderBy("vec_id").select("embedding").collect()], float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    near = unit @ unit.T >= 0.95
    want, got = near.sum() - len(unit), embeddings.near_duplicates(rows).agg(F.sum("n_links")).first()[0]
    assert want > 10_000 and 0.999 * want <= got <= want
    assert embeddings.near_duplicates(rows.where("false")).count() == 0


def test_blocks_of_a_cell_are_dealt_to_all_tasks(spark):
    unit = planted(14, 300, 8)
    placed = spark.createDataFrame([(i, 1, 8, v.tolist(), 0, [0]) for i, v in enumerate(unit)],
                                   "vec long, n long, dim int, embedding array<double>, home int, cells array<int>")
    plan = embeddings.linked(placed, 0.95)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(dim#\d+, cell#\d+, _i#\d+, _j#\d+", plan)


@pytest.mark.parametrize("small", [0, 128])
def test_similar_texts_against_all_pairs(spark, small, monkeypatch):
    monkeypatch.setattr(similar_texts, "SMALL_CELL", small)
    docs = near_copies(seed=5) + [(900, None), (901, ""), (902, "one"), (903, "One "), (904, "one two")]
    docs += [docs[0], (None, docs[1][1])]
    frame = spark.createDataFrame([(*d, i) for i, d in enumerate(docs)], DOC + ", node int")
    kept = similar_texts.distinct_texts(frame)
    assert kept.columns == frame.columns
    plain = sorted((d for d in docs[:-1]), key=lambda d: d[0])
    roots = brute.groups(len(plain), lambda i, j: brute.jaccard(plain[i][1], plain[j][1]) >= 0.8)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({plain[r][0] for r in roots})
    assert similar_texts.distinct_texts(frame.where("false")).count() == 0


def test_a_line_repeated_often_does_not_hide_a_near_copy(spark):
    """Candidates are looked for by shingle sets, as links are decided."""
    rng = random.Random(8)
    docs = []
    for times in (20, 60):
        base, line = words(rng, 300), words(rng, 12)
        docs += [(len(docs), " ".join(base)), (len(docs) + 1, " ".join(base + line * times))]
        assert brute.jaccard(docs[-2][1], docs[-1][1]) >= 0.8
    assert sorted(r.doc_id for r in similar_texts.distinct_texts(spark.createDataFrame(docs, DOC)).collect()) == [0, 2]


def stay(spark, docs):
    return sorted(r.doc_id for r in similar_texts.distinct_texts(spark.createDataFrame(docs, DOC)).collect())


def test_a_family_just_below_does_not_hide_pairs_above(spark):
    """300 texts at 0.787 to each other, each with one partner at 0.802."""
    rng, docs = random.Random(9), []
    common = words(rng, 100)
    for i in range(150):
        first = f"own{i}"
        docs += [(2 * i + k, " ".join([*common, first, *(f"{c}{i}x{k}" for c in "abcdefghijkl")])) for k in (0, 1)]
    assert brute.jaccard(docs[0][1], docs[1][1]) >= 0.8 > brute.jaccard(docs[0][1], docs[2][1]) > 0.78
    assert stay(spark, docs) == [2 * i for i in range(150)]


def test_short_near_copies_are_all_found(spark):
    """Pairs at exactly 0.8 of 8 and 13 words: a word appended, the last one replaced."""
    rng, docs = random.Random(10), []
    for i in range(300):
        short, long = words(rng, 8), words(rng, 13)
        docs += [(4 * i, " ".join(short)), (4 * i + 1, " ".join([*short, "more"])),
                 (4 * i + 2, " ".join(long)), (4 * i + 3, " ".join([*long[:-1], "other"]))]
    assert brute.jaccard(docs[0][1], docs[1][1]) == brute.jaccard(docs[2][1], docs[3][1]) == 0.8
    assert stay(spark, docs) == list(range(0, 1200, 2))


def test_different_texts_of_one_id_both_stay(spark):
    rng = random.Random(11)
    one, two = words(rng, 60), words(rng, 60)
    docs = [(1, " ".join(one)), (1, " ".join(two)), (2, " ".join([*one, "more"])), (None, " ".join([*two, "more"]))]
    assert stay(spark, docs) == [1, 1]


def test_pairs_leave_a_block_only_if_enough_can_be_common(spark, tmp_path, monkeypatch):
    """200 texts share nine hot first shingles, one fewer than they need; only two share others as well."""
    real = similar_texts._across

    def counted(similarity):
        run = real(similarity)

        def both(found):
            out = run(found)
            (tmp_path / uuid.uuid4().hex).write_text(str(out.num_rows))
            return out

        return both

    monkeypatch.setattr(similar_texts, "_across", counted)
    own = [list(range(1000 + 100 * i, 1012 + 100 * i)) for i in range(200)]
    rows = [(i, i, 100, [*range(9), *(range(50, 55) if i < 2 else own[i][7:]), *own[i][:7]]) for i in range(200)]
    texts = spark.createDataFrame(rows, "node long, group long, n int, prefix array<long>")
    assert [tuple(r) for r in similar_texts.missing(texts).collect()] == [(1, 0)]
    assert sum(int(p.read_text()) for p in tmp_path.iterdir()) == 1


def test_segment_counts_of_both_ways_are_the_same(spark):
    rng = random.Random(4)
    prints = [rng.getrandbits(64) - 2 ** 63 for _ in range(200)]
    found = spark.createDataFrame([(p,) for p in prints], "p long").select(simhash.unary_counts(F.col("p")).alias("c")).collect()
    assert similar_texts._unary(np.array(prints).astype(np.uint64)).astype(np.int64).tolist() == [r.c for r in found]
