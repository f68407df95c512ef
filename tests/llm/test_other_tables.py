"""Vectors, pages and conversations against brute force, components, and the registered queries and pipeline."""

import base64
import collections
import hashlib
import math
import random
import time

import numpy as np
import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from stridelake.llm import covertree, graph, minhash, preference, queries, warc

SF = "/root/testdata/sf0.001"


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)] + [(300 + i, 301 + i) for i in range(60)] + [(5, 5)]
    parent = {n: n for e in edges for n in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {n: find(n) for a, b in edges if a != b for n in (a, b)}
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want


def test_vectors(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(150, 12))
    x[50:90] = x[:40] + rng.normal(scale=0.12, size=(40, 12))
    x[90:120] = x[7]
    x[120] = 3 * x[8]
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    rows += [(200, None, 1), (201, [0.0] * 12, 1), (202, [math.nan] * 12, 1), (203, [math.inf] + [1.0] * 11, 1), (204, [1.0, None] + [1.0] * 10, 1), (205, [], 1),
             (206, [1.0, 2.0], 1), (207, [2.0, 4.0], 1), (None, [float(v) for v in x[9]], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= 0.95
    got = {r["vec_id"]: r for r in covertree.near_duplicates(df).collect()}
    assert len(got) == len(rows)
    for i in range(150):
        extra = int(near[i, 9])  # the row without an id
        assert got[i]["n_links"] == near[i].sum() - 1 + extra
        reach, todo = {i}, [i]
        while todo:
            for j in np.flatnonzero(near[todo.pop()]):
                if j not in reach:
                    reach.add(j)
                    todo.append(j)
        assert got[i]["component_id"] == min(reach) and got[i]["kept"] == (i == min(reach))
    assert all((got[i]["n_links"], got[i]["component_id"]) == (0, i) for i in range(200, 206))
    assert got[207]["component_id"] == 206
    assert covertree.near_duplicates(df.limit(0)).count() == 0


def test_dual_traversal_over_several_levels():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 4))
    x /= np.linalg.norm(x, axis=1)[:, None]
    path = covertree.cover_tree(x)
    a, b = covertree.dual_traversal(x, path, x[:200], covertree.cover_tree(x[:200]), 0.95)
    assert set(zip(a, b)) == set(zip(*np.nonzero(x @ x[:200].T >= 0.95)))
    for level, radius in enumerate(covertree.RADII):
        assert (np.linalg.norm(x - x[path[level]], axis=1) <= radius + 1e-9).all()


def test_vectors_over_many_blocks_strips_and_rounds(spark, monkeypatch):
    monkeypatch.setattr(covertree, "BLOCK_VALUES", 16 * 24)  # 16 rows of 24 values
    monkeypatch.setattr(covertree, "STRIP_BLOCKS", 2)
    monkeypatch.setattr(covertree, "PIVOT_ROWS", 6)
    monkeypatch.setattr(covertree, "ROUND_VALUES", 1)
    rng = np.random.default_rng(21)
    loose, tight, other = rng.normal(size=(260, 24)), rng.normal(size=24) + rng.normal(scale=0.12, size=(90, 24)), rng.normal(size=(70, 9))
    loose[200:] = loose[:60] + rng.normal(scale=0.3, size=(60, 24))
    other[40:] = other[:30] + rng.normal(scale=0.2, size=(30, 9))
    rows = [v.astype(np.float32).tolist() for part in (loose, tight, other) for v in part]
    rows += [rows[3], rows[270], [2 * v for v in rows[270]]]
    edges, n = set(), len(rows)
    unit = [np.array(v) / np.linalg.norm(v) for v in rows]
    for i in range(n):
        edges |= {(i, j) for j in range(n) if i != j and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.95}
    least = list(range(n))
    for _ in range(n):
        for i, j in edges:
            least[i] = min(least[i], least[j])
    want = {i: (sum(a == i for a, _ in edges), least[i], least[i] == i) for i in range(n)}
    kept = []
    monkeypatch.setattr(covertree, "stored", lambda df, name, *a, f=covertree.stored, **b: kept.append(name) or f(df, name, *a, **b))
    for kind in ("float", "double"):
        kept.clear()
        found = covertree.near_duplicates(spark.createDataFrame(list(enumerate(rows)), f"vec_id long, embedding array<{kind}>")).collect()
        assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found} == want and len(found) == n
        assert kept.count("links") > 3  # rounds
        monkeypatch.setattr(covertree, "COUNTED", 100)  # blocks from a part of the rows


def test_unclustered_vectors_cost_less_than_one_whole_product():
    rng = np.random.default_rng(22)
    x, y = (v / np.linalg.norm(v, axis=1)[:, None] for v in rng.normal(size=(2, 4096, 64)))
    y[:5] = x[:5]
    px, py = covertree.cover_tree(x), covertree.cover_tree(y)
    took = {"traversal": [], "product": []}
    for _ in range(5):
        for name, run in (("traversal", lambda: covertree.dual_traversal(x, px, y, py, 0.95)), ("product", lambda: np.nonzero(x @ y.T >= 0.95))):
            began = time.perf_counter()
            found = run()
            took[name].append(time.perf_counter() - began)
            assert sorted(zip(*found)) == [(i, i) for i in range(5)]
    assert min(took["traversal"]) < min(took["product"])


def test_screen_loses_no_pair():
    rng = np.random.default_rng(23)
    near = rng.normal(size=(40, 400))[rng.integers(0, 40, 700)] + rng.normal(size=(700, 400)) * rng.choice([0.01, 0.1, 0.2, 0.25, 1.0], size=(700, 1))
    for x in (near, near[:, :3], rng.normal(size=(3000, 2)), np.ones((1, 5)), np.eye(6), -np.eye(6)[[0, 0, 3]]):
        x = x / np.linalg.norm(x, axis=1)[:, None]
        for cosine in (0.95, 0.999, 0.3, -0.2):
            a, b = covertree.dual_traversal(x, covertree.cover_tree(x), x[::2], covertree.cover_tree(x[::2]), cosine)
            product = x @ x[::2].T
            sure = product >= cosine + 1e-9
            got = np.zeros(product.shape, int)
            np.add.at(got, (a, b), 1)
            assert (got[sure] == 1).all() and got[product < cosine - 1e-9].sum() == 0


def test_directions_of_runs_lose_no_pair():
    rng = np.random.default_rng(25)
    loose = rng.normal(size=(900, 32))
    near = rng.normal(size=(30, 32))[rng.integers(0, 30, 900)] + rng.normal(size=(900, 32)) * rng.choice([0.05, 0.1, 0.15, 0.3], size=(900, 1))
    opposite = np.repeat(np.eye(32)[:1], 900, axis=0) * rng.choice([-1.0, 1.0], size=(900, 1))
    for x in (loose, near, opposite):
        y = np.concatenate([x[::3], loose[:50], x[::7] + rng.normal(scale=0.04, size=(129, 32))])
        order, runs = covertree._runs(covertree._units(x), rng.integers(0, 9, 900))
        x = covertree._units(x)[order]
        y = covertree._units(y)
        assert sorted(order) == list(range(900)) and max(np.diff([*runs, 900])) <= covertree.RUN_ROWS
        flat = np.tile(np.arange(900, dtype=np.int32), (len(covertree.RADII), 1))  # no level that merges: only directions and axes
        for cosine in (0.95, 0.5, -0.5):
            limit, axes = covertree._limit(cosine), covertree._axes(x, cosine)
            tree = covertree._Tree(x, flat, axes, limit, runs, covertree._directions(x, runs))
            found = list(covertree._traverse(tree, covertree._Tree(y, covertree.cover_tree(y), axes, limit), cosine))
            a, b = map(np.concatenate, zip(*found))
            product = x @ y.T
            got = np.zeros(product.shape, int)
            np.add.at(got, (a, b), 1)
            assert (got[product >= cosine + 1e-9] == 1).all() and got[product < cosine - 1e-9].sum() == 0
    two, first = np.eye(32)[:1] * [[1.0], [-1.0]], np.array([0])
    tree = covertree._Tree(two, flat[:, :2], axes, covertree._limit(0.95), first, covertree._directions(two, first))
    assert tree.least[0] <= -1.0  # opposite rows: nothing is screened


def test_pivots_fill_blocks():
    start, parts, end = covertree._packed(np.array([3, 4, 9, 0, 2, 25, 1]), 10, 5)
    assert start.tolist() == [5, 5, 6, 6, 7, 8, 11] and parts.tolist() == [1, 1, 1, 1, 1, 3, 1] and end == 12


def test_blocks_of_short_vectors_are_bounded(spark):
    rng = np.random.default_rng(24)
    units = covertree.unit_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(9000, 2)))], "vec_id long, embedding array<double>"))
    reps = units.selectExpr("digest", "vec_id as rep", "1L as n", "dim", "vector")
    treed = covertree.blocks(reps, 0.95)[0].collect()
    assert sum(r["n_rows"] for r in treed) == 9000 and max(r["n_rows"] for r in treed) < 1.2 * covertree.BLOCK_ROWS


def test_rounds_copy_a_bounded_volume_and_every_pair_once():
    amounts = [5, 9, 2, 7, 7, 1, 3]
    pairs = [(i, j, amounts[i], amounts[j]) for i in range(7) for j in range(i, 7)]
    rounds = list(covertree._rounds(pairs, 20))
    assert sorted(p for r in rounds for p in r) == sorted((i, j) for i, j, *_ in pairs)
    assert all(sum(amounts[k] for p in r for k in set(p)) <= 20 for r in rounds)


def test_warc(spark, tmp_path):
    rows = [(3, "http://a/ü\r\nx", "<p>é</p>"), (1, None, "<p>é</p>"), (2, "u", None), (4, "u", ""), (5, "u", "WARC/1.1\r\n\r\nx"), (None, "u", "only"),
            (6, "u", "y" * 300_000), (7, "u", "z"), (7, "u", "z"), (8, "u", "z")]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, record_type string")
    path = str(tmp_path / "w")
    warc.write_archives(pages, path)
    found = warc.read_archives(spark, path)
    least = collections.defaultdict(list)
    for i, _, html in rows:
        least[html or ""].append(i)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in least.items()}
    want = collections.Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        first = least[html or ""]
        kind = "response" if i == first else "revisit"
        want[i, kind, None if i == first else first, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), data if i == first else None] += 1
    got = collections.Counter((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"], None if r["payload"] is None else bytes(r["payload"])) for r in found.collect())
    assert got == want
    assert {r["page_id"] for r in found.where("record_type = 'revisit'").collect()} == {3, 4, 8}
    assert found.where("page_id in (5, 6) and url is not null").count() == 2
    assert [r["page_id"] for r in warc.read_archives(spark, path, "page_id long").where("page_id = 6").collect()] == [6]
    warc.write_archives(pages.limit(0), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0
    warc.write_archives(pages, str(tmp_path / "large"), revisit_from=5, compression="none")
    assert {r["page_id"] for r in warc.read_archives(spark, str(tmp_path / "large")).where("record_type = 'revisit'").collect()} == {3}


def brute_pair(chosen, rejected):
    k = 0
    while k < min(len(chosen), len(rejected)) and chosen[k] == rejected[k]:
        k += 1
    show = lambda turns: "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in turns)
    return k, show(chosen[:k]), show(chosen[k:]), show(rejected[k:])


def test_preferences(spark):
    sides = {1: ([("user", "a"), ("assistant", "b"), ("user", "c")], [("user", "a"), ("assistant", "x")]), 2: ([("system", "s")], [("user", "s")]),
             3: ([("user", "q"), ("assistant", "same")], [("user", "q"), ("assistant", "same")]), 4: ([("user", "y" * 20_000), ("assistant", "é" * 9)], [("user", "y" * 20_000), ("assistant", "")])}
    rows = [(p, side, k, r, t, 0) for p, both in sides.items() for side, turns in zip(("chosen", "rejected"), both) for k, (r, t) in enumerate(turns)]
    rows += [(5, "chosen", 0, "user", None, 0), (5, "chosen", 0, "user", None, 0), (5, "rejected", 0, None, "n", 0), (6, "chosen", 0, "user", "alone", 0)]
    turns = spark.createDataFrame(rows, "pair_id long, side string, turn int, role string, text string, prompt int")
    got = {r["pair_id"]: r for r in preference.format_pairs(turns).collect()}
    for p, (chosen, rejected) in sides.items():
        r = got[p]
        assert (r["prompt_turns"], r["prompt"], r["chosen"], r["rejected"]) == brute_pair(chosen, rejected)
        for side in ("chosen", "rejected"):
            assert [r[side][s["start"] : s["end"]] for s in r[f"{side}_mask"]] == [f"{t}<|end|>\n" for role, t in (chosen if side == "chosen" else rejected)[r["prompt_turns"] :] if role == "assistant"]
    assert got[5]["chosen"] == "<|user|>\n<|end|>\n" and got[5]["rejected"] == "<||>\nn<|end|>\n" and got[6]["rejected"] is None
    assert preference.format_pairs(turns.limit(0)).count() == 0


def test_every_conversation_with_an_answer_has_a_pair(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    want = {r[0] for r in turns.where("role = 'assistant'").select("conv_id").distinct().collect()}
    pairs = preference.format_pairs(preference.sampled_pairs(turns)).collect()
    assert {r["pair_id"] for r in pairs} == want and len(pairs) == len(want)
    one = turns.where(turns["conv_id"] == min(want))
    assert preference.format_pairs(preference.sampled_pairs(one)).count() == 1 and preference.sampled_pairs(turns.limit(0)).count() == 0


def test_registered_once_each():
    numbers = [int(n[2:].split("_")[0]) for n in queries.QUERIES]
    assert numbers == list(range(1, 14)) and "pipeline" in entry_module.queries()


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_queries_read_whole_tables(spark, name):
    table, column = {"op2": ("conversations", "conv_id"), "op5": ("embeddings", "vec_id"), "op6": ("pages", "page_id"), "op12": ("conversations", "conv_id")}.get(name.split("_")[0], ("documents", "doc_id"))
    ids = {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(column).collect()}
    rows = queries.QUERIES[name](spark, SF).collect()
    found = {r["pair_id" if name.startswith("op2_") else column] for r in rows}
    assert found <= ids and (found == ids or name.startswith("op2_"))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes, columns = [docs.count()], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name == "best_fit_packing":
            assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in docs.collect()}
            break
        assert out.columns == columns
        docs = corpus_pipeline.stored(out, "stage")
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] > 0
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "pii", "target_weights", "best_fit_packing"]


def test_near_duplicates_stage_keeps_texts_without_or_with_repeated_ids(spark):
    rnd = random.Random(11)
    texts = [" ".join(f"w{rnd.randrange(500)}" for _ in range(80)) for _ in range(9)]
    rows = [(None, t) for t in texts[:4]] + [(7, t) for t in texts[4:7]] + [(8, texts[7]), (None, texts[7]), (9, texts[7]), (None, texts[0]), (7, texts[4]), (10, texts[8])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect())
    assert got == collections.Counter([(None, t) for t in texts[:4]] + [(7, t) for t in texts[4:7]] + [(8, texts[7]), (10, texts[8])])


def test_near_duplicates_stage_links_from_80_percent(spark):
    assert minhash.plan(85) == (9, 6, 1) == minhash.PLAN
    assert all(minhash.plan(p).miss(p) <= minhash.MISS for p in (70, 80, 90))
    rnd, rows = random.Random(12), []
    for i in range(400):  # one changed word in the middle changes 5 shingles of n: similarity (n - 5) / (n + 5)
        n = rnd.randint(45, 60)
        words = [f"x{rnd.randrange(10**9)}" for _ in range(n + 4)]
        rows.append((2 * i, " ".join(words)))
        words[n // 2] = "other"
        rows.append((2 * i + 1, " ".join(words)))
    rows += [(900, " ".join(a := [f"y{k}" for k in range(48)])), (901, " ".join([*a[:20], "other", *a[21:]]))]  # 39 of 49: below
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()}
    assert got == {2 * i for i in range(400)} | {900, 901}
