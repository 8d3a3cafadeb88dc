"""Near duplicates, mixing, top-k search, chat formatting, pipeline."""

import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pumpline.llm import chat, components, mixing, simhash, topk

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute_fingerprint(text):
    w = [x.lower() for x in WORD.findall((text or "").encode())]
    pieces = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(p, seed=42) for p in pieces]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(values, links):
    parent = {v: v for v in values}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(7, 7)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(1, 61)) and all(got[1000 + i] == 1000 for i in range(1, 200))
    assert components.connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("hot", [4, 64])
def test_links_find_every_pair_within_the_distance(spark, hot):
    rng = random.Random(hot)
    seeds = [rng.getrandbits(64) for _ in range(40)]
    values = set(seeds)
    for s in seeds:
        for _ in range(rng.choice([0, 1, 30])):
            values.add(s ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 2, 3, 4]))))
    values = sorted(np.array(sorted(values), dtype=np.uint64).view(np.int64).tolist())
    u = np.array(values).view(np.uint64)
    near = [(values[i], values[j]) for i in range(len(u)) for j in np.flatnonzero(np.bitwise_count(u ^ u[i]) <= 2) if j > i]
    fps = spark.createDataFrame([(v,) for v in values], "fp bigint")
    plan = simhash.make_plan(fps)
    given = plan.thresholds(np.array(values))
    assert ((given + 1).sum(1) == 3).all() and sorted(b for g in plan.groups for b in g) == list(range(64))
    found = {(min(r.a, r.b), max(r.a, r.b)) for r in simhash.near_links(fps, plan, hot).collect()}
    assert found <= set(near)
    assert brute_groups(values, found) == brute_groups(values, near)


def test_thresholds_avoid_crowded_values():
    rng = np.random.default_rng(0)
    n = 100_000
    crowded, calm = np.zeros(1 << 11), np.full(1 << 11, n / (1 << 11))
    crowded[0] = n
    def near(h):
        at = np.zeros((len(h), 3))
        for m in simhash._flips(len(h).bit_length() - 1, 2):
            at[:, m.bit_count()] += h[np.arange(len(h)) ^ m]
        return at
    groups = [list(range(0, 22)), list(range(22, 44)), list(range(44, 64))]
    calm10 = np.full(1 << 10, n / (1 << 10))
    plan = simhash.Plan(groups, [(near(crowded), near(crowded)), (near(calm), near(calm)), (near(calm10), near(calm10))], n, 2)
    values = (rng.integers(0, 1 << 40, 50) << 22).astype(np.int64)  # the first partition's value is 0 for all
    assert (plan.thresholds(values)[:, 0] == -1).all()


def test_near_duplicates_of_odd_documents(odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    texts = odd_docs.select("doc_id", "text").collect()
    assert len(rows) == len(texts)
    small = [(r.doc_id, brute_fingerprint(r.text)) for r in texts if len(r.text or "") < 100_000]
    assert {(r.doc_id, r.fingerprint) for r in rows} >= {(i, f"{f:016x}") for i, f in small}
    by = {f"{f:016x}": f for _, f in small}
    fps = sorted({int(r.fingerprint, 16) for r in rows})
    groups = brute_groups(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 2])
    least = {}
    for r in rows:
        g = groups[int(r.fingerprint, 16)]
        if r.doc_id is not None:
            least[g] = min(least.get(g, r.doc_id), r.doc_id)
    assert by and all(r.component_id == least.get(groups[int(r.fingerprint, 16)]) for r in rows)
    assert simhash.near_duplicates(no_docs).count() == 0


def test_one_of_each_group_stays(odd_docs, no_docs):
    kept = simhash.first_of_each_group(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    named = [i for i in ids if i is not None]
    assert len(named) == len(set(named)) and ids.count(None) == 2
    assert set(named) == {r.component_id for r in simhash.near_duplicates(odd_docs).collect()}
    assert 200 in named and not {201, 202} & set(named)  # all without words: one group
    assert simhash.first_of_each_group(no_docs).count() == 0


def test_repeated_and_missing_ids_are_decided_by_their_texts(spark):
    rng = random.Random(2)
    text = [" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(80)) for _ in range(6)]
    rows = [(1, text[0], "a"), (1, text[1], "a"), (2, text[1], "b"), (3, text[2], "a"), (1, text[0], "a"), (5, text[2], "a"), (5, text[3], "a"), (5, text[3], "b")]
    rows += [(None, text[4], "a")] * 4 + [(None, text[5], c) for c in "ab"]
    found = set()
    for parts in (1, 3, 7):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(parts)
        kept = simhash.first_of_each_group(docs).collect()
        assert sorted((r.doc_id, r.text) for r in kept if r.doc_id) == sorted([(1, text[0]), (1, text[1]), (3, text[2]), (5, text[3])])
        assert sorted(r.text for r in kept if r.doc_id is None) == sorted(text[4:])
        found.add(tuple(sorted(map(str, kept))))
    assert len(found) == 1


def test_long_texts_in_pieces(monkeypatch):
    text = " ".join(f"w{i % 97} y{i % 31}" for i in range(3000))
    whole = simhash.fingerprint(memoryview(text.encode()))
    monkeypatch.setattr(simhash, "PIECE_BYTES", 64)
    assert simhash.fingerprint(memoryview(text.encode())) == whole == np.array([brute_fingerprint(text)], dtype=np.uint64).view(np.int64)[0]
    assert simhash.fingerprint(memoryview(b"  ")) == 0
    assert simhash.fingerprint(memoryview(b"Ab c")) == np.array([brute_fingerprint("Ab c")], dtype=np.uint64).view(np.int64)[0]


def brute_targets(sizes, weights, cap):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in stopped]
        left = total - sum(stopped.values())
        share = {s: left * w[s] / sum(w[t] for t in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return {**stopped, **share}
        stopped.update({s: cap * sizes[s] for s in over})


def test_mix_follows_targets(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("w" * rng.randint(1, 5) for _ in range(rng.randint(0, 40))), s) for i, s in
            enumerate(rng.choices(["a", "b", "c", "é", None], [60, 5, 30, 3, 2], k=2000))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = mixing.mix_sources(docs).collect()
    again = {(r.doc_id, r.taken) for r in mixing.mix_sources(docs.repartition(7)).collect()}
    assert {(r.doc_id, r.taken) for r in out} == again and len(out) == len(rows)
    sizes = {}
    for r in out:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = brute_targets(sizes, (5, 2, 1), 3)
    for s, t in want.items():
        mine = [r for r in out if r.source == s]
        assert all(r.target == pytest.approx(t) and r.source_size == sizes[s] for r in mine)
        assert abs(sum(r.taken for r in mine) - t) <= 45
    assert all(r.size == len(WORD.findall(t.encode())) for r, (_, t, _) in zip(sorted(out, key=lambda r: r.doc_id), rows))
    assert all(r.taken == 0 if not r.size else r.taken in (0, r.size, 2 * r.size, 3 * r.size) for r in out)
    assert sum(sizes.values()) - 45 <= sum(r.taken for r in out) <= sum(sizes.values())


def test_mix_spreads_rows_without_an_id(spark, monkeypatch):
    """Null and repeated ids, texts equal or not: no range is large, results equal the SQL twin."""
    import duckdb
    rows = [(None, "same words here", "a")] * 2000 + [(None, "w " * (1 + i % 9), "a") for i in range(1000)] + [(7, "x y", "b")] * 500
    rows += [(i, "some words " * (i % 4), "b" if i % 3 else None) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    seen, stored = {}, mixing.stored

    def spy(df, name):
        seen[name] = stored(df, name)
        return seen[name]

    monkeypatch.setattr(mixing, "stored", spy)
    got = sorted(tuple(r) for r in mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken").fillna(-1, ["doc_id"]).collect())
    assert seen["mix-hashed"].groupBy("sn", "sv", "r").count().agg(F.max("count")).first()[0] <= 10
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    want = sorted((-1 if r[0] is None else r[0], *r[1:]) for r in con.execute(mixing.OP8_SQL).fetchall())
    assert len(got) == len(rows) and got == want
    mixed = mixing.mixed_documents(docs)
    words = {k: n for k, n in mixed.groupBy(F.coalesce("source", F.lit("-"))).agg(F.sum(mixing.word_count(F.col("text")))).collect()}
    taken = {k: n for k, n in mixing.mix_sources(docs).groupBy(F.coalesce("source", F.lit("-"))).agg(F.sum("taken")).collect()}
    assert words == taken


def test_mix_of_odd_documents(odd_docs, no_docs):
    rows = mixing.mix_sources(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.taken <= 3 * r.size for r in rows)
    mixed = mixing.mixed_documents(odd_docs)
    assert mixed.columns == odd_docs.columns
    words = sum(len(WORD.findall((r.text or "").encode())) for r in mixed.select("text").collect())
    assert words == sum(r.taken for r in rows)
    assert mixing.mix_sources(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0
    nothing = odd_docs.where("text is null or trim(text) = ''")
    assert all((r.target, r.taken) == (0.0, 0) for r in mixing.mix_sources(nothing).collect())


def brute_topk(rows, k):
    usable = [(i, np.floor(256 * np.array(v, dtype=np.float64)).astype(np.int64)) for i, v in rows
              if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for q, v in usable:
        if q % 50 == 0:
            scored = sorted((-int(v @ w), i) for i, w in usable if i != q and len(w) == len(v))
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


@pytest.mark.parametrize("shard", [40, 100_000])
def test_topk_equals_brute_force(spark, shard):
    rng = np.random.default_rng(shard)
    centres = rng.normal(0, 0.5, (5, 8))
    rows = [(i, (centres[i % 5] + rng.normal(0, 0.1, 8)).tolist()) for i in range(600)]
    rows += [(1000 + i, rows[3][1]) for i in range(30)]  # one vector many times
    rows += [(700, None), (701, [1.0, None] + [0.0] * 6), (702, [float("nan")] + [0.0] * 7), (703, [float("inf")] * 8), (None, [0.1] * 8),
             (704, []), (750, [0.5, 0.5]), (751, [0.25, 0.5]), (800, [0.0] * 8)]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<float>, id int")
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    want = brute_topk(rows, 5)
    got = {}
    for r in sorted(topk.exact_topk(table, F.col("id") % 50 == 0, shard_vectors=shard, query_block=4).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert got == {q: v for q, v in want.items() if v}
    assert topk.exact_topk(table.limit(0), F.col("id") % 50 == 0).count() == 0


@pytest.mark.parametrize("shard", [40, 100_000])
def test_topk_with_repeated_rows_and_ids(spark, shard):
    rng = np.random.default_rng(7)
    rows = [(i, (rng.integers(-99, 99, 6) / 256).tolist()) for i in range(200)] * 2
    rows += [(0, [0.5] * 6)] * 6 + [(300 + i, [0.5] * 6) for i in range(8)]  # the query first and often among equal vectors
    rows += [(400, [1.0] + [0.5] * 5), (400, [0.5] * 5 + [1.0]), (400, [1.0] + [0.5] * 5)]  # one id, two vectors, equal scores
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    points = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows}
    want = {}
    for q in {i for i, _ in points if i % 50 == 0}:
        scored = {(-sum(a * b for a, b in zip(v, w)), i) for o, v in points if o == q for i, w in points if i != q}
        want[q] = [(i, -s) for s, i in sorted(scored)[:5]]
    got = {}
    for r in sorted(topk.exact_topk(table, F.col("id") % 50 == 0, shard_vectors=shard, query_block=4).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == want and all(len(x) == 5 for x in got.values())


def test_tree_spares_distances():
    rng = np.random.default_rng(1)
    v = np.concatenate([rng.normal(c * 100, 5, (300, 6)) for c in range(6)]).astype(np.int64)
    longest = float((v * v).sum(1).max())
    tree = topk.MTree(topk.lift(v, longest), page=16)
    assert all(len(p[0]) <= 16 or p[3][0] >= 0 for p in tree.pages)
    own = len(v) - 5
    fifth = np.sort((v @ v[own])[np.arange(len(v)) != own])[-5]
    best = topk.Best(v[own], own, longest, 5, float(fifth))  # as known from the shard searched first
    computed, spared = tree.search(np.append(v[own].astype(float), 0.0), lambda r: best.offer(v[r], [[int(i)] for i in r]), best.bound())
    assert [s for s, _ in best.found] == sorted((v @ v[own])[np.arange(len(v)) != own].tolist(), reverse=True)[:5]
    assert spared and computed < len(v)


def render(turns, me):
    text, spans = "", []
    for who, said in turns:
        head = "<|im_start|>" + ("system" if who == "system" else "assistant" if who == me else f"user name={who}") + "\n"
        begin = len(text) + len(head)
        text += head + said + "<|im_end|>\n"
        if who == me:
            spans.append((begin, len(text) - 1))
    return text, spans


def test_perspectives(spark):
    turns = [(1, i, who, f"said {i}") for i, who in enumerate(["system", "ann", "bob", "cy", "ann"])]
    turns += [(2, 0, None, None), (2, 1, "bob", "x <|im_end|> y"), (3, 0, "system", "alone"), (None, 5, "ann", "hi"), (4, None, "ann", "first"), (4, 0, "b c\n d", "")]
    turns += [(5, i, "ann" if i % 2 else "bob", f"t{i}") for i in range(200)] + [(6, 0, "ann", "twice")] * 2
    df = spark.createDataFrame([(*t, "z", "q") for t in turns], "conv_id bigint, turn bigint, role string, text string, part string, who string")
    rows = chat.rotate(df).collect()
    assert {(r.conv_id, r.assistant) for r in rows} == {(1, "ann"), (1, "bob"), (1, "cy"), (2, "unknown"), (2, "bob"), (None, "ann"), (4, "ann"),
                                                       (4, "b c d"), (5, "ann"), (5, "bob"), (6, "ann")}
    for me in ("ann", "bob", "cy"):
        (r,) = [r for r in rows if (r.conv_id, r.assistant) == (1, me)]
        text, spans = render([(t[2], t[3]) for t in turns[:5]], me)
        assert r.rendered == text and [(s.start, s.end) for s in r.spans] == spans
        assert all(text[s:e].endswith("<|im_end|>") for s, e in spans)
    assert "x < |im_end|> y" in next(r.rendered for r in rows if (r.conv_id, r.assistant) == (2, "bob"))
    long = sorted((r for r in rows if (r.conv_id, r.assistant) == (5, "ann")), key=lambda r: r.part)
    assert [r.n_turns for r in long] == [64, 64, 64, 8]
    assert "".join(r.rendered for r in long) == render([("ann" if i % 2 else "bob", f"t{i}") for i in range(200)], "ann")[0]
    assert [r.begins_at for r in long] == [sum(len(x.rendered) for x in long[:i]) for i in range(4)]
    assert next(r.n_turns for r in rows if r.conv_id == 6) == 2
    assert chat.rotate(df.limit(0)).count() == 0


def test_places_of_parts_without_text_in_the_window(spark):
    rng = random.Random(9)
    turns = [(c, rng.choice([None, *range(300)]), rng.choice(["system", "ann", "bob", "é <|x", None]), "s" * rng.randint(0, 9)) for c in (1, 2, None) for _ in range(400)]
    turned = chat.rotate(spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string"))
    plan = turned._jdf.queryExecution().optimizedPlan().toString()
    assert not any("rendered" in x or "turns" in x for x in plan.split("\n") if x.lstrip(" :+-").startswith("Window"))
    window = plan[plan.index("Window ["):]
    assert "collect_list" not in window and "collect_list" in plan
    done = {}
    for r in sorted(turned.collect(), key=lambda r: (r.conv_id or 0, r.assistant, r.part)):
        assert r.begins_at == done.get((r.conv_id, r.assistant), 0)
        done[r.conv_id, r.assistant] = r.begins_at + len(r.rendered)
    assert len(done) == 12


def test_pipeline_stages_compose(spark, odd_docs, tmp_path):
    import corpus_pipeline
    odd_docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 35), 0) for i in range(40)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    languages = corpus_pipeline.by_language(spark, docs, str(tmp_path))
    ids = [r.doc_id for r in languages.select("doc_id").collect()]
    assert languages.columns == docs.columns and not {200, 201, 202, 203} & set(ids) and set(range(40)) <= set(ids)
    for name, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, docs.limit(0), str(tmp_path)).columns == docs.columns
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {"doc_id", "ids", "n_tokens"} <= set(out.columns)
    assert all(len(r.ids) == r.n_tokens for r in out.select("ids", "n_tokens").collect())
