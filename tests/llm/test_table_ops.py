"""Sharding, embedding and text near copies, mixing, components and the pipeline against brute force."""

import random

import numpy as np
import pytest
from conftest import same_rows
from pyspark.sql import functions as F
from test_text_ops import ODD, documents, shingle_set

import corpus_pipeline
from quaywatch.llm import collisions, mixing, ngramjoin, oracles, registry, sharding, tables


def united(n, links):
    up = list(range(n))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return [top(x) for x in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(rng.choice([60, 150]))] + [(k, k + 1) for k in range(200, 260)]
    want = united(261, links)
    got = {r.node: r.root for r in tables.components(spark.createDataFrame(links, "a long, b long")).collect()}
    touched = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: want[x] for x in touched}
    assert tables.components(spark.createDataFrame([], "a long, b long")).count() == 0


# Sharding.


def test_sharding_equals_sql(spark, duck, sf_dir):
    assert same_rows(registry.op1_sharding(spark, sf_dir), duck, oracles.SHARDS) == 200


def _sharded(rows, limit):
    """Splits buckets one after another; rows: (key hash, size)."""
    done, todo = {}, [(0, 0, rows)]
    while todo:
        depth, prefix, mine = todo.pop()
        if sum(s for _, s in mine) <= limit or depth == sharding.BITS:
            done[(depth, prefix)] = mine
            continue
        for bit in (0, 1):
            part = [r for r in mine if r[0] >> (sharding.BITS - depth - 1) & 1 == bit]
            if part:
                todo.append((depth + 1, prefix * 2 + bit, part))
    return done


def test_sharding_splits_only_what_is_too_large(spark):
    import hashlib

    rng = random.Random(3)
    data = [(k, "x" * rng.choice([0, 1, 10, 100, 400])) for k in range(300)] + [(7, "same row!!")] * 500 + [(9, "y" * 5000), (None, "no key"), (None, None)]
    df = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in data], "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit(1) for c in ("depth", "n", "prefix", "cell", "leaf", "shard")})
    got = sharding.shards(df, limit=600).collect()
    assert len(got) == len(data)
    key = lambda k, t: int(hashlib.md5((str(k) if k is not None else "text:" + (t or "")).encode()).hexdigest()[:15], 16)
    want = _sharded([(key(k, t), len(t or "")) for k, t in data], 600)
    leaf = {}
    for (depth, prefix), rows in want.items():
        for h, _ in rows:
            leaf[h] = format(prefix, f"0{depth}b") if depth else ""
    sizes, texts = {}, {k: t for k, t in data if k is not None}
    for r in got:
        if r.doc_id is not None:
            assert r.shard.split(".")[0] == leaf[key(r.doc_id, "")]
        sizes.setdefault(r.shard, []).append((r.doc_id, r.shard_bytes, r.shard_rows))
    for shard, rows in sizes.items():
        assert len(rows) == rows[0][2]
        assert rows[0][1] <= 600 or len(rows) == 1
        if "." not in shard and all(i is not None for i, _, _ in rows):
            assert sum(len(texts[i] or "") for i, _, _ in rows) == rows[0][1]
    assert sum(1 for s in sizes if "." in s) >= 500 * 10 // 600 + 1
    assert sharding.shards(df.where("false")).count() == 0
    assert {r.shard for r in sharding.shards(df).collect()} == {""}


def test_written_shards_hold_all_columns(spark, tmp_path):
    df = documents(spark, *[f"text {k} " * 50 for k in range(100)]).withColumns({c: F.lit(1) for c in ("leaf", "shard", "depth", "n", "_whole")})
    df = df.unionByName(df.limit(1).withColumn("doc_id", F.lit(5).cast("long")))
    sharding.write_shards(df, str(tmp_path / "s"), limit=4000)
    back = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "s"))
    assert sorted(map(str, back.select(*df.columns).collect())) == sorted(map(str, df.collect()))


# Embeddings.


def test_vectors_equal_sql(spark, duck, sf_dir):
    same_rows(registry.op2_collisions(spark, sf_dir), duck, oracles.NEAR_VECTORS)


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    vectors, labels = [], []
    for d, n in ((64, 300), (8, 150), (3, 60), (1, 5), (200, 60)):
        base = rng.normal(size=(n, d))
        for k in range(1, n, 2):  # near the threshold on both sides
            t = rng.normal(size=d)
            t -= t @ base[k - 1] / (base[k - 1] @ base[k - 1]) * base[k - 1]
            t = t / max(np.linalg.norm(t), 1e-9) * np.linalg.norm(base[k - 1])
            c = rng.choice([0.979, 0.9799, 0.9801, 0.99, 1.0])
            base[k] = (c * base[k - 1] + np.sqrt(1 - c * c) * t) * rng.choice([1, 1e-3, 50])
        vectors += [v.astype(np.float32).tolist() for v in base]
        labels += [int(x) for x in rng.integers(0, 2, n) // 2]
    odd = [None, [], [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0]]
    vectors += odd + [[1.0, 0.0]] * 4 + [[1e-30, 0.0]]
    labels += [0] * len(odd) + [5, 5, None, None] + [5]
    rows = [(k, v, l) for k, (v, l) in enumerate(zip(vectors, labels))] + [(3, vectors[3], labels[3]), (None, vectors[10], labels[10])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({c: F.lit(1) for c in ("row", "cell", "vector", "side", "links")})
    good = [k for k, (_, v, l) in enumerate(rows) if l is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = []
    for a in good:
        for b in good:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[k][1], dtype=np.float32).astype(float) for k in (a, b))
                if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= 0.98:
                    links.append((a, b))
    top = united(len(rows), links)
    least = {}
    for k, t in enumerate(top):
        ids = [rows[j][0] for j, u in enumerate(top) if u == t and rows[j][0] is not None]
        least[k] = min(ids) if ids else None
    want = sorted(((r[0] if r[0] is not None else -1), sum(k in l for l in links), least[k], r[0] == least[k]) for k, r in enumerate(rows))
    for how in (collisions.Search(), collisions.Search(block=20, tile=7)):
        got = sorted(((r.vec_id if r.vec_id is not None else -1), r.n_links, r.component_id, r.kept) for r in collisions.near_duplicates(df, how).collect())
        assert got == want
    assert len(links) > 150
    assert collisions.near_duplicates(df.where("false")).count() == 0


# Texts.


def test_join_equals_sql(spark, duck, sf_dir):
    same_rows(registry.op7_ngramjoin(spark, sf_dir), duck, oracles.NGRAM_JOIN)


def _texts(seed):
    rng = random.Random(seed)
    draw = lambda n: [rng.choice("abcdefghij") + rng.choice("klmnop") for _ in range(n)]
    passage, texts = draw(25), []
    for _ in range(40):
        one = draw(rng.choice([3, 5, 8, 40, 80]))
        if rng.random() < 0.4:
            one += passage
        for _ in range(rng.choice([1, 1, 2, 5])):
            two = list(one)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                two[rng.randrange(len(two))] = rng.choice("qrst") * 2
            texts.append(" ".join(two).upper() if rng.random() < 0.2 else "  ".join(two))
    hot = draw(120)
    for k in range(60):  # one large group of near copies
        two = list(hot)
        two[rng.randrange(120)] = f"n{k}"
        texts.append(" ".join(two))
    return texts


@pytest.mark.parametrize(("seed", "how"), [(1, ngramjoin.Join()), (2, ngramjoin.Join(run=500, block_sets=7, block_tokens=3000))])
def test_join_equals_brute_force(spark, seed, how):
    texts = [t for t in ODD if not t or len(t) < 120_000] + _texts(seed)
    df = documents(spark, *texts, extra=True)
    df = df.unionByName(df.where("doc_id in (3, 20, 21)")).repartition(3, "doc_id")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    sets = [shingle_set(t) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    top = united(len(rows), links)
    want = sorted((rows[k][0], len(sets[k]), sum(k in l for l in links), min(rows[j][0] for j in range(len(rows)) if top[j] == top[k])) for k in range(len(rows)))
    got = sorted((r.doc_id, r.n_shingles, r.n_links, r.component_id) for r in ngramjoin.join(df, how).collect())
    assert got == want and len(links) > 1000
    kept = ngramjoin.one_of_each(df, how)
    assert kept.columns == df.columns
    groups = {top[k] for k in range(len(rows)) if sets[k]}
    stays = sorted([min(rows[j][0] for j in range(len(rows)) if top[j] == g) for g in groups] + [rows[k][0] for k in range(len(rows)) if not sets[k]])
    assert sorted(r.doc_id for r in kept.collect()) == stays


def test_join_edges(spark):
    df = documents(spark, "a b c d e f", "a b c d e f", None, "", "a b c d e f g", "z")
    null = df.withColumn("doc_id", F.when(F.col("doc_id") != 1, F.col("doc_id")))
    got = sorted((r.doc_id is None, r.doc_id, r.n_links, r.component_id) for r in ngramjoin.join(null).collect())
    assert got[0] == (False, 0, 1, 0) or got[0][1] == 0
    assert [g for g in got if g[0]] == [(True, None, 1, 0)]
    assert ngramjoin.one_of_each(null).count() == 5
    other = df.withColumn("doc_id", F.lit(1).cast("long"))  # one id for all
    assert ngramjoin.one_of_each(other).count() == 5
    assert ngramjoin.join(df.where("false")).count() == 0 and ngramjoin.one_of_each(df.where("false")).count() == 0


# Mixing.


def _targets(sizes, most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        if not free:
            return capped
        level = (total - sum(capped.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > most * sizes[s]]
        if not over:
            return capped | {s: level * weight[s] for s in free}
        capped |= {s: most * sizes[s] for s in over}


@pytest.mark.parametrize("seed", range(3))
def test_mix_meets_its_targets(spark, seed):
    rng = random.Random(seed)
    data = []
    for k in range(600):
        s = rng.choice(["a", "b", "B", "é", None, "tiny"]) if seed < 2 else "only"
        if s == "tiny" and rng.random() < 0.9:
            s = "a"
        data.append((k, " ".join(["w"] * int(rng.paretovariate(0.9))) if rng.random() < 0.97 else rng.choice([None, "", "\t\n"]), "en", s, 0))
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit(1) for c in ("size", "block", "place", "passes", "state", "target", "shards", "extras")})
    how = mixing.Mix(rows=16)
    rows = mixing.decide(df, how).collect()
    assert sorted(r.doc_id for r in rows) == list(range(600))
    size = {k: len((t or "").split()) for k, t, *_ in data}
    sums = {}
    for k, _, _, s, _ in data:
        sums[s] = sums.get(s, 0) + size[k]
    want = _targets(sums)
    taken = {}
    for r in rows:
        s = data[r.doc_id][3]
        assert r["size"] == size[r.doc_id] and r.source_size == sums[s] and abs(r.target - want[s]) < 1e-6
        assert r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        taken[s] = taken.get(s, 0) + r.taken
    big = {s: max(size[k] for k, _, _, x, _ in data if x == s) for s in sums}
    for s in sums:  # documents are taken whole
        assert abs(taken[s] - want[s]) <= max(0.02 * want[s], big[s] / 2), (s, taken[s], want[s])
    again = mixing.decide(df.repartition(7), how).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    mixed = mixing.mix(df, how)
    assert mixed.columns == [*df.columns, "mix_shard", "order_key"]
    times = {r.doc_id: len(r.shards.split(",")) if r.shards else 0 for r in rows}
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {k: n for k, n in times.items() if n}


def test_mix_meets_its_targets_beside_giant_documents(spark):
    """Off by half of the smallest document left, however long the one that overshoots; 8 of 12 sources have a rest."""
    sizes = [(s, n) for s in range(12) for n in [*[20 + k % 11 for k in range(60)], 2000]]
    df = spark.createDataFrame([(k, "w " * n, f"s{s:02}") for k, (s, n) in enumerate(sizes)], "doc_id long, text string, source string")
    for docs, copies in ((df, 1), (df.unionByName(df), 2)):  # rows alike are drawn alike
        rows = mixing.decide(docs, mixing.Mix(rows=16)).collect()
        assert len(rows) == copies * len(sizes)
        for s in range(12):
            mine = [r for r in rows if sizes[r.doc_id][0] == s]
            passes = int(mine[0].target / mine[0].source_size + 1e-12)
            left = [copies * r["size"] for r in mine if r.taken == passes * r["size"]]
            assert abs(sum(r.taken for r in mine) - mine[0].target) <= min(left) / 2


def test_shards_take_even_and_disjoint_shares(spark):
    df = documents(spark, *["w " * 20] * 3000).withColumn("source", F.concat(F.lit("s"), F.col("doc_id") % 4))
    how = mixing.Mix(rows=8)
    rows = mixing.mix(df, how).groupBy("mix_shard").agg(F.count("*").alias("n"), F.count_distinct("source").alias("sources")).collect()
    assert len(rows) == 16 and max(r.n for r in rows) <= 1.5 * min(r.n for r in rows) and all(r.sources >= 3 for r in rows)


@pytest.mark.parametrize("n", [0, 1, 5, 1001])
def test_the_tree_halves_exactly_and_by_chance(spark, n):
    """Each node's units, in the order of chance, part into halves, whatever their number."""
    units = spark.range(n).select((F.col("id") % 7 == 0).cast("string").alias("source_key"), F.col("id").alias("block"), F.lit(0).alias("pass"), F.xxhash64("id").alias("_chance"))
    got = {r.block: r.node for r in mixing._shards(units, levels=3, bins=4).collect()}

    def halved(blocks, node, level):
        if level == 3:
            return {b: node for b in blocks}
        half = (len(blocks) + node % 2) // 2
        return halved(blocks[:half], 2 * node, level + 1) | halved(blocks[half:], 2 * node + 1, level + 1)

    assert got == halved([r.block for r in sorted(units.collect(), key=lambda r: r["_chance"])], 0, 0)


def test_mixed_shards_are_written_in_their_order(spark, tmp_path):
    df = documents(spark, *[f"w {k}" for k in range(90)])
    how = mixing.Mix(rows=4, levels=2)
    mixing.write_mixed(df, f"{tmp_path}/mixed", how)
    want = {(r.mix_shard, r.order_key, r.doc_id) for r in mixing.mix(df, how).collect()}
    for shard in {s for s, _, _ in want}:
        rows = [(shard, r.order_key, r.doc_id) for r in spark.read.parquet(f"{tmp_path}/mixed/mix_shard={shard}").coalesce(1).collect()]
        assert rows == sorted(w for w in want if w[0] == shard)


def test_mix_is_native(spark, sf_dir):
    plan = registry.op4_mixing(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert mixing.decide(documents(spark).where("false")).count() == 0
    assert mixing.decide(documents(spark, None, "")).select(F.sum("taken")).first()[0] == 0


# Pipeline.


def test_pipeline_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_copies", "decontaminate", "mix", "shard"]
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES:
        steps.append(tables.written(stage(spark, steps[-1], sf_dir), "test-stage"))
    assert all(s.columns == docs.columns for s in steps[:-1])
    good = {r.doc_id for r in registry.op10_quality(spark, sf_dir).collect() if r.predicted}
    one = {r.doc_id: r.text for r in steps[1].collect()}
    assert set(one) == good
    ids = sorted(one)
    sets = [shingle_set(one[i]) for i in ids]
    links = [(a, b) for a in range(len(ids)) for b in range(a) if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    assert sorted(r.doc_id for r in steps[2].collect()) == [ids[k] for k, t in enumerate(united(len(ids), links)) if t == k]
    items = [shingle_set(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = sorted(r.doc_id for r in steps[2].collect() if not any(q and 5 * len(q & shingle_set(r.text)) >= 4 * len(q) for q in items))
    assert sorted(r.doc_id for r in steps[3].collect()) == clean
    left = {r.doc_id: r for r in steps[3].collect()}
    sums = {}
    for r in left.values():
        sums[r.source] = sums.get(r.source, 0) + len(r.text.encode().split())
    want, taken = _targets(sums), {}
    for r in steps[4].collect():
        taken[r.source] = taken.get(r.source, 0) + len(r.text.encode().split())
        assert r.doc_id in left
    big = {s: max(len(r.text.encode().split()) for r in left.values() if r.source == s) for s in sums}
    assert all(abs(taken.get(s, 0) - want[s]) <= max(0.05 * want[s], big[s] / 2) for s in sums)
    assert steps[5].count() == steps[4].count()
    assert sorted(map(str, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(str, steps[5].collect()))


def test_blocks_meet_only_over_shared_prefix_tokens(spark):
    """A chain of sets, each sharing prefix tokens with the next few, is one component; its blocks meet their neighbours, not all others. Ranges follow the input."""
    import struct

    pack = lambda tokens: struct.pack(f"<{len(tokens)}q", *tokens)
    n = 600
    rows = [(struct.pack(">QQ", 0, k), 40 + k // 200, pack([k, k + 1]), pack([k, k + 1]), pack([k, k + 1]) if k % 2 else pack([k + 5000]), k) for k in range(n)]
    prefixes = spark.createDataFrame(rows, "cls binary, n long, a binary, b binary, c binary, lead long")
    how = ngramjoin.Join(block_sets=8)
    blocks = ngramjoin._blocks(prefixes, prefixes.select("cls", F.lit(b"root").alias("root")), how).cache()
    assert blocks.where("not split").count() == 0 and blocks.groupBy("block").count().agg(F.max("count")).first()[0] <= 16
    at = {r.cls: (r.block, r.length) for r in blocks.collect()}
    want = set()
    for k in range(n - 1):
        (x, lx), (y, ly) = at[rows[k][0]], at[rows[k + 1][0]]
        if x != y and abs(lx - ly) <= 1:
            want.add((min(x, y), max(x, y)))
    # Under the third order only odd sets have the chain's tokens, k and k + 1, which no two of them share.
    got = {(r.i, r.j) for r in ngramjoin._meeting(prefixes, blocks).collect()}
    assert got == set()
    both = prefixes.withColumn("c", F.col("a"))
    got = {(r.i, r.j) for r in ngramjoin._meeting(both, blocks).collect()}
    assert got == want and len(got) < n
    texts = documents(spark, *["x" * 1000] * 10)
    assert ngramjoin.Join(range_tokens=10).ranged(texts) == 500 and ngramjoin.Join().ranged(texts) == 4 * tables.partitions(spark)


def test_equal_vectors_are_searched_for_once(spark):
    """Ten thousand equal vectors are one class in one unit; counts are whole."""
    df = spark.range(10_000).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.when(F.col("id") < 3, 0.001 * F.col("id")).otherwise(0.0)).alias("embedding"), F.lit(1).alias("label"))
    how = collisions.Search(block=16)
    got = collisions.near_duplicates(df, how).groupBy("n_links", "component_id").count().collect()
    assert [tuple(r) for r in got] == [(9999, 0, 10_000)]


def test_only_files_read_row_by_row_are_settled(spark, sf_dir, monkeypatch):
    wrote = []
    monkeypatch.setattr(tables, "written", lambda df, name: wrote.append(name) or df)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tables.settled(docs.where("doc_id > 3").select("doc_id", F.upper("text")), "no")
    for df in (docs.sample(0.5), docs.coalesce(1), docs.where(F.rand() < 0.5), docs.repartition(3), docs.limit(3), docs.dropDuplicates(["text"])):
        tables.settled(df, "yes")
    assert wrote == ["yes"] * 6
