"""Pages, vectors, conversations and the pipeline."""

import itertools
import os
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from metricspark.llm import extraction, kdtree, preferences
from metricspark.llm.html_blocks import blocks


def test_blocks_of_broken_markup():
    page = """<!DOCTYPE html><HTML><head><title>no</title><script>var t="</p>";</script></head><body><p>a<b>b</b> &amp;
    c<br>d<p>e<ul><li>f<li>g</ul><!-- no <p>no</p> --><div hidden>h</div><a href='x>y'>i</a><style>p{}</style>&eacute;&#233;<p>j"""
    assert [b.text for b in blocks(page)] == ["ab & c d", "e", "f", "g", "h", "i éé", "j"]
    assert blocks(None) == blocks("") == blocks("<<<>") [1:] == [] and blocks("plain")[0].text == "plain"


def test_chain_finds_the_article_of_unseen_pages():
    chain = extraction.fit_chain(extraction.sample_pages(300, seed=1))
    wrong = total = 0
    for rows, labels in extraction.sample_pages(100, seed=2):
        wrong += sum(a != b for a, b in zip(chain.decode(rows), labels))
        total += len(labels)
    assert wrong <= total * 0.01


def test_viterbi_is_the_best_of_all_paths():
    draw = np.random.default_rng(3)
    names = [f"f{i}" for i in range(6)]
    for _ in range(20):
        chain = extraction.Chain({f: i for i, f in enumerate(names)}, draw.normal(size=(6, 2)), draw.normal(size=(2, 2)), draw.normal(size=2))
        rows = [[f for f in names if draw.random() < 0.5] for _ in range(6)]

        def score(path):
            out = chain.start[path[0]]
            for at, label in enumerate(path):
                out += sum(chain.emit[chain.number[f], label] for f in rows[at])
                out += chain.step[path[at - 1], label] if at else 0
            return out

        every = [[int(c) for c in f"{k:06b}"] for k in range(64)]
        assert abs(score(chain.decode(rows)) - max(map(score, every))) < 1e-9
    assert chain.decode([]) == []


def test_extraction_of_a_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").withColumn("text", F.lit("clash"))
    odd = pages.limit(1).withColumn("html", F.lit(None).cast("string"))
    got = extraction.extract_main_text(pages.unionByName(odd), extraction.train(pages)).collect()
    assert len(got) == pages.count() + 1
    assert sum(r["text"] == "" and r["n_chars"] == 0 for r in got) == 1
    for r in got[:50]:
        if r["html"]:
            assert "©" not in r["text"][-1:] and r["n_chars"] == len(r["text"]) > 0
    assert extraction.extract_main_text(pages.limit(0), extraction.train(pages.limit(0))).collect() == []


def test_page_of_another_layout():
    chain = extraction.fit_chain(extraction.sample_pages(300))
    page = """<body><header><a href=/>Site</a><nav><a href=/a>A</a></nav></header><div class="cookie-notice">We use cookies. <button>OK</button></div>
    <main><article><h1>Title of it</h1><p>First paragraph, rather long, with a full stop at its end.</p><div class="ad-slot">Buy now!</div>
    <h2>Part</h2><p>Second &lt;paragraph&gt; follows here.</p></article><section id="comments"><h3>Comments</h3><p>I liked this article a lot.</p></section></main>
    <aside><p>Related stories are listed here.</p></aside><form><label>Mail</label><input name=m></form><footer>&copy; All rights</footer></body>"""
    want = "Title of it First paragraph, rather long, with a full stop at its end. Part Second <paragraph> follows here."
    assert extraction.main_text(page, chain) == want


def test_pages_that_mark_nothing():
    chain = extraction.fit_chain(extraction.sample_pages(300) + extraction.sample_pages(150, bare=True))
    texts = ("Just plain text of a page.", "One. Two paragraphs of a bare page.", "Intro paragraph that is long enough to be text.")
    assert extraction.main_text(texts[0], chain) == texts[0]
    assert extraction.main_text("<p>One.</p><p>Two paragraphs of a bare page.</p>", chain) == texts[1]
    assert extraction.main_text(f"<main><p>{texts[2]}</p></main><footer>All rights</footer>", chain) == texts[2]
    table = f"<table><tr><td><a href=/a>Home</a><br><a href=/b>News</a></td><td><p>{texts[2]}</p></td></tr></table>"
    assert extraction.main_text(table, chain) == texts[2]
    assert extraction.main_text("<nav><a href=/a>Home</a></nav><footer>All rights</footer>", chain) == ""
    blocks = right = 0
    for rows, labels in extraction.sample_pages(200, seed=99, bare=True):  # pages the fit has not seen
        got = chain.decode(rows)
        blocks, right = blocks + len(labels), right + sum(a == b for a, b in zip(got, labels))
    assert right >= 0.93 * blocks


def test_decode_some_against_all_labellings():
    draw = random.Random(3)
    names = [f"f{i}" for i in range(6)]
    for _ in range(60):
        weights = np.array([[draw.uniform(-1, 3), draw.uniform(-3, 1)] for _ in names])
        step, start = np.array([[draw.uniform(-2, 2) for _ in range(2)] for _ in range(2)]), np.array([0.4, -0.3])
        chain = extraction.Chain({f: i for i, f in enumerate(names)}, weights, step, start)
        rows = [draw.sample(names, 2) for _ in range(draw.randint(1, 6))]
        allowed = [draw.random() < 0.6 for _ in rows]

        def score(labels):
            emit = sum(weights[chain.number[f]][k] for row, k in zip(rows, labels) for f in row)
            return start[labels[0]] + emit + sum(step[a][b] for a, b in zip(labels, labels[1:]))

        ways = [w for w in itertools.product((0, 1), repeat=len(rows)) if 1 in w and all(a or not k for a, k in zip(allowed, w))]
        want = list(max(ways, key=score)) if ways else [0] * len(rows)
        assert chain.decode_some(rows, allowed) == want


def test_deep_pages_take_time_by_their_length():
    page = "<div>" * 40_000 + "<b>x" * 5_000
    began = time.monotonic()
    found = blocks(page)
    assert extraction.page_features(found) and len(found) == 1
    assert time.monotonic() - began < 10  # the square of the depth took minutes
    long = blocks("<article>" + "<p>word &amp; word</p>" * 20_000 + "</article>")
    assert len(long) == 20_000 and {b.text for b in long} == {"word & word"}


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit("clash")).withColumn("rank", F.lit(1))


def brute_top(rows, k):
    whole = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    grid = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in whole]
    out = []
    for at, (q, own) in enumerate(grid):
        if q % 20 == 0:
            others = [(i, v) for n, (i, v) in enumerate(grid) if n != at and len(v) == len(own)]
            scored = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in others)
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scored[:k])]
    return sorted(out)


def test_top_k_against_brute_force(spark):
    draw = random.Random(4)
    rows = [(i, [draw.choice([-1.0, -0.5, 0.25, 0.3, 1.0]) for _ in range(5)]) for i in range(400)]
    rows += [(1000 + i, [0.25] * 5) for i in range(40)]  # copies: ties throughout
    rows += [(2000, None), (2001, [0.1, None, 0.2, 0.3, 0.4]), (2020, [float("nan")] * 5), (2040, [float("inf")] * 5), (None, [1.0] * 5),
             (2060, [1.0, 2.0]), (2061, [2.0, 1.0]), (2080, []), (20, rows[20][1])]
    got = sorted(map(tuple, kdtree.top_k(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=7, shard_rows=64).collect()))
    assert got == brute_top(rows, 7)
    assert kdtree.top_k(vectors(spark, rows).limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_each_row_is_a_candidate_and_asks_for_itself(spark):
    few = [(20, [1.0, 0.5]), (20, [0.5, 1.0]), (1, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [0.25, 0.25])]
    got = sorted(map(tuple, kdtree.top_k(vectors(spark, few), F.col("vec_id") % 20 == 0).collect()))
    assert got == brute_top(few, 20) and len(got) == 8
    draw = random.Random(7)
    rows = [(i % 150, [draw.choice([-1.0, -0.5, 0.25, 0.3, 1.0]) for _ in range(5)]) for i in range(300)]
    rows += [(3, [draw.uniform(-1, 1) for _ in range(5)]) for _ in range(200)]
    rows += [rows[40]] * 60 + [rows[3]] * 300  # copies of a row that asks and of one that does not
    got = kdtree.top_k(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=7, shard_rows=64)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 7)


def test_lists_are_cut_before_they_are_shuffled(spark):
    found = spark.range(1000).selectExpr("id % 10 AS query", "id % 10 AS query_id", "id AS vec_id", "id % 7 AS score")
    plan = kdtree._best(found, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_trees_bound_what_is_below():
    draw = np.random.default_rng(2)
    v = draw.integers(-100, 100, (1000, 4))
    tree = kdtree.build(np.arange(1000), np.arange(1000), v, 16)
    for node in range(len(tree.left)):
        own = tree.vectors[tree.start[node] : tree.end[node]]
        assert (own.min(axis=0) == tree.low[node]).all() and (own.max(axis=0) == tree.high[node]).all()
        assert tree.left[node] >= 0 or len(own) <= 16
    big = np.array([[2**40, -(2**40)], [2**39, 3]])
    assert kdtree.products(big, np.array([2**20, 1])).tolist() == [2**60 - 2**40, 2**59 + 3]


def branches(spark):
    rows = [
        (1, "chosen", 0, "user", "hi"), (1, "chosen", 1, "assistant", "good"), (1, "chosen", 2, "user", "x"),
        (1, "rejected", 0, "user", "hi"), (1, "rejected", 1, "assistant", "bad"),
        (2, "chosen", 0, None, None), (2, "rejected", 0, None, None), (2, "rejected", 0, None, None),
        (3, "chosen", 0, "user", "a"), (3, "rejected", 0, "user", "b"),
        (4, "rejected", 5, "assistant", None),
        (None, "chosen", 0, "user", "x"), (5, "chosen", None, "user", "x"), (6, "other", 0, "user", "x"),
        (7, "chosen", 0, "user", None), (7, "rejected", 0, "user", ""),
    ]
    df = spark.createDataFrame(rows, "pair_id long, side string, turn long, role string, text string")
    return df.withColumn("part", F.lit("clash")).withColumn("c", F.lit("clash"))


def test_preferences_split_at_the_first_difference(spark):
    got = preferences.preference_segments(branches(spark))
    flat = sorted((r["pair_id"], r["part"], r["turn"], r["rendered"], r["trained"]) for r in got.collect())
    assert flat == sorted([
        (1, "prompt", 0, "<|user|>\nhi\n", False), (1, "chosen", 1, "<|assistant|>\ngood\n", True), (1, "chosen", 2, "<|user|>\nx\n", False),
        (1, "rejected", 1, "<|assistant|>\nbad\n", True), (2, "prompt", 0, "<|unknown|>\n\n", False),
        (3, "chosen", 0, "<|user|>\na\n", False), (3, "rejected", 0, "<|user|>\nb\n", False), (4, "rejected", 5, "<|assistant|>\n\n", True),
        (7, "chosen", 0, "<|user|>\n\n", False), (7, "rejected", 0, "<|user|>\n\n", False),
    ])
    whole = {r["pair_id"]: r for r in preferences.assemble(got).collect()}
    assert whole[1]["prompt"] == "<|user|>\nhi\n" and whole[3]["prompt"] == ""
    (span,) = whole[1]["chosen_spans"]
    assert whole[1]["chosen"][span["start"] : span["end"]] == "good\n" and whole[2]["chosen_spans"] == []
    assert preferences.preference_segments(branches(spark).limit(0)).collect() == []


def test_preferences_run_no_python(spark):
    plan = preferences.preference_segments(branches(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [n for n, _ in cp.STAGES]
    assert names == ["toxicity", "near_dedup", "decontamination", "pii", "packing"]
    held = docs
    for name, stage in cp.STAGES[:-1]:
        before, held = {r["doc_id"] for r in held.collect()}, stage(spark, held, sf_dir).cache()
        assert held.columns == docs.columns and {r["doc_id"] for r in held.collect()} <= before, name
    rows = held.collect()
    assert all(r["n_chars"] == len(r["text"]) for r in rows) and 0.5 * docs.count() < len(rows) < docs.count()
    packed = cp.packing(spark, held, sf_dir)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in rows}


def test_dedup_stage_with_repeats_and_nulls(spark, sf_dir):
    import corpus_pipeline as cp

    text = " ".join(f"w{i}" for i in range(50))
    rows = [(2, text, "z"), (2, text, "a"), (3, text, "b"), (None, text, "c"), (None, None, "d"), (4, None, "e"), (5, "other text", "f")]
    got = cp.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), sf_dir).collect()
    assert sorted(((r["doc_id"] or -1), r["source"]) for r in got) == [(-1, "c"), (-1, "d"), (2, "a"), (4, "e"), (5, "f")]


def test_dedup_stage_keeps_texts_of_a_shared_id(spark, sf_dir):
    import corpus_pipeline as cp

    x, y, z = (" ".join(f"{c}{i}" for i in range(40)) for c in "xyz")
    rows = [(5, x), (5, y), (9, y), (9, z), (9, z), (7, x.upper()), (5, None), (8, " "), (8, "")]
    got = cp.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf_dir).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(5, x), (5, y), (9, z), (5, None), (8, "")], key=str)
    hot = [(1, " ".join(f"t{n}w{i}" for i in range(30))) for n in range(40)]
    got = cp.near_dedup(spark, spark.createDataFrame(hot, "doc_id long, text string"), sf_dir).collect()
    assert sorted(map(tuple, got)) == sorted(hot)


def test_stages_against_plain_python(spark, tmp_path):
    import corpus_pipeline as cp
    from metricspark.llm import packing, pii
    from metricspark.llm.queries import PII_KEY, TOXIC, tokenizer_path, toxicity_model

    draw, words = random.Random(3), [f"word{i}" for i in range(300)]
    texts = [" ".join(draw.choices(words, k=40)) for _ in range(40)]
    texts += [texts[i].replace(texts[i].split()[-1], "edited") for i in range(8)] + texts[8:12]
    texts += [f"{t} you vilething vilething" for t in texts[12:30]]
    leak = " ".join(f"item{i}" for i in range(14))
    texts += [f"{texts[i]} {leak}" for i in (30, 31)] + [f"card 4111 1111 1111 1111 12/27 {' '.join(draw.choices(words, k=30))}"]
    rows = [(i, t, len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    spark.createDataFrame([(i, int("vilething" in t)) for i, t, _ in rows], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, leak), (2, "short leak")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stage = lambda f, df=docs: sorted((r["doc_id"], r["text"]) for r in f(spark, df, str(tmp_path)).collect())
    plain = [r[:2] for r in rows]

    model = toxicity_model(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    want = [(i, t) for i, t in plain if model.score(t) < TOXIC]
    assert stage(cp.toxicity) == want and len(want) < len(rows)

    sets = [set(zip(*(t.lower().split()[k:] for k in range(5)))) for _, t in plain]
    group = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            for b in range(a):
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
    want = [r for r in plain if group[r[0]] == r[0]]
    assert stage(cp.near_dedup) == want and len(want) < len(rows)

    hit = [" ".join(leak.split()[k : k + 10]) for k in range(5)] + ["short leak"]
    want = [(i, t) for i, t in plain if not any(f" {h} " in f" {t} " for h in hit)]
    assert stage(cp.decontamination) == want and len(want) == len(rows) - 2

    names = pii.Pseudonyms(PII_KEY.encode())
    want = [(i, t.replace("4111 1111 1111 1111", names("card", "4111 1111 1111 1111"))) for i, t in plain]
    assert stage(cp.pii) == want != plain

    sums = {r["doc_id"]: r["n"] for r in cp.packing(spark, docs, str(tmp_path)).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    tokenizer = packing._parts(tokenizer_path()).tokenizer
    assert sums == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in plain}


def test_the_pipeline_writes_between_stages(spark, sf_dir, monkeypatch):
    import corpus_pipeline as cp

    seen = []

    def stage(session, docs, folder):
        seen.append(docs.inputFiles())
        return docs.where("doc_id IS NOT NULL")

    monkeypatch.setattr(cp, "STAGES", [("a", stage), ("b", stage), ("c", stage)])
    assert cp.run(spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id IS NOT NULL").count()
    assert "documents" in seen[0][0] and not any("documents" in f for files in seen[1:] for f in files)
    assert not set(seen[1]) & set(seen[2])


def test_queries_are_registered(spark, sf_dir):
    import __spark_entry__ as entry

    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", ["op1_preference_formatting", "op5_kd_tree_search", "op9_decontamination"])
def test_queries_equal_their_sql(spark, sf_dir, name):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as entry

    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{os.path.join(sf_dir, table)}.parquet'")
    df = entry.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    result = con.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, result)) == sorted(repr(tuple(r)) for r in df.select(*columns).collect())


def test_branches_of_a_table_with_clashing_columns(spark):
    long = "very long " * 50_000
    turns = spark.createDataFrame(
        [(2, 0, "user", "q", "x"), (2, 1, "assistant", long, "x"), (3, 0, "user", "q", None), (3, 1, "assistant", None, None)],
        "conv_id long, turn int, role string, text string, pair_id string",
    )
    odd = turns.selectExpr("*", "pair_id AS cut", "pair_id AS side")
    want = sorted(map(str, preferences.last_reply_branches(turns.drop("pair_id")).collect()))
    assert sorted(map(str, preferences.last_reply_branches(odd).collect())) == want and len(want) == 8


def test_stages_of_the_pipeline_take_small_batches(spark, monkeypatch):
    import corpus_pipeline as cp

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    rows = spark.range(0, 5000, 1, 1)
    monkeypatch.setattr(cp, "table", lambda *_: rows)
    stages = [("sizes", lambda spark, docs, _: docs.mapInArrow(sizes, "n bigint")), ("last", lambda spark, docs, _: docs)]
    monkeypatch.setattr(cp, "STAGES", stages)
    assert [r["n"] for r in cp.run(spark, "").collect()] == [1000] * 5
    assert spark.conf.get(name) == before


@pytest.mark.parametrize("stage", ["toxicity", "pii"])
def test_each_stage_takes_small_batches_by_itself(spark, monkeypatch, stage):
    import corpus_pipeline as cp

    @F.arrow_udf("double")
    def sizes(texts: pa.Array) -> pa.Array:
        return pa.array([float(len(texts))] * len(texts))

    score = lambda docs, model, name: docs.withColumn(name, sizes("text"))
    monkeypatch.setattr(cp, "table", lambda *_: None)
    monkeypatch.setattr(cp, "toxicity_model", lambda *_: None)
    monkeypatch.setattr(cp, "TOXIC", 1001)
    monkeypatch.setattr(cp, "score_texts", score)
    monkeypatch.setattr(cp, "pseudonymize", lambda docs, key: score(docs, None, "n").where("n <= 1000").drop("n"))
    docs = spark.range(0, 5000, 1, 1).selectExpr("id AS doc_id", "string(id) AS text", "0L AS n_chars")
    assert getattr(cp, stage)(spark, docs, "").count() == 5000


def test_texts_of_near_dedup_go_through_python_only_in_small_batches(spark, sf_dir):
    import corpus_pipeline as cp

    rows = [(1, "a b c", 2), (1, "A  b c", 1), (1, "a b c", 3), (2, "a b c", 0), (3, None, 2), (3, " ", 1), (None, "a b c", 0), (None, "a b c", 0)]
    got = cp.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string, raw long"), sf_dir)
    assert "ArrowEvalPython" not in got._jdf.queryExecution().toString()
    want = [(1, "A  b c", 1), (3, None, 2), (None, "a b c", 0), (None, "a b c", 0)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
