"""Languages, benchmark items, the pipeline and the registered queries."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from pulsefold.llm import decontaminate, language

DIR = "/root/testdata/sf0.001"


def test_gradients_match_differences():
    settings = language.Settings(window=12, embedding=3, widths=(2, 3), filters=4)
    net = language.ByteNet(["a", "b", "c"], settings)
    net.params = {k: v.astype(np.float64) for k, v in net.params.items()}
    draw = np.random.default_rng(0)
    windows, target = draw.integers(0, 256, (5, 12)).astype(np.uint8), np.array([0, 1, 2, 1, 0])
    loss = lambda: -net.log_probabilities(windows)[np.arange(5), target].mean()
    for name, grad in net.gradients(windows, target).items():
        for at in map(tuple, np.argwhere(np.abs(grad) > 1e-4)[:5]):
            value, step = net.params[name][at], 1e-6
            net.params[name][at] = value + step
            up = loss()
            net.params[name][at] = value - step
            assert abs((up - loss()) / (2 * step) - grad[at]) < 1e-4
            net.params[name][at] = value


def test_windows_cover_all_bytes():
    cut, doc, filled = language.windows_of(pa.array(["", "abc", None, "d" * 25]), 10)
    assert doc.tolist() == [1, 3, 3, 3] and filled.tolist() == [3, 10, 10, 5]
    assert cut[0].tobytes() == b"abc" + b"\0" * 7 and cut[3].tobytes() == b"d" * 5 + b"\0" * 5


def test_languages(spark, frame):
    documents = spark.read.parquet(f"{DIR}/documents.parquet")
    more = frame("doc_id long, text string, lang string, source string, n_chars long",
                 (9001, None, "en", "s", 0), (9002, "", None, "s", 0), (9003, "123 ... 456", "en", "s", 0), (None, "words of a text", None, None, None))
    small = language.Settings(steps=300)
    rows = language.identify(documents.unionByName(more), small).collect()
    truth = {r.doc_id: r.lang for r in documents.collect()}
    assert len(rows) == len(truth) + 4
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows if r.doc_id is not None)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.9
    by_id = {r.doc_id: r for r in rows}
    assert {by_id[k].lang_pred for k in (9001, 9002, 9003)} == {"und"} and all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in language.identify(more.where("lang is null")).collect()} == {"und"}
    kept = language.accepted(documents.unionByName(more).withColumn("__", documents["doc_id"] * 0), small)
    assert kept.count() == len(truth) + 1 and kept.columns[-1] == "__"
    assert language.identify(documents.limit(0)).count() == 0


def edited(words, edits, draw, pool):
    words = list(words)
    for _ in range(edits):
        at = draw.randrange(len(words))
        kind = draw.randrange(3)
        if kind == 0:
            words[at] = draw.choice(pool)
        elif kind == 1:
            del words[at]
        else:
            words.insert(at, draw.choice(pool))
    return words


def test_recall_against_exact_distance():
    draw, settings = random.Random(2), decontaminate.Settings()
    pool = ["".join(draw.choice("abcdefgh") for _ in range(4)) for _ in range(400)]
    items = [[draw.choice(pool) for _ in range(draw.randint(5, 50))] for _ in range(120)]
    block = decontaminate.Block(list(range(120)), [" ".join(x) for x in items], settings)
    for part in (0, 0.5, 1):
        texts = [" ".join([draw.choice(pool) for _ in range(40)] + edited(x, int(part * settings.edits(len(x))), draw, pool) + [draw.choice(pool) for _ in range(40)]) for x in items]
        found = {(d, i): e for d, i, e, _, _ in block.find(pa.array(texts))}
        assert np.mean([(k, k) in found for k in range(120)]) >= (1 if part == 0 else 0.95)
        assert all(e <= settings.edits(len(items[i])) for (_, i), e in found.items())
        if part == 0:
            assert all(found[k, k] == 0 for k in range(120))
    clean = [" ".join(draw.choice(pool) for _ in range(100)) for _ in range(100)]
    assert block.find(pa.array(clean)) == []


def test_recall_of_long_items():
    draw, settings = random.Random(6), decontaminate.Settings()
    pool = ["".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(3000)]
    some = lambda n: [draw.choice(pool) for _ in range(n)]
    for n in (200, 500, 1000):
        items = [some(n) for _ in range(12)]
        block = decontaminate.Block(list(range(12)), [" ".join(x) for x in items], settings)
        for edits in (0, n * 15 // 100, settings.edits(n)):
            texts = [" ".join(some(60) + edited(x, edits, draw, pool) + some(60)) for x in items]
            found = {(d, i): e for d, i, e, _, _ in block.find(pa.array(texts))}
            assert sorted(found) == [(k, k) for k in range(12)], (n, edits)
            assert max(found.values()) <= edits
        assert block.find(pa.array([" ".join(some(n)) for _ in range(5)] + [None, ""])) == []


def test_long_items_at_any_place():
    # Against the least distance of every beginning: items cut by the text's end, copies side by side, related items.
    draw, settings = random.Random(7), decontaminate.Settings()
    pool = ["".join(draw.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    some = lambda n: [draw.choice(pool) for _ in range(n)]
    a = some(60)
    items = [a, edited(a, 5, draw, pool)[:55], some(60)]
    texts = [edited(a, 12, draw, pool) + a, some(9) + a[:49], a[11:] + some(20), edited(items[2], 6, draw, pool) * 2 + some(30) + edited(a, 3, draw, pool), a[30:]]
    block = decontaminate.Block([0, 1, 2], [" ".join(x) for x in items], settings)
    got = block.find(pa.array([" ".join(x) for x in texts]))
    want = []
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            n, near = len(item), settings.edits(len(item))
            found = min((exact(item, text[k:k + n + near]), k) for k in range(len(text)))
            if found[0] <= near:
                want.append((d, i, *found, n))
    assert got == want and len(want) > 4


def exact(a, b):
    row = list(range(len(b) + 1))
    for x in a:
        above, row = row, [row[0] + 1]
        for j, y in enumerate(b):
            row.append(min(above[j] + (x != y), above[j + 1] + 1, row[j] + 1))
    return min(row)


def test_distances():
    draw = np.random.default_rng(4)
    items, windows = draw.integers(1, 5, (200, 7)).astype(np.uint64), draw.integers(1, 5, (200, 9)).astype(np.uint64)
    assert decontaminate.distances(items, windows).tolist() == [exact(a, b) for a, b in zip(items.tolist(), windows.tolist())]


def test_items_are_looked_for_in_small_runs(spark, monkeypatch):
    class Bounded:
        ids = [7]

        def find(self, column):
            return [(k, 0, 0, 0, 5) for k in range(len(column))] if column.nbytes > 2_100_000 else []

    monkeypatch.setattr(decontaminate, "blocks", lambda *_: [Bounded()])
    docs = spark.range(40, numPartitions=1).selectExpr("id AS doc_id", "repeat('ab cd ', 50000) AS text")
    assert sorted(r.doc_id for r in decontaminate.without_contaminated(docs, docs).select("doc_id").collect()) == list(range(40))
    assert decontaminate.contaminations(docs, docs).count() == 0


def test_contaminated_documents(spark, frame):
    item = "the quick brown fox jumps over one lazy dog again and again"
    docs = frame("doc_id long, text string, item_id string", (1, f"Intro. {item.upper()}! Outro", "a"), (2, "nothing here at all " * 5, "b"), (3, None, "c"), (4, "", "d"),
                 (5, item.replace("lazy", "sleepy").replace(" ", " | "), "e"), (5, item, "f"), (None, item, "g"))
    bench = frame("item_id long, text string", (7, item), (8, None), (9, "one two"), (10, ""))
    rows = decontaminate.contaminations(docs, bench, decontaminate.Settings(block_items=1)).collect()
    assert sorted((r.doc_id or 0, r.item_id, r.distance, r.first_word) for r in rows) == [(0, 7, 0, 0), (1, 7, 0, 1), (5, 7, 0, 0), (5, 7, 1, 0)]
    assert sorted(r.item_id for r in decontaminate.without_contaminated(docs, bench).collect()) == ["b", "c", "d"]
    assert decontaminate.contaminations(docs, bench.limit(0)).count() == 0
    assert decontaminate.contaminations(docs.limit(0), bench).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    found = {r.doc_id for r in decontaminate.contaminations(docs, spark.read.parquet(f"{DIR}/benchmark.parquet")).collect()}
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, DIR), name)
        assert docs.count() <= before
        before = docs.count()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        if name == "benchmark_decontamination":
            assert not found & {r.doc_id for r in docs.collect()}
        if name == "secret_scan":
            assert docs.where("text rlike '[0-9a-f]{24,}'").count() == 0
    assert before > 100 and docs.where("n_tokens <> size(ids)").count() == 0


def test_registration():
    names = contract.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names


@pytest.mark.parametrize("name", [n for n in contract.queries() if n.startswith("op")])
def test_queries_keep_every_row(spark, name):
    out = contract.queries()[name](spark, DIR)
    if name.startswith("op3_"):
        assert {"doc_id", "item_id"} <= set(out.columns)
    elif name.startswith("op13_"):
        # Nodes, not rows: every conversation is in the root.
        assert out.where("depth = 0").first()["n_convs"] == spark.read.parquet(f"{DIR}/conversations.parquet").select("conv_id").distinct().count()
    else:
        table, times = {"op1": ("pages", 1), "op11": ("embeddings", 1), "op12": ("embeddings", 4)}.get(name.split("_")[0], ("documents", 1))
        assert out.count() == times * spark.read.parquet(f"{DIR}/{table}.parquet").count()
