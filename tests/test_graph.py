import random
from collections import deque

from adlens.operators.graph import walk
from adlens.streaming.crawl import Crawl, CrawlRules, stored_readings, stream_first_fit

SCHEMA = "oid string, panoid string, status string, lon double, lat double, timestamp long, neighbor_oids array<string>"
BOX = (37.99, 44.99, 38.01, 45.01)


def graph(seed, n=40):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        status = "success" if r.random() < 0.9 or i == 0 else "error"
        links = [f"o{r.randrange(n + 5)}" for _ in range(r.randrange(0, 4))] + ([None] if r.random() < 0.1 else [])
        rows.append((f"o{i}", f"p{i if r.random() < 0.9 else r.randrange(n)}", status, 38 + r.uniform(-0.012, 0.012), 45 + r.uniform(-0.012, 0.012), i, links))
    # Every oid of a panorama is the same place with the same links.
    first = {}
    return [first.setdefault(x[1], x) and (x[0], x[1], x[2], *first[x[1]][3:]) for x in rows]


def test_walk_by_levels_equals_one_task(spark):
    for seed in range(3):
        df = spark.createDataFrame(graph(seed), SCHEMA)
        for limit in (None, 12):
            a = {tuple(r) for r in walk(df, 38.0, 45.0, BOX, limit).collect()}
            b = {tuple(r) for r in walk(df, 38.0, 45.0, BOX, limit, local_nodes=0).collect()}
            assert a == b and a


def test_walk_never_expands_outside(spark):
    rows = [("a", "A", "success", 38.0, 45.0, 1, ["b"]), ("b", "B", "success", 39.0, 45.0, 1, ["c"]), ("c", "C", "success", 38.001, 45.0, 1, ["a"])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [r.panoid for r in walk(df, 38.0, 45.0, BOX).collect()] == ["A"]
    assert walk(df.limit(0), 38.0, 45.0).count() == 0


def test_crawl_by_levels_equals_one_task(spark, tmp_path):
    for seed in range(2):
        df = spark.createDataFrame(graph(seed), SCHEMA)
        rules = CrawlRules(BOX, 150.0, 3)
        got = []
        for name, local in (("one", 10**6), ("levels", 0)):
            c = Crawl(spark, f"{tmp_path}/{seed}-{name}", rules, local)
            got.append(({tuple(r) for r in c.run(df, 38.0, 45.0).collect()}, c.last().reason, {tuple(r) for r in c.table("visited").collect()}))
        assert got[0] == got[1]


def test_crawl_continues_where_it_stopped(spark, tmp_path):
    df = spark.createDataFrame(graph(5), SCHEMA)
    whole = Crawl(spark, f"{tmp_path}/whole", CrawlRules(None, 100.0, 1000))
    want = {(r.panoid, r.seq) for r in whole.run(df, 38.0, 45.0).collect()}
    for local in (10**6, 0):
        for _ in range(50):
            c = Crawl(spark, f"{tmp_path}/part{local}", CrawlRules(None, 100.0, 1000, 2), local)
            rows = c.run(df, 38.0, 45.0)
            if c.last().reason == "frontier empty":
                break
        assert {(r.panoid, r.seq) for r in rows.collect()} == want


def test_crawl_of_the_whole_table(spark, tmp_path):
    for seed in range(2):
        df = spark.createDataFrame(graph(seed), SCHEMA)
        got = []
        for name, local in (("one", 10**6), ("levels", 0)):
            c = Crawl(spark, f"{tmp_path}/{seed}-{name}", CrawlRules(None, 150.0, 2), local)
            got.append(({tuple(r) for r in c.run_all(df, 38.0, 45.0).collect()}, sorted(tuple(r) for r in c.table("visited").collect())))
        assert got[0] == got[1]
        assert [v[0] for v in got[0][1]] == sorted({r[1] for r in graph(seed) if r[2] == "success"})


def test_crawl_query_leaves_no_component(spark, tmp_path):
    from adlens.plans.walks import q_crawl

    far = [("c", "C", "success", 37.0, 44.5, 1, ["d"]), ("d", "D", "success", 37.01, 44.5, 1, ["c", "x"]), ("e", "E", "success", 38.9, 45.7, 1, [])]
    rows = [("a", "A", "success", 38.0, 45.0, 1, ["b"]), ("b", "B", "success", 38.01, 45.0, 1, ["a"]), ("f", "F", "error", 38.0, 45.1, 1, []), *far]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/panoramas.parquet")
    assert {r.panoid: r.level for r in q_crawl(spark, str(tmp_path)).collect()} == {"A": 0, "B": 1, "C": 0, "D": 1, "E": 0}


def test_queue_model(spark):
    rows = graph(11)
    nodes = {r[0]: r for r in rows if r[2] == "success"}
    start = min(nodes.values(), key=lambda r: ((r[3] - 38) * 111320 * 0.7071) ** 2 + ((r[4] - 45) * 111320) ** 2)
    seen, queue, out = {start[1]}, deque([start]), set()
    while queue:
        n = queue.popleft()
        out.add(n[1])
        for o in n[6]:
            if o in nodes and nodes[o][1] not in seen:
                seen.add(nodes[o][1])
                queue.append(nodes[o])
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.panoid for r in walk(df, 38.0, 45.0).collect()} == out


def test_stream_of_readings(spark, tmp_path):
    schema = "seq long, lon double, lat double, bearing_deg double, phones array<string>"
    src = f"{tmp_path}/in"
    rows = [(1, 38.0, 45.0, None, None), (2, 38.0, 45.0001, None, None), (3, 38.001, 45.0, None, ["1"]), (4, 38.003, 45.0, None, ["1"])]
    for i, part in enumerate((rows[:2], rows[2:])):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        q = stream_first_fit(stream, f"{tmp_path}/store", f"{tmp_path}/ck").trigger(availableNow=True).start()
        q.awaitTermination()
    assert sorted(r.seq for r in stored_readings(spark, f"{tmp_path}/store", stream.schema).collect()) == [1, 3]


def test_a_micro_batch_done_again_changes_nothing(spark, tmp_path):
    schema = "seq long, lon double, lat double, bearing_deg double, phones array<string>"
    parts = [
        [(1, 38.0, 45.0, None, None), (2, 38.0, 45.0001, None, None), (3, 38.001, 45.0, None, ["1"]), (7, None, None, None, None)],
        [(4, 38.003, 45.0, None, ["1"]), (5, 38.9999, 46.0, None, None)],
        [(6, 39.0, 46.0, None, None), (8, 38.0, 45.0, 10.0, None), (9, 41.0, 46.0, None, None)],
    ]
    store, calls = f"{tmp_path}/store", []

    class Stream:  # stands for a stream's writer: keeps the function of a batch
        writeStream = property(lambda self: self)

        def foreachBatch(self, f):
            calls.append(f)
            return self

        def option(self, *_):
            return self

    stream_first_fit(Stream(), store, "unused")
    frames = [spark.createDataFrame(p, schema) for p in parts]
    seqs = lambda: sorted(r.seq for r in stored_readings(spark, store, frames[0].schema).collect())
    want = ([1, 3, 7], [1, 3, 5, 7], [1, 3, 5, 7, 9])
    for number, df in enumerate(frames):
        for _ in range(2):  # the batch, and its replay
            calls[0](df, number)
            assert seqs() == want[number], number
    calls[0](frames[0], 0)
    assert seqs() == want[2]


def test_unequal_repeats_of_an_oid(spark):
    rows = [("a", "A", "success", 38.0, 45.0, 5, ["b"]), ("a", "A", "success", 38.0, 45.0, 3, ["c"]), ("b", "B", "success", 38.0, 45.001, 1, []), ("c", "C", "success", 38.0, 45.002, 1, [])]
    for parts in (1, 3):
        df = spark.createDataFrame(rows, SCHEMA).repartition(parts, "timestamp")
        assert {r.panoid for r in walk(df, 38.0, 45.0).collect()} == {"A", "C"}


def test_counts_of_the_crawl(spark, tmp_path):
    df = spark.createDataFrame(graph(5), SCHEMA)
    c = Crawl(spark, f"{tmp_path}/c", CrawlRules(None, 100.0, 1000, 2))
    c.run(df, 38.0, 45.0)
    n = {r.state: r.n for r in c.counts().collect()}
    assert n["processed"] == 3 and n["visited"] >= 3 and n.keys() == {"pending", "visited", "processed", "recorded", "failed"}
    assert n["pending"] == c.table("frontier").filter(f"seq > {c.last().done_seq}").count()
    c.drop()
    assert c.last() is None
