import random

from quarry.llm.components import components
from quarry.llm.running import running_total
from quarry.llm.scratch import files_for, save


def test_components_against_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 200), rng.randint(0, 200)) for _ in range(120)] + [(500 + i, 501 + i) for i in range(40)]
    edges += [(900, 901 + i) for i in range(60)] + [(3, 3), (None, 4), (5, None)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


def test_running_total(spark):
    rng = random.Random(5)
    rows = [(rng.randint(0, 3), i, rng.randint(0, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, i long, v long").repartition(5)
    got = {r.i: r.s for r in running_total(df, ["k", "i"], "v", "s", "t").collect()}
    total = 0
    for _, i, v in sorted(rows):
        total += v
        assert got[i] == total
    assert running_total(df.where("false"), ["k", "i"], "v", "s", "t").count() == 0


def test_few_files_of_many_partitions(spark):
    from pyspark.sql import functions as F
    held = {"spark.sql.shuffle.partitions": "13", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in held}
    df = spark.range(500).select((F.col("id") * 7 % 500).alias("at"), F.lit(2).cast("long").alias("n"))
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        for files in (None, 1, 3):
            total = running_total(df, ["at"], "n", "upto", "t", files)
            assert files is None or len({f for f in total.inputFiles()}) <= files
            assert [(r.at, r.upto) for r in total.orderBy("at").collect()] == [(i, 2 * i + 2) for i in range(500)]
        assert len(save(df.repartition(13), "t", 2).inputFiles()) <= 2
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_near_dedup_writes_few_files(spark, frame, monkeypatch):
    """Out of a shuffle with many partitions, its tables have as many files as they are worth, not one a partition."""
    import corpus_pipeline
    from quarry.llm import components, oddsketch
    held = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in held}
    made = []

    def seen(df, name, files=None):
        out = save(df, name, files)
        made.append((name, len(out.inputFiles())))
        return out

    for module in (components, oddsketch):
        monkeypatch.setattr(module, "save", seen)
    texts = [" ".join(f"w{k % 150}x{i}" for i in range(30)) for k in range(300)]
    docs = save(frame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), "t")
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        kept = corpus_pipeline.near_dedup(spark, docs, "")
        assert kept.rdd.getNumPartitions() <= files_for(spark, 300)
        assert sorted(r.doc_id for r in kept.collect()) == list(range(150))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert made and max(n for name, n in made if not name.endswith("-blockwise")) <= files_for(spark, 300)
