import glob
import os

import pytest
from pyspark.sql import functions as F

from plans import plan_text
from quarry.operators import gain as G
from quarry.operators import packs as P
from quarry.sinks.writers import write_pair_costs, write_single_text, write_state_values
from quarry.sources.migration import FILE_STRIDE, read_packs_by_offset
from quarry.sources.text import read_lines, read_word_list


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_word_list_and_lines(spark, tmp_dir):
    p = os.path.join(tmp_dir, "words.txt")
    _write(p, "the\n\nThe\nthe\n a\n")
    assert sorted(r.word for r in read_word_list(spark, p).collect()) == [" a", "The", "the"]
    wide = read_lines(spark, p, min_partitions=3)
    assert wide.rdd.getNumPartitions() >= 3 and "Exchange" not in plan_text(wide) and "RoundRobin" not in plan_text(wide)
    assert sorted(r.value for r in wide.collect()) == ["", " a", "The", "the", "the"]
    assert wide.sparkSession.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")


def test_packs_keyed_by_byte_offset(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "p", "state_2"), "1,3\n2,2\n3,1\n")
    packs = read_packs_by_offset(spark, os.path.join(tmp_dir, "p"), [2])
    assert [(r.pack_id, r.runs) for r in packs.orderBy("pack_id").collect()] == \
        [(0, [1, 3]), (4, [2, 2]), (8, [3, 1])]


def test_offsets_over_files_and_splits(spark, tmp_dir):
    """Files cut into several splits, against offsets counted by hand."""
    rows, want = {}, []
    for n, name in enumerate(["a", "b/c", "d"]):
        lines = [f"{i % 7 + 1},{i + 1}" for i in range(40 * (n + 1))]
        if n == 1:
            lines[5] = ""
        rows[name], at = lines, 0
        for text in lines:
            if text:
                want.append((n, at, n * FILE_STRIDE + at, text))
            at += len(text) + 1
    for name, lines in rows.items():
        _write(os.path.join(tmp_dir, "p", "state_2", f"part={name.replace('/', '')}", "x.txt"), "\n".join(lines) + "\n")
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    kept = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "64")
    try:
        packs = read_packs_by_offset(spark, os.path.join(tmp_dir, "p"), [2])
        got = sorted((r.file_number, r.offset, r.pack_id, ",".join(map(str, r.runs))) for r in packs.collect())
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert got == sorted(want)


def test_an_over_long_file_is_an_error(spark, tmp_dir, monkeypatch):
    from quarry.sources import migration
    monkeypatch.setattr(migration, "FILE_STRIDE", 8)
    _write(os.path.join(tmp_dir, "p", "state_2"), "1,3\n2,2\n3,1\n")
    with pytest.raises(Exception, match="longer than its stride"):
        read_packs_by_offset(spark, os.path.join(tmp_dir, "p"), [2]).collect()


def test_single_file_and_pair_cost_sinks(spark, tmp_dir):
    top = spark.createDataFrame([("b", 2), ("a", 1)], "word STRING, n BIGINT")
    out = os.path.join(tmp_dir, "top")
    write_single_text(top, "word", out)
    files = glob.glob(os.path.join(out, "part-*"))
    assert len(files) == 1 and open(files[0]).read().split() == ["b", "a"]

    sizes = spark.createDataFrame([(i, float(i + 1)) for i in range(5)], "idx INT, size DOUBLE")
    line = P.item_line(sizes)
    packs = P.attach_sizes(P.generate_packs(line, [2, 3]), line).withColumn("idx", F.col("pack_id"))
    gains = G.pair_gains(packs, [(2, 3)], 15.0)
    path = os.path.join(tmp_dir, "costs")
    manifest = write_pair_costs(gains, path, n_files=5)
    assert os.path.isdir(os.path.join(path, "from_state=2", "to_state=3"))
    bounds = {r.file: r for r in manifest.collect()}
    assert sorted(bounds) == [0, 1, 2, 3, 4] and sum(r.n for r in bounds.values()) == 4 * 6
    before = (-1, -1)
    for i in range(5):
        files = glob.glob(os.path.join(path, "from_state=2", "to_state=3", f"file={i}", "*.parquet"))
        assert len(files) == 1
        keys = [(r.from_id, r.to_id) for r in spark.read.parquet(files[0]).collect()]
        assert keys == sorted(keys) and (keys[0], keys[-1]) == (tuple(bounds[i].first), tuple(bounds[i].last)) and keys[0] > before
        assert len(keys) == bounds[i].n and bounds[i].n in (4, 5)
        before = keys[-1]
    known = gains.withColumn("place", F.col("from_idx") * 6 + F.col("to_idx"))
    again = write_pair_costs(known, os.path.join(tmp_dir, "placed"), n_files=5, position="place")
    assert {r.file: r for r in again.collect()} == bounds
    few = write_pair_costs(gains.where("from_id = 0 AND to_id < 2"), os.path.join(tmp_dir, "few"), n_files=7)
    assert sorted((r.file, r.n) for r in few.collect()) == [(0, 1), (1, 1)]
    vals = packs.select("state", "pack_id", F.lit(1.0).alias("v"))
    vpath = os.path.join(tmp_dir, "values")
    write_state_values(vals, vpath)
    assert {"state=2", "state=3"} <= set(os.listdir(vpath))
