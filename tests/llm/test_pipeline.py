"""Every stage of the pipeline against a brute-force version, and the passage of rows through it."""

import random

import pytest
from test_fairmix import brute as mix_brute
from test_oddsketch import brute as near_brute
from test_repeats import brute as repeat_brute

import __spark_entry__ as E
import corpus_pipeline as P

SYLLABLES = [a + b for a in "bcdfglmnprst" for b in ("a", "e", "io", "an", "er", "ong")]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))
    passage = [word() for _ in range(60)]
    rows = []
    for i in range(60):
        words = [word() for _ in range(rng.randint(20, 200))]
        if i % 7 == 0:
            words[10:10] = passage
        rows.append([i, " ".join(words), "en", rng.choice(["s0", "s0", "s1", None])])
    for i in range(60, 80):  # near and exact copies
        words = rows[i % 11][1].split()
        if i % 2:
            words[rng.randrange(len(words))] = word()
        rows.append([i, " ".join(words), "en", "s2"])
    rows += [[80, None, None, None], [81, "", "en", "s1"], [82, "a b " * 100, "en", "s1"], [82, "a b " * 100, "en", "s1"]]
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")


def test_stages(spark, corpus):
    stages = dict(P.STAGES)
    assert [n for n, _ in P.STAGES] == ["quality_rules", "near_dedup", "substring_dedup", "mixing", "best_fit_packing"]
    good = P.save(stages["quality_rules"](spark, corpus, ""), "t")
    assert good.columns == COLUMNS
    ids = {r.doc_id for r in good.collect()}
    assert not ids & {80, 81, 82} and ids >= {r.doc_id for r in corpus.collect() if r.text and len(r.text.split()) >= 50} - {82}

    near = P.save(stages["near_dedup"](spark, good, ""), "t")
    rows = [(r.doc_id, r.text) for r in good.collect()]
    assert near.columns == COLUMNS
    assert sorted(r.doc_id for r in near.collect()) == sorted({c for _, _, c in near_brute(rows)})

    cut = P.save(stages["substring_dedup"](spark, near, ""), "t")
    before = near.orderBy("doc_id").collect()
    after = cut.orderBy("doc_id").collect()
    assert cut.columns == COLUMNS
    for old, new, (_, gone, left) in zip(before, after, repeat_brute([r.text for r in before], 35), strict=True):
        assert new.text == (left if gone else old.text) and new.n_chars == len(new.text)
    assert any(o.text != n.text for o, n in zip(before, after, strict=True))

    mixed = P.save(stages["mixing"](spark, cut, ""), "t")
    from quarry.llm.fairmix import Rule
    _, taken = mix_brute([(r.doc_id, r.source, r.text) for r in after], Rule())
    sizes = {r.doc_id: len(r.text.split()) for r in after}
    got = {}
    for r in mixed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + sizes[r.doc_id]
    assert mixed.columns == COLUMNS and {d: n for d, n in got.items() if n} == {d: n for d, n in taken.items() if n}

    packed = stages["best_fit_packing"](spark, mixed, "").collect()
    assert sum(r.piece == 0 for r in packed) == mixed.count()
    filled = {}
    for r in packed:
        filled[r.sequence_id] = filled.get(r.sequence_id, 0) + r.length
    assert max(filled.values()) <= 1024 and sum(filled.values()) / 1024 / len(filled) > 0.9


def test_stages_on_an_empty_table(spark, corpus):
    docs = corpus.where("false")
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == COLUMNS and docs.count() == 0
    assert P.STAGES[-1][1](spark, docs, "").count() == 0


def test_null_ids_stay(spark, corpus):
    docs = corpus.limit(2).selectExpr("cast(null as long) doc_id", "'one two three four five six' text", "lang", "source", "n_chars")
    assert dict(P.STAGES)["near_dedup"](spark, docs, "").count() == 2


def test_registered():
    names = set(E.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert set(E.oracle_sql()) <= names


def test_any_further_column_is_carried(spark, corpus):
    """Names that the operators use themselves, in every stage."""
    from pyspark.sql import functions as F
    names = ["_x", "_copies", "_ident", "_text", "n_words", "kept", "carried0", "a.b"]
    docs = corpus.where("doc_id < 12 or doc_id > 70").select("*", *[F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names])
    stages = dict(P.STAGES)
    for stage in ("near_dedup", "substring_dedup", "mixing"):
        docs = P.save(stages[stage](spark, docs, "").select(*[F.col(f"`{c}`").alias(c.replace("a.b", "a-b")) for c in docs.columns]), "t")
        rows = docs.collect()
        names = [n.replace("a.b", "a-b") for n in names]
        assert docs.columns == [*COLUMNS, *names] and rows and all(r[n] == (n.replace("a-b", "a.b") + str(r.doc_id) if r.doc_id is not None else None)
                                                                    for r in rows for n in names)


def test_one_id_with_several_texts_keeps_each(spark, corpus):
    words = [" ".join(f"w{k}x{i}" for i in range(60)) for k in range(3)]
    rows = [(1, words[0]), (1, words[1]), (2, words[1] + " more"), (3, words[2]), (3, words[2] + " end"), (3, words[2])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], corpus.schema)
    got = sorted((r.doc_id, r.text.split()[0], len(r.text.split())) for r in dict(P.STAGES)["near_dedup"](spark, docs, "").collect())
    assert [g[:2] for g in got] == [(1, "w0x0"), (1, "w1x0"), (3, "w2x0")]
