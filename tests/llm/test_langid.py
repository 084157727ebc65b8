import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quarry.llm import langid
from quarry.llm.langid import Rule, identify
from quarry.llm.textwords import Words

SOUNDS = {"aa": "ka ma ra to lo mi".split(), "bb": "sch itz ung ver ein ach".split(), "cc": "ção ões lha nha ável é".split()}


def docs(frame, n=240):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SOUNDS))
        rows.append((i, " ".join("".join(rng.choices(SOUNDS[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(5, 60))), lang))
    return frame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy(frame):
    df = docs(frame)
    got = identify(df, F.col("doc_id") % 3 != 1).join(df, "doc_id").collect()
    held = [r for r in got if r.doc_id % 3 == 1]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    again = identify(df.repartition(7), F.col("doc_id") % 3 != 1).join(df, "doc_id").collect()
    assert {r.doc_id: r.lang_pred for r in got} == {r.doc_id: r.lang_pred for r in again}


def test_label_source_and_id_are_no_inputs(frame):
    df = docs(frame)
    other = df.withColumn("lang", F.when(F.col("doc_id") % 3 == 1, F.lit("zz")).otherwise(F.col("lang")))
    a = {r.doc_id: (r.lang_pred, r.score) for r in identify(df, F.col("doc_id") % 3 != 1).collect()}
    b = {r.doc_id: (r.lang_pred, r.score) for r in identify(other, F.col("doc_id") % 3 != 1).collect()}
    assert a == b


def test_subwords_of_a_word():
    rule = Rule(grams=(2, 3), buckets=1 << 30)
    words = Words(pa.array(["ab ab cde", None, "ab"]), lower=True)
    buckets, cuts, back = langid._subwords(words, rule)
    sizes = np.diff(cuts)[back]
    assert sizes.tolist() == [3 + 2, 3 + 2, 4 + 3, 3 + 2]  # <a ab b> <ab ab>; <c cd de e> <cd cde de>
    assert len(set(buckets[cuts[back[0]]:cuts[back[0] + 1]].tolist())) == 5


def test_calibration_rejects_what_it_cannot_tell(frame):
    df = docs(frame)
    odd = frame([(1000, "zqzq wxwx 123 jyjy", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in identify(df.union(odd), F.col("doc_id") % 3 != 1).collect()}
    assert got[1000].score < np.median([r.score for r in got.values()])


def test_hard_rows(hard, none):
    got = identify(hard, F.col("doc_id") < 6).collect()
    assert len(got) == hard.count()
    by = {r.doc_id: r for r in got}
    assert by[0].lang_pred == by[1].lang_pred == by[2].lang_pred == "und" and by[0].score == 0 and by[0].rejected
    assert by[5].lang_pred == "en" and by[8].lang_pred == "en"
    assert identify(none, F.lit(True)).count() == 0
    assert {r.lang_pred for r in identify(hard, F.lit(False)).collect()} == {"und"}


def test_many_languages_hot_ids_and_copies(frame):
    rows = [(7, f"hot id with text {i} of many", "en") for i in range(3000)] + [(8, "one text copied over and over", "en")] * 3000
    rows += [(100 + i, f"ein satz nummer {i}", f"l{i}") for i in range(1200)]
    df = frame(rows, "doc_id long, text string, lang string").select(F.col("doc_id").alias("doc"), "text", "lang")
    rule = Rule(sample_rows=2400)  # two rows of a language
    picked = langid._sample(df, rule).collect()
    assert len([r for r in picked if r.lang != "en"]) == 1200 and len([r for r in picked if r.lang == "en"]) < 20
    assert len({(r.lang, r.key) for r in picked}) == len(picked)
