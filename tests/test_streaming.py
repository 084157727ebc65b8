import os

from quarry.sources.text import stop_words_frame
from quarry.streaming.wordcount import start_word_count, streaming_word_counts


def test_streaming_word_count_matches_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("The cat, the hat.\nA cat!\n")
    with open(os.path.join(src, "b.txt"), "w") as f:
        f.write("cat and dog\n")
    counts = streaming_word_counts(spark, src, stop_words_frame(spark), max_files_per_trigger=1)
    q = start_word_count(counts, "wc_test", "memory", available_now=True)
    q.awaitTermination(120)
    got = {r.word: r.n for r in spark.sql("SELECT * FROM wc_test").collect()}
    assert got == {"cat": 3, "hat": 1, "dog": 1}
