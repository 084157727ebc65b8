import hashlib
import random
import re
from collections import Counter

from quarry.llm.repeats import Rule, remove_repeats

PATTERN = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, window):
    words = [PATTERN.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    for w in words:
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1 for j in range(i, i + window)}
        yield len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)


def corpus(seed):
    rng = random.Random(seed)
    passages = [[f"p{p}w{i}" for i in range(rng.randint(30, 60))] for p in range(4)]
    texts = []
    for _ in range(40):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts += rng.choice(passages)[rng.randint(0, 3):] if rng.random() < 0.5 else [rng.choice("abc") + str(rng.randint(0, 999)) for _ in range(rng.randint(1, 40))]
        texts.append(rng.choice([" ", "\n", "  "]).join(parts))
    return texts + [texts[3], texts[3], None, "", "a " * 34, "a " * 36, "b " * 200, "b " * 35, "c d " * 50]


def test_against_brute_force(frame):
    for seed, rule in ((1, Rule()), (2, Rule(window=10, gram=3)), (3, Rule(window=12, gram=12))):
        texts = corpus(seed)
        df = frame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
        got = {r.doc_id: r for r in remove_repeats(df, rule=rule).collect()}
        for i, (n, gone, left) in enumerate(brute(texts, rule.window)):
            assert (got[i].n_words, got[i].n_removed) == (n, gone), (seed, i)
            assert got[i].kept_sha256 == hashlib.sha256(left.encode()).hexdigest()
            assert got[i].text == (left if gone else texts[i])


def test_hard_rows(hard, none):
    got = remove_repeats(hard)
    assert got.columns == ["doc_id", "text", "lang", "source", "kept", "n_chars", "n_words", "n_removed", "kept_sha256"]
    rows = got.collect()
    assert len(rows) == hard.count()
    assert sorted(r.n_removed for r in rows if r.doc_id in (5, 6, 7)) == [60, 60, 60, 30000]
    assert "text" not in remove_repeats(hard, texts=False).columns
    assert remove_repeats(none).count() == 0 and remove_repeats(none).columns == got.columns


def test_only_a_text_column(frame):
    got = remove_repeats(frame([("x " * 40,), ("y z",)], "text string")).collect()
    assert sorted((r.n_words, r.n_removed) for r in got) == [(2, 0), (40, 40)]
