import math
import re
from collections import Counter

from quarry.llm.backoff import Rule, score

PATTERN = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, order, discount):
    grams = [Counter(tuple(w[i:i + k]) for k in range(1, order + 1) for i in range(len(w) - k + 1))
             for w in (PATTERN.findall(t or "") for t in texts)]
    total = sum(grams, Counter())
    size = sum(n for g, n in total.items() if len(g) == 1)
    for text, own in zip(texts, grams, strict=True):
        words = PATTERN.findall(text or "")
        others, logs = max(size - len(words), 1), 0.0
        for i in range(len(words)):
            longest = min(order, i + 1)
            for k in range(longest, -1, -1):
                g = tuple(words[i + 1 - k:i + 1])
                c = total[g] - own[g] if k else 1
                if c > 0:
                    below = others if k <= 1 else total[g[:-1]] - own[g[:-1]]
                    logs += math.log(c / below) + (longest - k) * math.log(discount)
                    break
        yield len(words), logs


def test_against_brute_force(frame):
    texts = ["the cat sat on the mat", "the cat sat on a mat\nthe cat", "a dog", None, "", "zzz zzz zzz", "a dog", "the " * 50, "solo"]
    for order in (1, 2, 3, 4):
        df = frame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_words int").repartition(4)
        got = {r.doc_id: r for r in score(df, rule=Rule(order=order)).collect()}
        for i, (n, logs) in enumerate(brute(texts, order, 0.4)):
            assert got[i].n_words == n and abs(got[i].log_score - logs) < 1e-9
            assert n == got[i].n_unseen + sum(got[i][f"n_known_{k}"] for k in range(1, order + 1))
            assert got[i].per_word is None if not n else abs(got[i].per_word - logs / n) < 1e-9


def test_hard_rows(hard, none):
    got = score(hard).collect()
    assert len(got) == hard.count()
    copies = [r for r in got if r.doc_id in (6, 7)]
    assert len(copies) == 3 and len({r.log_score for r in copies}) == 1 and copies[0].n_known_3 == 58
    assert score(none).count() == 0
