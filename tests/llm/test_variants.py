import random
import re
import zlib
from collections import Counter

from quarry.llm.variants import Parts, Rule, group_variants, signatures


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _brute(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in words if v != w and abs(len(v) - len(w)) < 2 and _distance(v, w) == 1] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return sorted(out)


def _got(docs):
    return sorted(tuple(r) for r in group_variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect())


def _misspelt(rng, word):
    kind, at = rng.randrange(3), rng.randrange(len(word))
    letter = rng.choice("abcdeéßÀÿz")
    return [word[:at] + letter + word[at:], word[:at] + word[at + 1:], word[:at] + letter + word[at + 1:]][kind]


def test_equal_to_brute_force(frame):
    rng = random.Random(2)
    stems = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(7, 12))) for _ in range(25)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(40):
            w = stems[min(rng.randrange(25), rng.randrange(25))]
            for _ in range(rng.choice([0, 0, 0, 0, 1, 2])):
                w = _misspelt(rng, w)
            words.append(w.capitalize() if rng.random() < 0.2 else w)
        rows.append((i, rng.choice([" ", ", ", "1"]).join(words)))
    rows += [(3, rows[3][1]), (None, rows[4][1]), (99, None), (98, "")]
    got = _got(frame(rows, "doc_id long, text string"))
    assert got == _brute(rows) and any(r[1] for r in got)


def test_chains_of_forms(frame):
    rows = [(1, " ".join(["abcdefgh"] * 500 + ["abcdefgx"] * 40 + ["abcdefyx"] * 3))]
    got = _got(frame(rows, "doc_id long, text string"))
    assert got == _brute(rows)
    roots = {r[0]: r[2] for r in got}
    assert set(roots.values()) == {got[0][2]} and len(roots) == 3


def test_every_pair_one_edit_apart_shares_a_signature():
    rng = random.Random(7)
    same, next_ = Parts(4, 2), Parts(3, 1)
    for _ in range(3000):
        a = "".join(rng.choice("aabcdeéßzq") for _ in range(rng.randint(7, 11)))
        b = _misspelt(rng, a)
        if a == b or len(b) < 7 or _distance(a, b) != 1:
            continue
        short, long_ = sorted((a, b), key=len)
        roles = ((0, 0),) if len(a) == len(b) else ((1, 2),)
        mine, other = list(signatures(short, same, next_, 7)), list(signatures(long_, same, next_, 7))
        assert any({k for r, k in mine if r == x} & {k for r, k in other if r == y} for x, y in roles), (a, b)


def test_hard_rows(hard, none):
    rows = [(r.doc_id, r.text) for r in hard.collect()]
    assert _got(hard) == _brute(rows)
    assert _got(none) == []


def test_very_long_runs(frame):
    rows = [(1, "a" * 5000 + " " + "a" * 5000), (2, "a" * 4999 + "b " + "a" * 4999 + "b"), (3, "x" * 40)]
    got = {r.word: r.n_near for r in group_variants(frame(rows, "doc_id long, text string")).collect()}
    assert all(n == 1 for n in got.values()) and len(got) == 2
