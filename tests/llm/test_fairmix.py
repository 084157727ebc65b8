import hashlib
import re

from quarry.llm.fairmix import Rule, mix, take

PATTERN = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, rule):
    """Water filling, source by source."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: rule.weights[i % len(rule.weights)] for i, s in enumerate(names)}
    total, full = rule.share * sum(sizes.values()), set()
    while True:
        left = total - sum(rule.most * sizes[s] for s in full)
        level = left / sum(weight[s] for s in names if s not in full) if len(full) < len(names) else 0
        more = {s for s in names if s not in full and level * weight[s] > rule.most * sizes[s]}
        if not more:
            return {s: float(rule.most * sizes[s]) if s in full else level * weight[s] for s in names}
        full |= more


def brute(docs, rule):
    sizes, queue, budget = {}, [], 0
    for _, s, t in docs:
        sizes[s] = sizes.get(s, 0) + len(PATTERN.findall(t or ""))
    want = targets(sizes, rule)
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    for s in names:
        so_far = 0
        own = [(hashlib.md5(f"{rule.seed}:{d}".encode()).hexdigest(), d, len(PATTERN.findall(t or ""))) for d, x, t in docs if x == s]
        for key, d, n in sorted(own):
            for e in range(rule.most):
                if so_far + e * sizes[s] < want[s]:
                    queue.append(((so_far + n + e * sizes[s]) / want[s], names.index(s), key, d, e, n))
            so_far += n
    taken = {d: 0 for d, _, _ in docs}
    for _, _, _, d, _, n in sorted(queue):
        budget += n
        if budget <= sum(want.values()):
            taken[d] += n
    return want, taken


def corpus():
    docs, d = [], 0
    for source, n in ((None, 5), ("a", 3), ("b", 60), ("é", 9), ("z", 0), ("zz", 30)):
        for i in range(n):
            docs.append((d, source, "w " * ((i * 7) % 23)))
            d += 1
    return docs + [(d, "tiny", "just one"), (d + 1, "empty", None)]


def test_against_brute_force(frame):
    docs = corpus()
    df = frame(docs, "doc_id long, source string, text string").repartition(5)
    for rule in (Rule(), Rule(weights=(1,)), Rule(share=0.4, seed="other")):
        got, order = mix(df, rule=rule)
        want, taken = brute(docs, rule)
        source = {d: s for d, s, _ in docs}
        for r in got.collect():
            assert abs(r.target - want[source[r.id]]) < 1e-6 and r.taken == taken[r.id], (r, want)
        times = [r.virtual_finish for r in order.orderBy("words_so_far", "virtual_finish").collect()]
        assert times == sorted(times)


def test_take_repeats_rows(frame):
    docs = corpus()
    df = frame(docs, "doc_id long, source string, text string")
    got = mix(df)[0].where("copies > 0").select("id", "copies").collect()
    rows = take(df)
    assert rows.schema == df.schema
    assert {r.doc_id: r["count"] for r in rows.groupBy("doc_id").count().collect()} == {r.id: r.copies for r in got}


def test_hard_rows(hard, none):
    got = mix(hard)[0].collect()
    assert len(got) == hard.count() and all(r.taken <= 3 * r.size for r in got)
    assert sum(r.taken for r in got if r.id in (7,)) in (0, 60, 120, 240, 360)
    assert take(hard).schema == hard.schema
    assert mix(none)[0].count() == 0 and take(none).count() == 0
    nothing = hard.where("doc_id in (1, 2)")
    assert [r.taken for r in mix(nothing)[0].collect()] == [0, 0]
